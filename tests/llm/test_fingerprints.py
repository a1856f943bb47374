"""Document fingerprints: span hashes, extensions and likeness against plain string work."""

from __future__ import annotations

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from seqwise.llm import fingerprints as fp

DOCS = "doc_id long, text string, fingerprint string, part string"


def words(rng, n, letters="ab é𝒳"):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("step", [5, 1 << 20])
def test_span_hashes_equal_as_the_spans_do(monkeypatch, step):
    monkeypatch.setattr(fp, "STEP", step)
    rng = random.Random(1)
    for _ in range(60):
        a, b = words(rng, rng.randint(0, 30)), words(rng, rng.randint(0, 30))
        g, h = fp.PrefixHash(a), fp.PrefixHash(b)
        for _ in range(30):
            i, j = sorted(rng.randint(0, len(a)) for _ in "ij")
            k, m = sorted(rng.randint(0, len(b)) for _ in "km")
            assert (g.span(i, j) == h.span(k, m)) == (a[i:j] == b[k:m])


def brute_prefix_hash(text):
    out = [[0], [0]]
    for k, (b, m) in enumerate(zip(fp.BASES, fp.MODULI)):
        for i, c in enumerate(text):
            out[k].append((out[k][-1] + (ord(c) + 1) * pow(b, i, m)) % m)
    return out


def test_arrays_and_marks_by_their_definition():
    rng = random.Random(4)
    for n in (0, 1, 2, 9, 10, 57, 300):
        t = words(rng, n)
        h = fp.PrefixHash(t)
        assert [x.tolist() for x in h.prefix] == brute_prefix_hash(t)
        at = fp.rungs(n)
        assert h.tails(at).tolist() == [fp.PrefixHash(t[n - k:]).whole[0] for k in at.tolist()]
        assert [fp.letters([fp.PrefixHash(t[:k]).whole[0]]) for k in at.tolist()] == [
            fp.fingerprint(h).split(".")[2][3 * k:3 * k + 3] for k in range(len(at))]


def brute_extension(a, i, b, j, back):
    n = 0
    while (i - n > 0 and j - n > 0 and a[i - n - 1] == b[j - n - 1]) if back else (
            i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]):
        n += 1
    return n


def test_extensions_equal_brute_force():
    rng = random.Random(7)
    for _ in range(300):
        a = words(rng, rng.randint(0, 40), "ab")
        b = rng.choice([a, words(rng, 20, "ab"), a[:10] + words(rng, 5) + a[15:]])
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        g, h = fp.PrefixHash(a), fp.PrefixHash(b)
        for back in (False, True):
            assert fp.extension(g, i, h, j, back) == brute_extension(a, i, b, j, back)


def brute_likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    at = fp.rungs(min(len(a), len(b))).tolist()
    begin = max([m for m in at if a[:m] == b[:m]], default=0)
    end = max([m for m in at if a[-m:] == b[-m:]], default=0)
    return min(begin + end, len(a), len(b), max(len(a), len(b)) - 1) / max(len(a), len(b))


def test_likeness_of_fingerprints_equals_that_of_the_texts():
    rng = random.Random(9)
    print_of = lambda t: fp.fingerprint(fp.PrefixHash(t))
    for _ in range(400):
        a = words(rng, rng.randint(0, 200), "abcdefgh")
        k = rng.randint(0, len(a))
        b = rng.choice([a, "", a[:k], a[k:], a[:k] + "x" + a[k:], a[:k] + "x" + a[k + 1:], words(rng, 50, "abcdefgh")])
        x, y = print_of(a), print_of(b)
        assert fp.likeness(x, y) == fp.likeness(y, x) == brute_likeness(a, b)
        assert (x == y) == (a == b)


def brute_neighbours(rows):
    """By descending id, nulls last; of one id by the hash in the last column."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    out = []
    for k, (i, t, _) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        changed = t[:len(t) - half] + after[:half]
        p = [fp.fingerprint(fp.PrefixHash(x)) for x in (t, changed)]
        out.append((repr(i), len(t), sha256(changed.encode()).hexdigest(), *p, brute_likeness(t, changed), brute_likeness(t, after)))
    return sorted(out)


@pytest.mark.parametrize("partitions", [1, 7])
def test_neighbours_equal_brute_force(spark, partitions):
    rng = random.Random(12)
    rows = [(i, words(rng, rng.randint(0, 90), "abcdef \né𝒳"), "x", "y") for i in rng.sample(range(1_000), 120)]
    rows += [(5_000, None, "x", "y"), (5_001, "", "x", "y"), (None, "no id", "", ""), (None, "none", "", ""),
             (2 ** 62 + 1, "long " * 30_000, "", ""), rows[3], rows[3], (rows[4][0], "same id", "", "")]
    rows += [(7_777, "a hot id with text " + str(k % 9), "", "") for k in range(60)]
    docs = spark.createDataFrame(rows, DOCS).repartition(partitions)
    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    out = fp.edited_neighbours(docs, keep=["doc_id", "part", "fingerprint"])
    assert out.columns == ["doc_id", "part", *[c for c, _ in fp.MADE]]
    got = sorted((repr(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
                 for r in out.collect())
    assert got == brute_neighbours([tuple(r) for r in keyed])


def test_one_row_is_its_own_neighbour_and_an_empty_table_has_none(spark):
    one = fp.edited_neighbours(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).collect()
    assert [(r.n_chars, r.near_next, r.edited_sha256) for r in one] == [(4, 1.0, sha256(b"abab").hexdigest())]
    assert fp.edited_neighbours(spark.createDataFrame([], DOCS)).collect() == []


def test_frame_operators(spark):
    docs = spark.createDataFrame([(1, "one two three", "", ""), (2, None, "", ""), (3, "one two four", "", "")], DOCS)
    prints = {r.doc_id: r.fingerprint for r in fp.fingerprints(docs, keep=["doc_id"]).collect()}
    assert prints[2] == fp.fingerprint(fp.PrefixHash(""))
    pairs = spark.createDataFrame([(prints[1], prints[3]), (prints[1], None), (prints[1], prints[1])], "a string, b string")
    assert [r.likeness for r in fp.with_likeness(pairs, "a", "b").collect()] == [
        pytest.approx(brute_likeness("one two three", "one two four")), None, 1.0]
    texts = spark.createDataFrame([("abcab", "xabcab", 0, 1), (None, "a", 5, 0), ("aab", "ab", -3, 0)], "a string, b string, i int, j int")
    assert [(r.common_after, r.common_before) for r in fp.with_extensions(texts, "a", "b", "i", "j").collect()] == [(5, 0), (0, 0), (1, 0)]
    assert [(r.common_after, r.common_before) for r in fp.with_extensions(texts, "a", "b").collect()] == [(0, 5), (0, 0), (1, 2)]
