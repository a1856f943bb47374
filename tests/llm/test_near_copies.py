"""SimHash near-duplicates, components and decontamination against brute force; the pipeline."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from seqwise.llm import decontam, simhash, toxicity
from seqwise.llm.common import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, distance):
    """{node: smallest node reachable}."""
    nodes = sorted(set(nodes))
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def near_texts():
    rng = random.Random(4)
    rows = []
    for family in range(25):
        base = [f"{rng.choice('abcdef')}{rng.randint(0, 300)}" for _ in range(rng.randint(3, 150))]
        for _ in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = "new"
            rows.append(rng.choice([" ", "\n", "\t "]).join(words))
    rows += [None, "", "  \n", "One", "one", "one two", "ÉX éx", "a b", rows[0].upper(), rows[0]]
    return rows


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_and_classes_match_brute_force(spark):
    rows = near_texts()
    ids = [3 * i + 5 for i in range(len(rows))]
    ids[7], ids[9] = ids[2], None                        # a repeated id and a null one
    docs = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, rows)], "doc_id long, text string, fingerprint string")
    got = simhash.near_duplicates(docs).collect()
    fps = [brute_fingerprint(t) for t in rows]
    root = brute_components(fps, 3)
    smallest = {}
    for i, f in zip(ids, fps):
        if i is not None:
            smallest[root[f]] = min(i, smallest.get(root[f], i))
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    want = sorted(((i, format(f, "016x"), smallest.get(root[f])) for i, f in zip(ids, fps)), key=key)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=key) == want
    assert len(set(root.values())) < len(rows) - 10
    # exactly one row of each component is kept
    assert sum(r.representative for r in got) == len(set(root.values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("hot, parts, distance", [(2000, 3, 3), (5, 3, 3), (1, 3, 3), (3, 2, 3), (4, 4, 3), (3, 3, 5)])
def test_links_match_brute_force(spark, hot, parts, distance):
    """Also when signature values are crowded and their rows are split again."""
    rng = random.Random(hot + parts)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = set(centres)
    for c in centres:
        for _ in range(40):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    fps |= {centres[0] ^ (1 << b) for b in range(40)}    # a dense ball
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {(r.a, r.b) for r in simhash.links(frame, distance, parts, hot).collect()}
    fps = sorted(fps)
    want = {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(fps) for b in fps[i + 1:]
            if (a ^ b).bit_count() <= distance}
    assert got == want


def test_signatures_are_not_broadcast(spark):
    """A few fingerprints have hundreds of times as many signatures, which Spark's estimate leaves out."""
    fps = spark.range(300).select(F.xxhash64("id").alias("fp"))
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 300 * 8
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = simhash.links(fps)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_allocation_is_optimal():
    from itertools import product
    rng = random.Random(1)
    for _ in range(30):
        parts, distance, n = rng.randint(1, 4), rng.randint(1, 4), rng.randint(10, 10 ** 6)
        widths = [64 // parts] * parts
        col = [rng.random() * 10 ** rng.randint(2, 9) for _ in range(parts)]

        def cost(ts):
            return sum(n * simhash.ball(w, t) + (n if t > 0 else 0) + 4.0 * simhash.ball(w, t) * c
                       for w, t, c in zip(widths, ts, col))
        ts = simhash.allocate(n, widths, col, distance)
        assert sum(ts) == distance - parts + 1
        best = min(cost(x) for x in product(range(-1, distance + 1), repeat=parts) if sum(x) == distance - parts + 1)
        assert cost(ts) == pytest.approx(best)


def test_correlated_bits_stay_together():
    corr = np.zeros((64, 64))
    for a, b in ((0, 40), (40, 63), (0, 63), (5, 33)):
        corr[a, b] = corr[b, a] = 0.9
    groups = simhash.group_bits(corr, list(range(64)), 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({0, 40, 63} <= set(g) for g in groups) and any({5, 33} <= set(g) for g in groups)


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(2, 1)], [(i, i + 1) for i in range(60)], [(i + 1, i) for i in range(0, 60, 2)],
    [(0, i) for i in range(1, 80)], [(99, i) for i in range(80)], [(i, (7 * i) % 50) for i in range(50)] * 2,
])
def test_connected_components(spark, edges):
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    pairs = {r.node: r.component for r in got.collect()}
    root = {}

    def find(n):
        while root.setdefault(n, n) != n:
            n = root[n]
        return n
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {n: find(n) for n in root}
    alone = {n for n in want if not any(n in e and e[0] != e[1] for e in edges)}
    assert got.count() == len(pairs) and pairs == {n: c for n, c in want.items() if n not in alone}


# decontamination

def brute_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def masks(pattern):
    out = {}
    for j, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << j
    return out


def test_myers_is_the_edit_distance():
    rng = random.Random(8)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        assert decontam.myers(masks(p), len(p), t) == brute_distance(p, t)


def edited(rng, text, edits):
    s = list(text)
    for _ in range(edits):
        k = rng.randrange(len(s))
        s[k:k + rng.randint(0, 1)] = rng.choices("abcdefgh ", k=rng.randint(0, 1))
    return "".join(s)


def test_matches_equal_brute_force(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 40)))) for i in range(12)]
    items += [(50, items[0][1]), (51, None), (52, "short"), (None, items[1][1] + " more words after it here")]
    texts = [None, "", "short", "x" * 10_000]
    for _ in range(60):
        body = items[rng.randrange(12)][1]
        texts.append(" ".join(word() for _ in range(rng.randint(0, 30))) + " "
                     + edited(rng, body, rng.randint(0, 14)).upper() + "\n" + " ".join(word() for _ in range(5)))
    texts += texts[4:8]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in enumerate(texts):
        body, hit = decontam.normalise(t), {}
        for k, item in items:
            item = decontam.normalise(item)
            if k is None or len(item) < 32:
                continue
            d = brute_distance(item, body)
            if d <= decontam.budget(len(item), 0.05, 16):
                hit[k] = d
        want[i] = (bool(hit), sorted(hit), [hit[k] for k in sorted(hit)])
    assert 20 < sum(w[0] for w in want.values()) < len(texts)
    for block in (2_000_000, 300):                       # one block of items, or many
        got = decontam.decontaminate(docs, bench, keep=["doc_id"], min_item=32, block_chars=block)
        assert {r.doc_id: (r.contaminated, r["items"], r.distances) for r in got.collect()} == want
    none = decontam.decontaminate(docs, bench.limit(0)).select("contaminated").distinct().collect()
    assert [r[0] for r in none] == [False] and decontam.decontaminate(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("block", [2_000_000, 20])
def test_short_items_and_ids_of_any_kind(spark, block):
    texts = ["Q: What is the capital of France? Paris.", "what is the capitals of france", "concatenate", "a cat.", None]
    long = " ".join(f"word{k}" for k in range(20))
    docs = spark.createDataFrame(list(enumerate([*texts, long])), "doc_id long, text string")
    items = [("q-1", "What is the capital of France?"), (None, "cat"), ("q-2", long), ("q-2", long), ("q-3", "?"), ("q-4", None)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontam.decontaminate(docs, bench, keep=["doc_id"], min_item=1, block_chars=block)
    assert {r.doc_id: (r.contaminated, r["items"], r.distances) for r in got.collect()} == {
        0: (True, ["q-1"], [0]), 1: (False, [], []), 2: (False, [], []), 3: (True, [None], [0]), 4: (False, [], []),
        5: (True, ["q-2"], [0])}


def test_the_queries_search_short_items(spark, tmp_path):
    from seqwise.llm.queries import op8_decontamination
    spark.createDataFrame([(1, "see: THE cat"), (2, "dog")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, "the cat")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: (r.contaminated, r["items"]) for r in op8_decontamination(spark, str(tmp_path)).collect()}
    assert got == {1: (True, [None]), 2: (False, [])}


# pipeline

SF = "/root/testdata/sf0.001"


def test_stage_names_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "simhash_near_dedup",
                                                      "benchmark_decontamination", "bpe_encoding"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_stages_take_effect(spark):
    rng = random.Random(3)
    body = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    copied = body()
    rows = [(i, body()) for i in range(10)] + [(20, copied), (21, copied), (22, copied.upper()), (30, "too short"),
                                               (40, body() + " " + item + " " + body()), (50, None), (None, copied)]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted((-1 if r.doc_id is None else r.doc_id) for r in df.collect())
    clean = list(range(10))
    assert ids(stages["quality_rules"](spark, docs, SF)) == [-1, *clean, 20, 21, 22, 40]
    assert ids(stages["toxicity"](spark, docs, SF)) == ids(docs)
    assert ids(stages["simhash_near_dedup"](spark, docs, SF)) == [*clean, 20, 30, 40, 50]
    assert ids(stages["benchmark_decontamination"](spark, docs, SF)) == [-1, *clean, 20, 21, 22, 30, 50]
    got = stages["bpe_encoding"](spark, docs, SF)
    assert got.columns == ["doc_id", "n_tokens", "token_ids"] and got.count() == len(rows)


def test_pipeline_equals_brute_force(spark):
    """Every stage by its brute-force version (the fitted chain scores alone)."""
    from test_text_rules import brute_quality
    got = {r.doc_id: r.token_ids for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    kept = [(r[0], r[9]) for r in brute_quality(rows, 30, 0.001, 1 / 3) if r[8]]
    frame = spark.createDataFrame(kept, "doc_id long, text string")
    chain = toxicity.fit(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    cache = {}
    kept = [(i, t) for i, t in kept if chain.probabilities([chain.numbers(t, cache)])[0, -1] <= chain.threshold]
    fps = {i: brute_fingerprint(t) for i, t in kept}
    root = brute_components(fps.values(), 3)
    first = {}
    for i, _ in sorted(kept):
        first.setdefault(root[fps[i]], i)
    kept = [(i, t) for i, t in kept if first[root[fps[i]]] == i]
    items = [decontam.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = [(i, t) for i, t in kept if not any(x in decontam.normalise(t) for x in items)]
    assert set(got) <= {i for i, _ in exact}              # edited passages go as well
    left = {i for i, _ in exact} - set(got)
    for i, t in exact:
        if i in left:
            assert any(brute_distance(x, decontam.normalise(t)) <= decontam.budget(len(x), 0.05, 16) for x in items)
    assert len(got) > 50
    tokenizers = pytest.importorskip("tokenizers")
    from seqwise.llm.queries import tokenizer
    lib = tokenizers.Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    for i, t in exact:
        if i in got:
            assert got[i] == lib.encode(t, add_special_tokens=False).ids


def test_registered_queries(spark):
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for n in names:
        out = entry.queries()[n](spark, SF)
        if n.startswith("op11"):
            assert out.columns[0] == "conv_id" and out.count() > 0
            continue
        assert out.columns[0] in ("doc_id", "page_id")
        assert out.count() == (docs if out.columns[0] == "doc_id" else spark.read.parquet(f"{SF}/pages.parquet").count())


def test_whole_library_without_local_checkpoints():
    from pathlib import Path
    top = Path(corpus_pipeline.__file__).parent
    for p in [top / "corpus_pipeline.py", *(top / "seqwise").rglob("*.py")]:
        assert "localCheckpoint(" not in p.read_text() and "crossJoin" not in p.read_text(), p


def test_row_numbers_survive(spark):
    """Repeated rows stay apart: representatives are chosen by row, not by id."""
    docs = spark.createDataFrame([(1, "a b c d")] * 5, "doc_id long, text string").repartition(3)
    out = simhash.near_duplicates(docs)
    assert out.count() == 5 and out.filter("representative").count() == 1
    assert out.select(F.countDistinct("component_id")).first()[0] == 1
