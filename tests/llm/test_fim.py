"""Fill-in-middle: brute force, sentinels across pieces, edge cases, SQL."""

from __future__ import annotations

import random
import re
from hashlib import sha256

import duckdb
import pytest

from seqwise.llm import fim, oracles, queries

DOCS = "doc_id long, text string, n int, row string, head double"


def brute(doc_id, text):
    t = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    n = len(units)
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or re.search("<[PSM]>", t) or h[2] % 100 >= 90:
        return n, "plain", None, None, t, t
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", t
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", t


def corpus():
    rng = random.Random(11)
    texts = [None, "", "a", "<", "<P", "<M>", "x <S> y", "abc" * 40_000, "é " * 3_000, "a\nb\r\n\tc  d", "<<<P>>", "𝒳y𝒳 z"]
    texts += ["".join(rng.choice(["a", "Bc", " ", "<", "P", "S>", ">", "é", "\n", "7"]) for _ in range(rng.randint(0, 60)))
              for _ in range(250)]
    rows = [(i, t, i, "r", 0.5) for i, t in enumerate(texts)]
    return rows + [(None, "no id at all", None, None, None), rows[20], rows[20], (20, "the same id, other text", 1, "", 1.0),
                   (2 ** 62 + 1, "a long id", 1, "", 1.0)]


def test_units_match_the_pattern_in_every_stretch(monkeypatch):
    monkeypatch.setattr(fim, "STEP", 7)
    rng = random.Random(2)
    for _ in range(200):
        t = "".join(rng.choice("abZ <>é7") for _ in range(rng.randint(0, 40)))
        starts = [m.start() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", t)] + [len(t)]
        n, got = fim.unit_offsets(t, lambda n: range(n + 1))
        assert (n, got) == (len(starts) - 1, starts)


@pytest.mark.parametrize("size", [1, 3, 32_768])
def test_texts_equal_brute_force(spark, size):
    rows = corpus()
    rows = rows if size > 3 else [r for r in rows if len(r[1] or "") < 1_000]
    out = fim.fill_in_middle(spark.createDataFrame(rows, DOCS).repartition(3), keep=["doc_id", "row"], digest=False, size=size)
    assert out.columns == ["doc_id", "row", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    want = sorted((repr(r[0]), repr(r[3]), *brute(r[0], r[1])) for r in rows)
    got = sorted((repr(r[0]), repr(r[1]), *r[2:]) for r in out.collect())
    assert [tuple(map(repr, x)) for x in got] == [tuple(map(repr, x)) for x in want]


def test_digests_are_those_of_the_texts(spark):
    rows = corpus()
    out = fim.fill_in_middle(spark.createDataFrame(rows, DOCS), keep=["doc_id"])
    want = sorted((repr(r[0]), *[sha256(x.encode()).hexdigest() for x in brute(r[0], r[1])[4:]]) for r in rows)
    assert sorted((repr(r.doc_id), r.output_sha256, r.restored_sha256) for r in out.collect()) == want


def test_pieces_are_whole_units_and_join_to_the_output(spark):
    text = "word " * 2_000
    pieces = fim.cut_pieces(spark.createDataFrame([(5, text)], "doc_id long, text string"), size=64).orderBy("place").collect()
    assert len(pieces) > 100 and max(len(r.piece) for r in pieces) <= 64 + 3
    assert "".join(r.piece for r in pieces) == brute(5, text)[4]
    assert all(r.head is None for r in pieces[1:]) and pieces[0].head.n == 4_000
    bare = [re.sub("<[PSM]>", "", r.piece) for r in pieces]
    assert all(x in ("", "word", " ") or re.fullmatch("( ?word ?)+| ", x) for x in bare)


def test_restoration_reads_only_the_stream():
    scan = fim.Scanner(plain=False)
    stream = "<S>tail <<P>head<<M>mid"
    got = [x for k, c in enumerate(stream) for x in scan.read(c)] + list(scan.read("", last=True))
    parts = {s: "".join(p for seg, _, p in got if seg == s) for s in (0, 1, 2)}
    assert parts == {2: "tail <", 0: "head<", 1: "mid"}


def test_empty_table_and_plan(spark):
    empty = spark.createDataFrame([], DOCS)
    assert fim.fill_in_middle(empty).collect() == []
    plan = fim.fill_in_middle(spark.createDataFrame(corpus(), DOCS))._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange") == 1 and initial.count("MapInArrow") == 3


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    rel = con.execute(oracles.ORACLE["op12_fill_in_middle"])
    names = [d[0] for d in rel.description]
    got = queries.op12_fill_in_middle(spark, sf).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall())
