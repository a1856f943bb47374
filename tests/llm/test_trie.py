"""Conversation prefix trie: double arrays, shards and whole results against brute force and SQL."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seqwise.llm import oracles, queries, trie

TALK = "conv_id long, turn long, role string, text string, depth int, key string"


def brute(rows, rebuild=True):
    """Nodes by the definition, of (conv_id, turn, role, text) with distinct turn numbers."""
    own = defaultdict(list)
    for c, t, r, x, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((r or "", x or ""))
    h = {c: zlib.crc32(str(c).encode()) % 6 if rebuild else 0 for c in own}
    made = {c: tuple(own.get(c - c % 100, [])[:h[c]] + own[c][h[c]:]) for c in own}
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[made[c][:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        n = len(members[p])
        below = [out[k] for k in kids[p]]
        ends = ",".join(str(c) for c in members[p] if made[c] == p)
        out[p] = (members[p][0], len(p), members[p[:-1]][0] if p else None, n, len(below), sum(x[5] for x in below) or 1,
                  sum(x[6] for x in below) + ((n - 1) * len(p[-1][1]) if p else 0), sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=repr)


def talk(seed=3, n=260):
    """Families, a hot first turn, many copies, missing bases, nulls, empty texts, turns without number."""
    rng = random.Random(seed)
    words = ["a", "bb", "", None, "héllo", "a longer turn 𝒳"]
    rows = []
    for c in [x for x in range(0, 400) if rng.random() < 0.6 and x != 200] + [100_007, 2 ** 60 + 1]:
        if c % 3 == 0:
            rows += [(c, t, "user", f"copy {t}", 1, "k") for t in range(4)]
            continue
        rows.append((c, None if c % 7 == 0 else 0, "system" if c % 2 else rng.choice(["user", None]), "hot" if c % 2 else rng.choice(words), 1, "k"))
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(words), 2, "k") for t in range(1, rng.randint(1, 9))]
    rows += [(None, 1, "user", "no conversation", 1, "k")] * 3
    rng.shuffle(rows)
    return rows


def result(df):
    assert df.columns == trie.NODE
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_double_array_holds_exactly_the_rows():
    rng = random.Random(8)
    for trial in range(40):
        rows = [[rng.randrange(1 + 3 * trial) for _ in range(rng.randint(0, 7))] for _ in range(rng.randint(1, 60))]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        t = trie.DoubleArray(np.array([x for r in rows for x in r], np.int64), offsets)
        prefixes = {tuple(r[:d]) for r in rows for d in range(len(r) + 1)}
        assert np.count_nonzero(t.check != t.FREE) == len(prefixes)
        seen = {}
        for d, (which, state, _) in enumerate(t.walk()):
            for r, s in zip(which.tolist(), state.tolist()):
                assert s >= 0 and seen.setdefault(s, tuple(rows[r][:d])) == tuple(rows[r][:d])
        assert set(seen.values()) == prefixes
        for s, p in seen.items():                       # and no child that is not there
            for x in range(3 * trial + 2):
                to = int(t.step(np.array([s]), np.array([x]))[0])
                assert (to >= 0) == (p + (x,) in prefixes) and (to < 0 or seen[to] == p + (x,))


def test_arrays_stay_dense():
    rng = np.random.default_rng(1)
    rows, width = 20_000, 6
    t = trie.DoubleArray(rng.integers(0, 50_000, rows * width), np.arange(0, rows * width + 1, width))
    nodes = np.count_nonzero(t.check != t.FREE)
    assert 5 * rows < nodes <= t.end < 1.5 * nodes + 50_000


@pytest.mark.parametrize("limit, task_turns, hot", [(trie.LIMIT, trie.TASK_TURNS, trie.HOT), (3, 40, 2), (1, 7, 0)])
def test_nodes_equal_brute_force(spark, limit, task_turns, hot):
    rows = talk()
    df = spark.createDataFrame(rows, TALK).repartition(5)
    assert result(trie.prefix_trie(trie.rebuilt(df), limit, task_turns, hot)) == brute(rows)


def test_conversations_as_they_stand(spark):
    rows = talk(5)
    assert result(trie.prefix_trie(trie.sequences(spark.createDataFrame(rows, TALK)), limit=2)) == brute(rows, rebuild=False)


def test_copies_over_many_rows_keep_the_order_of_their_ids(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 3)
    rows = [(c, t, "user", f"turn {t}", 1, "k") for c in range(1, 4_000, 7) for t in range(2)] + [(5_000, 0, "user", "other", 1, "k")]
    df = spark.createDataFrame(rows, TALK)
    assert result(trie.prefix_trie(trie.sequences(df), limit=5)) == brute(rows, rebuild=False)
    runs = trie.copies(trie.sequences(df))
    assert runs.agg(F.sum("n")).first()[0] == len({r[0] for r in rows})


def test_repeated_turn_numbers_and_empty_tables(spark):
    rows = [(1, 0, "user", "x", 1, "k"), (1, 0, "user", "x", 1, "k"), (1, 0, "user", "y", 1, "k")]
    got = result(trie.prefix_trie(trie.sequences(spark.createDataFrame(rows, TALK))))
    assert [(r[1], r[3]) for r in sorted(got, key=lambda r: r[1])] == [(0, 1), (1, 1), (2, 1), (3, 1)]
    assert result(trie.prefix_trie(trie.rebuilt(spark.createDataFrame([], TALK)))) == []
    lone = spark.createDataFrame([(7, None, None, None, 1, "k")], TALK)       # h is 5 or less: no turn is left, or one
    assert result(trie.prefix_trie(trie.rebuilt(lone))) == brute([(7, None, None, None)])


def test_a_long_conversation_is_a_path(spark):
    rows = [(c, t, "user", str(t % 5), 1, "k") for c in (3, 4) for t in range(3_000)]
    got = result(trie.prefix_trie(trie.sequences(spark.createDataFrame(rows, TALK))))
    assert len(got) == 3_001 and all(r[0] == 3 and r[3] == 2 and r[5] == 1 for r in got)
    assert max(r[6] for r in got) == 3_000


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{sf}/conversations.parquet')")
    rel = con.execute(oracles.ORACLE["op11_conversation_trie"])
    names = [d[0] for d in rel.description]
    got = queries.op11_conversation_trie(spark, sf).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rel.fetchall(), key=repr)
