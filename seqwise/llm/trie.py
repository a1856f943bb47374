"""Conversation prefix trie: double arrays per prefix shard, merged at the top.

A conversation is a row of turns; a turn is known by 128 bits of hash and its
number of code points, so no text is shuffled. Steps:

1. Equal conversations become one (``copies``): rows are dealt by ranges of
   (hash of the conversation, id), sorted, and runs of equal ones written as one row
   for every 4,096 ids, with the ids joined by commas. A group of copies is thereby
   dealt to many tasks, and a third of all conversations is a few rows afterwards.
2. ``sharded`` gives every conversation a shard, the prefix of its first two turns.
   A prefix with more than ``limit`` conversations is split by its first four, eight
   and so on turns, so a frequent beginning is never one task's.
3. Every task packs the conversations of its shards into a double-array trie
   (``DoubleArray``): turns get dense ids, the child of slot s by turn t is slot
   BASE[s] + t, and CHECK of that slot is s. All conversations walk the arrays
   together, which counts members, ends and smallest ids of every node; sums over
   subtrees run from the deepest level up.
4. Nodes above a shard's prefix may lie in several tasks ("upper" nodes). They are
   merged by the key of their prefix, and the totals of the shard tops and of the upper
   nodes are added to each of their ancestors by one aggregation with partial sums.
   Parents with many children meet their children by a broadcast of those parents
   alone (at most nodes / ``HOT`` of them), the others by a shuffle join.

Ids of the members that end at a node are hashed in order as their rows stream by.

Defined results: rows without a conversation id are left out; null roles and texts
are empty; turns come in the order of their number, null first, equal numbers in the
order of their hashes (so repeated rows are further turns); an empty table has no
node, not even a root; extra columns play no part. Ids are long integers. A
conversation is one row of 24 bytes a turn, of any length; its texts are never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.llm.common import staged

LIMIT = 20_000              # conversations of a shard, beyond which it is split
TASK_TURNS = 1_000_000      # turns a task packs, on average
CHUNK = 4_096               # ids of a row of copies
HOT = 10_000                # children of a parent, beyond which it is broadcast
TURN = "struct<k1:bigint,k2:bigint,len:bigint>"
NO_END = sha256(b"").hexdigest()


# conversations ------------------------------------------------------------------

def turn_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """(conv_id, turn, k1, k2, len) of every turn: the hashes are made where the texts are read."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.xxhash64(r, t).alias("k1"),
        F.xxhash64(F.lit(1), t, r).alias("k2"), F.length(t).cast("long").alias("len"))


def ordered_turns() -> Column:
    """Aggregate: the turns of a group in order, as array of (k1, k2, len)."""
    rows = F.sort_array(F.collect_list(F.struct("turn", "k1", "k2", "len")))
    return F.transform(rows, lambda x: F.struct(x["k1"].alias("k1"), x["k2"].alias("k2"), x["len"].alias("len")))


def sequences(conversations: DataFrame, **names) -> DataFrame:
    """(conv_id, turns) of every conversation as it stands."""
    return turn_rows(conversations, **names).groupBy("conv_id").agg(ordered_turns().alias("turns"))


def rebuilt(conversations: DataFrame, family: int = 100, most: int = 5, **names) -> DataFrame:
    """(conv_id, turns) with the first h turns taken from conversation c - c % ``family``,
    h = crc32(decimal c) % (``most`` + 1), then c's own turns after its first h. One
    exchange: conversations of a family lie together."""
    rows = turn_rows(conversations, **names).withColumn("family", F.col("conv_id") - F.col("conv_id") % family)
    own = rows.repartition("family").groupBy("family", "conv_id").agg(ordered_turns().alias("own"))
    none = F.array().cast(f"array<{TURN}>")
    first = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("own", 1, most))).over(Window.partitionBy("family"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    own = own.withColumns({"first": F.coalesce(first, none), "h": h})
    kept = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
    return own.select("conv_id", F.concat(F.slice("first", F.lit(1), F.col("h")), kept).alias("turns"))


def copies(seqs: DataFrame) -> DataFrame:
    """Runs of equal conversations: (s1, s2, conv_id smallest, n, ids, turns)."""
    k1, k2 = F.transform("turns", lambda x: x["k1"]), F.transform("turns", lambda x: x["k2"])
    rows = seqs.select(F.xxhash64(k1, k2).alias("s1"), F.xxhash64(F.lit(1), k2, k1).alias("s2"), "conv_id", "turns")
    order = ["s1", "s2", "conv_id"]
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("n", T.LongType()), T.StructField("ids", T.StringType()),
                           rows.schema["turns"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:                    # a run that crosses batches is several rows
            s1, s2, ids = (batch.column(c).to_pylist() for c in order)
            begins = [k for k in range(len(ids)) if k == 0 or s1[k] != s1[k - 1] or s2[k] != s2[k - 1]]
            runs = [(a, min(a + CHUNK, b)) for i, j in zip(begins, [*begins[1:], len(ids)])
                    for a in range(i, j, CHUNK) for b in (j,)]
            first = pa.array([a for a, _ in runs], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(first) for c in order), pa.array([b - a for a, b in runs], pa.int64()),
                 pa.array([",".join(map(str, ids[a:b])) for a, b in runs], pa.string()), batch.column("turns").take(first)],
                [*order, "n", "ids", "turns"])
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def sharded(runs: DataFrame, limit: int = LIMIT, first: int = 2) -> DataFrame:
    """``runs`` with ``shard``, the hash of a prefix, and ``top``, the turns of that
    prefix: the fewest of ``first``, twice, four times ... as many at which at most
    ``limit`` longer conversations share it."""
    def prefix(k: int) -> Column:
        head = F.slice("turns", 1, k)
        return F.xxhash64(F.transform(head, lambda x: x["k1"]), F.transform(head, lambda x: x["k2"]))
    parts, rest, k = [], runs, first
    while True:
        keyed = rest.withColumns({"shard": prefix(k), "top": F.lit(k)})
        # at most rows / limit of them
        hot = staged(keyed.filter(F.size("turns") > k).groupBy("shard").agg(F.count("*").alias("many"))
                     .filter(F.col("many") > limit).select("shard"), "hot_prefixes")
        if hot.isEmpty():
            parts.append(keyed)
            break
        parts.append(keyed.join(F.broadcast(hot), "shard", "left_anti"))
        rest, k = keyed.join(F.broadcast(hot), "shard", "left_semi").select(*runs.columns), 2 * k
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# the double array ----------------------------------------------------------------

class DoubleArray:
    """A trie over dense labels: child of s by label t is s' = base[s] + t with check[s'] == s.

    Built level by level for all rows together. Nodes with several children look for
    the first place where all of them fit; nodes with one child then take the free
    slots in order, which fills the holes."""
    ROOT, FREE = 0, -1

    def __init__(self, labels: np.ndarray, offsets: np.ndarray):
        """Row r has the labels ``labels[offsets[r]:offsets[r + 1]]``, from 0 on."""
        self.labels, self.offsets = labels, offsets
        self.lengths = np.diff(offsets)
        self.base, self.check = np.zeros(1024, np.int64), np.full(1024, self.FREE, np.int64)
        self.check[self.ROOT] = -2
        self.low, self.end = 1, 1                # no free slot before low, no used one from end on
        state = np.full(len(self.lengths), self.ROOT, np.int64)
        for d in range(int(self.lengths.max(initial=0))):
            at = np.flatnonzero(self.lengths > d)
            state[at] = self.grow(state[at], labels[offsets[:-1][at] + d])

    def reserve(self, n: int) -> None:
        if n > len(self.check):
            more = max(n, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, self.FREE, np.int64)])

    def grow(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Children of ``state`` by ``label`` (none has children yet), and their slots."""
        order = np.lexsort((label, state))
        s, t = state[order], label[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
        cs, ct = s[new], t[new]
        begin = np.flatnonzero(np.concatenate([[True], cs[1:] != cs[:-1]]))
        size = np.diff(np.append(begin, len(cs)))
        for k, n in zip(begin[size > 1].tolist(), size[size > 1].tolist()):
            self.place(int(cs[k]), ct[k:k + n])
        one = begin[size == 1]
        slots = self.free_slots(len(one))
        self.base[cs[one]] = slots - ct[one]
        self.check[slots] = cs[one]
        self.end = max(self.end, int(slots.max(initial=0)) + 1)
        return self.step(state, label)

    def place(self, s: int, t: np.ndarray) -> None:
        """The first free place for all labels ``t`` (ascending) of slot ``s``."""
        gaps = t - t[0]
        begin, block = self.low, 1024
        while True:
            self.reserve(begin + block + int(gaps[-1]) + 1)
            free = begin + np.flatnonzero(self.check[begin:begin + block] == self.FREE)
            for g in gaps[1:].tolist():
                if not len(free):
                    break
                free = free[self.check[free + g] == self.FREE]
            if len(free):
                break
            begin, block = begin + block, 2 * block
        slots = free[0] + gaps
        self.base[s] = int(free[0]) - int(t[0])
        self.check[slots] = s
        self.end = max(self.end, int(slots[-1]) + 1)
        while self.check[self.low] != self.FREE:
            self.low += 1
            self.reserve(self.low + 1)

    def free_slots(self, n: int) -> np.ndarray:
        self.reserve(self.end + n)
        holes = self.low + np.flatnonzero(self.check[self.low:self.end + n] == self.FREE)[:n]
        if n:
            self.low = int(holes[-1]) + 1
        return holes

    def step(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The slots reached from ``state`` by ``label``; -1 where there is no such child."""
        to = self.base[state] + label
        inside = (to >= 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == state), to, -1)

    def walk(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All rows down the trie together: (rows, slots, places of the labels) of each level."""
        rows = np.arange(len(self.lengths))
        state = np.full(len(rows), self.ROOT, np.int64)
        yield rows, state, np.full(len(rows), -1, np.int64)
        for d in range(int(self.lengths.max(initial=0))):
            go = self.lengths[rows] > d
            rows, state = rows[go], state[go]
            at = self.offsets[:-1][rows] + d
            state = self.step(state, self.labels[at])
            yield rows, state, at


def dense(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Ids from 0 on of the distinct pairs."""
    order = np.lexsort((k2, k1))
    a, b = k1[order], k2[order]
    new = np.zeros(len(a), np.int64)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    out = np.empty(len(a), np.int64)
    out[order] = np.cumsum(new)
    return out


class Shard:
    """Conversations of one task, gathered from sorted runs, and their nodes."""
    FACTOR = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

    def __init__(self):
        self.k1, self.k2, self.len, self.sizes, self.tops = [], [], [], [], []
        self.n, self.conv, self.ends = [], [], []
        self.last, self.digest = None, None

    def add(self, batch: pa.RecordBatch) -> None:
        s1, s2, conv, n, ids, top = (batch.column(c).to_pylist() for c in ("s1", "s2", "conv_id", "n", "ids", "top"))
        fresh = []
        for k in range(len(conv)):
            if (s1[k], s2[k]) == self.last:
                self.n[-1] += n[k]
                self.digest.update(b"," + ids[k].encode())
                continue
            self.close()
            self.last, self.digest = (s1[k], s2[k]), sha256(ids[k].encode())
            self.n.append(n[k])
            self.conv.append(conv[k])
            self.tops.append(top[k])
            fresh.append(k)
        turns = batch.column("turns").take(pa.array(fresh, pa.int64()))
        flat = turns.flatten()
        for out, name in ((self.k1, "k1"), (self.k2, "k2"), (self.len, "len")):
            out.append(flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64))
        self.sizes.append(turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))

    def close(self) -> None:
        if self.digest is not None:
            self.ends.append(self.digest.hexdigest())
        self.digest = None

    def nodes(self) -> dict[str, np.ndarray]:
        """Columns of the nodes, by slot order; keys and ancestors of the upper ones and the tops."""
        self.close()
        k1, k2, length, sizes = (np.concatenate(x) for x in (self.k1, self.k2, self.len, self.sizes))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        trie = DoubleArray(dense(k1, k2), offsets)
        slots = trie.end
        n, low = np.array(self.n, np.int64), np.array(self.conv, np.int64)
        top = np.array(self.tops, np.int64)
        col = {c: np.zeros(slots, np.int64) for c in ("depth", "n_convs", "last_len", "shard_top", "n_leaves", "saved")}
        col["conv_id"] = np.full(slots, np.iinfo(np.int64).max)
        key = [np.zeros(slots, np.uint64) for _ in self.FACTOR]
        ends = np.full(slots, NO_END, object)
        levels = []
        for d, (rows, state, at) in enumerate(trie.walk()):
            np.add.at(col["n_convs"], state, n[rows])
            np.minimum.at(col["conv_id"], state, low[rows])
            np.maximum.at(col["shard_top"], state, top[rows])
            col["depth"][state] = d
            if d:
                col["last_len"][state] = length[at]
                for k, parts in zip(range(2), (k1, k2)):
                    key[k][state] = key[k][trie.check[state]] * self.FACTOR[k] + parts[at].view(np.uint64)
            over = sizes[rows] == d
            ends[state[over]] = np.array(self.ends, object)[rows[over]]
            levels.append(np.unique(state))
        parent = trie.check[:slots].copy()
        used = np.concatenate(levels)
        children = np.bincount(parent[used[used != trie.ROOT]], minlength=slots)
        col["n_leaves"][used] = children[used] == 0
        col["saved"][used] = (col["n_convs"][used] - 1) * col["last_len"][used]
        for level in reversed(levels[1:]):
            for c in ("n_leaves", "saved"):
                np.add.at(col[c], parent[level], col[c][level])
        return {"slots": used, "parent": parent, "children": children, "a": key[0], "b": key[1], "ends": ends, **col}


KEY = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
PARTIAL = T.StructType([
    *(T.StructField(c, T.LongType()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens")),
    T.StructField("ends_sha256", T.StringType()), T.StructField("upper", T.BooleanType()), T.StructField("last_len", T.LongType()),
    T.StructField("key", KEY), T.StructField("above", T.ArrayType(KEY))])
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def key_array(c: dict, slots: np.ndarray, mask: np.ndarray | None = None) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(c["a"][slots].view(np.int64)), pa.array(c["b"][slots].view(np.int64))],
                                      ["a", "b"], mask=None if mask is None else pa.array(mask))


def node_batch(c: dict, slots: np.ndarray) -> pa.RecordBatch:
    """Rows of some nodes; upper nodes and shard tops carry their key and their
    ancestors' keys from the root down, the others their parent's id."""
    depth, parent = c["depth"][slots], c["parent"][slots]
    upper, linked = depth < c["shard_top"][slots], depth <= c["shard_top"][slots]
    width = int(depth[linked].max(initial=0))
    path = np.zeros((len(slots), width), np.int64)
    at = np.where(depth > 0, parent, 0)
    for back in range(1, width + 1):
        rows = np.flatnonzero(linked & (depth >= back))
        path[rows, depth[rows] - back] = at[rows]
        at[rows] = np.maximum(c["parent"][at[rows]], 0)
    shown = np.where(linked, depth, 0)
    inside = np.arange(width) < shown[:, None]
    above = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(shown)]), pa.int32()), key_array(c, path[inside]))
    own_parent = pa.array(np.where(depth > 0, c["conv_id"][np.maximum(parent, 0)], 0), mask=linked)
    return pa.RecordBatch.from_arrays(
        [pa.array(c["conv_id"][slots]), pa.array(depth), own_parent, pa.array(c["n_convs"][slots]),
         pa.array(c["children"][slots].astype(np.int64)), pa.array(c["n_leaves"][slots]), pa.array(c["saved"][slots]),
         pa.array(c["ends"][slots].tolist(), pa.string()), pa.array(upper), pa.array(c["last_len"][slots]),
         key_array(c, slots, ~linked), above], PARTIAL.fieldNames())


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = Shard()
    for batch in batches:
        if batch.num_rows:
            shard.add(batch)
    if shard.conv:
        c = shard.nodes()
        for k in range(0, len(c["slots"]), 20_000):
            yield node_batch(c, c["slots"][k:k + 20_000])


def prefix_trie(seqs: DataFrame, limit: int = LIMIT, task_turns: int = TASK_TURNS, hot: int = HOT) -> DataFrame:
    """The nodes of the trie of (conv_id, turns): conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. A conversation id must not repeat."""
    runs = staged(copies(seqs), "copies")
    turns = runs.agg(F.coalesce(F.sum(F.size("turns") + 1), F.lit(0))).first()[0]
    parts = max(1, -(-turns // task_turns), runs.sparkSession.sparkContext.defaultParallelism)
    dealt = sharded(runs, limit).repartition(parts, "shard").sortWithinPartitions("s1", "s2", "conv_id")
    partial = staged(dealt.mapInArrow(pack, PARTIAL), "shard_nodes")
    upper = staged(partial.filter("upper").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.first("last_len").alias("last_len"), (F.sum("n_children") == 0).cast("long").alias("leaf"),
        F.min(F.when(F.col("ends_sha256") != NO_END, F.col("ends_sha256"))).alias("ends_sha256"),
        F.first("above").alias("above")), "upper_nodes")
    tops = partial.filter("NOT upper AND key IS NOT NULL")
    # every distinct node below adds its leaves and savings to all its ancestors, and is a child of the nearest
    own = upper.select("key", F.col("leaf").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("last_len")).alias("saved_tokens"),
                       "above")
    given = own.unionByName(tops.select("key", "n_leaves", "saved_tokens", "above"))
    gained = given.select(F.posexplode("above").alias("place", "key"), "n_leaves", "saved_tokens",
                          F.size("above").alias("depth")).select(
        "key", "n_leaves", "saved_tokens", (F.col("place") == F.col("depth") - 1).cast("long").alias("n_children"))
    gained = gained.unionByName(own.select("key", "n_leaves", "saved_tokens", F.lit(0).cast("long").alias("n_children")))
    sums = gained.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens", "n_children")])
    upper = staged(upper.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_END))).join(sums, "key"), "upper_sums")
    parents = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below = upper.select("above", *[c for c in NODE if c != "parent_conv_id"]).unionByName(
        tops.select("above", *[c for c in NODE if c != "parent_conv_id"])).withColumn("parent_key", F.try_element_at("above", F.lit(-1)))
    # at most nodes / hot parents have more children than that
    many = parents.filter(F.col("n_children") > hot).drop("n_children")
    few = parents.filter(F.col("n_children") <= hot).drop("n_children")
    met = below.join(F.broadcast(many), "parent_key", "left")
    found = met.filter("parent_conv_id IS NOT NULL OR parent_key IS NULL").select(*NODE)
    others = met.filter("parent_conv_id IS NULL AND parent_key IS NOT NULL").drop("parent_conv_id").join(few, "parent_key")
    rest = partial.filter("key IS NULL").select(*NODE)
    return rest.unionByName(found).unionByName(others.select(*NODE))
