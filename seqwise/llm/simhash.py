"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64 bits over word shingles (XXH64, seed 42). Two fingerprints
link if they differ in at most ``distance`` bits; a document's class is its
connected component.

The bits are grouped into ``parts`` partitions, correlated bits together, and
partition i gets a threshold t_i >= -1 (-1: not searched) with
sum(t_i) = distance - parts + 1. Two fingerprints within ``distance`` are then
within t_i in some partition. The thresholds come from dynamic programming over
the estimated cost: signatures written, and candidates expected from the
collision counts of the partition's values. Every fingerprint is an index row of
its exact value in each searched partition and probes all values within t_i;
whether a candidate pair really links is decided inside the join, so only links
leave it.

Equal fingerprints are one node, so copies are never paired. A signature value
with more than ``hot`` index rows is not joined: its rows are split again by the
same principle over the bits that it has not fixed yet, level by level, which is
exact and never compares a hot group all against all.

Defined results: a null or wordless text has fingerprint zero (linked like any
other); repeated rows and repeated ids belong to one class; a null id is never a
component's smallest unless all are null; extra columns stay (a column named
like an output is replaced); an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.llm.common import batches_by_bytes, connected_components, staged, texts_of, with_text, without_text

BITS = 64
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 256))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text: words are split at ASCII white space, A-Z lowered."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(size + 1) - size - 1
    k = min(shingle, len(words))
    first, last = begin[:len(words) - k + 1].tolist(), (begin + size)[k - 1:].tolist()
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(first, last)], "<u8")
    n = len(hashes)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 8192):
        block = hashes[at:at + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``) with ``__fp``, the fingerprint as a signed long."""
    keep = docs.columns if keep is None else keep
    rows, name = with_text(docs, keep, text)
    schema = T.StructType([*(f for f in rows.schema if f.name != "__text"), T.StructField("__fp", T.LongType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in batches_by_bytes(frame, name):
                fp = np.array([fingerprint(t, shingle) for t in texts_of(part, name)], np.uint64).view(np.int64)
                yield without_text(part, name).assign(__fp=fp)
    return rows.mapInPandas(run, schema)


def bit_correlations(fps: DataFrame) -> np.ndarray:
    """|correlation| of all pairs of bits over all fingerprints, from one
    64 x 64 table of counts (summed in Spark)."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS + 1, BITS + 1), np.int64)
        for frame in frames:
            raw = frame["fp"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little")
            one = np.hstack([bits, np.ones((len(bits), 1), np.uint8)]).astype(np.float32)
            total += np.rint(one.T @ one).astype(np.int64)
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "n": total.ravel()})
    rows = (fps.select("fp").mapInPandas(count, "i int, j int, n long")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())
    both = np.zeros((BITS + 1, BITS + 1))
    for r in rows:
        both[r.i, r.j] = r.n
    n = max(both[BITS, BITS], 1)
    p = both[BITS, :BITS] / n
    var = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    c = np.abs((both[:BITS, :BITS] / n - np.outer(p, p)) / np.outer(var, var))
    np.fill_diagonal(c, 0)
    return c


def group_bits(corr: np.ndarray, bits: list[int], parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, correlated ones together:
    a group begins with the bit most correlated with the rest and takes the bit
    most correlated with the group."""
    left, out = list(bits), []
    for k in range(parts, 0, -1):
        size = len(left) // k
        sums = corr[np.ix_(left, left)].sum(1)
        group = [left.pop(int(np.argmax(sums)))] if left else []
        while len(group) < size:
            group.append(left.pop(int(np.argmax(corr[np.ix_(left, group)].mean(1)))))
        out.append(sorted(group))
    return out


def ball(width: int, t: int) -> int:
    return sum(math.comb(width, k) for k in range(t + 1)) if t >= 0 else 0


def allocate(n: int, widths: list[int], collisions: list[float], distance: int) -> list[int]:
    """Thresholds with sum ``distance - parts + 1`` of the least estimated cost.

    Cost of threshold t in a partition: n * ball signatures, and
    ball * collisions candidates (``collisions``: pairs of equal values there)."""
    parts = len(widths)
    choices = range(-1, distance + 1)

    def cost(i: int, t: int) -> float:
        v = ball(widths[i], t)
        return n * v + (n if t > 0 else 0) + 4.0 * v * collisions[i]
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}     # sum of (t + 1) so far
    for i in range(parts):
        then: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in choices:
                s = used + t + 1
                got = (c + cost(i, t), [*ts, t])
                if s <= distance + 1 and (s not in then or got[0] < then[s][0]):
                    then[s] = got
        best = then
    return best[distance + 1][1]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def _flips(bits: list[int], t: int) -> list[int]:
    """All ways to change up to t of the bits, as masks."""
    from itertools import combinations
    return [_mask(list(c)) for k in range(t + 1) for c in combinations(bits, k)]


def _signed(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def links(fps: DataFrame, distance: int = 3, parts: int = 3, hot: int = 2_000, levels: int = 3) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints of the column ``fp``
    (distinct) within ``distance`` bits; a pair may come more than once."""
    n = fps.count()
    if n < 2:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    corr = bit_correlations(fps)
    found = None
    # rows still to be searched: path (signature values so far) and the bits not fixed by it
    index = probe = fps.select("fp", F.array().cast("array<long>").alias("path"), F.lit(0).alias("node"))
    nodes = {0: list(range(BITS))}
    for level in range(levels):
        plan = {}
        groups = {k: group_bits(corr, bits, parts) for k, bits in nodes.items()}
        flat = [(k, i, g) for k, gs in groups.items() for i, g in enumerate(gs)]
        sizes = {r.s: r.c for r in index.select(
            "path", F.explode(_by_node("node", {k: F.array(*[F.struct(
                F.lit(k * parts + i).alias("s"), F.col("fp").bitwiseAND(F.lit(_mask(g))).alias("v"))
                for i, g in enumerate(gs)]) for k, gs in groups.items()})).alias("x"))
            .groupBy("path", "x.s", "x.v").count().groupBy("s").agg(F.sum(F.col("count") * F.col("count")).alias("c"))
            .collect()}
        for k, gs in groups.items():
            plan[k] = allocate(n, [len(g) for g in gs], [float(sizes.get(k * parts + i, 0)) for i in range(len(gs))],
                               distance)
        exact = {k: F.array(*[_signature(k * parts + i, g, 0) for i, g in enumerate(gs) if plan[k][i] >= 0])
                 for k, gs in groups.items()}
        near = {k: F.concat(*[_signatures(k * parts + i, g, plan[k][i]) for i, g in enumerate(gs) if plan[k][i] >= 0])
                for k, gs in groups.items()}

        def signed(df: DataFrame, by: dict) -> DataFrame:
            return (df.select("fp", "path", F.explode(_by_node("node", by)).alias("x"))
                    .select("fp", F.concat("path", F.array(F.col("x.s").cast("long"), F.col("x.v"))).alias("path"),
                            F.col("x.s").alias("node")))
        index, probe = signed(index, exact), signed(probe, near)
        last = level == levels - 1
        crowded = None
        if not last:
            crowded = staged(index.groupBy("path").count().filter(F.col("count") > hot).select("path"), "simhash-hot")
            if crowded.isEmpty():
                crowded = None
        cold = [index, probe] if crowded is None else [x.join(crowded, "path", "left_anti") for x in (index, probe)]
        one, two = cold[0].select("path", F.col("fp").alias("a")), cold[1].select("path", F.col("fp").alias("b"))
        close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
        # a pair met through exact values on both sides comes twice: order decides only which end is a.
        # Spark takes an exploded table for as large as the one before: unhinted, it would broadcast all signatures
        pair = one.join(two.hint("merge"), (one["path"] == two["path"]) & (F.col("a") != F.col("b")) & close)
        pair = pair.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        found = pair if found is None else found.unionByName(pair)
        if crowded is None:
            break
        index, probe = (staged(x.join(crowded, "path", "left_semi"), "simhash-split") for x in (index, probe))
        nodes = {k * parts + i: [b for b in nodes[k] if b not in set(g)] for k, i, g in flat}
    return found


def _signature(s: int, bits: list[int], flip: int) -> Column:
    return F.struct(F.lit(s).alias("s"), F.col("fp").bitwiseAND(F.lit(_mask(bits))).alias("v"))


def _signatures(s: int, bits: list[int], t: int) -> Column:
    value = F.col("fp").bitwiseAND(F.lit(_mask(bits)))
    return F.transform(_signed(_flips(bits, t)),
                       lambda f: F.struct(F.lit(s).alias("s"), value.bitwiseXOR(f).alias("v")))


def _by_node(node: str, by: dict[int, Column]) -> Column:
    out = None
    for k, c in by.items():
        out = F.when(F.col(node) == k, c) if out is None else out.when(F.col(node) == k, c)
    return out


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    distance: int = 3, parts: int = 3, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, which should be narrow: they are stored; all
    by default) with ``fingerprint`` (16 hex digits), ``component_id`` (the
    component's smallest ``doc_id``) and ``representative`` (true for exactly
    one row of each component: the first with the smallest id)."""
    made = ["fingerprint", "component_id", "representative"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    rows = fingerprints(docs.withColumn("__id", F.col(doc_id)), text, shingle, [*keep, "__id"])
    rows = staged(rows.withColumn("__row", F.monotonically_increasing_id()), "simhash-rows")
    order = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__row").alias("row"))
    nodes = staged(rows.groupBy(F.col("__fp").alias("fp")).agg(F.min(order).alias("first")), "simhash-nodes")
    label = connected_components(links(nodes, distance, parts))
    nodes = nodes.join(label, nodes["fp"] == label["node"], "left")
    nodes = nodes.select("fp", "first", F.coalesce("component", "fp").alias("component"))
    best = nodes.groupBy("component").agg(F.min("first").alias("best"))
    nodes = staged(nodes.join(best, "component").select("fp", "best"), "simhash-classes")
    out = rows.join(nodes, rows["__fp"] == nodes["fp"])
    return out.select(*keep, F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"),
                      F.col("best.id").alias("component_id"),
                      (F.col("best.row") == F.col("__row")).alias("representative"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of ``docs``, all columns, of each component: one with the
    smallest id. Texts meet the verdict by (id, MD5) and are stored nowhere."""
    key = F.to_json(F.struct(F.col(doc_id).alias("i"), F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("m")))
    keyed = docs.withColumn("__content", key)
    best = near_duplicates(keyed, doc_id, text, keep=["__content"], **how).filter("representative").select("__content")
    out = keyed.join(best.hint("shuffle_hash"), "__content", "left_semi")
    # several rows with this id and text: any one of them is the row
    first = F.row_number().over(Window.partitionBy("__content").orderBy(F.hash(*docs.columns)))
    return out.withColumn("__nth", first).filter("__nth = 1").select(*docs.columns)
