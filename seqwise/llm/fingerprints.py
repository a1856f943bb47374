"""Document fingerprints by prefix polynomial hashes.

A text is hashed as a polynomial over its code points in two prime moduli;
``PrefixHash`` keeps the modular prefix arrays, so the hash of any span is a
difference of two entries times a power of the inverse base, whatever the
span's place. Two spans are equal if their hashes are; the longest common
extension of two places, forwards or backwards, is found by binary search over
span hashes (``extension``).

The fingerprint of a document is what is left of its arrays: the length, the hash
of the whole text, and a ladder of 18-bit marks, the hashes of its first m and of
its last m code points for m = 1, 2, 3, 4, 5, 6, 7, 9, 11 ... (steps of 1.3). Prefixes
that agree at m agree below m, so ``likeness`` finds the common beginning and the
common end of two fingerprints by binary search over their marks, without the
texts: (beginning + end) / length of the longer, 1 for equal fingerprints, 0 for
texts with nothing in common at their ends. Equal texts have equal fingerprints;
different ones differ but for a collision of about 2**-62.

``edited_neighbours`` compares every document with an edited text whose last half
comes from the next document. Rows are dealt by ranges of the order (one exchange,
bounds found by Spark from a sample), sorted within, and streamed, each row with
the one after it; the last row of a partition meets the first of the next one in a
small second step over two rows a partition.

Defined results: a null text is an empty one; two empty texts have likeness 1, an
empty and another 0; null ids come last; rows with the same id follow by a hash of their
text, and equal rows in any order (their results are the same); a single row is its own
neighbour; extra columns stay if asked for, and one named like an output is
replaced. Rows of one id are dealt to many tasks, since the text's hash and a row
number are part of the order. The arrays take 8 bytes a code point, of one or two
texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.llm.common import staged

#: Two primes below 2**31 (products of two residues fit 64 bits) and a base of each.
MODULI, BASES = (2_147_483_629, 2_147_483_587), (911_382_323, 972_663_749)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
STEP = 1 << 20


class Powers:
    """Powers of a base modulo a prime, by doubling."""

    def __init__(self, base: int, modulus: int):
        self.base, self.modulus, self.table = base, modulus, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            step = np.uint64(pow(self.base, len(self.table), self.modulus))
            self.table = np.concatenate([self.table, self.table * step % np.uint64(self.modulus)])
        return self.table


POWERS = [Powers(b, m) for b, m in zip(BASES, MODULI)]


class PrefixHash:
    """Modular prefix arrays of a text: entry i is the sum of (c_j + 1) * B**j over j < i."""

    def __init__(self, text: str):
        self.n = len(text)
        self.prefix = [np.zeros(self.n + 1, np.uint32) for _ in MODULI]
        for begin in range(0, self.n, STEP):
            part = text[begin:begin + STEP]
            code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
            for p, powers in zip(self.prefix, POWERS):
                m = np.uint64(powers.modulus)
                shift = np.uint64(pow(powers.base, begin, powers.modulus))
                sums = np.cumsum(code * powers.upto(min(STEP, self.n))[:len(code)] % m) % m * shift
                p[begin + 1:begin + 1 + len(code)] = (sums + np.uint64(p[begin])) % m

    def span(self, begin: int, end: int) -> tuple[int, int]:
        """Hash of text[begin:end], the same wherever the span lies."""
        return tuple((int(p[end]) - int(p[begin])) * pow(b, -begin, m) % m
                     for p, b, m in zip(self.prefix, BASES, MODULI))

    def tails(self, lengths: np.ndarray) -> np.ndarray:
        """Hashes of the last L code points by the first modulus, for every L of the ladder."""
        p, m = self.prefix[0][self.n - lengths].astype(np.int64), MODULI[0]
        lifted = pow(BASES[0], -self.n, m) * RUNG_POWERS[:len(lengths)] % m
        return (int(self.prefix[0][self.n]) - p) % m * lifted % m

    @property
    def whole(self) -> tuple[int, int]:
        return int(self.prefix[0][self.n]), int(self.prefix[1][self.n])


def extension(a: PrefixHash, i: int, b: PrefixHash, j: int, backwards: bool = False) -> int:
    """Longest L with a[i:i+L] == b[j:j+L] (backwards: a[i-L:i] == b[j-L:j]), by binary search."""
    low, high = 0, min(i, j) if backwards else min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        same = a.span(i - mid, i) == b.span(j - mid, j) if backwards else a.span(i, i + mid) == b.span(j, j + mid)
        low, high = (mid, high) if same else (low, mid - 1)
    return low


def ladder(limit: int = 1 << 33) -> np.ndarray:
    """Lengths of the marks, up to more code points than a text can have."""
    out, m = [], 1
    while m <= limit:
        out.append(m)
        m = max(m + 1, int(m * 1.3))
    return np.array(out, np.int64)


RUNGS = ladder()
RUNG_POWERS = np.array([pow(BASES[0], k, MODULI[0]) for k in RUNGS.tolist()], np.int64)


def rungs(n: int) -> np.ndarray:
    """Lengths of the ladder up to n."""
    return RUNGS[:np.searchsorted(RUNGS, n, "right")]


def letters(values) -> str:
    """18 bits of each value as three letters."""
    return "".join([ALPHABET[v >> 12 & 63] + ALPHABET[v >> 6 & 63] + ALPHABET[v & 63] for v in values])


def fingerprint(h: PrefixHash) -> str:
    """length.whole.marks of beginnings.marks of ends"""
    at = rungs(h.n)
    return f"{h.n}.{h.whole[0]:08x}{h.whole[1]:08x}.{letters(h.prefix[0][at].tolist())}.{letters(h.tails(at).tolist())}"


def common(a: str, b: str, at: np.ndarray) -> int:
    """The longest rung at which two rows of marks agree, by binary search."""
    low, high = 0, min(len(a), len(b)) // 3
    while low < high:
        mid = (low + high + 1) // 2
        same = a[3 * mid - 3:3 * mid] == b[3 * mid - 3:3 * mid]
        low, high = (mid, high) if same else (low, mid - 1)
    return int(at[low - 1]) if low else 0


def likeness(a: str, b: str) -> float:
    """0 to 1: the parts at both ends that two fingerprints share, of the longer text."""
    if a == b:
        return 1.0
    n, _, begin_a, end_a = a.split(".")
    m, _, begin_b, end_b = b.split(".")
    n, m = int(n), int(m)
    if not n or not m:
        return 0.0
    at = rungs(min(n, m))
    both = common(begin_a, begin_b, at) + common(end_a, end_b, at)
    return min(both, min(n, m), max(n, m) - 1) / max(n, m)


# DataFrame operators ----------------------------------------------------------

def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "fingerprint") -> DataFrame:
    """The ``keep`` columns (all but the text) and the fingerprint of every row."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != out and (keep is not None or c != text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint(PrefixHash(t)) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, pa.string())], [*keep, out])
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(out, T.StringType())])
    return docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, schema)


def with_likeness(pairs: DataFrame, a: str, b: str, out: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness of two fingerprint columns (null if one is null)."""
    @F.pandas_udf("double")
    def run(x, y):
        import pandas as pd
        return pd.Series([None if p is None or q is None else likeness(p, q) for p, q in zip(x, y)], dtype="float64")
    return pairs.withColumn(out, run(F.col(a), F.col(b)))


def with_extensions(pairs: DataFrame, a: str, b: str, at_a=None, at_b=None) -> DataFrame:
    """``pairs`` with ``common_after`` and ``common_before`` (long): the longest common
    extensions of two text columns from the places ``at_a`` and ``at_b`` (columns, 0
    and the ends where None) forwards, and backwards. A null text is an empty one;
    a place outside its text is moved to the nearer end."""
    zero = F.lit(0).cast("long")
    schema = "common_after long, common_before long"

    @F.pandas_udf(schema)
    def run(x, y, i, j):
        import pandas as pd
        rows = []
        for s, t, p, q in zip(x, y, i, j):
            g, h = PrefixHash(s), PrefixHash(t)
            p, q = min(max(int(p), 0), g.n), min(max(int(q), 0), h.n)
            back = (g.n, h.n) if at_a is None and at_b is None else (p, q)
            rows.append((extension(g, p, h, q), extension(g, back[0], h, back[1], backwards=True)))
        return pd.DataFrame(rows, columns=["common_after", "common_before"])
    place_a = zero if at_a is None else F.coalesce(F.col(at_a).cast("long"), zero)
    place_b = zero if at_b is None else F.coalesce(F.col(at_b).cast("long"), zero)
    empty = F.lit("")
    got = pairs.withColumn("__ext", run(F.coalesce(F.col(a), empty), F.coalesce(F.col(b), empty), place_a, place_b))
    return got.withColumns({c: F.col(f"__ext.{c}") for c in ("common_after", "common_before")}).drop("__ext")


MADE = [("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()),
        ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``after``."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def measures(text: str, own: str, after: str, next_print: str) -> tuple:
    """The output columns of one row, in the order of ``MADE``."""
    changed = edited(text, after)
    other = fingerprint(PrefixHash(changed))
    return (len(text), sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, other,
            likeness(own, other), likeness(own, next_print))


def edited_neighbours(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
                      keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``keep`` columns, n_chars, the SHA-256 of the
    edited text, both fingerprints, and the likeness of the document's fingerprint
    to the edited text's and to the next document's (descending ``id_column``; the
    first follows the last)."""
    names = [c for c, _ in MADE]
    keep = [c for c in (keep or [id_column]) if c not in names]
    kept = F.struct(*[F.col(c) for c in keep])
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(kept.alias("kept"), body.alias("text"), F.col(id_column).alias("id"), F.xxhash64(body).alias("h"),
                       F.monotonically_increasing_id().alias("row"))
    order = [F.col("id").desc_nulls_last(), F.col("h").asc(), F.col("row").asc()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("kept", "text")
    kind = dealt.schema["kept"].dataType
    full = T.StructType([T.StructField("part", T.LongType()), T.StructField("edge", T.StringType()),
                         T.StructField("text", T.StringType()), T.StructField("kept", kind),
                         *(T.StructField(c, t) for c, t in MADE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before = None                            # (kept, text, fingerprint) of the row that waits for its next
        out: list[tuple] = []
        for batch in batches:
            column = batch.column("kept")
            for k, t in enumerate(batch.column("text").to_pylist()):
                own = fingerprint(PrefixHash(t))
                here = column.slice(k, 1)
                if before is None:
                    out.append((part, "first", t, here, *[None] * len(MADE)))
                else:
                    out.append((part, None, None, before[0], *measures(before[1], before[2], t, own)))
                before = (here, t, own)
                if len(out) >= 1_000:
                    yield table_of(out)
                    out = []
        if before is not None:
            out.append((part, "last", before[1], before[0], *[None] * len(MADE)))
            yield table_of(out)

    arrow = [pa.int64(), pa.string(), pa.string(), pa.float64()]
    kinds = [arrow[0], arrow[1], arrow[1], arrow[1], arrow[3], arrow[3]]

    def table_of(rows: list[tuple]) -> pa.RecordBatch:
        part, edge, body, column, *made = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array(edge, pa.string()), pa.array(body, pa.string()), pa.concat_arrays(column),
             *[pa.array(m, k) for m, k in zip(made, kinds)]], ["part", "edge", "text", "kept", *names])

    done = staged(dealt.mapInArrow(run, full), "neighbours")
    firsts = done.filter("edge = 'first'").select("part", "text")
    # one row a partition: the order of the partitions is that of the documents
    w = Window.orderBy("part")
    turn = firsts.select("part", F.coalesce(F.lead("part").over(w), F.first("part").over(w.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))).alias("next_part"))
    lasts = done.filter("edge = 'last'").select("part", "text", "kept").join(turn, "part")
    met = lasts.join(firsts.select(F.col("part").alias("next_part"), F.col("text").alias("after")), "next_part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, after in zip(batch.column("text").to_pylist(), batch.column("after").to_pylist()):
                rows.append(measures(t, fingerprint(PrefixHash(t)), after, fingerprint(PrefixHash(after))))
            made = zip(*rows) if rows else [[]] * len(MADE)
            yield pa.RecordBatch.from_arrays([batch.column("kept"), *[pa.array(list(m), k) for m, k in zip(made, kinds)]],
                                             ["kept", *names])
    ends = met.select("kept", "text", "after").mapInArrow(finish, T.StructType(
        [T.StructField("kept", kind), *(T.StructField(c, t) for c, t in MADE)]))
    return done.filter("edge IS NULL").select("kept", *names).unionByName(ends).select("kept.*", *names)
