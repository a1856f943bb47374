"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqwise.session import materialize


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte:
    printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in out]
    return out | {b: chr(0x100 + k) for k, b in enumerate(rest)}


def batches_by_bytes(frame: pd.DataFrame, text: str, limit: int = 3_000_000) -> Iterator[pd.DataFrame]:
    """Slices of a batch whose texts have at most ``limit`` characters
    together (or a single row), so memory does not follow the batch size."""
    total, begin = 0, 0
    for k, n in enumerate(frame[text].str.len().fillna(0)):
        if total and total + n > limit:
            yield frame.iloc[begin:k]
            total, begin = 0, k
        total += n
    if begin < len(frame):
        yield frame.iloc[begin:]


def bounded_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """At most ``rows`` rows an Arrow batch in this session: texts are long, and
    a batch is held whole by the Python worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def with_text(docs: DataFrame, keep: list[str], text: str) -> tuple[DataFrame, str]:
    """(columns ``keep`` and the text, name of the text): the text is sent once,
    as the kept column if it is one."""
    if text in keep:
        return docs.select(*keep), text
    return docs.select(*keep, F.col(text).alias("__text")), "__text"


def texts_of(frame: pd.DataFrame, name: str) -> list[str]:
    """The texts of a batch, empty for null."""
    return [t if isinstance(t, str) else "" for t in frame[name]]


def without_text(frame: pd.DataFrame, name: str) -> pd.DataFrame:
    return frame.drop(columns=name) if name == "__text" else frame


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder of ``spark.checkpoint.dir`` and
    read back: a lost executor re-reads files."""
    return materialize(df, name=name)


def connected_components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its
    smallest node. Alternates large-star and small-star: every node hooks its
    larger neighbours, then its smaller ones, to the smallest it knows, until
    nothing changes. Each round is written to the shared folder."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:                                       # from the larger end to the smaller
            e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
        met = e.join(low, e["a"] == low["c"])
        hooked = met.filter(F.col("b") > F.col("a")) if large else met.filter(F.col("b") != F.col("m"))
        out = hooked.select(F.col("m").alias("a"), "b")
        if not large:
            out = out.unionByName(low.select(F.col("m").alias("a"), F.col("c").alias("b")))
        return out.filter("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        return r[0], r[1]
    e = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    for _ in range(rounds):
        e = staged(star(star(e, True), False), "edges")
        now = state(e)
        if now == before or not now[0]:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    # settled edges are stars: every node but the smallest points to it
    low = e.select(F.least("a", "b").alias("component"), F.greatest("a", "b").alias("node"))
    return (low.select("node", "component")
            .unionByName(low.select(F.col("component").alias("node"), "component")).distinct())
