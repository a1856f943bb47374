"""Co-located event storage (S1, S5, C7): events bucketed by a group key.

``write_colocated`` stores events as a bucketed table: rows of a group (entity,
period) lie in one bucket, sorted by the event order. Whatever later works on
whole groups reads its buckets as they lie: numbering and fills by a window on
the key, and attachments of group tables by a join that shuffles only the small
side. The events are shuffled once, when stored, for all later builds.

The key is one text column made of the group's columns (``key_text``): exact, never
NULL, and the same expression for windows and joins, while NULL-safe comparisons of
the columns themselves hash differently from a window on them and would bring
the shuffle back. Columns that the key does not hold (the season of an attached
table) are compared as a residual condition (``join_colocated``).

A bucket is one task. ``write_colocated`` counts the stored buckets, and a store
with a group too large for a task says so (``even`` is False): callers then take the
shuffling way, which splits groups.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqwise.session import checkpoint_dir

KEY = "__group"
MAX_GROUP_ROWS = 5_000_000


def key_text(cols: list[str], df: DataFrame | None = None) -> Column:
    """One exact, non-NULL text of several columns (of ``df``, one side of a join):
    length and text of each, NULL as ``-``."""
    def part(c: str) -> Column:
        t = (F.col(c) if df is None else df[c]).cast("string")
        return F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t))
    return F.concat(*[part(c) for c in cols])


#: Number of a stored row, and of its block of ``1 << BLOCK_BITS`` neighbouring rows, for
#: plans that work on a few columns of an event and join the rest again.
ROW, BLOCK, BLOCK_BITS = "__row", "__block", 3


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with ``ROW`` and ``BLOCK``, to be stored."""
    return df.withColumn(ROW, F.monotonically_increasing_id()).withColumn(BLOCK, F.shiftright(ROW, BLOCK_BITS))


def stored_by(df: DataFrame, col: str, buckets: int) -> DataFrame:
    """``df``, to be stored in ``buckets`` buckets by ``col``, with a note of it in the schema."""
    return df.withMetadata(col, {"buckets": buckets})


def join_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join of ``numbered`` events with rows of ``right`` that carry their numbers. Partitioned
    by the block, as the events may be stored: then only ``right`` moves, neighbouring rows stay
    together, and a row meets those of its block only (the row as a second key would bring the shuffle back).
    Events ``stored_by`` their block are not sorted for it either: what is joined is hashed, a bucket at a time."""
    r = right.withColumnsRenamed({ROW: "__r_row", BLOCK: "__r_block"})
    if left.schema[BLOCK].metadata.get("buckets"):
        r = r.hint("shuffle_hash")
    same = (left[BLOCK] == r["__r_block"]) & (left[ROW] >= r["__r_row"]) & (left[ROW] <= r["__r_row"])
    return left.join(r, same).drop("__r_row", "__r_block")


def join_group_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """``join_rows`` for numbered events stored by ``KEY``, whose groups are too large to be searched for
    a row: (key, row) is the key of the join and only ``right`` moves, to the buckets of the key. Spark joins two
    sides that are dealt alike by a part of the join's keys if the session allows it, which is set here."""
    left.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    r = right.withColumnsRenamed({ROW: "__r_row", KEY: "__r_key"})
    r = r.repartition(left.schema[KEY].metadata["buckets"], "__r_key").hint("shuffle_hash")
    return left.join(r, (left[KEY] == r["__r_key"]) & (left[ROW] == r["__r_row"])).drop("__r_row", "__r_key")


@dataclass(frozen=True)
class Colocated:
    """A stored, bucketed event table."""
    table: str
    path: str
    group: tuple[str, ...]
    buckets: int
    largest_group: int

    @property
    def even(self) -> bool:
        return self.largest_group <= MAX_GROUP_ROWS

    def read(self, spark: SparkSession) -> DataFrame:
        """The events with their key column, partitioned by it as stored."""
        return spark.table(self.table)

    def drop(self, spark: SparkSession) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def write_colocated(df: DataFrame, group: list[str], order: list[str], buckets: int, name: str = "events",
                    shape: Callable[[DataFrame], DataFrame] | None = None) -> Colocated:
    """Store ``df`` in ``buckets`` buckets by ``group``, each one file sorted by group and
    ``order``. ``buckets``: stored bytes / 200 MB, and no fewer than the cores. ``shape`` makes the
    stored rows of the dealt ones, keeping ``KEY``, where these are narrower. Rows with a number
    (``ROW``) let plans move a few columns of them and join the rest in their buckets."""
    spark = df.sparkSession
    table = f"seqwise_{name}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{table}"
    keyed = df.withColumn(KEY, key_text(group)).repartition(buckets, KEY)
    keyed = stored_by(keyed if shape is None else shape(keyed), KEY, buckets)
    (keyed.sortWithinPartitions(KEY, *order)
     .write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, KEY).sortBy(KEY, *order).saveAsTable(table))
    most = spark.table(table).groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    return Colocated(table, path, tuple(group), buckets, most)


def join_colocated(left: DataFrame, right: DataFrame, group: list[str], also: list[str]) -> DataFrame:
    """Left join of stored events with a group table on (``group``, ``also``), NULLs
    matching: partitioned by the stored key alone, so only ``right`` moves."""
    r = right.select(key_text(group).alias("__rk"), *([key_text(also).alias("__ra")] if also else []),
                     *[F.col(c).alias(f"__r_{c}" if c in {*group, *also} else c) for c in right.columns])
    r = r.hint("shuffle_hash")          # the events need not be sorted
    cond = left[KEY] == r["__rk"]
    if also:
        # a condition over both sides is no join key: the join stays partitioned by the stored key
        cond = cond & F.array_contains(F.array(r["__ra"]), key_text(also, left))
    out = left.join(r, cond, "left")
    return out.select(*[left[c] for c in left.columns], *[r[c] for c in right.columns if c not in {*group, *also}])
