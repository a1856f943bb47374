"""Heavy-key join (J5): frequent keys of the events apart from the others.

A shuffle join sends all events of a key to one task, so a frequent actor, or the
NULL actor of most events, is one task's work; AQE splits such a partition only
after it was shuffled, and only in some plans. Here the frequent keys are known
before:

1. ``key_summary``: a mergeable heavy-hitter sketch of the left keys, one pass with
   partial aggregation. Summaries can be stored per season (or any group) and merged
   for any set of them without reading events (``merged``).
2. ``heavy_keys``: the hashes of the keys above a share of the rows: at most
   1 / share of them, by arithmetic, whatever the data.
3. ``heavy_join``: events of heavy keys meet the few right rows of these keys by a
   broadcast, after a check of their stored size; all others meet the right side by a
   shuffle join, in which no key has more than the share. Where the right rows of
   the heavy keys are too many, or with ``mode="salt"`` (one pass over a costly left
   side), heavy keys are salted: right rows copied ``salts`` times, left rows dealt.

NULL keys meet NULL keys, as everywhere in the library. The sketch is approximate,
the result is not: a key missing from the list, or one more, changes the way its rows go only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqwise.operators._util import SMALL_BYTES, SMALL_ROWS, join_null_safe
from seqwise.session import materialize

SHARE = 0.001               # of the rows, from which a key is heavy
TRACKED = 16_384            # items of a sketch: counts are off by 3.5 / TRACKED of the rows at most
SALTS = 64


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def key_summary(df: DataFrame, keys: list[str], by: list[str] | None = None, tracked: int = TRACKED) -> DataFrame:
    """(``by`` columns, rows, summary): one sketch of the key's frequencies for each group."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(__h, {int(tracked)})").alias("summary")]
    narrow = df.select(*(by or []), key_hash(keys).alias("__h"))
    return narrow.groupBy(*by).agg(*aggs) if by else narrow.agg(*aggs)


def merged(summaries: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One (rows, summary) of several, e.g. of the seasons a run reads."""
    return summaries.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                         F.expr(f"approx_top_k_combine(summary, {int(tracked)})").alias("summary"))


def heavy_keys(summary: DataFrame, share: float = SHARE) -> list[int]:
    """Hashes of the keys with more than ``share`` of the rows (at most 1 / share)."""
    if not 5 / TRACKED < share <= 1:
        raise ValueError(f"share {share} is below what the sketch resolves")
    most = int(1 / share)
    row = summary.filter("rows > 0").select("rows", F.expr(f"approx_top_k_estimate(summary, {most})").alias("top")).first()
    if row is None:
        return []
    return [x["item"] for x in row.top if x["count"] > share * row.rows]


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], heavy: list[int], how: str, salts: int) -> DataFrame:
    """One shuffle join on (keys, salt): left rows of heavy keys are dealt to ``salts``
    salts, right rows of heavy keys are copied to each."""
    hot = key_hash(keys).isin(heavy)
    dealt = left.withColumn("__salt", F.when(hot, F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")).otherwise(0))
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = right.withColumn("__salt", F.explode(copies))
    return join_null_safe(dealt, spread, [*keys, "__salt"], how).drop("__salt")


def heavy_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", heavy: list[int] | None = None,
               share: float = SHARE, mode: str = "broadcast", salts: int = SALTS,
               max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Left or inner equi-join (NULL keys match) that no frequent left key makes uneven.

    ``heavy``: hashes from ``heavy_keys``; found from ``left`` if None. ``right`` may have
    several rows a key. ``mode="broadcast"`` reads ``left`` twice, each time filtered;
    ``mode="salt"`` once. Rows that are equal in every column share a salt."""
    if how not in ("left", "inner"):
        raise ValueError(how)
    if mode not in ("broadcast", "salt"):
        raise ValueError(mode)
    heavy = heavy_keys(key_summary(left, keys), share) if heavy is None else heavy
    if not heavy:
        return join_null_safe(left, right, keys, how)
    if mode == "salt":
        return salted_join(left, right, keys, heavy, how, salts)
    hot = key_hash(keys).isin(heavy)
    few = materialize(right.filter(hot), name="heavy_side")
    size = int(str(few._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > max_bytes or few.count() > max_rows:
        return salted_join(left, right, keys, heavy, how, salts)
    often = join_null_safe(left.filter(hot), F.broadcast(few), keys, how)
    return often.unionByName(join_null_safe(left.filter(~hot), right.filter(~hot), keys, how))
