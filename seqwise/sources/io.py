"""Readers and writers.

Parquet is the main format: the event table is partitioned by season so a
season range prunes files. CSV is supported at the edge with an explicit
schema (no inference) and empty text for NULL, as the source pipeline writes
it; CSV cannot tell NULL from an empty string, so Parquet is preferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from seqwise.functions.semantics import nan_to_null


PRECISION = 16              # of distinct-count sketches: 0.4 % relative error, one sigma


def without_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, as at every ingest."""
    return df.withColumns({f.name: nan_to_null(f"`{f.name}`") for f in df.schema.fields
                           if isinstance(f.dataType, (DoubleType, FloatType))})


def read_events(spark: SparkSession, path: str, seasons: range | None = None,
                schema: StructType | None = None, season_col: str = "season") -> DataFrame:
    """Multi-season event load. The season filter prunes partitions."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if seasons is not None:
        df = df.filter(F.col(season_col).between(min(seasons), max(seasons)))
    return without_nan(df)


def read_lookup(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Dimension table (e.g. actor names). Joined without a hint: AQE turns the
    join into a broadcast only when the runtime size is under the threshold."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return without_nan(spark.read.schema(schema).option("header", True).option("nullValue", "")
                       .option("mode", "FAILFAST").csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("nullValue", "").csv(path)


def write_splits(df: DataFrame, path: str, by=("split", "season"), fmt: str = "parquet",
                 mode: str = "overwrite", files: int = 8) -> None:
    """One sink per split: a ``split`` column plus ``partitionBy`` replaces
    three filtered writes (one scan instead of three). Rows are dealt by the
    partition and a hash into at most ``files`` files of each partition, so
    neither does every task write a file per partition nor one task a whole
    season."""
    df = df.repartition(*by, F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    w = df.write.mode(mode).partitionBy(*by)
    if fmt == "csv":
        w.option("header", True).option("nullValue", "").csv(path)
    else:
        w.parquet(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def distinct_summary(df: DataFrame, by: list[str], col: str, precision: int = PRECISION) -> DataFrame:
    """(``by``, sketch) of the distinct values of ``col``: mergeable, to be stored for
    each split or season. Relative error about 1.04 / sqrt(2 ** ``precision``), one sigma."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(col).cast("string"), precision).alias("sketch"))


def distinct_estimate(summaries: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The number of distinct values over any set of stored summaries, without their rows."""
    n = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n")
    return summaries.groupBy(*by).agg(n) if by else summaries.agg(n)


def write_splits_audited(df: DataFrame, path: str, game: str, splits=("train", "valid", "test"), by=("split", "season"),
                         files: int = 8, precision: int = PRECISION) -> tuple[DataFrame, DataFrame]:
    """``write_splits`` that audits what it writes (A10, A11), with no second scan: returns
    (column_name, n_null) of the written rows, and (split, rows, games) of each split, the
    games from a distinct-count sketch. The metrics are observed in the tasks that write."""
    spark, seen = df.sparkSession, Observation()
    at = F.col(by[0])
    metrics = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null {c}") for c in df.columns]
    for s in splits:
        metrics += [F.count_if(at == s).alias(f"rows {s}"),
                    F.hll_sketch_agg(F.when(at == s, F.col(game).cast("string")), precision).alias(f"games {s}")]
    dealt = df.repartition(*by, F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    dealt.observe(seen, *metrics).write.mode("overwrite").partitionBy(*by).parquet(path)
    got = seen.get
    nulls = spark.createDataFrame([(c, got[f"null {c}"]) for c in df.columns], "column_name string, n_null bigint")
    per = spark.createDataFrame([(s, got[f"rows {s}"], bytearray(got[f"games {s}"])) for s in splits],
                                "split string, rows bigint, sketch binary")
    return nulls, per.select("split", "rows", F.hll_sketch_estimate("sketch").alias("games"))
