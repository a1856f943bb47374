"""Session helpers.

``get_spark`` is only for tests, the bench and local runs; library code takes
the caller's session. ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from
the session and sets a scratch folder only when the cluster named none.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(cpus: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "seqwise") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    parts = shuffle_partitions or int(cpus) * 2
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("SEQWISE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.aggregatePushdown", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised stages.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    given; leaving it unset is an error there, since executors do not share
    local folders. Only a local master gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="seqwise-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def compiled_methods(spark: SparkSession) -> None:
    """Generated methods that the JVM would not compile (more than 8,000 bytes of code, as for
    tables of some fifty columns) are split, unless the session has its own bound."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > 8000:
        spark.conf.set(name, "8000")


def materialize(df, spark: SparkSession | None = None, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: cuts the lineage (a lost executor re-reads files instead of
    recomputing the inputs) and keeps column pruning and filter pushdown for
    every later consumer, which a ``checkpoint()`` RDD would not."""
    import uuid
    spark = spark or df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _STAGED.append(path)
    return spark.read.parquet(path)


# folders written by ``materialize``, for ``drop_staged``
_STAGED: list[str] = []


def drop_staged(spark: SparkSession, keep: tuple[str, ...] = ()) -> int:
    """Delete the folders staged so far, but those whose path holds a string of
    ``keep``. For a caller that is done with every result built on them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = [p for p in _STAGED if not any(k in p for k in keep)]
    for p in gone:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
        _STAGED.remove(p)
    return len(gone)


def materialize_all(frames: dict, spark: SparkSession | None = None, parallel: bool = True) -> dict:
    """``materialize`` several independent DataFrames (or zero-argument
    functions building them), as concurrent jobs: Spark schedules jobs from
    driver threads side by side, so the small stages of one fill cores idle
    in another, and plan construction overlaps too."""
    if not frames:
        return {}

    def one(name, f):
        return materialize(f() if callable(f) else f, spark, name)
    if not parallel or len(frames) == 1:
        return {k: one(k, v) for k, v in frames.items()}
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        futs = {k: pool.submit(one, k, v) for k, v in frames.items()}
        return {k: f.result() for k, f in futs.items()}
