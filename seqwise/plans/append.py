"""As-of rates kept up to date by appended periods.

``RateStore`` keeps what the rates of past periods leave behind, so that new periods are
added without reading old events:

* ``state``: per (side, season) the running sum and the number of NULLs of every
  numerator and denominator: mergeable, and NULL-poison-aware (one NULL makes the
  sum NULL from there on, as in the source);
* ``pending``: per side the last period's rates, which wait for the period they hold for;
* ``asof``: the finished rows, keyed by the period that sees them.

Each is a log: an append writes rows of its own keys only, the latest row of a key
counts. Batches are written under their number and count once their marker is
written last, so an append that was cut off is written over by the next try.

A period comes in one batch and after all stored periods of its side; an earlier, repeated
or unknown (NULL) one raises. NULL sides are a side of their own, as elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqwise.config import EventConfig
from seqwise.functions.semantics import safe_ratio
from seqwise.operators._util import join_null_safe
from seqwise.operators.aggregate import period_facts
from seqwise.operators.impute import fill_by_group
from seqwise.plans.rates import RATE_NAMES, RATE_SPECS

#: Distinct numerators and denominators, the values a state carries.
PARTS = sorted({e for _, num, den in RATE_SPECS for e in (num, den)})


class RateStore:
    def __init__(self, spark: SparkSession, path: str, side: str, prefix: str, cfg: EventConfig = EventConfig()):
        self.spark, self.path, self.side, self.prefix, self.cfg = spark, path.rstrip("/"), side, prefix, cfg
        self.rates = [prefix + n for n in RATE_NAMES]

    # stored logs

    def _exists(self, what: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{what}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def batches(self) -> int:
        """Committed batches: they are numbered from 0 without a gap."""
        return self.spark.read.parquet(f"{self.path}/committed").count() if self._exists("committed") else 0

    def _log(self, what: str) -> DataFrame | None:
        n = self.batches()
        return self.spark.read.parquet(f"{self.path}/{what}").filter(F.col("batch") < n) if n else None

    def _write(self, df: DataFrame, what: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{what}/batch={batch}")

    def _latest(self, what: str, keys: list[str]) -> DataFrame | None:
        log = self._log(what)
        if log is None:
            return None
        cols = [c for c in log.columns if c not in {*keys, "batch"}]
        last = F.max_by(F.struct(*cols), F.col("batch")).alias("__x")
        return log.groupBy(*keys).agg(last).select(*keys, *[F.col(f"__x.{c}").alias(c) for c in cols])

    # append

    def append(self, events: DataFrame) -> int:
        """Add the periods of ``events``; returns the number of the batch."""
        side, season, period = self.side, self.cfg.season, self.cfg.period
        k = self.batches()
        self._write(period_facts(events, side, self.cfg), "facts", k)
        facts = self.spark.read.parquet(f"{self.path}/facts/batch={k}")
        pending, state = self._latest("pending", [side]), self._latest("state", [side, season])
        self._write(self._checked(facts, pending).transform(lambda f: self._running(f, state)), "running", k)
        running = self.spark.read.parquet(f"{self.path}/running/batch={k}")
        totals = [c for j in range(len(PARTS)) for c in (f"s{j}", f"z{j}")]
        last = F.max_by(F.struct(*totals), F.col(period)).alias("__x")
        self._write(running.groupBy(side, season).agg(last).select(side, season, "__x.*"), "state", k)

        rows = running.select(side, season, period, *self.rates)
        if pending is not None:                      # the waiting rows of the sides that go on
            touched = rows.select(side).distinct().withColumn("__touched", F.lit(True))
            rows = rows.unionByName(join_null_safe(pending, touched, [side], "inner").select(*rows.columns))
        w = Window.partitionBy(side).orderBy(season, period)
        rows = rows.withColumn("__next", F.lead(period).over(w))
        self._write(rows.filter("__next IS NOT NULL").select(side, season, F.col("__next").alias(period), *self.rates), "asof", k)
        self._write(rows.filter("__next IS NULL").drop("__next"), "pending", k)
        self.spark.range(1).select(F.lit(k).alias("batch")).coalesce(1).write.mode("append").parquet(f"{self.path}/committed")
        return k

    def _checked(self, facts: DataFrame, pending: DataFrame | None) -> DataFrame:
        """The facts of a batch, or an error where a period is unknown or not after the stored ones."""
        season, period = F.col(self.cfg.season), F.col(self.cfg.period)
        wrong = season.isNull() | period.isNull()
        if pending is not None:
            last = pending.select(self.side, F.struct(self.cfg.season, self.cfg.period).alias("__last"))
            facts = join_null_safe(facts, last, [self.side], "left")
            wrong = wrong | F.coalesce(F.struct(season, period) <= F.col("__last"), F.lit(False))
        said = F.concat(F.lit("period not after the stored ones: "), F.coalesce(season.cast("string"), F.lit("NULL")), F.lit(" "),
                        F.coalesce(period.cast("string"), F.lit("NULL")))
        kind = facts.schema[self.cfg.period].dataType
        return facts.withColumn(self.cfg.period, F.when(wrong, F.raise_error(said).cast(kind)).otherwise(period)).drop("__last")

    def _running(self, facts: DataFrame, state: DataFrame | None) -> DataFrame:
        """Running sums (s) and NULLs (z) of every part after each period, from the state on, and the rates."""
        side, season, period = self.side, self.cfg.season, self.cfg.period
        w = Window.partitionBy(side, season).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
        if state is not None:
            state = state.select(side, season, *[F.col(f"{p}{j}").alias(f"__{p}{j}") for j in range(len(PARTS)) for p in "sz"])
            facts = join_null_safe(facts, state, [side, season], "left")
        out = {}
        for j, e in enumerate(PARTS):
            e = F.expr(e)
            s, z = F.sum(e).over(w), F.count(F.lit(1)).over(w) - F.count(e).over(w)
            if state is not None:
                before = F.col(f"__s{j}")
                s, z = F.coalesce(before + s, before, s), F.coalesce(F.col(f"__z{j}"), F.lit(0)) + z
            out |= {f"s{j}": s, f"z{j}": z}
        rows = facts.select(side, season, period, *[c.alias(n) for n, c in out.items()])
        value = {e: F.when(F.col(f"z{j}") == 0, F.col(f"s{j}")) for j, e in enumerate(PARTS)}
        return rows.withColumns({self.prefix + n: safe_ratio(value[num], value[den]) for n, num, den in RATE_SPECS})

    # results

    def unfilled(self) -> DataFrame:
        """C3 before the fill, as ``asof_rates(..., fill=False)`` of all events appended."""
        done, waiting = self._log("asof"), self._latest("pending", [self.side])
        if done is None:
            raise ValueError("nothing was appended")
        waiting = waiting.withColumn(self.cfg.period, F.lit(None).cast(waiting.schema[self.cfg.period].dataType))
        return done.drop("batch").unionByName(waiting.select(*[c for c in done.columns if c != "batch"]))

    def filled(self) -> DataFrame:
        """NULL rates filled with the season means of all rows appended so far."""
        return fill_by_group(self.unfilled(), [self.cfg.season], self.rates)
