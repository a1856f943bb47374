"""Next-event classifiers as Spark ML jobs.

The source trains recurrent networks on one machine; here each window row
(n steps x k features) is flattened to a vector and fed to Spark ML
estimators, which train data-parallel. Selection follows the source's rule
with fixed splits: fit every candidate on ``train``, score on ``valid``, keep
the lowest validation log-loss, report on ``test``. Evaluation tables
(confusion, per-class report, accuracy, RMSE of codes) are aggregations over
(label, prediction) pairs, so they stay distributed.
"""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqwise.functions.semantics import nan_to_null
from seqwise.operators._util import join_null_safe, small_side
from seqwise.session import materialize
from seqwise.operators.aggregate import class_weights


def window_vectors(win: DataFrame, features: str = "features", out: str = "vec") -> DataFrame:
    """Flatten an (n x k) window to one ML vector, JVM-side."""
    return win.withColumn(out, array_to_vector(F.flatten(F.col(features))))


def with_class_weight(df: DataFrame, fit_on: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """M4: balanced weight n / (k * n_c) of each row's class, fitted on ``fit_on``."""
    w = class_weights(fit_on, label).select(label, F.col("weight").alias(out))
    return join_null_safe(df, small_side(w), [label], "left").fillna({out: 1.0})


def evaluate(pred: DataFrame, label: str = "label", weight: str | None = None) -> dict:
    """M7: log-loss and accuracy (the source's evaluate), plus weighted F1."""
    out = {}
    for metric in ("logLoss", "accuracy", "f1"):
        ev = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
        if weight:
            ev.setWeightCol(weight)
        out[metric] = ev.evaluate(pred)
    return out


def objective_history(model) -> list[float]:
    """Objective after each iteration of the last stage (empty if it keeps none)."""
    last = model.stages[-1] if hasattr(model, "stages") else model
    if not getattr(last, "hasSummary", False):
        return []
    return [float(x) for x in getattr(last.summary, "objectiveHistory", [])]


def select_best(train: DataFrame, valid: DataFrame, candidates: dict, label: str = "label",
                metric: str = "logLoss"):
    """M5 + M6 + M13: fit each candidate on train, score on valid, keep the
    best by ``metric`` (lower is better for logLoss). Returns (best name,
    best model, history rows as dicts, with the objective per iteration)."""
    history = []
    best = None
    for name, est in candidates.items():
        model = est.fit(train)
        scores = evaluate(model.transform(valid), label)
        objective = objective_history(model)
        history.append({"candidate": name, "iterations": max(len(objective) - 1, 0) if objective else None,
                        "objective": objective, "valid_logloss": float(scores["logLoss"]),
                        "valid_accuracy": float(scores["accuracy"])})
        key = scores[metric] if metric == "logLoss" else -scores[metric]
        if best is None or key < best[0]:
            best = (key, name, model)
    return best[1], best[2], history


def confusion(pred: DataFrame, classes: list, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M9: one row per listed class, one column per predicted class, zeros
    filled. A label or prediction outside the list (or NULL) raises."""
    codes = [int(c) for c in classes]

    def listed(c):
        c = F.col(c).cast("int")
        return F.when(c.isin(codes), c).otherwise(F.raise_error(
            F.concat(F.lit("class not listed: "), F.coalesce(c.cast("string"), F.lit("NULL")))).cast("int"))
    pairs = (pred.select(listed(label).alias("true_label"), listed(prediction).alias("pred"))
             .groupBy("true_label", "pred").agg(F.count(F.lit(1)).alias("n")))
    none = pred.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, codes))).alias("true_label"))
    pairs = pairs.unionByName(none.select("true_label", F.col("true_label").alias("pred"), F.lit(0).cast("long").alias("n")))
    return pairs.groupBy("true_label").agg(*[
        F.sum(F.when(F.col("pred") == c, F.col("n")).otherwise(0)).alias(f"pred_{c}") for c in codes])


def class_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro and
    weighted averages, from the (label, prediction) counts."""
    # (label, prediction) counts: at most classes^2 rows, read by every part
    # of the report, so stored once instead of re-deriving the predictions
    pairs = materialize(pred.select(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p"))
                        .groupBy("y", "p").agg(F.count(F.lit(1)).alias("n")), name="label_pairs")
    tp = pairs.filter(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    sup = pairs.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    pcount = pairs.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = (sup.join(pcount, "cls", "full").join(tp, "cls", "left")
           .fillna(0, subset=["support", "predicted", "tp"]))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.select(F.col("cls").cast("string").alias("cls"), prec.alias("precision"), rec.alias("recall"),
                     F.col("support").cast("bigint").alias("support"))
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    tot = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), tot.cast("bigint").alias("support"), F.avg("f1").alias("f1"))
    wavg = per.agg(F.lit("weighted avg").alias("cls"),
                   (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                   (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                   tot.cast("bigint").alias("support"),
                   (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"))
    return per.unionByName(macro).unionByName(wavg)


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M11."""
    return pred.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def rmse_codes(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Root mean squared difference between class codes."""
    d = F.col(label).cast("double") - F.col(prediction).cast("double")
    return pred.agg(F.sqrt(F.avg(d * d)).alias("rmse"))


def history_frame(spark: SparkSession, history: list[dict], best: str) -> DataFrame:
    """Candidate-level training table (small: one row per candidate)."""
    rows = [dict(h, selected=(h["candidate"] == best)) for h in history]
    return spark.createDataFrame(rows, "candidate string, iterations int, objective array<double>, "
                                       "valid_logloss double, valid_accuracy double, selected boolean")


# early stopping (M6) ----------------------------------------------------------

ROUNDS, PATIENCE = 25, 5


def stopping(scores: DataFrame, run: list[str], round_: str = "round", loss: str = "valid_loss",
             accuracy: str = "valid_accuracy", patience: int = PATIENCE, rounds: int = ROUNDS) -> DataFrame:
    """Where training stops and which round is kept, for every ``run`` of a table of
    validation scores per round (from 1 on, distinct in a run): training ends after
    ``patience`` rounds without a new highest accuracy, or after ``rounds``; the round
    with the lowest loss until then is kept, the first of equal ones. One row a run:
    ``stopped_at``, ``best_round``, ``best_loss``, ``early``. A missing score is no
    improvement."""
    w = Window.partitionBy(*run).orderBy(round_)
    before = F.max(accuracy).over(w.rowsBetween(Window.unboundedPreceding, -1))
    seen = scores.filter(F.col(round_) <= rounds).select(
        *run, F.col(round_).alias("r"), nan_to_null(F.col(loss).cast("double")).alias("loss"),
        nan_to_null(F.col(accuracy).cast("double")).alias(accuracy)).withColumnRenamed("r", round_)
    better = F.col(accuracy).isNotNull() & (before.isNull() | (F.col(accuracy) > before))
    seen = seen.withColumn("__better", better)
    last = F.max(F.when(F.col("__better"), F.col(round_))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    seen = seen.withColumn("__wait", F.col(round_) - F.coalesce(last, F.lit(0)))
    ends = F.min(F.when(F.col("__wait") >= patience, F.col(round_))).over(Window.partitionBy(*run))
    seen = seen.withColumn("__end", ends).filter(F.col("__end").isNull() | (F.col(round_) <= F.col("__end")))
    order = F.struct(F.col("loss").isNull(), F.col("loss"), F.col(round_))
    return seen.groupBy(*run).agg(F.max(round_).cast("int").alias("stopped_at"), F.min_by(round_, order).cast("int").alias("best_round"),
                                  F.min("loss").alias("best_loss"), F.max(F.col("__end").isNotNull()).alias("early"))


class Rounds:
    """A training run stored round by round under ``path``: the model and the scores of
    each round, wall times apart. A run that lost its driver goes on after its last
    stored round; a finished one is only read."""
    SCORES = "round int, valid_loss double, valid_accuracy double"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, what: str, schema: str) -> DataFrame:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{what}")
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{what}")

    def scores(self) -> DataFrame:
        return self._read("scores", self.SCORES)

    def times(self) -> DataFrame:
        """Seconds of each round's fit and validation: not repeatable, so not among the scores."""
        return self._read("times", "round int, seconds double")

    def model(self, round_: int):
        from pyspark.ml.classification import MultilayerPerceptronClassificationModel
        return MultilayerPerceptronClassificationModel.load(f"{self.path}/round-{round_}")

    def add(self, round_: int, model, loss: float, accuracy: float, seconds: float) -> None:
        model.write().overwrite().save(f"{self.path}/round-{round_}")
        self.spark.createDataFrame([(round_, seconds)], "round int, seconds double").coalesce(1).write.mode("append").parquet(f"{self.path}/times")
        # the scores last: a round counts once its model is stored
        self.spark.createDataFrame([(round_, loss, accuracy)], self.SCORES).coalesce(1).write.mode("append").parquet(f"{self.path}/scores")

    def verdict(self, patience: int, rounds: int):
        """Row of ``stopping`` (None before the first round)."""
        return stopping(self.scores().withColumn("run", F.lit(1)), ["run"], patience=patience, rounds=rounds).first()


def fit_rounds(train: DataFrame, valid: DataFrame, path: str, layers: list[int], features: str = "vec", label: str = "label",
               rounds: int = ROUNDS, patience: int = PATIENCE, iterations: int = 4, seed: int = 7):
    """M5 + M6: a network trained in rounds of ``iterations`` passes over ``train``, each
    starting from the weights of the one before, validated after each; stops and
    picks by ``stopping``. Returns (best model, ``Rounds``). ``train`` and ``valid``
    should be stored tables."""
    import time

    from pyspark.ml.classification import MultilayerPerceptronClassifier
    run = Rounds(train.sparkSession, path)
    now = run.verdict(patience, rounds)
    done = now.stopped_at if now else 0
    weights = run.model(done).weights if done else None
    while not (now and (now.early or done >= rounds)):
        begin = time.monotonic()
        net = MultilayerPerceptronClassifier(layers=layers, featuresCol=features, labelCol=label, maxIter=iterations, seed=seed)
        model = (net.setInitialWeights(weights) if weights is not None else net).fit(train)
        scores = evaluate(model.transform(valid), label)
        done, weights = done + 1, model.weights
        run.add(done, model, float(scores["logLoss"]), float(scores["accuracy"]), time.monotonic() - begin)
        now = run.verdict(patience, rounds)
    return run.model(now.best_round), run
