"""Evaluation tables and classifier training on ``events`` windows.

The metric queries score a deterministic rule (predict the sequence's
previous label) so they can be checked against SQL; the training queries
fit Spark ML models on the sliding windows and have no SQL oracle."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from seqwise.functions.scalar import argmax
from seqwise.operators.aggregate import class_weights
from seqwise.operators.encode import minmax_scale
from seqwise.operators.sequence import longest, number_steps, pad_steps, previous_step, step_windows
from seqwise.operators.split import key_split
from seqwise.plans.model import (
    accuracy, class_report, confusion, evaluate, history_frame, rmse_codes, select_best, window_vectors,
    with_class_weight,
)
from seqwise.queries._common import rnd, rounded
from seqwise.queries.sequence import EV, FEATS, KEYS, ORDER, WIN, labelled_events, steps
from seqwise.session import checkpoint_dir, materialize
from seqwise.sources.io import load_model, save_model

CLASSES = [0, 1, 2, 3, 4]


def rule_predictions(spark, sf):
    """Predict each event's label as the previous label of its sequence
    (the first event gets 0)."""
    p = previous_step(steps(spark, sf), KEYS, "label", "__before")
    return p.select("label", F.coalesce("__before", F.lit(0)).alias("prediction"))


def q_confusion(spark, sf):
    return confusion(rule_predictions(spark, sf), CLASSES)


def q_class_report(spark, sf):
    return rounded(class_report(rule_predictions(spark, sf)))


def q_accuracy(spark, sf):
    return rounded(accuracy(rule_predictions(spark, sf)))


def q_rmse_codes(spark, sf):
    return rounded(rmse_codes(rule_predictions(spark, sf)))


def model_events(spark, sf):
    """Labelled events with their split (user_id mod 5)."""
    return key_split(labelled_events(spark, sf), "user_id")


def window_table(spark, sf):
    """Scaled (min-max of the train events), left-padded windows of all splits;
    targets that are padding are left out."""
    e = model_events(spark, sf)
    e = minmax_scale(e, FEATS, fit_on=e.filter(F.col("split") == "train"))
    length = longest(e, KEYS)
    s = pad_steps(number_steps(e, KEYS + ["split"], ORDER, FEATS, "label"), KEYS + ["split"], length, "left")
    w = step_windows(s, KEYS + ["split"], WIN, length, padding="drop")
    return window_vectors(w).withColumn("label", F.col("label").cast("double"))


def q_model_inputs(spark, sf):
    """Windows per split and class, with the class weights of the train events
    (unpadded)."""
    n = window_table(spark, sf).groupBy("split", F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    w = class_weights(model_events(spark, sf).filter(F.col("split") == "train"), "label").select("label", "weight")
    return rounded(n.join(w, "label", "left"))


def _train_eval(spark, sf, candidates, weighted):
    # windows are written once: every candidate fit and every metric reads them
    w = materialize(window_table(spark, sf), spark, "windows")
    train, valid, test = (w.filter(F.col("split") == s) for s in ("train", "valid", "test"))
    if weighted:
        train = with_class_weight(train, model_events(spark, sf).filter(F.col("split") == "train")
                                  .withColumn("label", F.col("label").cast("double")))
    best, model, hist = select_best(train, valid, candidates)
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{best}"
    save_model(model, path)                 # S6: keep the selected model, then reload it
    model = load_model(path)
    scores = evaluate(model.transform(test))
    h = history_frame(spark, hist, best)
    return h.withColumns({"test_logloss": F.when(F.col("selected"), F.lit(scores["logLoss"])),
                          "test_accuracy": F.when(F.col("selected"), F.lit(scores["accuracy"])),
                          "test_f1": F.when(F.col("selected"), F.lit(scores["f1"]))})


def q_train_eval_lr(spark, sf):
    """Two-class style: class-weighted logistic regression candidates."""
    cands = {f"lr_reg{r}": Pipeline(stages=[LogisticRegression(featuresCol="vec", labelCol="label", weightCol="weight",
                                                              regParam=r, maxIter=50)])
             for r in (0.0, 0.01)}
    return _train_eval(spark, sf, cands, weighted=True)


def q_train_eval_rf(spark, sf):
    """Multi-class style: unweighted candidates, a forest and a regression."""
    cands = {
        "rf_20": Pipeline(stages=[RandomForestClassifier(featuresCol="vec", labelCol="label", numTrees=20,
                                                         maxDepth=6, seed=7)]),
        "lr_reg0.01": Pipeline(stages=[LogisticRegression(featuresCol="vec", labelCol="label", regParam=0.01,
                                                          maxIter=50)]),
    }
    return _train_eval(spark, sf, cands, weighted=False)


def q_test_confusion(spark, sf):
    """M8 + M9 on a trained model: predictions on test windows, confusion table."""
    w = materialize(window_table(spark, sf), spark, "windows")
    train, test = w.filter(F.col("split") == "train"), w.filter(F.col("split") == "test")
    model = Pipeline(stages=[LogisticRegression(featuresCol="vec", labelCol="label", regParam=0.01,
                                                maxIter=30)]).fit(train)
    # predicted class = argmax of the probability vector, as the source takes it
    pred = model.transform(test).withColumn("prediction", argmax(vector_to_array("probability")))
    return confusion(pred, CLASSES)


# A fixed linear model: class scores are small whole multiples of the features.
COEF = [(3, -1), (-2, 4), (1, 2), (0, -3), (-1, 1)]


def q_predict_argmax(spark, sf):
    """M8 + F15: class scores of every event under a fixed coefficient table,
    prediction = argmax (the first of equal scores)."""
    e = labelled_events(spark, sf)
    score = F.array(*[a * F.floor("value").cast("double") + b * F.col("hr") for a, b in COEF])
    return e.select("event_id", "label", argmax(score).alias("prediction"))


QUERIES = {
    "model_inputs": q_model_inputs,
    "predict_argmax": q_predict_argmax,
    "confusion": q_confusion,
    "class_report": q_class_report,
    "accuracy": q_accuracy,
    "rmse_codes": q_rmse_codes,
    "train_eval_lr": q_train_eval_lr,
    "train_eval_rf": q_train_eval_rf,
    "test_confusion": q_test_confusion,
}

PRED = EV + """, pred as (select user_id, label,
    coalesce(lag(label) over (partition by user_id order by ts, event_id), 0) as prediction from ev),
pairs as (select label as y, prediction as p, count(*) as n from pred group by label, prediction),
per as (select c.cls, coalesce(t.tp, 0) as tp, coalesce(s.support, 0) as support, coalesce(q.predicted, 0) as predicted
  from (select y as cls from pairs union select p from pairs) c
  left join (select y as cls, n as tp from pairs where y = p) t on t.cls = c.cls
  left join (select y as cls, sum(n) as support from pairs group by y) s on s.cls = c.cls
  left join (select p as cls, sum(n) as predicted from pairs group by p) q on q.cls = c.cls),
rep as (select cast(cls as varchar) as cls, coalesce(tp / nullif(cast(predicted as double), 0), 0.0) as precision,
  coalesce(tp / nullif(cast(support as double), 0), 0.0) as recall, cast(support as bigint) as support from per),
rep2 as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) as f1 from rep)"""

_SPLIT = "case user_id % 5 when 4 then 'test' when 3 then 'valid' else 'train' end"
_SCORES = "[" + ", ".join(f"{a} * floor(value) + {b} * hr" for a, b in COEF) + "]"

ORACLE = {
    "model_inputs": EV + f""", win as (select {_SPLIT} as split, y[i + {WIN} - (len - n) + 1] as label
      from seq, generate_series(0, len - {2 * WIN}) a(i) where i + {WIN} >= len - n),
    tr as (select label, count(*) as n_c from ev where {_SPLIT} = 'train' group by label),
    wt as (select label, {rnd('cast(sum(n_c) over () as double) / (count(*) over () * n_c)')} as weight from tr)
    select win.split, win.label, count(*) as n, any_value(wt.weight) as weight
    from win left join wt using (label) group by win.split, win.label""",
    "predict_argmax": EV + f""" select event_id, label, cast(list_position(s, list_max(s)) - 1 as int) as prediction
      from (select event_id, label, {_SCORES} as s from ev) t""",
    "confusion": PRED + " select cast(label as int) as true_label, "
    + ", ".join(f"cast(count(*) filter (where prediction = {c}) as bigint) as pred_{c}" for c in CLASSES)
    + " from pred group by label",
    "class_report": PRED + f""" select cls, {rnd('precision')} as precision, {rnd('recall')} as recall, support, {rnd('f1')} as f1 from rep2
      union all select 'macro avg', {rnd('avg(precision)')}, {rnd('avg(recall)')}, cast(sum(support) as bigint), {rnd('avg(f1)')} from rep2
      union all select 'weighted avg', {rnd('sum(precision * support) / sum(support)')}, {rnd('sum(recall * support) / sum(support)')},
        cast(sum(support) as bigint), {rnd('sum(f1 * support) / sum(support)')} from rep2""",
    "accuracy": PRED + f" select {rnd('avg(case when label = prediction then 1.0 else 0.0 end)')} as accuracy from pred",
    "rmse_codes": PRED + f" select {rnd('sqrt(avg(power(cast(label - prediction as double), 2)))')} as rmse from pred",
}
