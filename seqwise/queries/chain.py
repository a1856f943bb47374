"""The chain from the feature table to trained windows (C10 -> C11 -> C12 -> C13
-> C14): prepare, split, encode, scale, sequences by (game, side) in play order,
windows, fit and evaluate."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from seqwise.operators.project import prepare_events
from seqwise.operators.sequence import BLOCK, longest, number_steps, pad_steps, step_windows
from seqwise.plans.model import evaluate, history_frame, select_best, window_vectors, with_class_weight
from seqwise.plans.prepare import encode_and_scale
from seqwise.queries._common import rnd, rounded
from seqwise.queries._sql import with_plays
from seqwise.queries.features import FEATURE_CTES, q_feature_table
from seqwise.queries.prepare import LABEL_MAP, RECODE_SQL
from seqwise.queries.rates import CFG
from seqwise.session import materialize

KEYS, WIN = ["game_id", "posteam", "split"], 4
FEATS = ["down", "yards_gained", "epa", "wp", "pt_spread", "pt_pass_pct"]


def chain_events(spark, sf):
    """Prepared (strict), encoded and scaled events, stored once."""
    p = prepare_events(q_feature_table(spark, sf), cfg=CFG, fourth_down=None)
    # labels, scales and the encoded events read it: stored, so that the features are built once
    p = materialize(p.select(*KEYS, "pt_play_no", "play_type", *FEATS), spark, "prepared")
    return materialize(encode_and_scale(p, "play_type", LABEL_MAP, FEATS, fit_labels_on="train", code="label"), spark, "chain")


def chain_windows(spark, sf):
    e = chain_events(spark, sf)
    length = longest(e, KEYS)
    # plays of a game are numbered; blocks of them are the coarse order column
    e = e.withColumn("block", F.floor(F.col("pt_play_no") / BLOCK).cast("int"))
    # the padding is made from the numbered steps too: stored, so that they are numbered once
    steps = materialize(number_steps(e, KEYS, ["block", "pt_play_no"], FEATS, "label"), spark, "steps")
    s = pad_steps(steps, KEYS, length, "left")
    return e, step_windows(s, KEYS, WIN, length, padding="drop")


def q_pipeline_windows(spark, sf):
    w = chain_windows(spark, sf)[1]
    # sums over the steps, in whole millionths, stand for the features
    sums = [F.expr(f"aggregate(features, 0L, (a, x) -> a + cast(round(x[{k}] * 1000000) as long))").alias(f) for k, f in enumerate(FEATS)]
    return w.select(*KEYS, "window_index", "label", *sums)


def q_pipeline_train(spark, sf):
    e, w = chain_windows(spark, sf)
    w = materialize(window_vectors(w).withColumn("label", F.col("label").cast("double")), spark, "chain_windows")
    train, valid, test = (w.filter(F.col("split") == x) for x in ("train", "valid", "test"))
    train = with_class_weight(train, e.filter(F.col("split") == "train").withColumn("label", F.col("label").cast("double")))
    best, model, history = select_best(train, valid, {
        f"lr_reg{r}": Pipeline(stages=[LogisticRegression(featuresCol="vec", labelCol="label", weightCol="weight",
                                                          regParam=r, maxIter=20)]) for r in (0.0, 0.1)})
    scores = evaluate(model.transform(test))
    return history_frame(spark, history, best).withColumn("test_logloss", F.when(F.col("selected"), F.lit(scores["logLoss"])))


QUERIES = {"pipeline_windows": q_pipeline_windows, "pipeline_train": q_pipeline_train}

_MM = ", ".join(f"min({c}) as mn_{c}, max({c}) as mx_{c}" for c in FEATS)
_SCALED = ", ".join(f"(cast({c} as double) - cast(mn_{c} as double)) / (case when mx_{c} = mn_{c} then 1.0::double "
                    f"else cast(mx_{c} as double) - cast(mn_{c} as double) end) as {c}" for c in FEATS)
_LISTS = ", ".join(f"list(cast(round({c} * 1000000) as bigint) order by pt_play_no) as x_{c}" for c in FEATS)
_SUMS = ", ".join(f"cast(coalesce(list_sum(list_slice(x_{c}, greatest(i - (len - n) + 1, 1), i - (len - n) + {WIN})), 0) as bigint) as {c}"
                  for c in FEATS)
_RECODE = RECODE_SQL.replace("case pt", "case play_type")

ORACLE = {
    "pipeline_windows": with_plays(f"""select game_id, posteam, split, cast(i as int) as window_index,
        y[i - (len - n) + {WIN} + 1] as label, {_SUMS}
      from seqs, generate_series(0, len - {2 * WIN}) g(i) where i + {WIN} >= len - n""", FEATURE_CTES + f""",
fr as (select {", ".join(rnd(c) + " as " + c for c in ("pt_play_no", "pt_spread", "pt_pass_pct"))},
        game_id, posteam, split, {_RECODE} as cls, down, yards_gained, epa, wp from features),
codes as (select cls, cast(row_number() over (order by cls nulls last) - 1 as int) as label
          from (select distinct cls from fr where split = 'train') d),
mm as (select {_MM} from fr where split = 'train'),
sc as (select game_id, posteam, split, pt_play_no, label, {_SCALED}
       from fr left join codes on fr.cls is not distinct from codes.cls, mm),
seqs as (select game_id, posteam, split, {_LISTS}, list(label order by pt_play_no) as y, count(*) as n,
           max(count(*)) over () as len from sc group by game_id, posteam, split)"""),
}
