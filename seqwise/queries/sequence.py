"""Class balance, encoders and sequence windows on ``events``
(A12-A16, M1, N1-N10). sequence = user_id, order = (day, ts, event_id),
label = event_type code, features = (value, hour of ts). The pad length is the
longest sequence, found by the profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqwise.operators.aggregate import class_balance, class_weights, minmax_fit
from seqwise.operators.encode import apply_labels, fit_labels
from seqwise.operators.sequence import (
    longest, number_steps, pad_steps, rolling_windows, sequence_profile, step_windows, with_batch_id, with_step_mask,
)
from seqwise.queries._common import rnd, rounded
from seqwise.sources.fixtures import events

WIN, BATCH_R, BATCH_L = 15, 32, 87
KEYS, ORDER, FEATS = ["user_id"], ["day", "ts", "event_id"], ["value", "hr"]


def labelled_events(spark, sf):
    e = events(spark, sf).withColumns({"hr": F.hour("ts").cast("double"), "day": F.to_date("ts")})
    codes = fit_labels(e, "event_type", code="label")
    return apply_labels(e, codes, "event_type")


def steps(spark, sf):
    return number_steps(labelled_events(spark, sf), KEYS, ORDER, FEATS, "label")


def pad_length(spark, sf):
    return longest(events(spark, sf), KEYS)


def padded(spark, sf, side):
    return pad_steps(steps(spark, sf), KEYS, pad_length(spark, sf), side)


def padded_windows(spark, sf, side, padding="keep"):
    length = pad_length(spark, sf)
    return step_windows(pad_steps(steps(spark, sf), KEYS, length, side), KEYS, WIN, length, padding=padding)


def _scalars(df):
    """Feature arrays to scalar columns for comparison."""
    return df.withColumns({"value": F.col("features")[0], "hr": F.col("features")[1]}).drop("features")


def q_class_balance(spark, sf):
    return class_balance(labelled_events(spark, sf), ["label", "event_type"])


def q_class_freq(spark, sf):
    return class_balance(events(spark, sf), ["event_type"]).orderBy("event_type")


def q_class_weights(spark, sf):
    return rounded(class_weights(labelled_events(spark, sf), "label"))


def q_minmax_fit(spark, sf):
    return minmax_fit(labelled_events(spark, sf), FEATS)


def q_sequences(spark, sf):
    return _scalars(steps(spark, sf)).select(*KEYS, "pos", "value", "hr", "label")


def q_pad_right(spark, sf):
    return _scalars(padded(spark, sf, "right")).select(*KEYS, "pos", "value", "hr", "label")


def q_pad_left(spark, sf):
    return _scalars(padded(spark, sf, "left")).select(*KEYS, "pos", "value", "hr", "label")


def q_windows_exact(spark, sf):
    w = padded_windows(spark, sf, "right").select(*KEYS, "window_index", F.posexplode("features").alias("step", "features"))
    return _scalars(w)


def q_window_targets(spark, sf):
    return padded_windows(spark, sf, "left").select(*KEYS, "window_index", "label")


def q_window_targets_real(spark, sf):
    """Q16 switched on: only windows whose target is a real event."""
    return padded_windows(spark, sf, "left", "drop").select(*KEYS, "window_index", "label")


def q_windows_rowframe(spark, sf):
    r = rolling_windows(labelled_events(spark, sf), KEYS, ORDER, ["value"], WIN)
    return r.select(*KEYS, "event_id", F.posexplode("features").alias("step", "__x")).select(
        *KEYS, "event_id", F.col("step").cast("int").alias("step"), F.col("__x")[0].alias("value"))


def q_batch_ids(spark, sf):
    return with_batch_id(padded_windows(spark, sf, "left"), BATCH_L).select(*KEYS, "window_index", "batch_id")


def q_mask(spark, sf):
    w = with_step_mask(padded_windows(spark, sf, "left"))
    return w.select(*KEYS, "window_index", F.posexplode("mask").alias("step", "masked"))


def q_sequence_profile(spark, sf):
    return rounded(sequence_profile(events(spark, sf), KEYS, len(FEATS)))


QUERIES = {
    "class_balance": q_class_balance,
    "class_freq": q_class_freq,
    "class_weights": q_class_weights,
    "minmax_fit": q_minmax_fit,
    "sequences": q_sequences,
    "pad_right": q_pad_right,
    "pad_left": q_pad_left,
    "windows_exact": q_windows_exact,
    "window_targets": q_window_targets,
    "window_targets_real": q_window_targets_real,
    "windows_rowframe": q_windows_rowframe,
    "batch_ids": q_batch_ids,
    "mask": q_mask,
    "sequence_profile": q_sequence_profile,
}

EV = """with codes as (select event_type, cast(row_number() over (order by event_type) - 1 as int) as label
                from (select distinct event_type from events) d),
ev as (select e.event_id, e.user_id, e.ts, e.event_type, e.value, cast(hour(e.ts) as double) as hr, c.label
       from events e join codes c on e.event_type = c.event_type),
seq as (select user_id, list(value order by ts, event_id) as x0, list(hr order by ts, event_id) as x1,
               list(label order by ts, event_id) as y, count(*) as n, max(count(*)) over () as len from ev group by user_id)"""


def _padded_pos(q: str, side: str) -> str:
    """(value, hr, label) of padded position ``q`` (0-based) in SQL."""
    if side == "right":
        idx, inside = f"{q} + 1", f"{q} < n"
    else:
        idx, inside = f"{q} - (len - n) + 1", f"{q} >= len - n"
    return (f"case when {inside} then x0[{idx}] else 0.0 end as value, "
            f"case when {inside} then x1[{idx}] else 0.0 end as hr, "
            f"case when {inside} then y[{idx}] else 0 end as label")


ORACLE = {
    "class_balance": EV + " select label, event_type, count(*) as n from ev group by label, event_type",
    "class_freq": "select event_type, count(*) as n from events group by event_type order by event_type",
    "class_weights": EV + f""" select label, n_c, {rnd('cast(sum(n_c) over () as double) / (count(*) over () * n_c)')} as weight
        from (select label, count(*) as n_c from ev group by label) t""",
    "minmax_fit": EV + " select min(value) as value__min, max(value) as value__max, min(hr) as hr__min, max(hr) as hr__max from ev",
    "sequences": EV + """ select user_id, cast(p as int) as pos, x0[p + 1] as value, x1[p + 1] as hr, y[p + 1] as label
        from seq, generate_series(0, n - 1) g(p)""",
    "pad_right": EV + f" select user_id, cast(p as int) as pos, {_padded_pos('p', 'right')} from seq, generate_series(0, len - 1) g(p)",
    "pad_left": EV + f" select user_id, cast(p as int) as pos, {_padded_pos('p', 'left')} from seq, generate_series(0, len - 1) g(p)",
    "windows_exact": EV + f""" select user_id, window_index, step, value, hr from (
        select user_id, cast(i as int) as window_index, cast(j as int) as step, {_padded_pos('i + j', 'right')}
        from seq, generate_series(0, len - {2 * WIN}) a(i), generate_series(0, {WIN - 1}) b(j)) t""",
    "window_targets": EV + f""" select user_id, window_index, label from (
        select user_id, cast(i as int) as window_index, {_padded_pos(f'i + {WIN}', 'left')}
        from seq, generate_series(0, len - {2 * WIN}) a(i)) t""",
    "window_targets_real": EV + f""" select user_id, window_index, label from (
        select user_id, cast(i as int) as window_index, {_padded_pos(f'i + {WIN}', 'left')}
        from seq, generate_series(0, len - {2 * WIN}) a(i) where i + {WIN} >= len - n) t""",
    "windows_rowframe": EV + f""" select user_id, event_id, cast(j as int) as step, x0[r - {WIN} + j + 1] as value
        from (select user_id, event_id, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as int) as r
              from ev) e join seq using (user_id), generate_series(0, {WIN - 1}) b(j) where r >= {WIN}""",
    "batch_ids": EV + f""" select user_id, cast(i as int) as window_index, cast(floor(i / {BATCH_L}) as int) as batch_id
        from seq, generate_series(0, len - {2 * WIN}) a(i)""",
    "mask": EV + f""" select user_id, window_index, step, (value <> 0 or hr <> 0) as masked from (
        select user_id, cast(i as int) as window_index, cast(j as int) as step, {_padded_pos('i + j', 'left')}
        from seq, generate_series(0, len - {2 * WIN}) a(i), generate_series(0, {WIN - 1}) b(j)) t""",
    "sequence_profile": EV + f""" select count(*) as sequences, cast(min(n) as int) as min_len, {rnd('avg(n)')} as mean_len,
        cast(max(n) as int) as max_len, cast(sum(n) as bigint) as total_steps, 2 as n_features from seq""",
}
