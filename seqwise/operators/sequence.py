"""Ordered sequences, padding and sliding training windows.

A sequence is every event of one key (e.g. one side in one game), in order.
It is kept in long form, one *step* per row: ``number_steps`` numbers the
events of each key by the two-level scan, ``pad_steps`` adds the padding as
rows, and ``step_windows`` builds the windows. No key is ever gathered into one
row or one task: steps are dealt into blocks of consecutive positions, each
block also gets the few steps after it that its last windows need, and a
bounded row frame inside (key, block) collects exactly n steps per window.

``to_sequences`` / ``pad`` / ``windows`` are the array form for short keys: one
row per key, bounded by ``max_len``, which is checked before collecting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqwise.functions.scalar import step_mask
from seqwise.operators.window import number_within

BLOCK = 1024
MAX_ARRAY = 1_000


class SequenceTooLong(ValueError):
    pass


def check_max_len(df: DataFrame, keys: list[str], max_len: int) -> None:
    """Raise when any key has more than ``max_len`` events (one aggregation)."""
    over = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_len)
            .select("n").limit(1).collect())
    if over:
        raise SequenceTooLong(f"a sequence has {over[0]['n']} events, more than {max_len}")


# long form ------------------------------------------------------------------

def number_steps(df: DataFrame, keys: list[str], order: list[str], features: list[str],
                 label: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """N1 + N2 in long form: (keys, ``pos`` from 0, ``n`` events of the key,
    ``features`` array of doubles, ``label``, ``carry`` columns); NULL keys are
    skipped. With two or more ``order`` columns the first one is the coarse
    bucket of the two-level numbering."""
    carry = carry or []
    d = number_within(df.dropna(subset=keys), keys, order, "__no", total="n")
    x = F.array(*[F.col(f).cast("double") for f in features]).cast("array<double>")
    y = [F.col(label).alias("label")] if label else []
    return d.select(*keys, (F.col("__no") - 1).cast("int").alias("pos"), F.col("n").cast("int").alias("n"),
                    x.alias("features"), *y, *[c for c in carry if c != "label" or not label])


def pad_steps(steps: DataFrame, keys: list[str], length: int | list[int], side: str = "right", pad_label=0) -> DataFrame:
    """N3 / N4 in long form: every key gets ``length`` steps; the added ones
    have all-zero features and ``pad_label``, and ``is_pad`` tells them apart.
    A longer sequence raises. ``longest`` finds the length as the source does.

    With a list of lengths (``bucket_lengths``) a key is padded to the shortest of
    them that holds it, and the column ``length`` tells windows which that is:
    ``step_windows(..., length=F.col("length"))``."""
    if side not in ("right", "left"):
        raise ValueError(side)
    n = F.col("n")
    plan = length if isinstance(length, list) else None
    longest_known = max(plan, default=0) if plan is not None else length
    to = F.lit(length) if plan is None else bucket_of(n, plan)
    own = [] if plan is None else [to.alias("length")]
    too_long = F.raise_error(F.concat(F.lit(f"sequence longer than {longest_known}: "), n.cast("string"))).cast("int")
    moved = F.col("pos") + (to - n if side == "left" else F.lit(0))
    real = steps.select(*keys, F.when(n <= longest_known, moved).otherwise(too_long).alias("pos"), "n", *own, "features", "label",
                        F.lit(False).alias("is_pad"))
    first = steps.filter((F.col("pos") == 0) & (n < to))
    added = F.explode(F.sequence(F.lit(0), to - 1 - n)).alias("__i")
    pads = first.select(*keys, "n", *own, F.transform("features", lambda v: F.lit(0.0)).alias("features"), added)
    pads = pads.select(*keys, (F.col("__i") + (F.lit(0) if side == "left" else F.col("n"))).cast("int").alias("pos"), "n",
                       *[c for c in ("length",) if own], "features",
                       F.lit(pad_label).cast(steps.schema["label"].dataType).alias("label"), F.lit(True).alias("is_pad"))
    return real.unionByName(pads)


def length_histogram(df: DataFrame, keys: list[str], factor: float = 1.25) -> DataFrame:
    """(bin, keys, steps, longest): the lengths of the keys in bins whose longest is less
    than ``factor`` times their shortest; one row for each bin in use, which is at most
    log(longest key) / log(``factor``) rows."""
    if factor <= 1:
        raise ValueError(f"factor {factor} must be above 1")
    per = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    bin_ = F.floor(F.log("n") / F.log(F.lit(float(factor))) + 1e-9).cast("int").alias("bin")
    return per.groupBy(bin_).agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("steps"), F.max("n").alias("longest"))


def bucket_lengths(histogram: DataFrame) -> list[int]:
    """The bucket plan: the longest length of every bin in use, ascending. A key padded to
    the shortest of them that holds it gets less than ``factor`` times its own steps."""
    return sorted(int(r.longest) for r in histogram.select("longest").collect())


def bucket_of(n: Column, plan: list[int]) -> Column:
    """The shortest length of the plan that holds ``n`` steps (NULL if none does)."""
    return F.array_min(F.filter(F.array(*map(F.lit, plan or [0])), lambda length: length >= n))


def padding_report(histogram: DataFrame) -> DataFrame:
    """(plan, keys, steps, pad_rows): padding by the bucket plan, and to the longest of all."""
    got = histogram.agg(F.sum("keys").alias("keys"), F.sum("steps").alias("steps"),
                        F.sum(F.col("longest") * F.col("keys") - F.col("steps")).alias("bucketed"),
                        (F.max("longest") * F.sum("keys") - F.sum("steps")).alias("longest"))
    return got.select("keys", "steps", F.expr("stack(2, 'bucketed', bucketed, 'longest', longest) as (plan, pad_rows)"))


def longest(df: DataFrame, keys: list[str]) -> int:
    """Most events of any key (0 for none): the pad length the profile finds."""
    per = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def _blocks(steps: DataFrame, keys: list[str], reach: int, block: int):
    """Steps dealt to their block of positions and, where a step is among the
    ``reach`` steps after an earlier block's end (or before a later block's
    begin, for a negative reach), to that block as well. Returns (rows, window)."""
    size = max(block, abs(reach))
    own, other = F.floor(F.col("pos") / size), F.floor(F.greatest(F.col("pos") - reach, F.lit(0)) / size)
    rows = steps.withColumn("__b", F.explode(F.array_distinct(F.array(own, other))))
    return rows, Window.partitionBy(*keys, "__b").orderBy("pos"), F.floor(F.col("pos") / size) == F.col("__b")


def step_windows(steps: DataFrame, keys: list[str], n: int = 15, length: int | Column | None = None,
                 truncate_tail: bool = True, padding: str = "keep", carry: list[str] | None = None,
                 block: int = BLOCK) -> DataFrame:
    """N5 + N6 + N10: window i holds steps i..i+n-1, its label is step i+n.

    ``length``: steps of every key (the pad length; the key's own count when
    None). ``truncate_tail`` keeps the source's count (starts 0..L-2n); False
    gives every start with a target (0..L-n-1). ``padding``: "keep" counts
    windows whose target is a padding step, as the source does; "drop" removes
    them; "flag" adds ``target_is_pad``. ``carry`` columns come from the target.
    Each (key, block) task holds at most block + n steps."""
    if padding not in ("keep", "drop", "flag"):
        raise ValueError(padding)
    L = F.col("n") if length is None else length if isinstance(length, Column) else F.lit(length)
    last = (L - 2 * n) if truncate_tail else (L - n - 1)
    rows, w, own = _blocks(steps, keys, n, block)
    target = {c: F.lead(c, n).over(w) for c in [*(["label"] if "label" in steps.columns else []), *(carry or [])]}
    if padding != "keep":
        target["target_is_pad"] = F.lead("is_pad", n).over(w)
    out = rows.select(*keys, F.col("pos").alias("window_index"), own.alias("__own"), last.alias("__last"),
                      F.collect_list("features").over(w.rowsBetween(0, n - 1)).alias("features"),
                      *[c.alias(k) for k, c in target.items()])
    out = out.filter(F.col("__own") & (F.col("window_index") <= F.col("__last"))).drop("__own", "__last")
    return out.filter(~F.col("target_is_pad")).drop("target_is_pad") if padding == "drop" else out


def previous_step(steps: DataFrame, keys: list[str], col: str, name: str, block: int = BLOCK) -> DataFrame:
    """``name`` = ``col`` of the step before (NULL for the first), by blocks."""
    rows, w, own = _blocks(steps, keys, -1, block)
    rows = rows.withColumn(name, F.lag(col).over(w))
    return rows.filter(own).drop("__b")


def rolling_windows(df: DataFrame, keys: list[str], order: list[str], features: list[str], n: int,
                    label: str | None = None, block: int = BLOCK) -> DataFrame:
    """For each event, its n previous events (only events with a full
    history of n); no padding."""
    steps = number_steps(df, keys, order, features, label, carry=order)
    out = step_windows(steps, keys, n, truncate_tail=False, carry=order, block=block)
    out = out.withColumnRenamed("label", label) if label else out
    return out.select(*keys, *order, "features", *([label] if label else []))


def sequence_profile(df: DataFrame, keys: list[str], n_features: int) -> DataFrame:
    """Number of sequences, min / mean / max length, total steps, features
    per step, from the event counts per key (no sequence is built)."""
    per = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("sequences"), F.min("n").cast("int").alias("min_len"),
                   F.avg("n").alias("mean_len"), F.max("n").cast("int").alias("max_len"),
                   F.sum("n").cast("bigint").alias("total_steps"), F.lit(n_features).alias("n_features"))


def with_batch_id(win: DataFrame, size: int) -> DataFrame:
    """Batch number inside each sequence (a batch never crosses sequences)."""
    return win.withColumn("batch_id", F.floor(F.col("window_index") / F.lit(size)).cast("int"))


def with_step_mask(win: DataFrame) -> DataFrame:
    """Per step, False when every feature is 0 (a masked step)."""
    return win.withColumn("mask", step_mask("features"))


# array form -----------------------------------------------------------------

def to_sequences(df: DataFrame, keys: list[str], order: list[str], features: list[str], label: str,
                 max_len: int = MAX_ARRAY) -> DataFrame:
    """N1 + N2 in array form: one row per key with ``features`` (array of
    per-step feature arrays, doubles) and ``labels``, in event order; NULL keys
    are skipped. A key with more than ``max_len`` events raises before anything
    is collected: such keys are for ``number_steps``."""
    df = df.dropna(subset=keys)
    check_max_len(df, keys, max_len)
    okey = [F.struct(F.col(c).isNull(), F.col(c)) for c in order]
    step = F.struct(F.struct(*okey).alias("o"),
                    F.array(*[F.col(f).cast("double") for f in features]).alias("x"),
                    F.col(label).alias("y"))
    s = df.groupBy(*keys).agg(F.array_sort(F.collect_list(step)).alias("__s"))
    return s.select(*keys, F.transform("__s", lambda e: e["x"]).alias("features"),
                    F.transform("__s", lambda e: e["y"]).alias("labels"))


def pad(seqs: DataFrame, length: int, side: str = "right", pad_label=0) -> DataFrame:
    """Pad ``features`` with all-zero steps and ``labels`` with
    ``pad_label`` to ``length``; a longer sequence raises. Adds ``n_real``
    (real steps) and ``pad_offset`` (index of the first real step), which
    ``windows`` uses to tell padded targets apart."""
    n = F.size("features")
    k = F.lit(length) - n
    nfeat = F.size(F.element_at("features", 1))
    zeros = F.array_repeat(F.array_repeat(F.lit(0.0), nfeat), k)
    lpad = F.array_repeat(F.lit(pad_label).cast(seqs.schema["labels"].dataType.elementType), k)
    if side == "right":
        fx, fy = F.concat("features", zeros), F.concat("labels", lpad)
    elif side == "left":
        fx, fy = F.concat(zeros, "features"), F.concat(lpad, "labels")
    else:
        raise ValueError(side)
    too_long = F.raise_error(F.concat(F.lit(f"sequence longer than {length}: "), n.cast("string")))
    return seqs.withColumns({"n_real": n.cast("int"),
                             "pad_offset": (k if side == "left" else F.lit(0)).cast("int"),
                             "features": F.when(k >= 0, fx).otherwise(too_long),
                             "labels": F.when(k >= 0, fy).otherwise(too_long)})


def windows(padded: DataFrame, keys: list[str], n: int = 15, truncate_tail: bool = True,
            padding: str = "keep") -> DataFrame:
    """N5 + N6 + N10 on the array form; the same switches as ``step_windows``
    (``padding`` needs the ``n_real`` / ``pad_offset`` columns of ``pad``)."""
    L = F.size("features")
    last = (L - 2 * n) if truncate_tail else (L - n - 1)
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    per = F.transform(starts, lambda i: F.struct(
        F.slice("features", i + 1, n).alias("features"),
        F.element_at("labels", i + n + 1).alias("label")))
    meta = ["n_real", "pad_offset"] if padding != "keep" else []
    out = padded.select(*keys, *meta, F.posexplode(per).alias("window_index", "__w"))
    cols = [*keys, F.col("window_index").cast("int").alias("window_index"),
            F.col("__w.features").alias("features"), F.col("__w.label").alias("label")]
    if padding == "keep":
        return out.select(*cols)
    t = F.col("window_index") + n
    is_pad = (t < F.col("pad_offset")) | (t >= F.col("pad_offset") + F.col("n_real"))
    out = out.select(*cols, is_pad.alias("target_is_pad"))
    if padding == "drop":
        return out.filter(~F.col("target_is_pad")).drop("target_is_pad")
    if padding == "flag":
        return out
    raise ValueError(padding)
