"""Scalar recodes and small per-row helpers (all JVM-side expressions)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqwise.functions.semantics import _c, r_ifelse


def mmss_to_seconds(c) -> Column:
    """'m:ss' text to seconds; NULL or malformed text gives NULL."""
    parts = F.split(_c(c), ":")
    mins = F.try_element_at(parts, F.lit(1)).try_cast("int")
    secs = F.try_element_at(parts, F.lit(2)).try_cast("int")
    return mins * 60 + secs


def closed_flag(c, closed=("dome", "closed")) -> Column:
    """Two-step roof recode: dome counts as closed; closed -> 1, anything else 0."""
    return F.when(_c(c).isin(list(closed)), F.lit(1)).otherwise(F.lit(0))


def recode(c, mapping: dict) -> Column:
    """Dictionary recode; values not in the mapping become NULL."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, _c(c))


def encode_by_list(c, values) -> Column:
    """Position of the value in a fixed list (0-based); unknown values raise."""
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), _c(c))
    return F.when(pos > 0, (pos - 1).cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("value not in list: "), F.coalesce(_c(c).cast("string"), F.lit("NULL")))))


def signed_by_side(value, side, negative_side="away") -> Column:
    """Flip the sign of ``value`` for one side (point spread seen from the entity)."""
    return r_ifelse(_c(side) == F.lit(negative_side), F.lit(-1.0) * _c(value), _c(value).cast("double"))


def label_of(play_type, qb_dropback, run_location, pass_label="pass",
             spike="qb_spike", run="run", default_loc="middle") -> Column:
    """Event label: spikes and dropbacks are passes; runs carry their direction."""
    pt, db = _c(play_type), _c(qb_dropback)
    is_pass = (pt == F.lit(spike)) | (db == F.lit(1))
    run_label = F.concat_ws("_", pt, F.coalesce(_c(run_location), F.lit(default_loc)))
    return r_ifelse(is_pass, F.lit(pass_label), r_ifelse(pt == F.lit(run), run_label, pt))


def argmax(prob) -> Column:
    """0-based index of the largest probability in an array column."""
    p = _c(prob)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def step_mask(features) -> Column:
    """Per time step: True unless every feature is 0 (a fully masked step)."""
    return F.transform(_c(features), lambda t: F.exists(t, lambda v: v != 0))


def attempt_rule(rush, pass_, rule: str = "as_written") -> Column:
    """Run-attempt flag after the source's rule. ``as_written`` zeroes a run
    when the play is *not* a pass (so only runs that are also passes stay);
    ``intended`` zeroes a run when the play *is* a pass. NULL stays NULL."""
    r, p = _c(rush), _c(pass_)
    if rule == "as_written":
        cond = (r == 1) & (p == 0)
    elif rule == "intended":
        cond = (r == 1) & (p == 1)
    else:
        raise ValueError(rule)
    return r_ifelse(cond, F.lit(0), r)
