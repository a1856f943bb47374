"""Small internal helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asc_last(cols) -> list[Column]:
    """Ascending order with NULLs last (the source sorts missing values last)."""
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in cols]


def desc_first(cols) -> list[Column]:
    """The reverse of ``asc_last``. What comes after a row is read as what came before it in
    this order: Spark computes a frame that ends at the group's end anew for every row,
    in time that grows with the square of the group."""
    return [(F.col(c) if isinstance(c, str) else c).desc_nulls_first() for c in cols]


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join where NULL keys match each other (the source's join rule).

    Still planned as a hash / sort-merge join on the keys. Built with one
    aliasing projection and one output projection, so a deep plan is
    analysed few times.
    """
    keyset = set(keys)
    # every column of the right side is made anew, so the sides may share lineage
    r = right.select(*[F.col(c).alias(f"__r_{c}" if c in keyset else c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    return out.select(*[left[c] for c in left.columns],
                      *[r[c] for c in right.columns if c not in keyset])


def join_dealt(left: DataFrame, right: DataFrame, at: str, keys: list[str]) -> DataFrame:
    """Inner join on ``keys``, NULLs matching, of a ``left`` already dealt by ``at``, a never-NULL hash
    of the keys on both sides: it stays where it is. The keys are compared without being keys of the
    join, for which Spark would deal both sides anew."""
    r = right.select(*[F.col(c).alias(f"__r_{c}" if c in {at, *keys} else c) for c in right.columns])
    cond = left[at] == r[f"__r_{at}"]
    for k in keys:
        a, b = left[k], r[f"__r_{k}"]
        cond = cond & F.when(a.isNull(), b.isNull()).otherwise(F.coalesce((a >= b) & (a <= b), F.lit(False)))
    return left.join(r, cond).select(*[left[c] for c in left.columns], *[r[c] for c in right.columns if c not in {at, *keys}])


# Group tables (one row per season, week, class ...) are broadcast only when
# they are stored in at most this many rows and bytes.
SMALL_ROWS, SMALL_BYTES = 100_000, 8 << 20


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """A group-level table for a join with the events, with its size checked.

    Written once to the shared checkpoint folder and counted from the stored
    files; broadcast when it has at most ``max_rows`` rows in ``max_bytes``
    bytes of files, otherwise joined by shuffle (then it has many keys, so no key concentrates the events).
    Joining events to a season- or week-keyed table by shuffle would send a
    whole season to one task."""
    from seqwise.session import materialize
    stored = materialize(df, name="group_table")
    stored_bytes = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(stored) if stored_bytes <= max_bytes and stored.count() <= max_rows else stored
