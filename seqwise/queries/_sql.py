"""Tiny builders for the DuckDB oracle text (the oracle is written in SQL,
independently of the Spark plans it checks)."""

from __future__ import annotations

from seqwise.sources.fixtures import PLAYS_SQL, PLAYERS_SQL


def ifelse(cond: str, a: str, b: str) -> str:
    return f"(case when ({cond}) is null then null when {cond} then {a} else {b} end)"


def na_sum(expr: str) -> str:
    return f"(case when count(*) = count({expr}) then cast(sum({expr}) as bigint) end)"


def na_cumsum(expr: str, w: str) -> str:
    return f"(case when count(*) over {w} = count({expr}) over {w} then cast(sum({expr}) over {w} as bigint) end)"


def ratio(num: str, den: str) -> str:
    return f"(cast({num} as double) / nullif(cast({den} as double), 0))"


def with_plays(body: str, extra: str = "") -> str:
    ctes = f"plays as ({PLAYS_SQL})"
    if extra:
        ctes += ", " + extra
    return f"with {ctes}\n{body}"


PLAYERS = PLAYERS_SQL


def exact_avg(c: str, over: str = "") -> str:
    """Mean over an exact decimal sum (the library's group mean)."""
    o = f" over {over}" if over else ""
    return (f"(cast(sum(cast({c} as decimal(38,12))){o} as double) / "
            f"nullif(cast(count({c}){o} as double), 0))")
