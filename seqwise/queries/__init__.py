"""Registered queries: one per operator of SURVEY §2, each with its DuckDB
oracle text where the operator is SQL-expressible."""

from __future__ import annotations

import importlib

MODULES = ["rates", "priors", "features", "prepare", "sequence", "model", "io", "chain", "scale"]


def all_queries() -> dict:
    out = {}
    for m in MODULES:
        out.update(importlib.import_module(f"seqwise.queries.{m}").QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    for m in MODULES:
        out.update(importlib.import_module(f"seqwise.queries.{m}").ORACLE)
    return out
