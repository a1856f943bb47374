"""Registered queries against their DuckDB oracle at sf0.001 (a cheap subset
of tools/oracle_check.py, which runs them all at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
NAMES = ["asof_rates_entity", "shrunk_actor_rate", "leaderboard", "fill_downup", "play_no", "split_report",
         "prepare_events", "label_encode", "minmax_scale", "windows_exact", "window_targets", "class_report",
         "csv_roundtrip", "encode_and_scale", "asof_state_actor", "window_targets_real", "feature_table", "model_inputs", "predict_argmax", "confusion",
         "windows_rowframe", "first_per_group", "lookup_left_join", "sequence_profile"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return repr(v) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert srows == drows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "pt_fd_pass_pct" in df.columns


def test_every_query_has_an_oracle_or_is_training():
    from seqwise.queries import all_oracles, all_queries
    missing = set(all_queries()) - set(all_oracles())
    assert missing <= {"train_eval_lr", "train_eval_rf", "test_confusion", "pipeline_train", "train_early_stop"}
