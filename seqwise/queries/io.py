"""Sources and sinks (S1, S3-S5): CSV at the edge with an explicit schema,
split-partitioned sinks, season-pruned event reads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from seqwise.operators.split import rule_split
from seqwise.queries._sql import with_plays
from seqwise.queries.features import MIN_SEASON, SPLIT_EXPR, TEST_SEASON
from seqwise.session import checkpoint_dir
from seqwise.sources.fixtures import plays
from seqwise.sources.io import read_csv, read_events, write_csv, write_splits


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_csv_roundtrip(spark, sf):
    """S4 then S3: write with header and empty text for NULL, read back with
    the explicit schema of the written frame (no inference)."""
    p = plays(spark, sf)
    path = _scratch(spark, "csv")
    write_csv(p, path)
    return read_csv(spark, path, p.schema)


def q_split_sinks(spark, sf):
    """S5 + S1: one write partitioned by (split, season), then a season-range
    read that prunes partitions."""
    p = rule_split(plays(spark, sf).select("drive", "play_id", "season", "week", "game_id", "epa"),
                   "season", "week", MIN_SEASON, TEST_SEASON)
    path = _scratch(spark, "splits")
    write_splits(p, path)
    back = read_events(spark, path, range(MIN_SEASON + 1, TEST_SEASON + 1))
    return back.select("drive", "play_id", F.col("season").cast("int").alias("season"), "week", "game_id", "epa", "split")


QUERIES = {
    "csv_roundtrip": q_csv_roundtrip,
    "split_sinks": q_split_sinks,
}

ORACLE = {
    "csv_roundtrip": with_plays("select * from plays"),
    "split_sinks": with_plays(
        f"select * from (select drive, play_id, season, week, game_id, epa, {SPLIT_EXPR} as split from plays "
        f"where season >= {MIN_SEASON}) t where split is not null and season between {MIN_SEASON + 1} and {TEST_SEASON}"),
}
