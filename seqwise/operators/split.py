"""Deterministic rule split and its audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

# Even weeks that go to training, by season parity.
ODD_SEASON_TRAIN_WEEKS = (4, 8, 12, 16)
EVEN_SEASON_TRAIN_WEEKS = (2, 6, 10, 14)


def split_column(season: str = "season", week: str = "week", test_season: int = 2022,
                 odd_weeks=ODD_SEASON_TRAIN_WEEKS, even_weeks=EVEN_SEASON_TRAIN_WEEKS):
    """'test' for the test season; before it, odd weeks plus the listed even
    weeks -> 'train', the other even weeks -> 'valid'; NULL otherwise.
    A whole (season, week) always lands in one split."""
    s, w = F.col(season), F.col(week)
    odd_pick = (s % 2 == 1) & w.isin(list(odd_weeks))
    even_pick = (s % 2 == 0) & w.isin(list(even_weeks))
    train = (w % 2 == 1) | odd_pick | even_pick
    valid = (w % 2 == 0) & ~odd_pick & ~even_pick
    before = s < test_season
    return (F.when(s == test_season, F.lit("test"))
            .when(before & train, F.lit("train"))
            .when(before & valid, F.lit("valid")))


def rule_split(df: DataFrame, season: str = "season", week: str = "week", min_season: int = 2016,
               test_season: int = 2022, **kw) -> DataFrame:
    """Keep seasons >= ``min_season`` and tag each row with its split."""
    return (df.filter(F.col(season) >= min_season)
            .withColumn("split", split_column(season, week, test_season, **kw))
            .filter(F.col("split").isNotNull()))


def split_report(df: DataFrame, game: str = "game_id") -> DataFrame:
    """Sides per split (distinct games x 2) and the two ratios.

    One distinct count grouped by split (no Expand of the events for three
    distinct aggregates), then a fold over the three-row result."""
    per = df.groupBy("split").agg((F.count_distinct(game) * 2).cast("bigint").alias("n"))

    def pick(name):
        return F.coalesce(F.sum(F.when(F.col("split") == name, F.col("n"))), F.lit(0)).cast("bigint")
    r = per.agg(pick("train").alias("train_games"), pick("valid").alias("valid_games"),
                pick("test").alias("test_games"))
    tv = F.col("train_games") + F.col("valid_games")
    return r.select(
        tv.alias("training_games"),
        F.try_divide(F.col("valid_games"), tv).alias("validation_split"),
        F.col("test_games"),
        F.try_divide(F.col("test_games"), tv + F.col("test_games")).alias("test_split"))


def key_split(df: DataFrame, key: str, buckets: int = 5, valid=(3,), test=(4,)) -> DataFrame:
    """Deterministic split by entity: every row of a key lands in one split
    (a sequence never crosses splits). Bucket = key mod buckets for whole
    numbers, else pmod(xxhash64(key), buckets)."""
    whole = isinstance(df.schema[key].dataType, IntegralType)
    b = F.pmod(F.col(key) if whole else F.xxhash64(F.col(key)), F.lit(buckets))
    return df.withColumn("split", F.when(b.isin(list(test)), "test").when(b.isin(list(valid)), "valid")
                         .otherwise("train"))
