"""Adapters from the driver's test tables to the event model.

``plays`` maps the order tables onto the play model used by the rate, prior,
join and split operators: season = order year, week = order month, period =
first day of that month, entity = customer nation, opponent = supplier
nation, actor = supplier. Measures are integral (cents, tenths) so sums are
exact. NULLs are injected by fixed rules because the tables hold none.

``events`` is read as is: sequence = user_id, order = ts, label = event_type.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(pairs, default=None):
    expr = None
    for cond, val in pairs:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(default) if default is not None else expr


# The other columns of the input schema (name, rule, type), each a fixed rule on
# the order tables that Spark and DuckDB both read.
EXTRA = [
    ("series", "l_linenumber % 5 + 1", "int"),
    ("surface", "case when l_partkey % 2 = 0 then 'grass' else 'turf' end", "string"),
    ("season_type", "case when month(o_orderdate) = 12 then 'POST' else 'REG' end", "string"),
    ("home_team", "case when l_suppkey % 2 = 0 then c_nationkey else s_nationkey end", "bigint"),
    ("away_team", "case when l_suppkey % 2 = 0 then s_nationkey else c_nationkey end", "bigint"),
    ("desc", "concat('line ', cast(l_linenumber as string))", "string"),
    ("two_point_attempt", "case when l_partkey % 83 = 0 then 1 else 0 end", "int"),
    ("game_half", "case when l_linenumber <= 3 then 'Half1' else 'Half2' end", "string"),
    ("quarter_end", "case when l_linenumber = 4 then 1 else 0 end", "int"),
    ("field_goal_attempt", "case when l_linenumber = 6 then 1 else 0 end", "int"),
    ("punt_attempt", "case when l_linenumber = 7 then 1 else 0 end", "int"),
    ("half_seconds_remaining", "cast(l_quantity as int) * 36", "int"),
    ("drive_play_count", "l_partkey % 12 + 1", "bigint"),
    ("yards_after_catch", "case when l_partkey % 9 = 0 then null else l_partkey % 15 end", "bigint"),
    ("qb_spike", "case when l_partkey % 89 = 0 then 1 else 0 end", "int"),
    ("qb_scramble", "case when l_partkey % 31 = 0 then 1 else 0 end", "int"),
    ("no_huddle", "case when l_suppkey % 5 = 0 then 1 else 0 end", "int"),
    ("shotgun", "case when l_partkey % 3 = 0 then 1 else 0 end", "int"),
    ("total_away_rush_epa", "(l_partkey + 0) % 50 - 25", "bigint"),
    ("total_home_rush_epa", "(l_partkey + 1) % 50 - 25", "bigint"),
    ("total_away_pass_epa", "(l_partkey + 2) % 50 - 25", "bigint"),
    ("total_home_pass_epa", "(l_partkey + 3) % 50 - 25", "bigint"),
    ("total_away_rush_wpa", "(l_partkey + 4) % 50 - 25", "bigint"),
    ("total_home_rush_wpa", "(l_partkey + 5) % 50 - 25", "bigint"),
    ("total_away_pass_wpa", "(l_partkey + 6) % 50 - 25", "bigint"),
    ("total_home_pass_wpa", "(l_partkey + 7) % 50 - 25", "bigint"),
    ("air_epa", "case when l_partkey % 6 = 0 then null else l_partkey % 21 - 10 end", "bigint"),
    ("yac_epa", "case when l_partkey % 8 = 0 then null else l_partkey % 17 - 8 end", "bigint"),
    ("qb_epa", "case when l_partkey % 10 = 1 then null else l_partkey % 13 - 6 end", "bigint"),
    ("ep", "l_partkey % 7", "bigint"),
    ("pass_length", "case when l_returnflag = 'R' then (case when l_partkey % 3 = 0 then 'deep' else 'short' end) end", "string"),
    ("pass_location", "case when l_returnflag = 'R' then (case l_partkey % 3 when 0 then 'left' when 1 then 'middle' else 'right' end) end", "string"),
    ("air_yards", "case when l_partkey % 4 = 1 then null else l_partkey % 40 end", "bigint"),
    ("penalty_yards", "case when l_partkey % 25 < 2 then 5 + l_partkey % 3 * 5 end", "bigint"),
    ("qb_hit", "case when l_suppkey % 7 = 0 then 1 else 0 end", "int"),
    ("first_down", "case when l_quantity > 25 then 1 else 0 end", "int"),
    ("timeout", "case when l_partkey % 30 in (3, 4) then 1 else 0 end", "int"),
]


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, shaped as a play (see module doc)."""
    return _shaped(_joined(spark, sf_dir))


def _joined(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """The line items with their play number and the columns of order, customer and supplier;
    dealt by order into ``parts`` partitions, where they stay if Spark broadcasts the suppliers."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    if parts is not None:
        li = li.repartition(parts, "l_orderkey")
    # play number inside an order; the window shares the orderkey exchange
    # with the orders join below, so it adds no shuffle of its own
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    li = li.withColumn("play_id", F.row_number().over(w).cast("int"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # customers meet the orders, not the line items: these move once, to their orders
    oc = o.join(c, F.col("o_custkey") == c.c_custkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey)
    if parts is None:
        return j.join(s, li.l_suppkey == s.s_suppkey)
    if _size(s) <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold():
        return j.join(F.broadcast(s), li.l_suppkey == s.s_suppkey)
    return j.join(s, li.l_suppkey == s.s_suppkey).repartition(parts, "l_orderkey")


PERIOD = "to_date(date_trunc('month', o_orderdate))"


def _shaped(j: DataFrame, *more: str) -> DataFrame:
    """The plays of ``_joined``, and the expressions ``more`` on its columns."""
    pk, sk, ln, rf = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_returnflag")
    cn, sn = F.col("c_nationkey"), F.col("s_nationkey")
    season = F.year("o_orderdate").cast("int")
    month = F.month("o_orderdate").cast("int")
    qty = F.col("l_quantity").cast("int")
    is_r = rf == "R"
    return j.select(
        season.alias("season"),
        month.alias("week"),
        F.expr(PERIOD).alias("game_date"),
        cn.alias("posteam"),
        sn.alias("defteam"),
        sk.alias("passer_src"),
        F.col("l_orderkey").alias("drive"),
        F.col("play_id"),
        F.when(pk % 200 == 0, F.lit(None)).otherwise((ln % 4 + 1).cast("int")).alias("down"),
        F.when(is_r, 1).otherwise(0).alias("pass_attempt"),
        F.when(is_r, 0).otherwise(1).alias("rush_attempt"),
        _case([(rf == "A", F.lit("left")), (rf == "N", F.lit("right"))]).alias("run_location"),
        F.when(F.col("l_tax") >= 0.07, 1).otherwise(0).alias("goal_to_go"),
        F.round(F.col("l_discount") * 100).cast("int").alias("wp"),
        (F.round(F.col("l_extendedprice") * 100).cast("bigint") - 3000000).alias("epa"),
        (F.round(F.col("l_tax") * 10000).cast("bigint") - 400).alias("wpa"),
        F.when(is_r & (F.col("l_linestatus") == "F"), sk).alias("passer"),
        F.concat(season.cast("string"), F.lit("_"), month.cast("string"), F.lit("_"),
                 cn.cast("string")).alias("game_id"),
        _case([(is_r, F.lit("pass")), (ln == 7, F.lit("punt")), (ln == 6, F.lit("field_goal")),
               (pk % 97 == 0, F.lit(None).cast("string")), (pk % 89 == 0, F.lit("qb_spike"))],
              F.lit("run")).alias("play_type"),
        _case([(pk % 211 == 0, F.lit(None).cast("int")), (is_r, F.lit(1))], F.lit(0)).alias("qb_dropback"),
        _case([(pk % 4 == 0, F.lit("dome")), (pk % 4 == 1, F.lit("outdoors")),
               (pk % 4 == 2, F.lit("open"))]).alias("roof"),
        F.when(pk % 10 == 0, F.lit(None)).otherwise(qty).alias("temp"),
        F.when(sk % 2 == 0, "home").otherwise("away").alias("posteam_type"),
        _case([(pk % 25 == 0, cn), (pk % 25 == 1, sn)]).alias("penalty_team"),
        F.concat(ln.cast("string"), F.lit(":"), F.lpad(qty.cast("string"), 2, "0")).alias("drive_time_of_possession"),
        F.floor(F.col("c_acctbal") / 1000).cast("int").alias("spread_line"),
        _case([(pk % 30 == 3, cn), (pk % 30 == 4, sn)]).alias("timeout_team"),
        F.when(pk % 7 == 0, F.lit(None)).otherwise(qty % 20).alias("wind"),
        (qty - 10).alias("yards_gained"),
        *[F.expr(f"cast({rule} as {kind})").alias(name) for name, rule, kind in EXTRA],
        *map(F.expr, more),
    )


# DuckDB text of the same adapter, used by the oracle SQL (DuckDB dialect).
_DUCK = {"int": "int", "bigint": "bigint", "string": "varchar"}
_EXTRA_SQL = ",\n ".join(f'cast({rule.replace("as string", "as varchar")} as {_DUCK[kind]}) as "{name}"'
                         for name, rule, kind in EXTRA)
PLAYS_SQL = """
select cast(year(o_orderdate) as int) as season, cast(month(o_orderdate) as int) as week,
 cast(date_trunc('month', o_orderdate) as date) as game_date, c_nationkey as posteam, s_nationkey as defteam,
 l_suppkey as passer_src, l_orderkey as drive,
 cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_shipdate) as int) as play_id,
 case when l_partkey % 200 = 0 then null else cast(l_linenumber % 4 + 1 as int) end as down,
 case when l_returnflag = 'R' then 1 else 0 end as pass_attempt,
 case when l_returnflag = 'R' then 0 else 1 end as rush_attempt,
 case l_returnflag when 'A' then 'left' when 'N' then 'right' end as run_location,
 case when l_tax >= 0.07 then 1 else 0 end as goal_to_go,
 cast(round(l_discount * 100) as int) as wp,
 cast(round(l_extendedprice * 100) as bigint) - 3000000 as epa,
 cast(round(l_tax * 10000) as bigint) - 400 as wpa,
 case when l_returnflag = 'R' and l_linestatus = 'F' then l_suppkey end as passer,
 concat(cast(cast(year(o_orderdate) as int) as varchar), '_', cast(cast(month(o_orderdate) as int) as varchar), '_',
        cast(c_nationkey as varchar)) as game_id,
 case when l_returnflag = 'R' then 'pass' when l_linenumber = 7 then 'punt' when l_linenumber = 6 then 'field_goal'
      when l_partkey % 97 = 0 then null when l_partkey % 89 = 0 then 'qb_spike' else 'run' end as play_type,
 case when l_partkey % 211 = 0 then null when l_returnflag = 'R' then 1 else 0 end as qb_dropback,
 case l_partkey % 4 when 0 then 'dome' when 1 then 'outdoors' when 2 then 'open' end as roof,
 case when l_partkey % 10 = 0 then null else cast(l_quantity as int) end as temp,
 case when l_suppkey % 2 = 0 then 'home' else 'away' end as posteam_type,
 case l_partkey % 25 when 0 then c_nationkey when 1 then s_nationkey end as penalty_team,
 concat(cast(l_linenumber as varchar), ':', lpad(cast(cast(l_quantity as int) as varchar), 2, '0')) as drive_time_of_possession,
 cast(floor(c_acctbal / 1000) as int) as spread_line,
 case l_partkey % 30 when 3 then c_nationkey when 4 then s_nationkey end as timeout_team,
 case when l_partkey % 7 = 0 then null else cast(l_quantity as int) % 20 end as wind,
 cast(l_quantity as int) - 10 as yards_gained,
 """ + _EXTRA_SQL + """
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
 join supplier on l_suppkey = s_suppkey
"""


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actor dimension: (player_id, player_display_name) from the supplier table."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("player_display_name"))


PLAYERS_SQL = "select s_suppkey as player_id, s_name as player_display_name from supplier"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")


_STORED: dict = {}


def _files_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, length and time of the files behind ``plays``: a stored copy stands for these."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in ("lineitem", "orders", "customer", "supplier"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        for f in path.getFileSystem(conf).listStatus(path):
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


ROW_BUCKET_BYTES = 4 << 20  # of line item files, for each bucket of the stored plays
MAX_DRIVE = 1_000           # rows of a drive; the rows of one block are compared with each other


def _size(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _plays_stored(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(table, path) of the ``plays`` adapter, stored once as Parquet in the shared checkpoint
    folder (per state of its input files), as an event table is at scale, in buckets by ``BLOCK``,
    here the drive: what a plan joins to the events by their number moves to their buckets, they
    stay. The rows are dealt to the buckets before they take the shape of plays, which is several
    times wider, and only once: where the plays are numbered. In a bucket they lie by period and
    sides, so what is attached to them by these takes little room in whatever is written of them."""
    from seqwise.session import checkpoint_dir, compiled_methods
    from seqwise.sources.bucketed import BLOCK
    compiled_methods(spark)
    key = (checkpoint_dir(spark), _files_state(spark, sf_dir))
    name, path = _STORED.get(key, (None, None))
    if path is None or not _exists(spark, path) or not spark.catalog.tableExists(name):
        n = max(4, -(-_size(table(spark, sf_dir, "lineitem")) // ROW_BUCKET_BYTES))
        name, path = _STORED[key] = _store_plays(spark, sf_dir, n, by_drive=True)
        largest = spark.table(name).groupBy(BLOCK).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
        if largest > MAX_DRIVE:
            spark.sql(f"DROP TABLE {name}")
            name, path = _STORED[key] = _store_plays(spark, sf_dir, n, by_drive=False)
    return name, path


def _store_plays(spark: SparkSession, sf_dir: str, n: int, by_drive: bool) -> tuple[str, str]:
    """The plays stored in ``n`` buckets of their blocks: drives, as they were numbered, or a few
    neighbouring rows, which deals them a second time."""
    from seqwise.session import checkpoint_dir
    from seqwise.sources.bucketed import BLOCK, ROW, numbered, stored_by
    name = f"seqwise_rows_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/plays-{uuid.uuid4().hex}"
    if by_drive:
        rows = _shaped(_joined(spark, sf_dir, n), f"monotonically_increasing_id() as {ROW}", f"l_orderkey as {BLOCK}")
    else:
        rows = _shaped(numbered(_joined(spark, sf_dir)).repartition(n, BLOCK), ROW, BLOCK)
    (stored_by(rows, BLOCK, n).write.format("parquet").option("path", path).bucketBy(n, BLOCK)
     .sortBy("game_date", "posteam", "defteam").saveAsTable(name))
    return name, path


def plays_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored plays with ``ROW`` and ``BLOCK``, partitioned as stored."""
    return spark.table(_plays_stored(spark, sf_dir)[0])


def plays_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored plays. Every query scans them with column pruning instead of recomputing
    the four-way join in each branch of its plan."""
    from seqwise.sources.bucketed import BLOCK, ROW
    return spark.read.parquet(_plays_stored(spark, sf_dir)[1]).drop(ROW, BLOCK)


def plays_columns(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    """A few columns of the plays: read from the stored ones if there are any, else stored by
    themselves. Storing all columns takes most of the time of a query that reads these only."""
    from seqwise.session import checkpoint_dir
    folder, files = checkpoint_dir(spark), _files_state(spark, sf_dir)
    path = _STORED.get((folder, files), (None, None))[1]
    if path is None or not _exists(spark, path):
        path = _STORED.get((folder, files, tuple(cols)))
    if path is None or not _exists(spark, path):
        path = _STORED[folder, files, tuple(cols)] = f"{folder.rstrip('/')}/plays-{uuid.uuid4().hex}"
        plays(spark, sf_dir).select(*cols).write.parquet(path)
    return spark.read.parquet(path).select(*cols)


BUCKET_BYTES = 8 << 20      # of line item files, for each bucket of the co-located plays


def plays_colocated(spark: SparkSession, sf_dir: str, buckets: int | None = None):
    """``plays`` stored once in buckets by (entity, period), as an event table that is
    built from more than once is at scale, with the number of each row. ``buckets``: 16, and more of
    them for larger tables. The rows are dealt before they take the shape of plays."""
    from seqwise.session import checkpoint_dir, compiled_methods
    from seqwise.sources.bucketed import KEY, ROW, write_colocated
    compiled_methods(spark)
    if buckets is None:
        buckets = max(16, -(-_size(table(spark, sf_dir, "lineitem")) // BUCKET_BYTES))
    key = (checkpoint_dir(spark), _files_state(spark, sf_dir), buckets)
    store = _STORED.get(key)
    if store is None or not _exists(spark, store.path) or not spark.catalog.tableExists(store.table):
        rows = _joined(spark, sf_dir).withColumns({"posteam": F.col("c_nationkey"), "game_date": F.expr(PERIOD)})
        store = _STORED[key] = write_colocated(
            rows, ["posteam", "game_date"], ["drive", "play_id"], buckets, "plays",
            lambda dealt: _shaped(dealt, KEY, f"monotonically_increasing_id() as {ROW}"))
    return store
