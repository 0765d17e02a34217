"""Driver tables laid out as the three inputs of the injury model.

``plays`` (player = customer, game = order, play = line item), ``injuries``
(flagged play lines) and ``tracks`` (a user's events laid on the first play of
that customer's n-th order by week of month).  The rules are the staging SQL in
FIXTURES.md; ``playtrack.plans.staging_sql`` holds the same SQL for DuckDB.

The three tables stand in for the reference's input files.  By default each
is derived ONCE per session, when a query first asks for it, and stored under
the shared checkpoint folder as a table bucketed by ``PlayKey`` (and sorted by ``PlayKey, time`` for the
frames): every per-play window and every frames-plays join on ``PlayKey``
then reads co-partitioned buckets and needs no shuffle of the frames.  Each
query reads the stored tables, so its work still grows with the data.  With
``spark.playtrack.staging.store=false`` each query derives them lazily from
the parquet scans instead (Catalyst prunes columns into those scans).
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import skew as SK
from ..operators.tracking import PlayMarks, game_days, play_marks
from .tables import table

PLAY_COLUMNS = ["PlayerKey", "GameID", "PlayKey", "RosterPosition", "PlayerDay", "PlayerGame", "StadiumType",
                "FieldType", "Temperature", "Weather", "PlayType", "PlayerGamePlay", "Position", "PositionGroup",
                "src_quantity", "src_flag", "src_order"]
INJURY_COLUMNS = ["PlayerKey", "GameID", "PlayKey", "BodyPart", "Surface", "DM_M1", "DM_M7", "DM_M28", "DM_M42"]
TRACK_COLUMNS = ["PlayKey", "time", "event", "x", "y", "dir", "dis", "o", "s"]


def _s(c: str) -> Column:
    return F.col(c).cast("string")


# Texts that stand for a category of the plays travel as its number: rows are dealt up to three times.
_SEGMENTS = {"MACHINERY": "Linebacker", "BUILDING": "Safety", "AUTOMOBILE": "Wide Receiver", "FURNITURE": "Cornerback"}
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
_FLAGS = {"AF": "Pass", "AO": "Rush", "NF": "Punt", "NO": "Kickoff", "RF": "0"}


def _number(c: Column, values) -> Column:
    """The place of a value among ``values``; their number for any other, and for null."""
    out = F.lit(len(values))
    for i, v in enumerate(values):
        out = F.when(c == v, i).otherwise(out)
    return out.cast("tinyint")


def _named(c: str, names) -> Column:
    """The name at a place; null beyond the last."""
    return F.get(F.array(*map(F.lit, names)), F.col(c).cast("int"))


def _games(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", _number(F.col("o_orderpriority"), _PRIORITIES).alias("priority"),
        _number(F.col("o_orderstatus"), ["F"]).alias("status"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", _number(F.col("c_mktsegment"), _SEGMENTS).alias("segment"))
    order = ["o_orderdate", "o_orderkey"]

    def met(d):
        return d.join(customer, d.o_custkey == customer.c_custkey)

    # the orders are dealt once, for the join and for the numbers
    numbered = SK.split_by_key_size(
        orders, "o_custkey",
        lambda d: met(d).withColumn("PlayerGame", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*order))),
        lambda d: SK.row_number_in_group(met(d), "o_custkey", order, "PlayerGame"), deal=True)
    return (numbered.withColumn("PlayerGame", F.col("PlayerGame").cast("int"))
            .withColumn("PlayerDay",
                        F.floor(F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
                                / 6).cast("int")))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
        "l_returnflag", _number(F.concat("l_returnflag", "l_linestatus"), _FLAGS).alias("flag"))
    return SK.row_number_by(lineitem, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                                                     "l_quantity", "l_extendedprice"], "rn")


def _line_rows(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """A row per play, as the driver's tables have it: what ``_as_plays`` makes its texts of.

    ``parts``: partitions of the join with the parts, unless they are broadcast."""
    g = _games(spark, sf_dir)
    line = _lines(spark, sf_dir).select("l_orderkey", "rn", "l_partkey", "l_quantity", "l_returnflag", "flag")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    if parts:
        part = part.repartition(parts, "p_partkey")         # the lines follow: this side's number stands
    j = g.join(line, g.o_orderkey == line.l_orderkey).drop("l_orderkey", "o_orderdate")
    return j.join(part, j.l_partkey == part.p_partkey).drop("l_partkey", "p_partkey")


def _play_key() -> Column:
    return F.concat(_s("o_custkey"), F.lit("-"), _s("o_orderkey"), F.lit("-"), _s("rn"))


def _as_plays(rows: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    roster = _named("segment", [*_SEGMENTS.values(), "Offensive Lineman"])
    stadium = F.when(F.col("priority") == 3, F.when(k % 3 == 0, "Domed, Open").when(k % 3 == 1, "Retr. Roof-Open").otherwise("Ourdoor")).otherwise(
        _named("priority", ["Outdoor", "Indoors", "Domed, closed"]))
    weather = (F.when(k % 8 == 0, "Sunny").when(k % 8 == 1, "Cloudy").when(k % 8 == 2, "Light Rain")
               .when(k % 8 == 3, "Snow").when(k % 8 == 4, "Indoor").when(k % 8 == 5, "Clear")
               .when(k % 8 == 6, "Mostly Coudy"))
    return rows.select(
        _s("o_custkey").alias("PlayerKey"),
        F.concat(_s("o_custkey"), F.lit("-"), _s("o_orderkey")).alias("GameID"),
        _play_key().alias("PlayKey"),
        roster.alias("RosterPosition"),
        "PlayerDay", "PlayerGame",
        stadium.alias("StadiumType"),
        F.when(F.col("status") == 0, "Natural").otherwise("Synthetic").alias("FieldType"),
        F.when(k % 10 == 0, -999).otherwise(30 + k % 60).cast("double").alias("Temperature"),
        weather.alias("Weather"),
        _named("flag", _FLAGS.values()).alias("PlayType"),
        F.col("rn").alias("PlayerGamePlay"),
        F.col("p_type").alias("Position"),
        F.col("p_brand").alias("PositionGroup"),
        F.col("l_quantity").alias("src_quantity"),
        F.col("l_returnflag").alias("src_flag"),
        F.col("o_orderkey").alias("src_order"),
        F.col("o_custkey").alias("src_cust"),
    )


def plays_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``plays`` plus the numeric customer key (``src_cust``) for numeric joins."""
    return _as_plays(_line_rows(spark, sf_dir))


def derive_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plays_with_customer(spark, sf_dir).select(*PLAY_COLUMNS)


def derive_injuries(spark: SparkSession, sf_dir: str, plays_df: DataFrame | None = None) -> DataFrame:
    p = derive_plays(spark, sf_dir) if plays_df is None else plays_df
    q = F.col("src_quantity")
    flagged = (((F.col("src_flag") == "R") & (q >= 44))
               | ((F.col("src_flag") == "A") & (F.col("PlayerGamePlay") == 1) & (q % 4 == 0)))
    o = F.col("src_order")
    body = (F.when(o % 5 == 0, "Knee").when(o % 5 == 1, "Ankle").when(o % 5 == 2, "Foot")
            .when(o % 5 == 3, "Toes").otherwise("Heel"))
    return p.where(flagged).select(
        "PlayerKey", "GameID",
        F.when(o % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("PlayKey")).alias("PlayKey"),
        body.alias("BodyPart"),
        F.col("FieldType").alias("Surface"),
        F.lit(1).alias("DM_M1"),
        F.when(q >= 20, 1).otherwise(0).alias("DM_M7"),
        F.when(q >= 35, 1).otherwise(0).alias("DM_M28"),
        F.when(q >= 45, 1).otherwise(0).alias("DM_M42"),
    )


def derive_tracks(spark: SparkSession, sf_dir: str, plays_df: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """One frame per event; ``time`` is hours since the play's first frame.

    ``parts``: partitions of the joins, and of the result by ``PlayKey``."""
    p = derive_plays(spark, sf_dir) if plays_df is None else plays_df
    # PlayerKey is the customer key's canonical text: join on the number.
    first_plays = (p.where(F.col("PlayerGamePlay") == 1)
                   .select("PlayKey", F.col("PlayerKey").cast("bigint").alias("src_cust"), "PlayerGame"))
    if parts:
        first_plays = first_plays.repartition(parts, "src_cust", "PlayerGame")      # the events follow
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # TZ-independent epoch seconds of a timestamp_ntz (same double as epoch() in DuckDB).
    epoch = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") / F.lit(1000000.0)
    e = (events.withColumn("epoch", epoch)
         .withColumn("PlayerGame", (1 + F.floor((F.dayofmonth("ts") - 1) / 7)).cast("int")))
    j = e.join(first_plays, (e.user_id == first_plays.src_cust) & (e.PlayerGame == first_plays.PlayerGame))
    # The play's first epoch: a partial aggregate joined back (a hot play is
    # pre-aggregated and the join's skewed partition is split by AQE).
    if parts:
        j = j.select("PlayKey", "epoch", "event_type", "event_id", "value").repartition(parts, "PlayKey")     # dealt once, as it is stored
    start = j.groupBy("PlayKey").agg(F.min("epoch").alias("_start"))
    j = j.join(start, "PlayKey")
    ev = F.col("event_type")
    return j.select(
        "PlayKey",
        ((F.col("epoch") - F.col("_start")) / F.lit(3600.0)).cast("double").alias("time"),
        F.when(ev == "click", "ball_snap").when(ev == "signup", "pass").when(ev == "purchase", "tackle")
        .alias("event"),
        (F.col("value") % 120).alias("x"),
        (F.col("event_id") % 53).cast("double").alias("y"),
        ((F.col("event_id") * 37) % 360).cast("double").alias("dir"),
        (F.col("value") / 1000).alias("dis"),
        ((F.col("event_id") * 53) % 360).cast("double").alias("o"),
        (F.col("value") / 100).alias("s"),
    )


# -- stored staging -----------------------------------------------------------
_STORED: dict = {}
STORE_CONF = "spark.playtrack.staging.store"
BUCKETS_CONF = "spark.playtrack.staging.buckets"


def _store_enabled(spark: SparkSession) -> bool:
    return spark.conf.get(STORE_CONF, "true").lower() == "true"


SOURCE_TABLES = ["orders", "customer", "lineitem", "part", "events"]
BYTES_PER_BUCKET = 128 * 1024 * 1024
EXPANSION = 18       # parquet bytes -> bytes of staged rows in memory (decompression, text keys): 1.6 GB of 88 MB measured


def bucket_count(spark: SparkSession, sf_dir: str) -> int:
    """``spark.playtrack.staging.buckets`` if set; else about BYTES_PER_BUCKET
    of staged data per bucket, never fewer than the cluster's default
    parallelism (so every core gets a bucket)."""
    configured = spark.conf.get(BUCKETS_CONF, None)
    if configured:
        return int(configured)
    size = sum(length for length, _ in source_state(spark, sf_dir))
    return max(spark.sparkContext.defaultParallelism, -(-size * EXPANSION // BYTES_PER_BUCKET))


def source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """``(bytes, time of change)`` of every source table: what is stored for a folder holds for this state only."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in SOURCE_TABLES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        store = path.getFileSystem(conf)
        out.append((store.getContentSummary(path).getLength(), store.getFileStatus(path).getModificationTime()))
    return tuple(out)


STORED_TABLES = ["plays", "injuries", "tracks", "snaps", "ends", "game_marks", "game_rows", "games"]


def stored_tables(spark: SparkSession, sf_dir: str) -> dict:
    """All stored tables as ``{name: catalog table}``."""
    return {name: stored_table(spark, sf_dir, name) for name in STORED_TABLES}


def stored_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The catalog table of this name: derived and stored when first asked for, once per (session, input folder).

    A query stores what it reads and no more.  Each table is repartitioned by
    its bucket key into the bucket count before the write, so every write task
    produces one file per bucket it owns (no tasks x buckets file explosion).
    """
    from ..session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), source_state(spark, sf_dir))
    names = _STORED.setdefault(key, {})
    if name in names and spark.catalog.tableExists(names[name]):
        return names[name]
    tag = hashlib.md5(repr(key).encode()).hexdigest()[:10]
    n = bucket_count(spark, sf_dir)
    if name in FE.FACT_COLUMNS:
        names |= _stored_facts(spark, stored_table(spark, sf_dir, "plays"), n, tag)
        return names[name]
    n, by, sort_cols, rows = _TO_STORE[name](spark, sf_dir, n)
    tname = f"playtrack_{name}_{tag}"
    (rows.write.mode("overwrite").option("path", f"{scratch_path(spark, f'staged-{name}-{tag}')}").option("compression", "zstd")
     .bucketBy(n, by).sortBy(*sort_cols).saveAsTable(tname))
    names[name] = tname
    return tname


def _stored_facts(spark: SparkSession, plays_table: str, n: int, tag: str) -> dict:
    """Both facts of the play list, from one deal of its rows: one job writes a folder for each, which becomes a table."""
    from ..session import scratch_path

    folder = scratch_path(spark, f"staged-game_facts-{tag}")
    facts = FE.facts_together(spark.table(plays_table), n)
    (facts.write.mode("overwrite").option("path", folder).option("compression", "zstd")
     .partitionBy("facts").bucketBy(n, "GameID").sortBy("GameID").saveAsTable(f"playtrack_game_facts_{tag}"))
    out = {}
    for name, cols in FE.FACT_COLUMNS.items():
        own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"facts={name}")
        own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(own)       # no plays: no rows
        out[name] = f"playtrack_{name}_{tag}"
        columns = ", ".join(f"`{c}` {facts.schema[c].dataType.simpleString()}" for c in cols)
        spark.sql(f"DROP TABLE IF EXISTS {out[name]}")
        spark.sql(f"CREATE TABLE {out[name]} ({columns}) USING parquet CLUSTERED BY (GameID) SORTED BY (GameID) INTO {n} BUCKETS "
                  f"LOCATION '{own.toString()}'")
    return out


def _dealt(by: str, derive, *sort_cols):
    """How a table is stored: its rows dealt by ``by`` and sorted by it and more."""
    def rows(spark, sf_dir, n):
        return n, by, [by, *sort_cols], derive(spark, sf_dir).repartition(n, by)
    return rows


def _store_plays(spark, sf_dir, n):
    # the rows are dealt before their texts are made: the shuffle carries the source's columns
    return n, "PlayKey", ["PlayKey"], _as_plays(_line_rows(spark, sf_dir, n).repartition(n, _play_key())).select(*PLAY_COLUMNS)


def _store_injuries(spark, sf_dir, n):
    # An injury without a play has no key to meet: its rows go to any task, not all to that of the null key.
    deal = F.coalesce(F.col("PlayKey"), F.concat_ws("-", F.lit("none"), F.col("GameID")))
    return n, "PlayKey", ["PlayKey"], derive_injuries(spark, sf_dir, plays(spark, sf_dir)).repartition(n, deal)


def _store_tracks(spark, sf_dir, n):
    # dealt by play already: writing as many buckets moves nothing again
    rows = derive_tracks(spark, sf_dir, plays(spark, sf_dir), n)
    return n, "PlayKey", ["PlayKey", "time"], rows.repartition(n, "PlayKey")


def _store_games(spark, sf_dir, n):
    # a game's plays are spread over the buckets: summing them before they are dealt saves nothing but for a hot game
    rows = plays(spark, sf_dir).select("PlayerKey", "GameID", "PlayerDay")
    if SK.measured_rows(rows, "GameID")[1] <= SK.hot_rows_of(rows):
        rows = rows.repartition(n, "GameID")
    return n, "GameID", ["GameID"], game_days(rows).repartition(n, "GameID")


_TO_STORE = {
    "plays": _store_plays,
    "injuries": _store_injuries,
    "tracks": _store_tracks,
    # what the frame chain asks of a play, stored beside the frames and bucketed alike
    "snaps": _dealt("PlayKey", lambda spark, sf: play_marks(tracks(spark, sf)).snaps),
    "ends": _dealt("PlayKey", lambda spark, sf: play_marks(tracks(spark, sf)).ends),
    "games": _store_games,          # what seasons ask of the play list, bucketed by game (its facts: ``_stored_facts``)
}


def _staged(spark: SparkSession, sf_dir: str, name: str, derive) -> DataFrame:
    if not _store_enabled(spark):
        return derive(spark, sf_dir)
    return spark.table(stored_table(spark, sf_dir, name))


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "plays", derive_plays)


def injuries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "injuries", derive_injuries)


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "tracks", derive_tracks)


def marks(spark: SparkSession, sf_dir: str) -> PlayMarks:
    """Snaps and last events of every play of ``tracks``."""
    if not _store_enabled(spark):
        return play_marks(derive_tracks(spark, sf_dir))
    return PlayMarks(*[spark.table(stored_table(spark, sf_dir, name)) for name in ("snaps", "ends")])


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``game_days`` of ``plays``."""
    if not _store_enabled(spark):
        return game_days(derive_plays(spark, sf_dir))
    return spark.table(stored_table(spark, sf_dir, "games"))


def game_facts(spark: SparkSession, sf_dir: str) -> FE.GameFacts:
    """``features.game_facts`` of ``plays``."""
    if not _store_enabled(spark):
        return FE.game_facts(derive_plays(spark, sf_dir))
    return FE.GameFacts(*[spark.table(stored_table(spark, sf_dir, name)) for name in ("game_marks", "game_rows")])


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register ``plays``, ``injuries`` and ``tracks`` as temp views for SQL."""
    plays(spark, sf_dir).createOrReplaceTempView("plays")
    injuries(spark, sf_dir).createOrReplaceTempView("injuries")
    tracks(spark, sf_dir).createOrReplaceTempView("tracks")
