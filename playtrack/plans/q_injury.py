"""Injury tables and the severity / environment reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import (STADIUM_OPEN_CLOSED, STADIUM_TWO_WAY, WEATHER_QUALITY, categorize, categorize_sql)
from ..operators import clean as CL
from ..operators import features as FE
from ..operators import reports as R
from ..operators import skew as SK
from ..sources import staging as S
from .registry import query

SEV_SQL = "(DM_M1+DM_M7+DM_M28+DM_M42)"
INJ_SEV_CTE = f"""inj AS (select *, {SEV_SQL} as Severity,
  case when {SEV_SQL}>=3 then 'H' else 'L' end as SevLevel from injuries)"""

DETAIL_PLAY_COLS = ["RosterPosition", "PlayerDay", "PlayerGame", "StadiumType", "FieldType", "Temperature",
                    "Weather", "PlayType", "PlayerGamePlay", "Position", "PositionGroup"]
DETAIL_INJ_COLS = ["PlayKey", "PlayerKey", "GameID", "BodyPart", "Surface", "Severity", "SevLevel"]


def injury_detail(spark, sf, how="inner"):
    """Injuries (with severity) joined to their play on PlayKey."""
    inj = FE.with_severity(S.injuries(spark, sf)).select(*DETAIL_INJ_COLS)
    plays = S.plays(spark, sf).select("PlayKey", *DETAIL_PLAY_COLS)
    met = inj.where(F.col("PlayKey").isNotNull()).join(plays, "PlayKey", how)
    if how == "inner":
        return met
    # Injuries without a play key meet nothing: they pass beside the join instead of gathering in its null key.
    alone = inj.where(F.col("PlayKey").isNull()).select(
        *DETAIL_INJ_COLS, *[F.lit(None).cast(plays.schema[c].dataType).alias(c) for c in DETAIL_PLAY_COLS])
    return met.unionByName(alone)


DETAIL_SQL = ("select " + ", ".join(f"i.{c}" for c in DETAIL_INJ_COLS) + ", "
              + ", ".join(f"p.{c}" for c in DETAIL_PLAY_COLS) + " from inj i {how} join plays p on i.PlayKey=p.PlayKey")
DETAIL_CTE = INJ_SEV_CTE + ",\ndetail AS (" + DETAIL_SQL.format(how="inner") + ")"
DETAIL_LEFT_CTE = INJ_SEV_CTE + ",\ndetail AS (" + DETAIL_SQL.format(how="left") + ")"


# -- projections and derived columns ---------------------------------------
@query("injury_severity", sql=f"select *, {SEV_SQL} as Severity, case when {SEV_SQL}>=3 then 'H' else 'L' end as SevLevel from injuries")
def injury_severity(spark, sf):
    return FE.with_severity(S.injuries(spark, sf))


@query("injury_projection",
       sql="select PlayerKey, GameID, PlayKey, BodyPart, Surface, Severity, SevLevel from inj", ctes=INJ_SEV_CTE)
def injury_projection(spark, sf):
    return FE.with_severity(S.injuries(spark, sf)).select(
        "PlayerKey", "GameID", "PlayKey", "BodyPart", "Surface", "Severity", "SevLevel")


@query("injury_renamed",
       sql=f"""select PlayerKey as InjPlayerKey, GameID as InjGameID, PlayKey as InjPlayKey, BodyPart, Surface,
 DM_M1, DM_M7, DM_M28, DM_M42, {SEV_SQL} as Severity from injuries""")
def injury_renamed(spark, sf):
    return FE.construct_injuries(S.injuries(spark, sf))


@query("injury_level_from_text",
       sql=f"""select PlayerKey, GameID, BodyPart, cast({SEV_SQL} as int) as level_of_injury from injuries""")
def injury_level_from_text(spark, sf):
    # The text form of the injury file (every column read as string).
    text = S.injuries(spark, sf).select("PlayerKey", "GameID", "BodyPart",
                                        *[F.col(c).cast("string").alias(c) for c in C.DM_COLUMNS])
    return text.select("PlayerKey", "GameID", "BodyPart", C.severity_from_text().alias("level_of_injury"))


@query("non_null_counts",
       sql="select " + ", ".join(f"count({c}) as {c}" for c in S.INJURY_COLUMNS) + " from injuries")
def non_null_counts(spark, sf):
    return R.non_null_counts(S.injuries(spark, sf))


# -- grouped counts -------------------------------------------------------
def _counts(keys, source_cte=INJ_SEV_CTE, source="inj"):
    k = ", ".join(keys)
    return dict(sql=f"select {k}, count(*) as count from {source} group by {k}", ctes=source_cte)


@query("injury_by_severity_surface", **_counts(["Severity", "Surface"]))
def injury_by_severity_surface(spark, sf):
    inj = FE.with_severity(S.injuries(spark, sf))
    return R.count_by(inj, "Severity", "Surface").orderBy(F.col("Severity").asc(), F.col("Surface").desc())


@query("injury_by_level_surface", **_counts(["SevLevel", "Surface"]))
def injury_by_level_surface(spark, sf):
    inj = FE.with_severity(S.injuries(spark, sf))
    return R.count_by(inj, "SevLevel", "Surface").orderBy(F.col("SevLevel").asc(), F.col("Surface").desc())


@query("injury_by_body_part", **_counts(["BodyPart", "Severity"]))
def injury_by_body_part(spark, sf):
    return R.count_by(FE.with_severity(S.injuries(spark, sf)), "BodyPart", "Severity").orderBy("BodyPart",
                                                                                                "Severity")


@query("injury_by_body_part_surface", **_counts(["BodyPart", "Severity", "Surface"]))
def injury_by_body_part_surface(spark, sf):
    inj = FE.with_severity(S.injuries(spark, sf))
    return R.count_by(inj, "BodyPart", "Severity", "Surface").orderBy(
        F.col("BodyPart").asc(), F.col("Severity").desc(), F.col("Surface").asc())


@query("injury_by_surface", **_counts(["Surface"]))
def injury_by_surface(spark, sf):
    return R.count_by(S.injuries(spark, sf), "Surface")


@query("plays_by_type", sql="select PlayType, count(*) as count from plays group by PlayType")
def plays_by_type(spark, sf):
    return R.count_by(S.plays(spark, sf), "PlayType")


# -- joins of injuries and plays -----------------------------------------
@query("injury_play_detail", sql="select * from detail", ctes=DETAIL_CTE)
def injury_play_detail(spark, sf):
    return injury_detail(spark, sf, "inner")


@query("injury_play_detail_left", sql="select * from detail", ctes=DETAIL_LEFT_CTE)
def injury_play_detail_left(spark, sf):
    return injury_detail(spark, sf, "left")


@query("injury_by_roster_position", **_counts(["Surface", "Severity", "RosterPosition"], DETAIL_LEFT_CTE, "detail"))
def injury_by_roster_position(spark, sf):
    detail = injury_detail(spark, sf, "left")
    return R.count_by(detail, "Surface", "Severity", "RosterPosition").orderBy(
        F.col("Severity").desc(), F.col("RosterPosition").asc())


@query("injury_by_position", **_counts(["Surface", "Position", "Severity"], DETAIL_CTE, "detail"))
def injury_by_position(spark, sf):
    detail = injury_detail(spark, sf, "inner")
    return R.count_by(detail, "Surface", "Position", "Severity").orderBy(
        F.col("Position").asc(), F.col("Severity").desc())


ENV_SQL = (f"select Surface, StadiumType, Weather, count(*) as count, "
           f"{categorize_sql('Weather', WEATHER_QUALITY, 'Unknown')} as WeatherGrp, "
           f"{categorize_sql('StadiumType', STADIUM_TWO_WAY, 'Unknown')} as StadiumGrp "
           f"from detail group by Surface, StadiumType, Weather")


def injury_environment_counts(spark, sf):
    """Counts by Surface x StadiumType x Weather on raw text; the weather and
    stadium groups are added to the counted rows afterwards (A6)."""
    counts = R.count_by(injury_detail(spark, sf, "inner"), "Surface", "StadiumType", "Weather")
    return (counts.withColumn("WeatherGrp", categorize("Weather", WEATHER_QUALITY, "Unknown"))
            .withColumn("StadiumGrp", categorize("StadiumType", STADIUM_TWO_WAY, "Unknown")))


@query("injury_by_environment", sql=ENV_SQL, ctes=DETAIL_CTE)
def injury_by_environment(spark, sf):
    return injury_environment_counts(spark, sf).orderBy("Surface", "StadiumType", "Weather")


@query("chart_weather_stadium_groups",
       sql=f"select WeatherGrp, StadiumGrp, cast(sum(count) as bigint) as count from ({ENV_SQL}) e group by WeatherGrp, StadiumGrp",
       ctes=DETAIL_CTE)
def chart_weather_stadium_groups(spark, sf):
    env = injury_environment_counts(spark, sf)
    return env.groupBy("WeatherGrp", "StadiumGrp").agg(F.sum("count").cast("bigint").alias("count"))


@query("chart_severity_weather",
       sql=f"select Surface, {categorize_sql('Weather', WEATHER_QUALITY, 'Unknown')} as WeatherGrp, Severity, "
           f"count(*) as count from detail group by 1, 2, 3", ctes=DETAIL_CTE)
def chart_severity_weather(spark, sf):
    detail = injury_detail(spark, sf, "inner").withColumn(
        "WeatherGrp", categorize("Weather", WEATHER_QUALITY, "Unknown"))
    return R.count_by(detail, "Surface", "WeatherGrp", "Severity")


@query("injured_player_history",
       sql=f"""select i.PlayerKey as InjPlayerKey, i.GameID as InjGameID, i.PlayKey as InjPlayKey, {SEV_SQL} as Severity,
 p.GameID, p.PlayKey, p.RosterPosition, p.PlayerDay, p.PlayerGame, p.StadiumType, p.FieldType, p.Temperature, p.Weather,
 p.PlayType, p.PlayerGamePlay, p.Position, p.PositionGroup
 from injuries i join plays p on i.PlayerKey=p.PlayerKey""")
def injured_player_history(spark, sf):
    inj = FE.construct_injuries(S.injuries(spark, sf)).select("InjPlayerKey", "InjGameID", "InjPlayKey", "Severity")
    plays = S.plays(spark, sf).select("PlayerKey", "GameID", "PlayKey", *[c for c in DETAIL_PLAY_COLS])
    return (inj.join(plays, inj.InjPlayerKey == plays.PlayerKey, "inner").drop("PlayerKey"))


@query("injury_game_plays",
       sql="""select i.PlayerKey as InjPlayerKey, i.GameID as InjGameID, p.PlayKey, p.RosterPosition, p.PlayerDay,
 p.PlayerGame, p.StadiumType, p.FieldType, p.Temperature, p.Weather, p.PlayType, p.PlayerGamePlay, p.Position,
 p.PositionGroup from injuries i join plays p on i.PlayerKey=p.PlayerKey where i.GameID=p.GameID""")
def injury_game_plays(spark, sf):
    hist = injured_player_history(spark, sf)
    return (hist.where(F.col("InjGameID") == F.col("GameID"))
            .select("InjPlayerKey", "InjGameID", "PlayKey", *DETAIL_PLAY_COLS)
            .orderBy("InjPlayerKey", "InjGameID", "PlayerGamePlay"))


@query("injury_plays_by_type",
       sql="""select PlayType, count(*) as count from (select distinct p.PlayType, i.PlayKey
 from injuries i join plays p on i.PlayKey=p.PlayKey) d group by PlayType""")
def injury_plays_by_type(spark, sf):
    j = S.injuries(spark, sf).select("PlayKey").join(S.plays(spark, sf).select("PlayKey", "PlayType"), "PlayKey")
    return R.distinct_count_by(j, "PlayType", "PlayKey")


@query("injury_games_by_roster",
       sql="""select RosterPosition, count(*) as count from (select distinct p.RosterPosition, i.GameID
 from injuries i join plays p on i.PlayKey=p.PlayKey) d group by RosterPosition""")
def injury_games_by_roster(spark, sf):
    # The play side's GameID copy is dropped before the USING join (hazard H9).
    j = (S.injuries(spark, sf).select("PlayKey", "GameID")
         .join(S.plays(spark, sf).select("PlayKey", "RosterPosition"), "PlayKey"))
    return R.distinct_count_by(j, "RosterPosition", "GameID")


# -- SQL view (S6) -----------------------------------------------------------
@query("sql_view_counts",
       sql=f"select BodyPart, Severity, count(*) as count from (select BodyPart, {SEV_SQL} as Severity from injuries) v group by BodyPart, Severity")
def sql_view_counts(spark, sf):
    FE.construct_injuries(S.injuries(spark, sf)).createOrReplaceTempView("playtrack_injury_severity")
    return spark.sql("select BodyPart, Severity, count(*) as count from playtrack_injury_severity "
                     "group by BodyPart, Severity")


@query("chart_zeppelin_bars",
       sql=f"""select 'bodypart' as chart, BodyPart as key, Severity, cast(sum(Severity) as bigint) as value
 from (select BodyPart, Severity from inj) a group by BodyPart, Severity
 union all
 select 'surface' as chart, Surface as key, Severity, cast(sum(count) as bigint) as value
 from (select Surface, Severity, count(*) as count from inj group by Surface, Severity) b group by Surface, Severity""",
       ctes=INJ_SEV_CTE)
def chart_zeppelin_bars(spark, sf):
    inj = FE.with_severity(S.injuries(spark, sf))
    body = (inj.groupBy("BodyPart", "Severity").agg(F.sum("Severity").cast("bigint").alias("value"))
            .select(F.lit("bodypart").alias("chart"), F.col("BodyPart").alias("key"), "Severity", "value"))
    surface = (R.count_by(inj, "Surface", "Severity").groupBy("Surface", "Severity")
               .agg(F.sum("count").cast("bigint").alias("value"))
               .select(F.lit("surface").alias("chart"), F.col("Surface").alias("key"), "Severity", "value"))
    return body.unionByName(surface)


@query("chart_bodypart_surface", sql="select BodyPart, Surface, count(*) as count from injuries group by 1, 2")
def chart_bodypart_surface(spark, sf):
    return R.count_plot_data(S.injuries(spark, sf), "BodyPart", hue="Surface")


@query("chart_level_bodypart",
       sql=f"select {SEV_SQL} as level_of_injury, BodyPart, count(*) as count from injuries group by 1, 2")
def chart_level_bodypart(spark, sf):
    inj = S.injuries(spark, sf).withColumn("level_of_injury", C.severity())
    return R.count_plot_data(inj, "level_of_injury", hue="BodyPart")


# -- the environment analysis (J4, X9, V1) ---------------------------------------
ENV_COLS = ["PlayerKey", "GameID", "Temperature", "Weather", "StadiumType", "FieldType"]
INJ_ENV_CTE = f"""injenv AS (select i.GameID, i.PlayerKey, i.BodyPart, i.level_of_injury, g.Temperature, g.Weather,
 g.StadiumType, g.FieldType
 from (select PlayerKey, GameID, BodyPart, cast({SEV_SQL} as int) as level_of_injury from injuries) i
 join (select distinct {', '.join(ENV_COLS)} from plays) g on i.GameID=g.GameID and i.PlayerKey=g.PlayerKey)"""
ENV_CLEAN_CTE = INJ_ENV_CTE + f""",
envclean AS (select GameID, PlayerKey, BodyPart, level_of_injury, Temperature, FieldType,
 {categorize_sql("coalesce(Weather, 'null')", WEATHER_QUALITY)} as Weather,
 {categorize_sql("coalesce(StadiumType, 'null')", STADIUM_OPEN_CLOSED)} as StadiumType
 from injenv)"""


def injury_environment_df(spark, sf):
    """Injuries joined to the distinct game environments of the play list on
    (GameID, PlayerKey) (J4)."""
    inj = S.injuries(spark, sf).select("PlayerKey", "GameID", "BodyPart",
                                       C.severity().cast("int").alias("level_of_injury"))
    # a game's plays lie in many buckets: dealt first, they are made distinct and joined where they are
    games = SK.dealt_by_key(S.plays(spark, sf).select(*ENV_COLS), "GameID", "PlayerKey").distinct()
    return inj.join(games, ["GameID", "PlayerKey"], "inner")


def injury_environment_clean_df(spark, sf):
    """J4 -> null text "null" -> weather quality and stadium open/closed rules,
    unknown values kept (X9)."""
    env = CL.fill_text(injury_environment_df(spark, sf), "null", ["Weather", "StadiumType"])
    env = CL.with_category(env, "Weather", WEATHER_QUALITY)
    return CL.with_category(env, "StadiumType", STADIUM_OPEN_CLOSED)


@query("injury_environment", sql="select * from injenv", ctes=INJ_ENV_CTE)
def injury_environment(spark, sf):
    return injury_environment_df(spark, sf)


@query("env_fill_null_text",
       sql="""select GameID, PlayerKey, BodyPart, level_of_injury, Temperature, coalesce(Weather, 'null') as Weather,
 coalesce(StadiumType, 'null') as StadiumType, FieldType from injenv""", ctes=INJ_ENV_CTE)
def env_fill_null_text(spark, sf):
    return CL.fill_text(injury_environment_df(spark, sf), "null", ["Weather", "StadiumType"])


@query("injury_environment_clean", sql="select * from envclean", ctes=ENV_CLEAN_CTE)
def injury_environment_clean(spark, sf):
    return injury_environment_clean_df(spark, sf)


@query("temperature_try_cast",
       sql="""select GameID, PlayerKey, Temperature as raw_temperature,
 try_cast(cast(Temperature as varchar) as double) as Temperature from envclean""", ctes=ENV_CLEAN_CTE)
def temperature_try_cast(spark, sf):
    # The environment table travels as text (pandas frame of strings in the
    # source); the numeric column is recovered with a null-on-failure cast.
    env = injury_environment_clean_df(spark, sf).select(
        "GameID", "PlayerKey", F.col("Temperature").alias("raw_temperature"),
        F.col("Temperature").cast("string").alias("Temperature"))
    return CL.try_number(env, "Temperature", "double")


def _chart(name, x, hue=None, facet=None):
    keys = [k for k in (facet, x, hue) if k]
    sql = f"select {', '.join(keys)}, count(*) as count from envclean group by {', '.join(keys)}"

    @query(name, sql=sql, ctes=ENV_CLEAN_CTE)
    def _q(spark, sf):
        return R.count_plot_data(injury_environment_clean_df(spark, sf), x, hue=hue, facet=facet)
    return _q


_chart("chart_weather_level_field", "Weather", hue="level_of_injury", facet="FieldType")
_chart("chart_stadium_level_field", "StadiumType", hue="level_of_injury", facet="FieldType")
_chart("chart_weather_bodypart_field", "Weather", hue="BodyPart", facet="FieldType")
_chart("chart_stadium_weather", "StadiumType", hue="Weather")
_chart("chart_weather", "Weather")
_chart("chart_stadium", "StadiumType")
_chart("chart_weather_field", "Weather", hue="FieldType")
_chart("chart_stadium_field", "StadiumType", hue="FieldType")
_chart("chart_weather_level", "Weather", hue="level_of_injury")
_chart("chart_stadium_level", "StadiumType", hue="level_of_injury")
_chart("chart_weather_bodypart", "Weather", hue="BodyPart")
_chart("chart_stadium_bodypart", "StadiumType", hue="BodyPart")


@query("chart_bodypart", sql="select BodyPart, count(*) as count from injuries group by 1")
def chart_bodypart(spark, sf):
    return R.count_plot_data(S.injuries(spark, sf), "BodyPart")


@query("chart_level_surface",
       sql=f"select {SEV_SQL} as level_of_injury, Surface, count(*) as count from injuries group by 1, 2")
def chart_level_surface(spark, sf):
    inj = S.injuries(spark, sf).withColumn("level_of_injury", C.severity())
    return R.count_plot_data(inj, "level_of_injury", hue="Surface")
