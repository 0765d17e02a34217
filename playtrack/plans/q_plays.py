"""Play-list queries: category rules, fills, casts, flags, keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import (KEEP, MAIN_POSITIONS, PLAY_TEXT_COLUMNS, RUSH_PASS, STADIUM_FIVE_WAY,
                               STADIUM_OPEN_CLOSED, STADIUM_THREE_WAY, STADIUM_TWO_WAY, WEATHER_FIVE_WAY,
                               WEATHER_QUALITY, WEATHER_THREE_WAY, categorize, categorize_sql, in_list_sql)
from ..operators import clean as CL
from ..operators import features as FE
from ..operators import reports as R
from ..operators import tracking as TR
from ..sources import staging as S
from .registry import query
from .sql_blocks import CPLAYS


# -- category rules: one row per (raw value, group) with its play count ------------
def _rule_query(name, col, rules, default=KEEP, fill=None):
    src = f"coalesce({col}, '{fill}')" if fill else col
    sql = (f"select {col}, {categorize_sql(src, rules, default)} as {col}Grp, count(*) as count "
           f"from plays group by 1, 2")

    @query(name, sql=sql)
    def _q(spark, sf):
        plays = S.plays(spark, sf)
        c = F.coalesce(F.col(col), F.lit(fill)) if fill else F.col(col)
        return R.count_by(plays.withColumn(f"{col}Grp", categorize(c, rules, default)), col, f"{col}Grp")
    _q.__doc__ = f"{name}: {col} -> group ({'keep unknown' if default is KEEP else default})"
    return _q


_rule_query("stadium_five_way", "StadiumType", STADIUM_FIVE_WAY)
_rule_query("weather_five_way", "Weather", WEATHER_FIVE_WAY)
_rule_query("stadium_three_way", "StadiumType", STADIUM_THREE_WAY, "Unknown")
_rule_query("stadium_two_way", "StadiumType", STADIUM_TWO_WAY, "Unknown")
_rule_query("weather_three_way", "Weather", WEATHER_THREE_WAY, "Unknown")
_rule_query("weather_quality_udf_rule", "Weather", WEATHER_QUALITY, "Unknown")
_rule_query("weather_quality_keep", "Weather", WEATHER_QUALITY, KEEP, fill="null")
_rule_query("stadium_two_way_keep", "StadiumType", STADIUM_OPEN_CLOSED, KEEP, fill="null")


# -- fills and sentinels ------------------------------------------------------------
_FILL_SQL = ", ".join(f"coalesce({c}, 'Missing') as {c}" for c in PLAY_TEXT_COLUMNS if c != "PlayType")


@query("plays_fill_missing",
       sql=f"""select PlayKey, RosterPosition,
 case when coalesce(PlayType,'Missing')='0' then 'Missing' else coalesce(PlayType,'Missing') end as PlayType,
 {_FILL_SQL} from plays""")
def plays_fill_missing(spark, sf):
    df = CL.fill_text(S.plays(spark, sf), "Missing", PLAY_TEXT_COLUMNS)
    df = CL.replace_sentinel(df, "PlayType", "0", "Missing")
    return df.select("PlayKey", "RosterPosition", *PLAY_TEXT_COLUMNS)


@query("temperature_sentinel_61",
       sql="""select distinct GameID, Temperature as raw_temperature,
 case when Temperature<0 then 61 else Temperature end as Temperature from plays""")
def temperature_sentinel_61(spark, sf):
    df = S.plays(spark, sf).select("GameID", F.col("Temperature").alias("raw_temperature"), "Temperature")
    return CL.replace_below(df, "Temperature", 0, 61).distinct()


@query("distinct_categories",
       sql="""select distinct 'Weather' as column_name, Weather as value from plays
 union select distinct 'StadiumType', StadiumType from plays
 union select distinct 'PlayType', PlayType from plays
 union select distinct 'FieldType', FieldType from plays""")
def distinct_categories(spark, sf):
    plays = S.plays(spark, sf)
    parts = [CL.distinct_values(plays, c).select(F.lit(c).alias("column_name"), F.col(c).alias("value"))
             for c in ["Weather", "StadiumType", "PlayType", "FieldType"]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("distinct_entities",
       sql="""select count(distinct PlayerKey) as n_players, count(distinct GameID) as n_games,
 count(distinct PlayKey) as n_plays from plays""")
def distinct_entities(spark, sf):
    return R.distinct_counts(S.plays(spark, sf), {"n_players": "PlayerKey", "n_games": "GameID",
                                                  "n_plays": "PlayKey"})


# -- keys, casts, predicates ---------------------------------------------------------
@query("game_list",
       sql="""select distinct PlayerKey as GamePlayerID, GameID, PlayerDay, PlayerGame, RosterPosition, StadiumType,
 FieldType, Temperature, Weather from cplays""", ctes=f"cplays AS ({CPLAYS})")
def game_list(spark, sf):
    return FE.game_list(CL.clean_plays(S.plays(spark, sf)))


@query("typed_plays",
       sql="""select PlayKey, PlayerDay, PlayerGame, PlayerGamePlay, Temperature from plays""")
def typed_plays(spark, sf):
    # The text form of the play list (all columns as read without a schema) ...
    text = S.plays(spark, sf).select(
        "PlayKey", *[F.col(c).cast("string").alias(c) for c in
                     ["PlayerDay", "PlayerGame", "PlayerGamePlay", "Temperature"]])
    # ... typed back; text that is not a number becomes null (ANSI-safe).
    for c in ["PlayerDay", "PlayerGame", "PlayerGamePlay"]:
        text = CL.try_number(text, c, "int")
    return CL.try_number(text, "Temperature", "double")


@query("main_position_plays",
       sql=f"""select PlayKey, RosterPosition, PlayType from plays
 where RosterPosition in {in_list_sql(MAIN_POSITIONS)} and PlayType in {in_list_sql(RUSH_PASS)}""")
def main_position_plays(spark, sf):
    return (S.plays(spark, sf).where(F.col("RosterPosition").isin(*MAIN_POSITIONS)
                                     & F.col("PlayType").isin(*RUSH_PASS))
            .select("PlayKey", "RosterPosition", "PlayType"))


@query("season_of_play",
       sql="select PlayKey, PlayerDay, case when PlayerDay<350 then 1 else 2 end as season from plays")
def season_of_play(spark, sf):
    return S.plays(spark, sf).select("PlayKey", "PlayerDay", C.season("PlayerDay", 350).alias("season"))


@query("game_id_from_play_key",
       sql="""select PlayKey, GameID, split_part(PlayKey,'-',1)||'-'||split_part(PlayKey,'-',2) as DerivedGameID
 from plays""")
def game_id_from_play_key(spark, sf):
    return S.plays(spark, sf).select("PlayKey", "GameID", C.game_id_from_play_key("PlayKey").alias("DerivedGameID"))


@query("season2_player_plays",
       sql="""select PlayKey, PlayerKey, GameID, PlayerDay, case when PlayerDay<350 then 1 else 2 end as season
 from plays where PlayerKey in (select PlayerKey from plays where PlayerDay>=350)""")
def season2_player_plays(spark, sf):
    return TR.season_plays(S.plays(spark, sf)).select("PlayKey", "PlayerKey", "GameID", "PlayerDay", "season")


@query("play_flags",
       sql=f"""select p.PlayKey, p.RosterPosition, p.PlayType,
 coalesce(p.RosterPosition in {in_list_sql(MAIN_POSITIONS)}, false) as is_main_pos,
 exists(select 1 from injuries i where i.PlayKey=p.PlayKey) as is_injury_play,
 coalesce(p.PlayType in {in_list_sql(RUSH_PASS)}, false) as is_rush_pass from plays p""")
def play_flags(spark, sf):
    attrs = TR.play_attributes(S.plays(spark, sf), S.injuries(spark, sf))
    return attrs.select("PlayKey", "RosterPosition", "PlayType", "is_main_pos", "is_injury_play", "is_rush_pass")


# -- histograms of temperature (V3, C16) ---------------------------------------------
def hist_sql(source: str, value: str, where: str = "true", bins: int = 100) -> str:
    return f"""select cast(bin as int) as bin, round(vmin + bin*w, 6) as lo, round(vmin + (bin+1)*w, 6) as hi,
 count(*) as n, round(count(*)/(total*w), 6) as density
 from (select least(floor((v - vmin)/w), {bins - 1}) as bin, vmin, w, total
   from (select cast({value} as double) as v from {source} where {where} and {value} is not null) hv,
        (select min(v) as vmin, case when max(v)>min(v) then (max(v)-min(v))/{bins} else 1.0 end as w,
                count(*) as total
         from (select cast({value} as double) as v from {source} where {where} and {value} is not null) x) s) b
 group by bin, vmin, w, total"""


def hist_df(df, col):
    """Histogram rows of one column."""
    h = R.histogram(df.select(col), col)
    return h.select("bin", C.r6("lo").alias("lo"), C.r6("hi").alias("hi"), "n", C.r6("density").alias("density"))


@query("hist_temperature", sql=hist_sql("plays", "cast(Temperature as int)"))
def hist_temperature(spark, sf):
    plays = S.plays(spark, sf).select(F.col("Temperature").cast("int").alias("t"))
    return hist_df(plays, "t")


@query("hist_temperature_clean", sql=hist_sql("plays", "cast(Temperature as int)", "Temperature > -999"))
def hist_temperature_clean(spark, sf):
    plays = (S.plays(spark, sf).where(F.col("Temperature") > -999)
             .select(F.col("Temperature").cast("int").alias("t")))
    return hist_df(plays, "t")
