"""Game and player feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import columns as C
from ..functions.rules import FIELD_PIVOT, STADIUM_PIVOT, WEATHER_PIVOT
from ..operators import features as FE
from ..operators import ml as ML
from ..sources import staging as S
from .registry import query
from .sql_blocks import GAMES, KIN, PGF, PGF_COLS, PLAYER, PLAYER_COUNTS, PLAYER_DOUBLES, qi


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (reported values are compared at 6 places)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _r(cols):
    return ", ".join(f"round({c}, 6) as {c}" for c in cols)


GAME_FEATURE_OUT = ["GameID", "PlayerKey", "PlayerGame", "NumRosterPosition", "NumPlayTypePerGame",
                    "NumPositionPerGame", "MaxPlayGamePlay", "PlayerDay", "RosterPosition", "StadiumType", "FieldType",
                    "Temperature", "Weather", "Rest_days"]


def player_game_table(spark, sf, mode="reference"):
    return FE.player_game_features(S.plays(spark, sf), S.injuries(spark, sf), S.tracks(spark, sf), mode,
                                   S.game_facts(spark, sf))


def player_table(spark, sf):
    return FE.player_features(player_game_table(spark, sf))


@query("rest_days", sql="select GamePlayerID, GameID, PlayerGame, PlayerDay, Rest_days from rest", ctes=GAMES)
def rest_days(spark, sf):
    return FE.rest_days(S.game_facts(spark, sf).rows).select("GamePlayerID", "GameID", "PlayerGame", "PlayerDay", "Rest_days")


@query("game_features", sql="select " + ", ".join(GAME_FEATURE_OUT) + " from gamefeat", ctes=GAMES)
def game_features(spark, sf):
    return FE.game_features(S.plays(spark, sf), S.game_facts(spark, sf)).select(*GAME_FEATURE_OUT)


@query("game_injury_label", sql="select " + ", ".join(GAME_FEATURE_OUT) + ", Severity, IsInjury from gamelabel",
       ctes=GAMES)
def game_injury_label(spark, sf):
    g = FE.game_injury_label(FE.game_features(S.plays(spark, sf), S.game_facts(spark, sf)), S.injuries(spark, sf))
    return g.select(*GAME_FEATURE_OUT, "Severity", "IsInjury")


_KIN_COLS = ["PlayKey", "time", "event", "x_distance", "o_minus_dir", "y_distance", "time_period", "x_velocity",
             "y_velocity", "velocity"]
_KIN_DOUBLES = ["x_distance", "o_minus_dir", "y_distance", "time_period", "x_velocity", "y_velocity", "velocity"]


@query("track_kinematics", sql="select PlayKey, time, event, " + _r(_KIN_DOUBLES) + " from kin", ctes=KIN)
def track_kinematics(spark, sf):
    return round_doubles(FE.track_kinematics(S.tracks(spark, sf)).select(*_KIN_COLS)).select(
        "PlayKey", F.col("time"), "event", *_KIN_DOUBLES)


@query("track_kinematics_per_step", sql="select PlayKey, time, event, " + _r(_KIN_DOUBLES) + " from kinstep",
       ctes=KIN)
def track_kinematics_per_step(spark, sf):
    return round_doubles(FE.track_kinematics(S.tracks(spark, sf), mode="per_step").select(*_KIN_COLS))


@query("track_single_play",
       sql="select PlayKey, time, event, " + _r(_KIN_DOUBLES) + " from kin where PlayKey in (select PlayKey from injuries)",
       ctes=KIN)
def track_single_play(spark, sf):
    """The one-play prototype applied to the plays named by a key table (the
    injured plays): key-equality semi join, then the play's event-frame
    kinematics."""
    keys = S.injuries(spark, sf).select("PlayKey").where(F.col("PlayKey").isNotNull())
    frames = S.tracks(spark, sf).join(keys, "PlayKey", "left_semi")
    return round_doubles(FE.track_kinematics(frames).select(*_KIN_COLS))


_TRACK_AVG = ["avg_o_mins_dir", "avg_x_velocity", "avg_y_velocity", "avg_velocity"]


@query("track_game_features", sql="select TrackGameID, " + _r(_TRACK_AVG) + " from trackfeat", ctes=KIN)
def track_game_features(spark, sf):
    return round_doubles(FE.track_game_features(S.tracks(spark, sf)))


_PGF_DOUBLES = ["Temperature"] + _TRACK_AVG


@query("player_game_features",
       sql="select " + ", ".join(c for c in PGF_COLS if c not in _PGF_DOUBLES) + ", " + _r(_PGF_DOUBLES) + " from pgf",
       ctes=PGF)
def player_game_features(spark, sf):
    return round_doubles(player_game_table(spark, sf))


_PLAYER_AVG_SQL = "select PlayerKey, " + _r(PLAYER_DOUBLES) + ", sum_Injury from player"


@query("player_averages", sql=_PLAYER_AVG_SQL, ctes=PLAYER)
def player_averages(spark, sf):
    return round_doubles(player_table(spark, sf).select("PlayerKey", *PLAYER_DOUBLES, "sum_Injury"))


def _pivot_query(name, col, values):
    sql = "select PlayerKey, " + ", ".join(
        f"cast(sum(case when {col}='{v}' then 1 end) as bigint) as {qi(v)}" for v in values) + " from pgf group by PlayerKey"

    @query(name, sql=sql, ctes=PGF)
    def _q(spark, sf):
        return FE.pivot_table(player_game_table(spark, sf), col, values)
    return _q


_pivot_query("pivot_weather", "Weather", WEATHER_PIVOT)
_pivot_query("pivot_stadium", "StadiumType", STADIUM_PIVOT)
_pivot_query("pivot_field", "FieldType", FIELD_PIVOT)

_PLAYER_SQL = "select PlayerKey, " + _r(PLAYER_DOUBLES) + ", " + ", ".join(qi(c) for c in PLAYER_COUNTS) + " from player"


@query("player_features", sql=_PLAYER_SQL, ctes=PLAYER)
def player_features(spark, sf):
    return round_doubles(player_table(spark, sf))


@query("player_features_filled",
       sql="select PlayerKey, " + ", ".join(f"round(coalesce({c}, 0), 6) as {c}" for c in PLAYER_DOUBLES) + ", "
           + ", ".join(f"coalesce({qi(c)}, 0) as {qi(c)}" for c in PLAYER_COUNTS) + " from player", ctes=PLAYER)
def player_features_filled(spark, sf):
    return round_doubles(player_table(spark, sf).na.fill(0))


@query("player_model_input",
       sql="select " + ", ".join(
           (f"round(coalesce({c}, 0), 6) as {c}" if c in PLAYER_DOUBLES else f"coalesce({qi(c)}, 0) as {qi(c)}")
           for c in ML.PLAYER_MODEL_FEATURES) + ", case when sum_Injury>0 then 1 else 0 end as IsInjury from player",
       ctes=PLAYER)
def player_model_input(spark, sf):
    return round_doubles(FE.model_input(player_table(spark, sf), ML.PLAYER_MODEL_FEATURES))


@query("top_rows_preview", sql=_PLAYER_SQL + " order by PlayerKey limit 5", ctes=PLAYER)
def top_rows_preview(spark, sf):
    """``show(5)`` of the player table made deterministic: first 5 by key."""
    return round_doubles(player_table(spark, sf)).orderBy("PlayerKey").limit(5)
