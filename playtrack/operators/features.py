"""Game and player feature tables.

Shuffle plan: what game tables ask of the play list is kept in two small
tables that merge (``GameFacts``), stored bucketed by game; tracking frames
are windowed by PlayKey and pre-aggregated per game before their one join.
The player table is ONE aggregation: averages, the injury sum and the pivot
counts (fixed value lists) come out of the same shuffle on PlayerKey.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import FIELD_PIVOT, MAIN_POSITIONS, STADIUM_FIVE_WAY, STADIUM_PIVOT, WEATHER_FIVE_WAY, WEATHER_PIVOT
from . import skew as SK
from .clean import clean_plays

GAME_FEATURE_COLUMNS = ["PlayerKey", "GameID", "NumRosterPosition", "NumPlayTypePerGame", "NumPositionPerGame",
                        "MaxPlayGamePlay", "RosterPosition", "StadiumType", "FieldType", "Temperature", "Weather",
                        "Rest_days", "avg_o_mins_dir", "avg_x_velocity", "avg_y_velocity", "avg_velocity",
                        "IsInjury"]
PLAYER_AVERAGED = ["NumRosterPosition", "NumPlayTypePerGame", "NumPositionPerGame", "MaxPlayGamePlay", "Rest_days",
                   "avg_o_mins_dir", "avg_x_velocity", "avg_y_velocity", "avg_velocity", "Temperature"]


# -- X1 -------------------------------------------------------------------
def construct_injuries(injuries: DataFrame) -> DataFrame:
    """Keys renamed with an ``Inj`` prefix, plus ``Severity``."""
    return (injuries.withColumnsRenamed({"PlayerKey": "InjPlayerKey", "GameID": "InjGameID",
                                         "PlayKey": "InjPlayKey"})
            .withColumn("Severity", C.severity()))


def with_severity(injuries: DataFrame, threshold: int = 3) -> DataFrame:
    """``Severity`` and ``SevLevel`` (H at or above ``threshold``)."""
    return (injuries.withColumn("Severity", C.severity())
            .withColumn("SevLevel", C.severity_level("Severity", threshold)))


# -- X2 -------------------------------------------------------------------
def game_list(clean: DataFrame) -> DataFrame:
    """Distinct game attributes (one row per distinct combination, see H14)."""
    return clean.select(F.col("PlayerKey").alias("GamePlayerID"), "GameID", "PlayerDay", "PlayerGame",
                        "RosterPosition", "StadiumType", "FieldType", "Temperature", "Weather").distinct()


def rest_days(games: DataFrame, player: str = "GamePlayerID", default_day: int = 1,
              hot_rows: int | None = None, probe: DataFrame | None = None) -> DataFrame:
    """Days since the player's previous game; the first game gives ``PlayerDay - 1``.
    (``lag`` per player; players with very many games are chunked, see ``skew``;
    ``probe``: a table with a ``player`` column counted to find them.)"""
    prev = SK.lag_in_group(games, player, [player, "PlayerGame"], "PlayerDay", "_prev_day", default_day, hot_rows,
                           probe)
    return prev.withColumn("Rest_days", F.col("PlayerDay") - F.col("_prev_day")).drop("_prev_day")


GAME_KEYS = ["PlayerKey", "GameID", "PlayerGame"]
COUNTED = {"RosterPosition": "NumRosterPosition", "PlayType": "NumPlayTypePerGame", "Position": "NumPositionPerGame"}


GAME_ROW = ["PlayerDay", "RosterPosition", "StadiumType", "FieldType", "Temperature", "Weather"]


class GameFacts(NamedTuple):
    """What the game tables ask of the play list, in states that merge (``game_marks``, ``game_list``)."""

    marks: DataFrame
    rows: DataFrame


def game_marks(clean: DataFrame) -> DataFrame:
    """``PlayerKey, GameID, PlayerGame, kind, value, bits``: the distinct values of a player-game.

    A row per category that occurs, and one per 64 play numbers, whose bits
    say which occur.  Bits merge by "or", so one hash aggregate with map-side
    combine builds the table, and marks of other plays can be added to it
    (``merged_facts``).  A null value keeps the game and counts nothing.
    """
    return _one_each(clean.select(*GAME_KEYS, F.explode(F.array(*_marks())).alias("mark")).select(*GAME_KEYS, "mark.*"))


def _marks(*more) -> list:
    """What a play says of its game, as structs of ``more`` and kind, value, bits."""
    play = F.col("PlayerGamePlay").cast("long")
    found = [(F.lit(c), F.col(c), F.lit(0).cast("long")) for c in COUNTED]
    found.append((F.lit("PlayerGamePlay"), F.shiftright(play, 6).cast("string"),
                  F.expr("shiftleft(1L, cast(PlayerGamePlay & 63 as int))")))
    return [F.struct(*more, kind.alias("kind"), value.alias("value"), bits.alias("bits")) for kind, value, bits in found]


def _one_each(marks: DataFrame) -> DataFrame:
    return marks.groupBy(*GAME_KEYS, "kind", "value").agg(F.bit_or("bits").alias("bits"))


def game_facts(plays: DataFrame) -> GameFacts:
    """The facts of a play list."""
    clean = clean_plays(plays)
    return GameFacts(game_marks(clean), game_list(clean))


FACT_COLUMNS = {"game_marks": [*GAME_KEYS, "kind", "value", "bits"],
                "game_rows": ["GamePlayerID", "GameID", "PlayerDay", "PlayerGame", *GAME_ROW[1:]]}


def facts_together(plays: DataFrame, parts: int) -> DataFrame:
    """Both facts in one table, dealt by GameID into ``parts``; ``facts`` names the fact, other columns of the other fact are null.

    Plays are dealt once for both, and summed where they are: a game's marks are
    about as many as its plays, so summing before a shuffle, and dealing the
    sums again, moves more.  Only a game with very many plays is summed first.
    """
    clean = clean_plays(plays)
    hot = SK.measured_rows(clean, "GameID")[1] > SK.hot_rows_of(plays)
    dealt = clean if hot else _spelled(_numbered(clean).repartition(parts, "GameID"))
    row, no_text = F.struct(*GAME_ROW), F.lit(None).cast("string")
    marks = _marks(F.lit("game_marks").alias("facts"), F.when(F.lit(False), row).alias("row"))
    game = F.struct(F.lit("game_rows").alias("facts"), row.alias("row"), no_text.alias("kind"), no_text.alias("value"),
                    F.lit(0).cast("long").alias("bits"))
    each = dealt.select(*GAME_KEYS, F.explode(F.array(*marks, game)).alias("mark")).select(*GAME_KEYS, "mark.*")
    each = each.groupBy(*GAME_KEYS, "facts", "row", "kind", "value").agg(F.bit_or("bits").alias("bits"))
    of_game = F.col("facts") == "game_rows"
    out = each.select(F.when(~of_game, F.col("PlayerKey")).alias("PlayerKey"), F.when(of_game, F.col("PlayerKey")).alias("GamePlayerID"),
                      "GameID", "PlayerGame", "kind", "value", "bits", *[f"row.{c}" for c in GAME_ROW], "facts")
    return out.repartition(parts, "GameID") if hot else out


# Values that the cleaned categories have as a rule: their texts are most of a play's bytes when it is dealt.
USUAL = {"RosterPosition": [*MAIN_POSITIONS, "Offensive Lineman", "Defensive Lineman", "Running Back", "Tight End", "Quarterback", "Kicker"],
         "StadiumType": [*[label for label, _ in STADIUM_FIVE_WAY], "Missing"], "FieldType": [*FIELD_PIVOT, "Missing"],
         "Weather": [*[label for label, _ in WEATHER_FIVE_WAY], "Missing"],
         "PlayType": ["Pass", "Rush", "Punt", "Kickoff", "Extra Point", "Field Goal", "Missing"]}
_USUAL_BITS = 4


def _numbered(clean: DataFrame) -> DataFrame:
    """``clean`` with the ``USUAL`` columns as one number, and their texts where a value is none of the usual (or null)."""
    numbers = {}
    for c, values in USUAL.items():
        numbers[c] = F.lit(len(values))
        for i, v in enumerate(values):
            numbers[c] = F.when(F.col(c) == v, i).otherwise(numbers[c])
    other = {c: n == len(USUAL[c]) for c, n in numbers.items()}
    number = sum(F.shiftleft(n, _USUAL_BITS * i) for i, n in enumerate(numbers.values()))
    texts = F.when(reduce(or_, other.values()), F.struct(*[F.when(other[c], F.col(c)).alias(c) for c in USUAL]))
    return clean.withColumns({"_number": number, "_texts": texts}).drop(*USUAL)


def _spelled(numbered: DataFrame) -> DataFrame:
    """What ``_numbered`` was made of."""
    def text(i, c):
        n = F.shiftright("_number", _USUAL_BITS * i).bitwiseAND(F.lit((1 << _USUAL_BITS) - 1))
        return F.coalesce(F.col("_texts")[c], F.get(F.array(*map(F.lit, USUAL[c])), n))
    return numbered.withColumns({c: text(i, c) for i, c in enumerate(USUAL)}).drop("_number", "_texts")


def merged_facts(known: GameFacts, more: GameFacts) -> GameFacts:
    """Facts of both play lists together; only ``more`` was derived from plays anew."""
    return GameFacts(_one_each(known.marks.unionByName(more.marks)), known.rows.unionByName(more.rows).distinct())


def game_counts(marks: DataFrame) -> DataFrame:
    """Distinct counts per player-game from ``game_marks`` (``MaxPlayGamePlay`` counts distinct plays).

    Marks are distinct already, so these are plain sums: no distinct
    aggregate, no sets, and no shuffle where marks are bucketed by game.
    """
    counts = [F.count(F.when(F.col("kind") == c, F.col("value"))).alias(n) for c, n in COUNTED.items()]
    plays = F.sum(F.when(F.col("kind") == "PlayerGamePlay", F.bit_count("bits")))
    return marks.groupBy(*GAME_KEYS).agg(*counts, F.coalesce(plays, F.lit(0)).cast("bigint").alias("MaxPlayGamePlay"))


def game_features(plays: DataFrame, facts: GameFacts | None = None) -> DataFrame:
    """One row per player-game (per distinct game-attribute combination).

    With stored ``facts`` the play list is not read.
    """
    # hot players are found on the play list (>= games per player) where the game list is not stored
    probe = facts.rows if facts else plays.select(F.col("PlayerKey").alias("GamePlayerID"))
    marks, rows = facts or game_facts(plays)
    return game_counts(marks).join(rest_days(rows, probe=probe).drop("GamePlayerID", "PlayerGame"), "GameID")


def game_injury_label(games: DataFrame, injuries: DataFrame) -> DataFrame:
    """Games left-joined to injuries on player and game; ``IsInjury`` 1/0.

    A game with two injuries appears twice (reference behaviour, hazard H2).
    """
    inj = construct_injuries(injuries).select("InjPlayerKey", "InjGameID", "Severity")
    return (games.join(inj, (games.PlayerKey == inj.InjPlayerKey) & (games.GameID == inj.InjGameID), "left")
            .withColumn("IsInjury", C.positive_flag("Severity"))
            .drop("InjPlayerKey", "InjGameID"))


# -- X3 -------------------------------------------------------------------
def track_kinematics(tracks: DataFrame, mode: str = "reference", strategy: str = "auto",
                     hot_rows: int | None = None) -> DataFrame:
    """Event frames with steps to the previous event frame of the play.

    ``mode="reference"`` divides the step by the absolute ``time`` (as the
    source does); ``"per_step"`` divides by the time step.  Division by zero
    gives null.  ``strategy="auto"``: normal plays use a ``lag`` window on the
    PlayKey partitioning; hot plays (see ``tracking.by_play_size``) use
    ``skew.previous_in_group`` over time-range chunks.
    """
    from .tracking import by_play_size

    if strategy == "auto":
        return by_play_size(tracks, lambda f, s: track_kinematics(f, mode, s), "auto", hot_rows)
    ev = tracks.where(F.col("event") != "")
    if strategy == "join":
        prev = SK.previous_in_group(ev, "PlayKey", ["time"], ["x", "y", "time"]).drop("_has_prev")
    else:
        w = Window.partitionBy("PlayKey").orderBy("time")
        prev = ev.withColumns({f"_prev_{c}": F.lag(c, 1).over(w) for c in ["x", "y", "time"]})
    df = (prev.withColumn("x_distance", F.col("x") - F.col("_prev_x"))
          .withColumn("o_minus_dir", C.angle_gap_plain("o", "dir"))
          .withColumn("y_distance", F.col("y") - F.col("_prev_y"))
          .withColumn("time_period", F.col("time") - F.col("_prev_time"))
          .drop("_prev_x", "_prev_y", "_prev_time"))
    denom = F.col("time") if mode == "reference" else F.col("time_period")
    return (df.withColumn("x_velocity", F.try_divide(F.col("x_distance"), denom))
            .withColumn("y_velocity", F.try_divide(F.col("y_distance"), denom))
            .withColumn("velocity", F.sqrt(F.pow(F.col("x_velocity"), 2) + F.pow(F.col("y_velocity"), 2))))


def track_game_features(tracks: DataFrame, mode: str = "reference") -> DataFrame:
    """Per-game averages of the kinematics (``avg`` skips nulls)."""
    k = track_kinematics(tracks, mode).withColumn("TrackGameID", C.game_id_from_play_key("PlayKey"))
    return (k.groupBy("TrackGameID")
            .agg(F.avg("o_minus_dir").alias("avg_o_mins_dir"),
                 F.avg("x_velocity").alias("avg_x_velocity"),
                 F.avg("y_velocity").alias("avg_y_velocity"),
                 F.avg("velocity").alias("avg_velocity")))


# -- X4 / X5 --------------------------------------------------------------
def player_game_features(plays: DataFrame, injuries: DataFrame, tracks: DataFrame,
                         mode: str = "reference", facts: GameFacts | None = None) -> DataFrame:
    """The 17-column player-game table."""
    games, track = game_features(plays, facts), track_game_features(tracks, mode)
    # the frames' averages come first: games lie by GameID until they are dealt for the injuries
    met = games.join(track, games.GameID == track.TrackGameID, "left")
    return game_injury_label(met, injuries).select(*GAME_FEATURE_COLUMNS)


def pivot_counts(col: str, values) -> list:
    """Pivot-count cells as aggregate expressions: null where the player has no
    row of that value, so they equal ``groupBy().pivot(col, values).count()``."""
    return [F.sum(F.when(F.col(col) == v, 1)).alias(v) for v in values]


def player_features(game_table: DataFrame) -> DataFrame:
    """Per-player averages, injury sum and pivot counts in one aggregation."""
    aggs = [F.avg(c).alias(f"avg_{c}" if not c.startswith("avg_") else c) for c in PLAYER_AVERAGED]
    aggs.append(F.sum("IsInjury").cast("bigint").alias("sum_Injury"))
    aggs += pivot_counts("Weather", WEATHER_PIVOT)
    aggs += pivot_counts("StadiumType", STADIUM_PIVOT)
    aggs += pivot_counts("FieldType", FIELD_PIVOT)
    return game_table.groupBy("PlayerKey").agg(*aggs)


def pivot_table(game_table: DataFrame, col: str, values) -> DataFrame:
    """``groupBy(player).pivot(col, values).count()`` with a fixed value list."""
    return game_table.groupBy("PlayerKey").pivot(col, list(values)).count()


def model_input(player_table: DataFrame, feature_cols, label: str = "IsInjury") -> DataFrame:
    """Player model input: label from ``sum_Injury``, nulls filled with 0."""
    return (player_table.withColumn(label, C.positive_flag("sum_Injury"))
            .select(*feature_cols, label).na.fill(0))
