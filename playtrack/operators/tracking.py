"""Tracking-frame chain: snap trim, last-event trim, season and orientation
repair, play flags and movement classes (SURVEY X6-X8, J12-J16, D8-D15).

Everything the chain asks of a play comes from two small tables, its *marks*
(``play_marks``): the snap frames, and the play's last events.  The last events
are an arg-max with ties, (largest event time, rows per event at it), built by
aggregates that merge: one pass over three columns, no window, no self join.

Shuffle plan (frames are the big table):

* ``strategy="window"`` (plays of normal size): frames meet the marks and the
  play-level attributes in joins on PlayKey, with the time bounds as join
  conditions.  Frames bucketed by PlayKey stay where they are, and no frame
  carries a list: the join buffers one play's marks, and can spill them.
  The abnormal-snap test reads the snaps, so season and orientation are play
  attributes, too, and no per-play window is left.
* ``strategy="salted"`` (hot plays): frames are dealt by a salt of their row, the
  marks are repeated for every salt, so one play is spread over all tasks and
  its copies arise where they are joined, after the shuffle.
* ``strategy="join"``: the literal join form (self join on PlayKey, group by
  + join on (PlayKey, time), join back).  Same rows; kept to test the others.
* ``strategy="auto"`` (default of the public chains): one small job counts
  frames per play (partial aggregate).  Without plays above
  ``spark.playtrack.frames.hotPlayRows`` / ``spark.playtrack.hotKeyRows``
  (default 1,000,000) the first form runs alone.  Otherwise those hot
  plays form a key table of at most ``frames / threshold`` rows -- a proven
  bound, so it is broadcast -- and take the salted form.

Predicate transfer: a condition on play attributes (``movement_frames(where=)``)
is applied to the play list, whose keys then filter the frames at their scan,
before any frame is copied.

Both reproduce the source's duplication (hazard H3): a play with k snap frames
yields k copies of each frame after the snap join, and the last-event join
multiplies again by the number of rows at the last event time.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import MAIN_POSITIONS, RUSH_PASS
from . import skew as SK

SNAP = "ball_snap"
PLAY_ATTRS = ["PlayerKey", "RosterPosition", "PositionGroup", "FieldType", "PlayType"]
HOT_ROWS_CONF = "spark.playtrack.frames.hotPlayRows"   # falls back to spark.playtrack.hotKeyRows


def _play(key: str = "PlayKey") -> Window:
    return Window.partitionBy(key)


# -- hot-play split -------------------------------------------------------
def hot_play_keys(tracks: DataFrame, hot_rows: int) -> DataFrame:
    """Plays with more than ``hot_rows`` frames (at most rows / hot_rows keys)."""
    return SK.hot_keys(tracks, "PlayKey", hot_rows)


def by_play_size(tracks: DataFrame, chain, strategy: str = "auto", hot_rows: int | None = None,
                 hot_strategy: str = "join") -> DataFrame:
    """Run ``chain(frames, strategy)``; with ``strategy="auto"`` normal plays
    take the window form and hot plays ``hot_strategy`` (see module doc)."""
    if strategy != "auto":
        return chain(tracks, strategy)
    if hot_rows is None:
        hot_rows = int(tracks.sparkSession.conf.get(HOT_ROWS_CONF, str(SK.hot_rows_of(tracks))))
    return SK.split_by_key_size(
        tracks, "PlayKey", lambda f: chain(f, "window"),
        # the hot plays' frames are spread by a row hash, so no task holds a whole play
        lambda f: chain(f.repartition(F.xxhash64("PlayKey", "time")), hot_strategy), hot_rows)


# -- marks: what the chain asks of a play -----------------------------------
class PlayMarks(NamedTuple):
    """``snaps`` (PlayKey, snap_time, snap_x, snap_y, snap_o) and ``ends`` (PlayKey, last_time, last_event, n_rows)."""

    snaps: DataFrame
    ends: DataFrame


def play_marks(tracks: DataFrame) -> PlayMarks:
    """The snap frames of every play, and its last events.

    ``ends`` has a row per distinct event (null: frames without one) at the
    play's last event time, with the number of frames that have it.  Frames are
    counted per (play, time, event), then per time, then the largest time that
    has an event wins with its counts: each step is a partial aggregate, and
    what it holds per time is bounded by the distinct events.
    """
    snaps = tracks.where(F.col("event") == SNAP).select(
        "PlayKey", F.col("time").alias("snap_time"), F.col("x").alias("snap_x"), F.col("y").alias("snap_y"),
        F.col("o").alias("snap_o"))
    counted = (tracks.select("PlayKey", "time", "event").where(F.col("time").isNotNull())
               .groupBy("PlayKey", "time", "event").agg(F.count(F.lit(1)).alias("n")))
    at_time = counted.groupBy("PlayKey", "time").agg(
        F.collect_list(F.struct("event", "n")).alias("rows"), F.count("event").alias("events")).where("events > 0")
    last = at_time.groupBy("PlayKey").agg(F.max("time").alias("last_time"), F.max_by("rows", "time").alias("rows"))
    ends = last.select("PlayKey", "last_time", F.explode("rows").alias("r")).select(
        "PlayKey", "last_time", F.col("r.event").alias("last_event"), F.col("r.n").alias("n_rows"))
    return PlayMarks(snaps, ends)


def first_snaps(snaps: DataFrame) -> DataFrame:
    return snaps.groupBy("PlayKey").agg(F.min("snap_time").alias("snap_time"))


def last_events(marks: PlayMarks, before: float = 0.1) -> DataFrame:
    """``PlayKey, last_time, last_event``: the rows of a play's last event time, once for
    every snap that they are not ``before`` ahead of (A15 + J13 on the snap pairs)."""
    met = marks.ends.join(marks.snaps.select("PlayKey", "snap_time"), "PlayKey").where(
        F.col("last_time") >= F.col("snap_time") - before)
    return met.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows"))).select(
        "PlayKey", "last_time", "last_event")


SALTS_CONF = "spark.playtrack.frames.salts"


def _meet(frames: DataFrame, facts: DataFrame, condition, how: str, salted: bool) -> DataFrame:
    """``frames`` joined to play facts on PlayKey and ``condition(frames, facts)``; salted: a play is dealt over all tasks."""
    facts = facts.withColumnRenamed("PlayKey", "_play")
    on = F.col("PlayKey") == F.col("_play")
    if salted:
        conf = frames.sparkSession.conf
        n = int(conf.get(SALTS_CONF, conf.get("spark.sql.shuffle.partitions")))
        frames = frames.withColumn("_salt", F.pmod(F.xxhash64(*frames.columns), F.lit(n)))
        facts = facts.withColumn("_salt_of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
        on &= F.col("_salt") == F.col("_salt_of")
    if condition is not None:
        on &= condition
    return frames.join(facts, on, how).drop("_play", "_salt", "_salt_of")


# -- J12: snap frames ------------------------------------------------------
def snap_frames(tracks: DataFrame) -> DataFrame:
    """Ball-snap frames of each play with renamed time/x/y."""
    return (tracks.where(F.col("event") == SNAP)
            .withColumnsRenamed({"x": "snap_x", "y": "snap_y", "time": "snap_time"})
            .drop("dir", "dis", "o", "event", "s"))


def frames_with_snap(tracks: DataFrame, strategy: str = "auto", hot_rows: int | None = None,
                     marks: PlayMarks | None = None) -> DataFrame:
    """Every frame paired with every snap frame of its play (left join: a play
    without a snap keeps its frames with null snap columns)."""
    if strategy == "join":
        return tracks.join(snap_frames(tracks), ["PlayKey"], "left_outer")
    marks = marks or play_marks(tracks)
    if strategy == "auto":
        return by_play_size(tracks, lambda f, s: frames_with_snap(f, s, marks=marks), "auto", hot_rows, "salted")
    # the fan-out of a play streams from its two sorted sides; co-bucketed ones are merged in place
    snaps = marks.snaps.select("PlayKey", "snap_x", "snap_y", "snap_time").hint("merge")
    return _meet(tracks, snaps, None, "left_outer", strategy == "salted")


def frames_with_snap_one(tracks: DataFrame) -> DataFrame:
    """One-snap variant: the first snap time of the play, no frame copies."""
    first = F.min(F.when(F.col("event") == SNAP, F.col("time"))).over(_play())
    return tracks.withColumn("snap_time", first)


# -- X6: trimming ---------------------------------------------------------
def _trimmed_by_marks(frames: DataFrame, marks: PlayMarks, before: float, after: float, one_snap: bool,
                      salted: bool) -> DataFrame:
    """Frames met with the snaps that they are late enough for, then with the last events that they are early enough for."""
    snaps = first_snaps(marks.snaps) if one_snap else marks.snaps.select("PlayKey", "snap_x", "snap_y", "snap_time")
    a = _meet(frames, snaps, F.col("time") >= F.col("snap_time") - before, "inner", salted)
    ends = last_events(PlayMarks(snaps, marks.ends), before)
    return _meet(a, ends, F.col("time") <= F.col("last_time") + after, "inner", salted)


def last_event(frames: DataFrame) -> DataFrame:
    """Latest event frame(s) of each play: ``PlayKey, last_time, last_event``
    (aggregate + join on (PlayKey, time), A15 + J13)."""
    agg = frames.where(F.col("event").isNotNull()).groupBy("PlayKey").agg(F.max("time").alias("time"))
    return (agg.join(frames, ["PlayKey", "time"], "inner")
            .select("PlayKey", F.col("time").alias("last_time"), F.col("event").alias("last_event")))


def frames_trimmed(tracks: DataFrame, before: float = 0.1, after: float = 0.1, strategy: str = "auto",
                   one_snap: bool = False, hot_rows: int | None = None, marks: PlayMarks | None = None) -> DataFrame:
    """Frames from ``before`` ahead of the snap to ``after`` past the last event.

    ``marks``: those of all plays in ``tracks`` (or of more), if they are at hand."""
    if strategy != "join":
        marks = marks or play_marks(tracks)
    if strategy == "auto":
        return by_play_size(tracks, lambda f, s: frames_trimmed(f, before, after, s, one_snap, marks=marks), "auto",
                            hot_rows, "salted")
    if strategy != "join":
        return _trimmed_by_marks(tracks, marks, before, after, one_snap, strategy == "salted")
    if one_snap:
        first = (tracks.where(F.col("event") == SNAP).groupBy("PlayKey")
                 .agg(F.min("time").alias("snap_time")))
        a = tracks.join(first, ["PlayKey"], "left_outer")
    else:
        a = frames_with_snap(tracks, "join")
    a = a.where(F.col("time") >= F.col("snap_time") - before)
    return a.join(last_event(a), ["PlayKey"], "left_outer").where(F.col("time") <= F.col("last_time") + after)


# -- X7: season and orientation -------------------------------------------
def game_days(plays: DataFrame) -> DataFrame:
    """``PlayerKey, GameID, max_day, min_day, unknown_day``: the days of a player's plays in a game.

    A row per player and game from one scan (partial aggregate).  The states
    merge (largest, least, any), so days of new plays can be added to it."""
    return plays.groupBy("PlayerKey", "GameID").agg(
        F.max("PlayerDay").alias("max_day"), F.min("PlayerDay").alias("min_day"), F.max(F.col("PlayerDay").isNull()).alias("unknown_day"))


def season_games(games: DataFrame, day: int = 350, only: DataFrame | None = None) -> DataFrame:
    """``PlayerKey, GameID, seasons`` of the games of players who reach ``day``, from ``game_days``.

    With ``only`` (a table with a GameID column): of those games, though all games tell who reaches ``day``.

    ``seasons`` has two entries only where the plays of one game lie on both
    sides of the day, as the source's distinct games have; a play without a day is of season 2.
    """
    reached = (games.groupBy("PlayerKey").agg(F.max("max_day").alias("_max_day"))
               .where(F.col("_max_day") >= day).select("PlayerKey"))
    asked = games if only is None else games.join(only.select("GameID"), "GameID", "left_semi")
    tough = asked.join(reached, "PlayerKey", "left_semi")
    first, second = F.max(F.col("min_day") < day), F.max((F.col("max_day") >= day) | F.col("unknown_day"))
    seasons = tough.groupBy("GameID").agg(first.alias("_first"), second.alias("_second")).select(
        "GameID", F.filter(F.array(F.when(F.col("_first"), 1), F.when(F.col("_second"), 2)), lambda x: x.isNotNull()).alias("seasons"))
    return tough.select("PlayerKey", "GameID").join(seasons, "GameID").select("PlayerKey", "GameID", "seasons")


def tough_players(plays: DataFrame, day: int = 350) -> DataFrame:
    """Players who reach ``day`` (partial aggregation; no key list on the driver)."""
    return (plays.groupBy("PlayerKey").agg(F.max("PlayerDay").alias("_max_day"))
            .where(F.col("_max_day") >= day).select("PlayerKey"))


def season_plays(plays: DataFrame, day: int = 350) -> DataFrame:
    """Plays of players seen in season 2 (a semi join), with their season."""
    return (plays.join(tough_players(plays, day), "PlayerKey", "left_semi")
            .withColumn("season", C.season("PlayerDay", day)))


def plays_in(plays: DataFrame, keys: DataFrame | None) -> DataFrame:
    """The plays whose key is in ``keys`` (bucketed alike, nothing moves); all without ``keys``."""
    return plays if keys is None else plays.join(keys.select("PlayKey"), "PlayKey", "left_semi")


def play_season(plays: DataFrame, day: int = 350, games: DataFrame | None = None, keys: DataFrame | None = None) -> DataFrame:
    """PlayKey -> (GameID, season) for the tough players' plays, through the
    (GameID, season) games as the source does.  ``games``: ``game_days`` of the plays, if at hand;
    ``keys``: the plays that are asked for, if not all."""
    games = games or game_days(plays)
    plays = plays_in(plays, keys)
    found = season_games(games, day, None if keys is None else plays)
    met = plays.select("PlayerKey", "PlayKey", "GameID").join(found, ["PlayerKey", "GameID"])
    return met.select("PlayKey", "GameID", F.explode("seasons").alias("season"))


def frames_with_season(frames: DataFrame, plays: DataFrame, day: int = 350, games: DataFrame | None = None,
                       keys: DataFrame | None = None) -> DataFrame:
    """Frames left-joined to the tough players' plays, then to their games.

    ``keys``: a table that names every play of ``frames`` (trimmed frames: the plays' ends); others are not looked up."""
    return frames.join(play_season(plays, day, games, keys), ["PlayKey"], "left_outer")


def abnormal_snap(o="o") -> F.Column:
    c = F.col(o) if isinstance(o, str) else o
    return (c < 50) | (c > 325) | ((c < 225) & (c > 125))


def abnormal_snap_plays(frames_season: DataFrame) -> DataFrame:
    """Plays without a season whose snap orientation is off (union of three
    ranges, deduplicated, U2)."""
    return (frames_season.where((F.col("event") == SNAP) & F.col("season").isNull() & abnormal_snap())
            .select("PlayKey").distinct())


def impute_season(frames_season: DataFrame, strategy: str = "window") -> DataFrame:
    """Null season -> 1 for abnormal-snap plays, else 2."""
    if strategy == "join":
        ab = abnormal_snap_plays(frames_season).withColumn("_ab", F.lit(True))
        df = frames_season.join(ab, ["PlayKey"], "left_outer")
        flag = F.col("_ab").isNotNull()
    else:
        hit = F.max(F.when((F.col("event") == SNAP) & F.col("season").isNull() & abnormal_snap(), 1)
                    .otherwise(0)).over(_play())
        df = frames_season.withColumn("_ab", hit)
        flag = F.col("_ab") == 1
    return (df.withColumn("season", F.coalesce(F.col("season"), F.when(flag, 1).otherwise(2)))
            .drop("_ab"))


def fix_orientation(df: DataFrame, turn: float = 90) -> DataFrame:
    """Season-1 orientation turned by ``turn`` degrees."""
    return df.withColumn("o", F.when(F.col("season") == 1, (F.col("o") + turn) % 360).otherwise(F.col("o")))


def imputed_season(season: Column, abnormal: Column) -> Column:
    """Null season -> 1 for abnormal-snap plays, else 2."""
    return F.coalesce(season, F.when(abnormal, 1).otherwise(2))


def abnormal_plays(snaps: DataFrame) -> DataFrame:
    """``PlayKey, _ab`` of the plays with an abnormal snap.  Snaps are never trimmed off by margins of zero or more."""
    return (snaps.where(F.col("snap_time").isNotNull() & abnormal_snap("snap_o")).select("PlayKey").distinct()
            .withColumn("_ab", F.lit(True)))


def season_imputed(tracks: DataFrame, plays: DataFrame, strategy: str = "auto",
                   hot_rows: int | None = None, marks: PlayMarks | None = None, games: DataFrame | None = None) -> DataFrame:
    """X6 + season join + J11 on the trimmed frames."""
    if strategy == "join":
        return impute_season(frames_with_season(frames_trimmed(tracks, strategy="join"), plays), "join")
    marks = marks or play_marks(tracks)
    trimmed = frames_trimmed(tracks, strategy=strategy, hot_rows=hot_rows, marks=marks)
    met = frames_with_season(trimmed, plays, games=games, keys=marks.ends).join(abnormal_plays(marks.snaps), ["PlayKey"], "left_outer")
    return met.withColumn("season", imputed_season(F.col("season"), F.col("_ab").isNotNull())).drop("_ab")


def orientation_fixed(tracks: DataFrame, plays: DataFrame, strategy: str = "auto",
                      hot_rows: int | None = None, marks: PlayMarks | None = None, games: DataFrame | None = None) -> DataFrame:
    """X6 + X7: trimmed frames with season and repaired orientation."""
    return fix_orientation(season_imputed(tracks, plays, strategy, hot_rows, marks, games))


# -- X8: flags, movement ---------------------------------------------------
def injured_play_keys(injuries: DataFrame) -> DataFrame:
    return injuries.select("PlayKey").where(F.col("PlayKey").isNotNull()).distinct()


def mark_injury_plays(df: DataFrame, injuries: DataFrame, out: str = "is_injury_play") -> DataFrame:
    """Mark join: True when the PlayKey is among the injured plays."""
    keys = injured_play_keys(injuries).withColumn("_hit", F.lit(True))
    return (df.join(keys, ["PlayKey"], "left_outer")
            .withColumn(out, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))


def play_attributes(plays: DataFrame, injuries: DataFrame, day: int = 350, games: DataFrame | None = None,
                    keys: DataFrame | None = None) -> DataFrame:
    """Everything the movement study needs per play, built on the play list:
    season of the tough players' games (null otherwise), the attributes of
    the enrichment join, the injury mark and the position/play-type flags.
    ``keys``: the plays that are asked for, if not all."""
    games = games or game_days(plays)
    plays = plays_in(plays, keys)
    seasons = season_games(games, day).withColumnsRenamed({"PlayerKey": "_player", "GameID": "_game"})
    base = plays.select("PlayKey", "GameID", *PLAY_ATTRS)
    with_season = (base.join(seasons, (F.col("PlayerKey") == F.col("_player")) & (F.col("GameID") == F.col("_game")), "left_outer")
                   .select("PlayKey", *PLAY_ATTRS, F.explode_outer("seasons").alias("season")))
    marked = mark_injury_plays(with_season, injuries)
    return (marked.withColumn("is_main_pos", C.in_list_flag("RosterPosition", MAIN_POSITIONS))
            .withColumn("is_rush_pass", C.in_list_flag("PlayType", RUSH_PASS)))


def movement_frames(tracks: DataFrame, plays: DataFrame, injuries: DataFrame, within: float = 25,
                    threshold: float = 45, day: int = 350, strategy: str = "auto",
                    hot_rows: int | None = None, marks: PlayMarks | None = None, where: Column | None = None,
                    games: DataFrame | None = None) -> DataFrame:
    """X8 up to the movement class: trimmed frames with season, repaired
    orientation, play attributes and flags, kept within ``within`` of the
    snap, with the circular angle gap and the movement class.

    Season, abnormal-snap test and flags are facts of the play, so frames meet
    them in one inner join on PlayKey at their scan (frames of plays absent
    from the play list drop out, as the source's inner join does), and plays
    that ``where`` (a condition on play attributes) excludes lose their frames
    there, before any is copied.
    """
    marks = marks or play_marks(tracks)
    # a trimmed frame's play has an end: other plays are not looked up
    attrs = play_attributes(plays, injuries, day, games, marks.ends).join(abnormal_plays(marks.snaps), ["PlayKey"], "left_outer")
    attrs = attrs.withColumn("season", imputed_season(F.col("season"), F.col("_ab").isNotNull())).drop("_ab")
    if where is not None:
        attrs = attrs.where(where)

    def chain(f, s):
        met = f.join(attrs, ["PlayKey"], "inner")
        if s == "join":
            return frames_trimmed(f, strategy="join").join(attrs, ["PlayKey"], "inner")
        return frames_trimmed(met, strategy=s, marks=marks)
    fixed = fix_orientation(by_play_size(tracks, chain, strategy, hot_rows, "salted"))
    within_snap = (fixed.withColumn("time_since_snap", F.col("time") - F.col("snap_time"))
                   .where(F.col("time_since_snap") <= within))
    return (within_snap.withColumn("o_dir_diff", C.angle_gap("o", "dir"))
            .withColumn("movement", C.movement_class("o_dir_diff", threshold))
            .withColumn("is_abnormal_movement", F.when(F.col("movement") == "normal", False).otherwise(True)))


def enrich_frames(frames: DataFrame, plays: DataFrame) -> DataFrame:
    """Inner join of frames with selected play columns."""
    return frames.join(plays.select("PlayKey", *PLAY_ATTRS), ["PlayKey"], "inner")
