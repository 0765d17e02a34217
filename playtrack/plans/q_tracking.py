"""Tracking-frame queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import INJURY_PRONE_POSITIONS, in_list_sql
from ..operators import reports as R
from ..operators import tracking as TR
from ..sources import staging as S
from .q_features import round_doubles
from .q_plays import hist_df, hist_sql
from .registry import query
from .sql_blocks import MOVEMENT, SEASON, TRIM

TRACK = ["PlayKey", "time", "event", "x", "y", "dir", "dis", "o", "s"]


def _t(spark, sf):
    return S.tracks(spark, sf)


def _m(spark, sf):
    return S.marks(spark, sf)


def _trimmed(spark, sf, **how):
    return TR.frames_trimmed(_t(spark, sf), marks=_m(spark, sf), **how)


def _with_season(spark, sf):
    return TR.frames_with_season(_trimmed(spark, sf), S.plays(spark, sf), games=S.games(spark, sf), keys=_m(spark, sf).ends)


def _fixed(spark, sf):
    return TR.orientation_fixed(_t(spark, sf), S.plays(spark, sf), marks=_m(spark, sf), games=S.games(spark, sf))


@query("event_frames", sql="select * from tracks where event <> ''")
def event_frames(spark, sf):
    return _t(spark, sf).where(F.col("event") != "")


@query("ball_snap_frames",
       sql="select PlayKey, time as snap_time, x as snap_x, y as snap_y from tracks where event = 'ball_snap'")
def ball_snap_frames(spark, sf):
    return TR.snap_frames(_t(spark, sf))


@query("frames_with_snap", sql="select * from withsnap", ctes=TRIM)
def frames_with_snap(spark, sf):
    return TR.frames_with_snap(_t(spark, sf), marks=_m(spark, sf))


@query("last_event", sql="select * from lastev", ctes=TRIM)
def last_event(spark, sf):
    return TR.last_events(_m(spark, sf))


@query("frames_trimmed", sql="select * from trimmed", ctes=TRIM)
def frames_trimmed(spark, sf):
    return _trimmed(spark, sf)


@query("frames_trimmed_one_snap",
       sql="""select a1.*, l.last_time, l.last_event from a1 join
 (select b.PlayKey, b.last_time, a1.event as last_event
  from (select PlayKey, max(time) as last_time from a1 where event is not null group by PlayKey) b
  join a1 on a1.PlayKey=b.PlayKey and a1.time=b.last_time) l on a1.PlayKey=l.PlayKey where a1.time<=l.last_time+0.1""",
       ctes="""a1 AS (select * from (select t.*, min(case when event='ball_snap' then time end)
 over (partition by PlayKey) as snap_time from tracks t) z where time>=snap_time-0.1)""")
def frames_trimmed_one_snap(spark, sf):
    return _trimmed(spark, sf, one_snap=True)


@query("frames_with_season", sql="select * from se", ctes=SEASON)
def frames_with_season(spark, sf):
    return _with_season(spark, sf)


@query("season_null_plays", sql="select PlayKey, time, event, o from se where season is null", ctes=SEASON)
def season_null_plays(spark, sf):
    se = _with_season(spark, sf)
    return se.where(F.col("season").isNull()).select("PlayKey", "time", "event", "o")


@query("abnormal_snap_plays", sql="select * from ab", ctes=SEASON)
def abnormal_snap_plays(spark, sf):
    se = _with_season(spark, sf)
    return TR.abnormal_snap_plays(se)


@query("season_imputed", sql="select * from imputed", ctes=SEASON)
def season_imputed(spark, sf):
    return TR.season_imputed(_t(spark, sf), S.plays(spark, sf), marks=_m(spark, sf), games=S.games(spark, sf))


@query("orientation_fixed", sql="select * from fixed", ctes=SEASON)
def orientation_fixed(spark, sf):
    return _fixed(spark, sf)


@query("frames_enriched", sql="select * from enriched", ctes=SEASON)
def frames_enriched(spark, sf):
    return TR.enrich_frames(_fixed(spark, sf), S.plays(spark, sf))


def movement(spark, sf, where=None):
    return TR.movement_frames(_t(spark, sf), S.plays(spark, sf), S.injuries(spark, sf), marks=_m(spark, sf), where=where,
                              games=S.games(spark, sf))


_WITHIN_COLS = ["PlayKey", "time", "event", "o", "dir", "s", "season", "snap_time", "time_since_snap",
                "is_main_pos", "is_injury_play", "is_rush_pass"]


@query("frames_within_25s", sql="select " + ", ".join(_WITHIN_COLS) + " from within", ctes=MOVEMENT)
def frames_within_25s(spark, sf):
    return movement(spark, sf).select(*_WITHIN_COLS)


@query("angle_gap", sql="select PlayKey, time, o, dir, o_dir_diff from movement", ctes=MOVEMENT)
def angle_gap(spark, sf):
    return movement(spark, sf).select("PlayKey", "time", "o", "dir", "o_dir_diff")


@query("movement_class",
       sql="select PlayKey, time, o_dir_diff, movement, is_abnormal_movement from movement", ctes=MOVEMENT)
def movement_class(spark, sf):
    return movement(spark, sf).select("PlayKey", "time", "o_dir_diff", "movement", "is_abnormal_movement")


@query("movement_by_injury_main",
       sql="""select movement, is_injury_play, count(*) as count from movement
 where is_rush_pass and is_main_pos group by 1, 2""", ctes=MOVEMENT)
def movement_by_injury_main(spark, sf):
    m = movement(spark, sf, F.col("is_rush_pass") & F.col("is_main_pos"))
    return R.count_by(m, "movement", "is_injury_play")


@query("movement_by_injury",
       sql="select movement, is_injury_play, count(*) as count from movement where is_rush_pass group by 1, 2",
       ctes=MOVEMENT)
def movement_by_injury(spark, sf):
    return R.count_by(movement(spark, sf, F.col("is_rush_pass")), "movement", "is_injury_play")


@query("speed_by_injury",
       sql="select is_injury_play, round(avg(s), 6) as avg_speed from movement group by 1", ctes=MOVEMENT)
def speed_by_injury(spark, sf):
    return round_doubles(R.mean_by(movement(spark, sf), "is_injury_play", "s", "avg_speed"))


@query("movement_injury_ratio",
       sql="""select is_injury_play, movement, count, round(count*100.0/sum(count) over (partition by is_injury_play), 6)
 as share from (select movement, is_injury_play, count(*) as count from movement where is_rush_pass group by 1, 2) c""",
       ctes=MOVEMENT)
def movement_injury_ratio(spark, sf):
    counts = R.count_by(movement(spark, sf, F.col("is_rush_pass")), "movement", "is_injury_play")
    return round_doubles(R.share_of_total(counts, "count", ["is_injury_play"]))


@query("lateral_share_by_position",
       sql=f"""select RosterPosition,
 round(avg(case when not is_injury_play then cast(is_abnormal_movement as int) end)*100, 6) as non_injury_play_pct,
 round(avg(case when is_injury_play then cast(is_abnormal_movement as int) end)*100, 6) as injury_play_pct
 from movement where RosterPosition in {in_list_sql(INJURY_PRONE_POSITIONS)} and is_rush_pass group by 1""",
       ctes=MOVEMENT)
def lateral_share_by_position(spark, sf):
    m = movement(spark, sf, F.col("RosterPosition").isin(*INJURY_PRONE_POSITIONS) & F.col("is_rush_pass"))
    p = R.percent_true_by(m, "RosterPosition", "is_injury_play", "is_abnormal_movement")
    return round_doubles(p.withColumnsRenamed({"false": "non_injury_play_pct", "true": "injury_play_pct"}))


@query("hist_orientation_raw", sql=hist_sql("trimmed", "o", "event='ball_snap'"), ctes=TRIM)
def hist_orientation_raw(spark, sf):
    snaps = _trimmed(spark, sf).where(F.col("event") == TR.SNAP)
    return hist_df(snaps, "o")


@query("hist_orientation_fixed", sql=hist_sql("enriched", "o", "event='ball_snap'"), ctes=SEASON)
def hist_orientation_fixed(spark, sf):
    fixed = TR.enrich_frames(_fixed(spark, sf), S.plays(spark, sf))
    return hist_df(fixed.where(F.col("event") == TR.SNAP), "o")
