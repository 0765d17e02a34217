"""Reusable oracle CTE chains (DuckDB SQL) for the feature and tracking queries.

Each constant is a comma-separated list of CTEs to pass as ``ctes=`` to
``registry.query``; later chains include the earlier ones they need.
"""

from __future__ import annotations

from ..functions.rules import (FIELD_PIVOT, MAIN_POSITIONS, RUSH_PASS, STADIUM_FIVE_WAY, STADIUM_PIVOT,
                               WEATHER_FIVE_WAY, WEATHER_PIVOT, categorize_sql, in_list_sql)

SEV = "(DM_M1+DM_M7+DM_M28+DM_M42)"

# -- X2: cleaned plays, game list, rest days, distinct counts --------------------
CPLAYS = f"""select PlayerKey, GameID, PlayKey, RosterPosition, PlayerDay, PlayerGame,
 {categorize_sql("coalesce(StadiumType,'Missing')", STADIUM_FIVE_WAY)} as StadiumType,
 coalesce(FieldType,'Missing') as FieldType,
 case when Temperature<0 then 61 else Temperature end as Temperature,
 {categorize_sql("coalesce(Weather,'Missing')", WEATHER_FIVE_WAY)} as Weather,
 case when coalesce(PlayType,'Missing')='0' then 'Missing' else coalesce(PlayType,'Missing') end as PlayType,
 PlayerGamePlay, coalesce(Position,'Missing') as Position, coalesce(PositionGroup,'Missing') as PositionGroup
 from plays"""

GAMES = f"""cplays AS ({CPLAYS}),
games AS (select distinct PlayerKey as GamePlayerID, GameID, PlayerDay, PlayerGame, RosterPosition, StadiumType,
 FieldType, Temperature, Weather from cplays),
rest AS (select *, PlayerDay - lag(PlayerDay, 1, 1) over (partition by GamePlayerID order by GamePlayerID, PlayerGame)
 as Rest_days from games),
counts AS (select PlayerKey, GameID, PlayerGame, count(distinct RosterPosition) as NumRosterPosition,
 count(distinct PlayType) as NumPlayTypePerGame, count(distinct Position) as NumPositionPerGame,
 count(distinct PlayerGamePlay) as MaxPlayGamePlay from cplays group by PlayerKey, GameID, PlayerGame),
gamefeat AS (select c.GameID, c.PlayerKey, c.PlayerGame, c.NumRosterPosition, c.NumPlayTypePerGame,
 c.NumPositionPerGame, c.MaxPlayGamePlay, r.PlayerDay, r.RosterPosition, r.StadiumType, r.FieldType, r.Temperature,
 r.Weather, r.Rest_days from counts c join rest r on c.GameID=r.GameID),
gamelabel AS (select g.*, i.Severity, case when i.Severity>0 then 1 else 0 end as IsInjury from gamefeat g
 left join (select PlayerKey as InjPlayerKey, GameID as InjGameID, {SEV} as Severity from injuries) i
 on g.PlayerKey=i.InjPlayerKey and g.GameID=i.InjGameID)"""

# -- X3: kinematics and per-game tracking averages --------------------------------
KIN = """ev AS (select *, x - lag(x) over w as x_distance, abs(o-dir) as o_minus_dir, y - lag(y) over w as y_distance,
 time - lag(time) over w as time_period from tracks where event <> '' window w as (partition by PlayKey order by time)),
kin AS (select *, x_distance/nullif(time,0) as x_velocity, y_distance/nullif(time,0) as y_velocity,
 sqrt(pow(x_distance/nullif(time,0),2) + pow(y_distance/nullif(time,0),2)) as velocity from ev),
kinstep AS (select *, x_distance/nullif(time_period,0) as x_velocity, y_distance/nullif(time_period,0) as y_velocity,
 sqrt(pow(x_distance/nullif(time_period,0),2) + pow(y_distance/nullif(time_period,0),2)) as velocity from ev),
trackfeat AS (select split_part(PlayKey,'-',1)||'-'||split_part(PlayKey,'-',2) as TrackGameID,
 avg(o_minus_dir) as avg_o_mins_dir, avg(x_velocity) as avg_x_velocity, avg(y_velocity) as avg_y_velocity,
 avg(velocity) as avg_velocity from kin group by 1)"""

# -- X4 / X5 ------------------------------------------------------------------
PGF_COLS = ["PlayerKey", "GameID", "NumRosterPosition", "NumPlayTypePerGame", "NumPositionPerGame",
            "MaxPlayGamePlay", "RosterPosition", "StadiumType", "FieldType", "Temperature", "Weather", "Rest_days",
            "avg_o_mins_dir", "avg_x_velocity", "avg_y_velocity", "avg_velocity", "IsInjury"]
PLAYER_AVG = ["NumRosterPosition", "NumPlayTypePerGame", "NumPositionPerGame", "MaxPlayGamePlay", "Rest_days",
              "avg_o_mins_dir", "avg_x_velocity", "avg_y_velocity", "avg_velocity", "Temperature"]


def _avg_name(c: str) -> str:
    return c if c.startswith("avg_") else f"avg_{c}"


def qi(name: str) -> str:
    """Quoted identifier (pivot names such as Natural are SQL keywords)."""
    return f'"{name}"'


def _pivot(col, values):
    return [f"cast(sum(case when {col}='{v}' then 1 end) as bigint) as {qi(v)}" for v in values]


PGF = GAMES + ",\n" + KIN + ",\npgf AS (select " + ", ".join(f"l.{c}" if c not in (
    "avg_o_mins_dir", "avg_x_velocity", "avg_y_velocity", "avg_velocity") else f"t.{c}" for c in PGF_COLS) + \
    " from gamelabel l left join trackfeat t on l.GameID=t.TrackGameID)"

PLAYER = PGF + ",\nplayer AS (select PlayerKey, " + ", ".join(
    [f"avg({c}) as {_avg_name(c)}" for c in PLAYER_AVG] + ["cast(sum(IsInjury) as bigint) as sum_Injury"]
    + _pivot("Weather", WEATHER_PIVOT) + _pivot("StadiumType", STADIUM_PIVOT) + _pivot("FieldType", FIELD_PIVOT)) + \
    " from pgf group by PlayerKey)"
PLAYER_DOUBLES = [_avg_name(c) for c in PLAYER_AVG]
PLAYER_COUNTS = ["sum_Injury"] + WEATHER_PIVOT + STADIUM_PIVOT + FIELD_PIVOT

# -- X6-X8: the tracking chain (join form, following the source's steps) ----------
TRIM = """snaps AS (select PlayKey, time as snap_time, x as snap_x, y as snap_y from tracks where event='ball_snap'),
withsnap AS (select t.*, s.snap_x, s.snap_y, s.snap_time from tracks t left join snaps s on t.PlayKey=s.PlayKey),
a AS (select * from withsnap where time>=snap_time-0.1),
lastev AS (select b.PlayKey, b.last_time, a.event as last_event
   from (select PlayKey, max(time) as last_time from a where event is not null group by PlayKey) b
   join a on a.PlayKey=b.PlayKey and a.time=b.last_time),
trimmed AS (select a.*, l.last_time, l.last_event from a join lastev l on a.PlayKey=l.PlayKey
   where a.time<=l.last_time+0.1)"""

SEASON = TRIM + """,
tough AS (select PlayKey, GameID, PlayerDay, PlayerKey, case when PlayerDay<350 then 1 else 2 end as season from plays
   where PlayerKey in (select PlayerKey from plays where PlayerDay>=350)),
se AS (select trimmed.*, p.GameID, g.season from trimmed
   left join (select PlayKey, GameID from tough) p on trimmed.PlayKey=p.PlayKey
   left join (select distinct GameID, season from tough) g on g.GameID=p.GameID),
ab AS (select distinct PlayKey from se where event='ball_snap' and season is null and (o<50 or o>325 or (o<225 and o>125))),
imputed AS (select se.* replace (coalesce(se.season, case when ab.PlayKey is not null then 1 else 2 end) as season)
   from se left join ab on se.PlayKey=ab.PlayKey),
fixed AS (select * replace (case when season=1 then (o+90)%360 else o end as o) from imputed),
enriched AS (select fixed.*, p.PlayerKey, p.RosterPosition, p.PositionGroup, p.FieldType, p.PlayType
   from fixed join plays p on fixed.PlayKey=p.PlayKey)"""

MOVEMENT = SEASON + f""",
flagged AS (select *, coalesce(RosterPosition in {in_list_sql(MAIN_POSITIONS)}, false) as is_main_pos,
   exists(select 1 from injuries i where i.PlayKey=enriched.PlayKey) as is_injury_play,
   coalesce(PlayType in {in_list_sql(RUSH_PASS)}, false) as is_rush_pass,
   time - snap_time as time_since_snap from enriched),
within AS (select * from flagged where time_since_snap<=25),
mv AS (select *, least(abs(o-dir), abs(o-(dir-360)), abs(o-(dir+360))) as o_dir_diff from within),
movement AS (select *, case when o_dir_diff>=45 then 'abnormal' else 'normal' end as movement,
   case when (case when o_dir_diff>=45 then 'abnormal' else 'normal' end)='normal' then false else true end
   as is_abnormal_movement from mv)"""
