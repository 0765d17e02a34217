"""The staging views as DuckDB SQL (the oracle's side of ``sources.staging``).

Every oracle query is ``WITH plays AS (..), injuries AS (..), tracks AS (..)``
followed by its own CTEs and SELECT.
"""

from __future__ import annotations

_DAYS = "date_diff('day', timestamp '1995-01-01', o_orderdate)"
_EPOCH = "epoch(e.ts)"

PLAYS_SQL = f"""
select cast(g.o_custkey as varchar) as PlayerKey,
 concat(cast(g.o_custkey as varchar),'-',cast(g.o_orderkey as varchar)) as GameID,
 concat(cast(g.o_custkey as varchar),'-',cast(g.o_orderkey as varchar),'-',cast(l.rn as varchar)) as PlayKey,
 case g.c_mktsegment when 'MACHINERY' then 'Linebacker' when 'BUILDING' then 'Safety' when 'AUTOMOBILE' then 'Wide Receiver'
  when 'FURNITURE' then 'Cornerback' else 'Offensive Lineman' end as RosterPosition,
 g.PlayerDay, g.PlayerGame,
 case g.o_orderpriority when '1-URGENT' then 'Outdoor' when '2-HIGH' then 'Indoors' when '3-MEDIUM' then 'Domed, closed'
  when '5-LOW' then case when g.o_orderkey%3=0 then 'Domed, Open' when g.o_orderkey%3=1 then 'Retr. Roof-Open' else 'Ourdoor' end end as StadiumType,
 case when g.o_orderstatus='F' then 'Natural' else 'Synthetic' end as FieldType,
 cast(case when g.o_orderkey%10=0 then -999 else 30+g.o_orderkey%60 end as double) as Temperature,
 case g.o_orderkey%8 when 0 then 'Sunny' when 1 then 'Cloudy' when 2 then 'Light Rain' when 3 then 'Snow' when 4 then 'Indoor'
  when 5 then 'Clear' when 6 then 'Mostly Coudy' end as Weather,
 case concat(l.l_returnflag,l.l_linestatus) when 'AF' then 'Pass' when 'AO' then 'Rush' when 'NF' then 'Punt' when 'NO' then 'Kickoff' when 'RF' then '0' end as PlayType,
 l.rn as PlayerGamePlay, p.p_type as Position, p.p_brand as PositionGroup,
 l.l_quantity as src_quantity, l.l_returnflag as src_flag, g.o_orderkey as src_order
from (select o.*, c.c_mktsegment,
   cast(row_number() over (partition by o_custkey order by o_orderdate,o_orderkey) as int) as PlayerGame,
   cast(floor({_DAYS}/6) as int) as PlayerDay
  from orders o join customer c on o.o_custkey=c.c_custkey) g
join (select *, cast(row_number() over (partition by l_orderkey
   order by l_linenumber,l_partkey,l_suppkey,l_shipdate,l_quantity,l_extendedprice) as int) as rn from lineitem) l on g.o_orderkey=l.l_orderkey
join part p on l.l_partkey=p.p_partkey
"""

INJURIES_SQL = """
select PlayerKey, GameID, case when src_order%4=0 then null else PlayKey end as PlayKey,
 case src_order%5 when 0 then 'Knee' when 1 then 'Ankle' when 2 then 'Foot' when 3 then 'Toes' else 'Heel' end as BodyPart,
 FieldType as Surface, 1 as DM_M1,
 case when src_quantity>=20 then 1 else 0 end as DM_M7,
 case when src_quantity>=35 then 1 else 0 end as DM_M28,
 case when src_quantity>=45 then 1 else 0 end as DM_M42
from plays where (src_flag='R' and src_quantity>=44) or (src_flag='A' and PlayerGamePlay=1 and src_quantity%4=0)
"""

TRACKS_SQL = f"""
select p.PlayKey, cast(({_EPOCH}-min({_EPOCH}) over (partition by p.PlayKey))/3600.0 as double) as time,
 case e.event_type when 'click' then 'ball_snap' when 'signup' then 'pass' when 'purchase' then 'tackle' end as event,
 e.value%120 as x, cast(e.event_id%53 as double) as y, cast((e.event_id*37)%360 as double) as dir,
 e.value/1000 as dis, cast((e.event_id*53)%360 as double) as o, e.value/100 as s
from events e join plays p on p.PlayerKey=cast(e.user_id as varchar)
 and p.PlayerGame=1+cast(floor((day(e.ts)-1)/7) as int) and p.PlayerGamePlay=1
"""

STAGING_CTES = f"plays AS ({PLAYS_SQL}),\ninjuries AS ({INJURIES_SQL}),\ntracks AS ({TRACKS_SQL})"


def with_staging(select_sql: str, ctes: str = "") -> str:
    """Prefix the staging views (and optional extra CTEs) to a SELECT."""
    extra = f",\n{ctes}" if ctes else ""
    return f"WITH {STAGING_CTES}{extra}\n{select_sql}"
