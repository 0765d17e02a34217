"""Sources and sinks.

The CSV and Parquet round trips write the staged table under the shared
checkpoint folder (``spark.checkpoint.dir``; a fresh sub-folder per call) and
return the table read back.  The oracle is the staged table itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import scratch_path
from ..sources import files as IO
from ..sources import staging as S
from ..sources.tables import table
from .q_features import player_game_table, round_doubles
from .registry import query
from .sql_blocks import PGF, PGF_COLS

_PGF_DOUBLES = ["Temperature", "avg_o_mins_dir", "avg_x_velocity", "avg_y_velocity", "avg_velocity"]


@query("scan_csv_schema", sql="select * from injuries")
def scan_csv_schema(spark, sf):
    path = IO.write_csv(S.injuries(spark, sf), scratch_path(spark, "injuries-csv"))
    return IO.read_csv(spark, path, schema=IO.INJURY_SCHEMA)


@query("scan_csv_play_list",
       sql="""select PlayerKey as play_PlayerKey, GameID as play_GameID, PlayKey as play_PlayKey, RosterPosition,
 PlayerDay, PlayerGame, StadiumType, FieldType, Temperature, Weather, PlayType, PlayerGamePlay, Position, PositionGroup
 from plays""")
def scan_csv_play_list(spark, sf):
    """Play list through CSV with the fixed schema: the first three columns are
    renamed by position (the header says PlayerKey, GameID, PlayKey)."""
    plays = S.plays(spark, sf).drop("src_quantity", "src_flag", "src_order")
    path = IO.write_csv(plays, scratch_path(spark, "plays-csv"))
    return IO.read_csv(spark, path, schema=IO.PLAY_LIST_SCHEMA)


@query("scan_csv_infer",
       sql="""select cast(PlayerKey as int) as PlayerKey, GameID, PlayKey, BodyPart, Surface, DM_M1, DM_M7, DM_M28, DM_M42
 from injuries""")
def scan_csv_infer(spark, sf):
    """Inferred schema: one extra pass over the file; numeric keys become int."""
    path = IO.write_csv(S.injuries(spark, sf), scratch_path(spark, "injuries-infer"))
    return IO.read_csv(spark, path, infer=True)


@query("scan_csv_strings", sql="select * from tracks")
def scan_csv_strings(spark, sf):
    """All-text read, then ANSI-safe casts of the numeric columns."""
    path = IO.write_csv(S.tracks(spark, sf), scratch_path(spark, "tracks-csv"))
    text = IO.read_csv(spark, path)
    return text.select("PlayKey", F.expr("try_cast(time as double)").alias("time"), "event",
                       *[F.expr(f"try_cast({c} as double)").alias(c) for c in ["x", "y", "dir", "dis", "o", "s"]])


@query("scan_parquet", sql="select * from orders")
def scan_parquet(spark, sf):
    """Parquet scan of a whole table."""
    return table(spark, sf, "orders")


@query("sink_parquet_roundtrip",
       sql="select " + ", ".join(c for c in PGF_COLS if c not in _PGF_DOUBLES) + ", "
           + ", ".join(f"round({c}, 6) as {c}" for c in _PGF_DOUBLES) + " from pgf", ctes=PGF)
def sink_parquet_roundtrip(spark, sf):
    """The player-game feature table written once to Parquet and read back
    (later steps reuse the written table instead of recomputing its lineage)."""
    path = IO.write_parquet(player_game_table(spark, sf), scratch_path(spark, "player-game-features"))
    return round_doubles(IO.read_parquet(spark, path))


@query("sink_parquet_append",
       sql="select " + ", ".join(c for c in PGF_COLS if c not in _PGF_DOUBLES) + ", "
           + ", ".join(f"round({c}, 6) as {c}" for c in _PGF_DOUBLES) + " from pgf", ctes=PGF)
def sink_parquet_append(spark, sf):
    """The player-game feature table appended in two batches, of which one is
    repeated; read back, every row is there once."""
    # every batch reads the same rows: they are derived once
    rows = IO.read_parquet(spark, IO.write_parquet(player_game_table(spark, sf), scratch_path(spark, "player-game-rows")))
    path = scratch_path(spark, "player-game-batches")
    first = F.coalesce(C.hash_bucket("PlayerKey") < 50, F.lit(True))
    for batch, part in (("first", first), ("second", ~first), ("first", first)):
        IO.append_parquet(rows.where(part), path, batch)
    return round_doubles(IO.read_appended(spark, path))


@query("table_counts",
       sql="""select 'plays' as table_name, count(*) as row_count from plays
 union all select 'injuries', count(*) from injuries
 union all select 'tracks', count(*) from tracks""")
def table_counts(spark, sf):
    parts = [(n, df) for n, df in [("plays", S.plays(spark, sf)), ("injuries", S.injuries(spark, sf)),
                                   ("tracks", S.tracks(spark, sf))]]
    out = None
    for name, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


_SQL_TYPE = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
             "float": "FLOAT", "date": "DATE"}
_SCHEMA_TABLES = [("plays", S.PLAY_COLUMNS), ("injuries", S.INJURY_COLUMNS), ("tracks", S.TRACK_COLUMNS)]


@query("schema_report",
       sql="\nunion all ".join(f"select '{t}' as table_name, {i} as position, '{c}' as column_name, "
                               f"any_value(typeof({c})) as data_type, count({c}) as n_values from {t}"
                               for t, cols in _SCHEMA_TABLES for i, c in enumerate(cols)))
def schema_report(spark, sf):
    """``printSchema`` as rows: (table, position, column, SQL type name) of the
    three staged tables, with the number of values that each column holds (one
    aggregation a table)."""
    out = None
    for name, df in [("plays", S.plays(spark, sf)), ("injuries", S.injuries(spark, sf)),
                     ("tracks", S.tracks(spark, sf))]:
        fields = [(i, f.name, _SQL_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString().upper()))
                  for i, f in enumerate(df.schema.fields)]
        held = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c, _ in fields])
        lines = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("data_type"),
                                   F.col(f"n{i}").alias("n_values")) for i, c, t in fields])
        part = held.select(F.lit(name).alias("table_name"), F.explode(lines).alias("line")).select("table_name", "line.*")
        out = part if out is None else out.unionByName(part)
    return out
