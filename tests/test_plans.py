"""Plan checks: no Python UDF anywhere; the frame chain reads the bucketed
frames without shuffling them; scans are pruned."""

import os
import re

import pytest

from playtrack.plans import oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

# Queries that run a job while being built (file round trips, model fits).
_EAGER = {"scan_csv_schema", "scan_csv_play_list", "scan_csv_infer", "scan_csv_strings", "sink_parquet_roundtrip", "sink_parquet_append",
          "ml_string_index", "ml_one_hot", "temperature_mean_impute", "ml_mae", "ml_string_index_ranks", "ml_lr_optimality", "ml_auc_by_ranks"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - _EAGER))
def test_no_python_udf(spark, name):
    plan = _plan(queries()[name](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", ["frames_trimmed", "frames_with_snap", "track_kinematics"])
def test_frames_not_shuffled(spark, name):
    plan = _plan(queries()[name](spark, SF))
    assert "Bucketed: true" in plan
    assert "Exchange hashpartitioning(PlayKey" not in plan


def test_scan_prunes_and_pushes(spark):
    orders = queries()["scan_parquet"](spark, SF)           # the whole table; what a user asks of it reaches the reader
    plan = _plan(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan


@pytest.mark.parametrize("name", ["frames_trimmed", "frames_with_snap", "track_game_features"])
def test_frames_scanned_once(spark, name):
    """The window form reads the frames table exactly once (the source's self
    joins read it two or three times)."""
    plan = _plan(queries()[name](spark, SF))
    assert plan.count("FileScan parquet spark_catalog.default.playtrack_tracks_") == 1


MOVEMENT = ["movement_by_injury_main", "movement_by_injury", "speed_by_injury", "lateral_share_by_position", "movement_class"]
CHAIN = MOVEMENT + ["frames_with_snap", "last_event", "frames_trimmed", "frames_trimmed_one_snap", "frames_with_season",
                    "season_imputed", "orientation_fixed", "frames_enriched"]


@pytest.mark.parametrize("name", CHAIN)
def test_frame_chain_has_no_lists_and_no_windows(spark, name):
    plan = _plan(queries()[name](spark, SF))
    assert "collect_list" not in plan and "Window" not in plan
    assert plan.count("FileScan parquet spark_catalog.default.playtrack_tracks_") <= 1


@pytest.mark.parametrize("name", MOVEMENT)
def test_movement_reads_the_play_list_twice_at_most(spark, name):
    df = queries()[name](spark, SF)
    df.collect()
    final = _plan(df).split("+- == Initial Plan ==")[0]
    assert final.count("FileScan parquet spark_catalog.default.playtrack_plays_") <= 2


def test_play_filter_is_below_every_copy(spark):
    """The rush/pass filter stands in the plan below the join in which frames are copied for their snaps."""
    lines = queries()["movement_by_injury"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    copy = next(i for i, line in enumerate(lines) if re.search(r"Join Inner.*[ (]time#\d+ >= \(snap_time", line))
    kept = next(i for i, line in enumerate(lines) if "Filter" in line and "PlayType" in line and "Rush" in line)
    assert kept > copy


@pytest.mark.parametrize("name", ["hist_orientation_raw", "hist_orientation_fixed", "hist_temperature", "hist_temperature_clean"])
def test_a_histogram_reads_its_source_once(spark, name):
    df = queries()[name](spark, SF)
    df.collect()
    final = _plan(df).split("+- == Initial Plan ==")[0]
    table = "tracks" if "orientation" in name else "plays"
    joined = {"hist_orientation_fixed": 2}      # plays: for the season and for the attributes
    assert final.count(f"FileScan parquet spark_catalog.default.playtrack_{table}_") == 1
    assert final.count("FileScan parquet spark_catalog.default.playtrack_plays_") <= joined.get(name, 1)


GAME = ["game_features", "game_injury_label", "player_game_features", "player_features"]


@pytest.mark.parametrize("name", GAME)
def test_game_tables_read_stored_facts_once(spark, name):
    """No scan of the play list, no object aggregate or distinct count, and no shuffle of the marks before their sums."""
    df = queries()[name](spark, SF)
    df.collect()
    final = _plan(df).split("+- == Initial Plan ==")[0]
    assert "playtrack_plays_" not in final and "ObjectHashAggregate" not in final and "distinct" not in final.lower()
    assert final.count("playtrack_game_marks_") == 1 and final.count("playtrack_game_rows_") == 1
    marks = next(i for i, line in enumerate(final.splitlines()) if "playtrack_game_marks_" in line)
    above = final.splitlines()[:marks]
    last_sum = max(i for i, line in enumerate(above) if "HashAggregate" in line and "bit_count" in line)
    assert not any("Exchange" in line for line in above[last_sum:])
