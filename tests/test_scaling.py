"""Partitions follow the rows: what a task holds does not grow with the input, and only what is asked for is moved."""

import os
import re

import pytest
from pyspark.sql import functions as F

from playtrack.operators import skew as SK
from playtrack.plans import queries
from playtrack.sources import staging as S

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _plan(df, which="executedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def _parts(df, key):
    return {int(n) for n in re.findall(rf"hashpartitioning\([^)]*?{key}#\d+L?[^)]*?, (\d+)\)", _plan(df))}


def test_staging_partitions_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(SK, "ROWS_PER_PART", 100)
    rows = S._line_rows(spark, SF, 23)                   # 6,000 lines, 1,500 orders, 8 partitions of Spark's own
    assert _parts(rows, "l_orderkey") == {60}
    assert _parts(rows, "o_custkey") == {15}


def test_parts_join_in_the_number_asked_for(spark, monkeypatch):
    monkeypatch.setattr(SK, "ROWS_PER_PART", 100)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = S._line_rows(spark, SF, 97)
        assert _parts(rows, "l_partkey") == {97} and _parts(rows, "p_partkey") == {97}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_keys_are_looked_for_in_heavy_slots_only(spark, monkeypatch):
    counted = []
    real = SK.hot_keys
    monkeypatch.setattr(SK, "hot_keys", lambda df, *a: counted.append(df) or real(df, *a))
    df = spark.range(20_000).select(F.when(F.col("id") < 9_000, -1).otherwise(F.col("id")).alias("k"))
    mark = {"plain": F.lit("plain"), "chunked": F.lit("chunked")}
    chains = [lambda d, m=m: d.withColumn("how", m) for m in mark.values()]
    assert {r.how for r in SK.split_by_key_size(df, "k", *chains, hot_rows=10_000).collect()} == {"plain"}
    assert not counted                                   # no slot is that full: keys are not counted one by one
    got = SK.split_by_key_size(df, "k", *chains, hot_rows=1_000).groupBy("how").count().collect()
    assert {r["how"]: r["count"] for r in got} == {"plain": 11_000, "chunked": 9_000}
    assert counted[0].count() < 10_000                   # the rows of one slot
    assert SK.key_slots(df, "k").count() <= SK.SLOTS


def test_environment_is_dealt_once(spark, monkeypatch):
    S.injuries(spark, SF)
    monkeypatch.setattr(SK, "ROWS_PER_PART", 100)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries()["injury_environment"](spark, SF)
        assert _parts(df, "GameID") == {60} and _plan(df).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["frames_with_season", "abnormal_snap_plays", "season_imputed", "movement_injury_ratio"])
def test_only_plays_with_frames_are_looked_up(spark, name):
    """The play list meets the plays' ends where it lies, before anything of it is moved."""
    plan = _plan(queries()[name](spark, SF))
    lines = plan.splitlines()
    for i in [i for i, line in enumerate(lines) if "playtrack_plays_" in line]:
        above = lines[:i][::-1]
        semi = next(k for k, line in enumerate(above) if "LeftSemi" in line)
        assert not any("Exchange hashpartitioning" in line for line in above[:semi])


def test_tracks_and_games_are_dealt_once(spark):
    n, _, _, rows = S._store_tracks(spark, SF, 13)
    assert _parts(rows, "PlayKey") == {13}
    n, _, _, rows = S._store_games(spark, SF, 13)
    assert _parts(rows, "GameID") == {13} and _plan(rows).count("Exchange hashpartitioning") == 1


def test_mae_derives_its_rows_once(spark):
    assert "playtrack_plays_" not in _plan(queries()["ml_mae"](spark, SF), "optimizedPlan")
