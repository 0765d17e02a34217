"""Tracking chain on hand-made frames: two snaps, no snap, no events, edge times."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from playtrack.operators import tracking as TR

SCHEMA = "PlayKey string, time double, event string, x double, y double, dir double, dis double, o double, s double"


def _frames(spark):
    rows = []
    # A: two snaps (H3), a frame exactly 0.1 before the first snap and 0.1 after the last event (H6)
    for t, e in [(0.5, None), (0.9, None), (1.0, "ball_snap"), (2.0, "ball_snap"), (3.0, "tackle"), (3.1, None),
                 (3.5, None)]:
        rows.append(("1-1-1", t, e, t, t, 10.0, 0.1, 40.0, 1.0))
    # B: events but no snap
    for t, e in [(0.0, "pass"), (1.0, None)]:
        rows.append(("1-1-2", t, e, t, t, 10.0, 0.1, 200.0, 2.0))
    # C: no events at all
    for t in [0.0, 1.0]:
        rows.append(("1-2-1", t, None, t, t, 10.0, 0.1, 100.0, 3.0))
    # D: the snap is the only event, at time 0
    for t, e in [(0.0, "ball_snap"), (0.05, None), (0.2, None)]:
        rows.append(("2-1-1", t, e, t, t, 350.0, 0.1, 170.0, 4.0))
    return spark.createDataFrame(rows, SCHEMA)


def _multiset(df, cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def test_trim_counts_and_duplication(spark):
    f = _frames(spark)
    out = TR.frames_trimmed(f)
    per_play = {r.PlayKey: r["count"] for r in out.groupBy("PlayKey").count().collect()}
    assert per_play == {"1-1-1": 16, "2-1-1": 2}          # 2 snaps x 2 last-event rows; edges kept
    times_a = sorted({r.time for r in out.where(F.col("PlayKey") == "1-1-1").collect()})
    assert times_a == [0.9, 1.0, 2.0, 3.0, 3.1]


def test_window_and_join_forms_agree(spark):
    f = _frames(spark)
    cols = ["PlayKey", "time", "event", "snap_time", "snap_x", "last_time", "last_event"]
    w = TR.frames_trimmed(f, strategy="window").select(*cols)
    j = TR.frames_trimmed(f, strategy="join").select(*cols)
    assert _multiset(w, cols) == _multiset(j, cols)
    cols2 = ["PlayKey", "time", "snap_time", "snap_x", "snap_y"]
    assert _multiset(TR.frames_with_snap(f, "window").select(*cols2), cols2) == \
        _multiset(TR.frames_with_snap(f, "join").select(*cols2), cols2)


@pytest.mark.parametrize(("before", "after"), [(0.1, 0.1), (0, 0), (-0.5, 0.3), (-1.5, -0.5), (0.6, -1.2)])
def test_trim_forms_agree_for_any_margin(spark, before, after):
    f = _frames(spark)
    cols = ["PlayKey", "time", "event", "snap_time", "snap_y", "last_time", "last_event"]
    w, j = (TR.frames_trimmed(f, before, after, strategy=s).select(*cols) for s in ("window", "join"))
    assert _multiset(w, cols) == _multiset(j, cols)


def test_one_snap_variant(spark):
    out = TR.frames_trimmed(_frames(spark), one_snap=True)
    per_play = {r.PlayKey: r["count"] for r in out.groupBy("PlayKey").count().collect()}
    assert per_play == {"1-1-1": 5, "2-1-1": 2}


def test_season_imputation_forms_agree(spark):
    rows = [("p1", "ball_snap", 10.0, None), ("p1", None, 200.0, None),     # abnormal snap -> season 1
            ("p2", "ball_snap", 100.0, None),                               # normal snap -> season 2
            ("p3", "ball_snap", 10.0, 2),                                    # season known: kept
            ("p4", "tackle", 10.0, None)]                                    # no snap -> season 2
    df = spark.createDataFrame(rows, "PlayKey string, event string, o double, season int")
    w = {(r.PlayKey, r.o): r.season for r in TR.impute_season(df, "window").collect()}
    j = {(r.PlayKey, r.o): r.season for r in TR.impute_season(df, "join").collect()}
    assert w == j == {("p1", 10.0): 1, ("p1", 200.0): 1, ("p2", 100.0): 2, ("p3", 10.0): 2, ("p4", 10.0): 2}
    fixed = {(r.PlayKey, r.season): r.o for r in TR.fix_orientation(TR.impute_season(df)).collect()}
    assert fixed[("p1", 1)] in (100.0, 290.0)


def test_abnormal_ranges(spark):
    df = spark.createDataFrame([(o,) for o in [49.9, 50.0, 125.0, 125.1, 224.9, 225.0, 325.0, 325.1]], "o double")
    hits = [r.o for r in df.where(TR.abnormal_snap("o")).collect()]
    assert sorted(hits) == [49.9, 125.1, 224.9, 325.1]


def test_mark_join_handles_null_keys(spark):
    frames = spark.createDataFrame([("a",), ("b",), (None,)], "PlayKey string")
    inj = spark.createDataFrame([("a",), (None,)], "PlayKey string")
    marks = {r.PlayKey: r.is_injury_play for r in TR.mark_injury_plays(frames, inj).collect()}
    assert marks == {"a": True, "b": False, None: False}


def test_hot_play_split_matches_pure_forms(spark):
    """With a tiny hot threshold, play 1-1-1 (7 frames) takes the join path and
    the rest the window path; the union equals either pure form."""
    f = _frames(spark)
    cols = ["PlayKey", "time", "event", "snap_time", "last_time", "last_event"]
    split = TR.frames_trimmed(f, strategy="auto", hot_rows=3).select(*cols)
    pure = TR.frames_trimmed(f, strategy="window").select(*cols)
    assert _multiset(split, cols) == _multiset(pure, cols)
    assert [r.PlayKey for r in TR.hot_play_keys(f, 3).collect()] == ["1-1-1"]
    one = TR.frames_trimmed(f, strategy="auto", hot_rows=3, one_snap=True).select(*cols)
    assert _multiset(one, cols) == _multiset(TR.frames_trimmed(f, strategy="window", one_snap=True).select(*cols),
                                             cols)


FORMS = ["window", "salted", "join"]


def _tied_frames(spark):
    """Ties at the last event time, null events beside them, null times, repeated frames, snaps at one time."""
    rows = [("a", t, e, t, 7.0, 10.0, 0.1, o, 1.0) for t, e, o in
            [(0.0, None, 1.0), (0.2, "ball_snap", 60.0), (0.2, "ball_snap", 330.0), (0.2, None, 5.0), (0.7, "pass", 1.0),
             (0.8, "ball_snap", 100.0), (2.0, "tackle", 1.0), (2.0, "tackle", 1.0), (2.0, "pass", 2.0), (2.0, None, 3.0),
             (2.1, None, 4.0), (2.2, None, 4.0), (None, "tackle", 9.0), (None, "ball_snap", 9.0), (None, None, 9.0)]]
    rows += [("b", None, "ball_snap", 1.0, 1.0, 1.0, 0.1, 1.0, 1.0), ("b", 1.0, None, 1.0, 1.0, 1.0, 0.1, 1.0, 1.0)]
    rows += [("c", 1.0, "pass", 1.0, 1.0, 1.0, 0.1, 1.0, 1.0), ("d", 0.5, "ball_snap", 1.0, 1.0, 1.0, 0.1, 20.0, 1.0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("form", ["window", "salted"])
@pytest.mark.parametrize(("before", "after"), [(0.1, 0.1), (-0.5, 0.3), (0.6, -1.2), (-3.0, 0.0)])
def test_ties_and_nulls_multiply_as_in_the_join_form(spark, form, before, after):
    f = _tied_frames(spark).unionByName(_frames(spark))
    cols = ["PlayKey", "time", "event", "o", "snap_time", "snap_x", "last_time", "last_event"]
    want = _multiset(TR.frames_trimmed(f, before, after, strategy="join").select(*cols), cols)
    assert _multiset(TR.frames_trimmed(f, before, after, strategy=form).select(*cols), cols) == want
    one = ["PlayKey", "time", "event", "o", "snap_time", "last_time", "last_event"]
    assert _multiset(TR.frames_trimmed(f, before, after, form, one_snap=True).select(*one), one) == _multiset(
        TR.frames_trimmed(f, before, after, "join", one_snap=True).select(*one), one)
    pairs = ["PlayKey", "time", "event", "o", "snap_time", "snap_x", "snap_y"]
    assert _multiset(TR.frames_with_snap(f, form).select(*pairs), pairs) == _multiset(
        TR.frames_with_snap(f, "join").select(*pairs), pairs)


@pytest.mark.parametrize("before", [0.1, -0.3, 2.5])
def test_last_events_equal_the_join_on_snap_pairs(spark, before):
    f = _tied_frames(spark).unionByName(_frames(spark))
    cols = ["PlayKey", "last_time", "last_event"]
    pairs = TR.frames_with_snap(f, "join").where(F.col("time") >= F.col("snap_time") - before)
    assert _multiset(TR.last_events(TR.play_marks(f), before), cols) == _multiset(TR.last_event(pairs), cols)


def _plays(spark):
    rows = [("1", "1-1", "1-1-1", 10), ("1", "1-1", "1-1-2", 10), ("1", "1-2", "1-2-1", 400), ("2", "2-1", "2-1-1", 20),
            ("3", "3-1", "a", 349), ("3", "3-1", "b", 350), ("4", None, "c", 500), ("5", "5-1", "d", None)]
    full = [(p, g, k, d, r, "LB", "Natural", t) for (p, g, k, d), (r, t) in zip(
        rows, [("Linebacker", "Rush"), ("Safety", "Pass"), ("Kicker", "Punt"), ("Linebacker", "Pass")] * 2, strict=True)]
    return spark.createDataFrame(full, "PlayerKey string, GameID string, PlayKey string, PlayerDay int, RosterPosition string, "
                                       "PositionGroup string, FieldType string, PlayType string")


def test_seasons_of_games_equal_the_distinct_games(spark):
    plays = _plays(spark)
    tp = TR.season_plays(plays)
    want = tp.select("PlayKey", "GameID").join(tp.select("GameID", "season").distinct(), ["GameID"])
    cols = ["PlayKey", "GameID", "season"]
    assert _multiset(TR.play_season(plays), cols) == _multiset(want, cols)
    assert {r.season for r in TR.play_season(plays).where("PlayKey = 'a'").collect()} == {1, 2}


def test_movement_forms_and_predicate_transfer_agree(spark):
    f, plays = _tied_frames(spark).unionByName(_frames(spark)), _plays(spark)
    injuries = spark.createDataFrame([("1-1-1",), ("a",), (None,)], "PlayKey string")
    cols = ["PlayKey", "time", "event", "o", "season", "snap_time", "last_event", "is_injury_play", "is_rush_pass", "movement"]
    where = F.col("is_rush_pass") & F.col("is_main_pos")
    for cond in (None, where):
        want = TR.movement_frames(f, plays, injuries, strategy="join")
        want = _multiset((want if cond is None else want.where(cond)).select(*cols), cols)
        assert want
        for form in ("window", "salted", "auto"):
            got = TR.movement_frames(f, plays, injuries, strategy=form, hot_rows=5, where=cond)
            assert _multiset(got.select(*cols), cols) == want
    cols = ["PlayKey", "time", "event", "o", "season", "GameID", "snap_time", "last_event"]
    want = _multiset(TR.orientation_fixed(f, plays, "join").select(*cols), cols)
    for form in ("window", "auto"):
        assert _multiset(TR.orientation_fixed(f, plays, form, hot_rows=5).select(*cols), cols) == want


def test_a_hot_play_of_many_snaps_is_spread_over_its_salts(spark):
    """20,000 frames and 20 snaps of one play: no task makes more than a small part of its 4 million copies."""
    n = 20_000
    hot = spark.range(n, numPartitions=4).select(
        F.lit("hot").alias("PlayKey"), (F.col("id") / 100).alias("time"),
        F.when(F.col("id") % 1000 == 0, "ball_snap").when(F.col("id") == n - 1, "tackle").alias("event"),
        *[F.lit(1.0).alias(c) for c in ("x", "y", "dir", "dis", "o", "s")])
    out = TR.frames_trimmed(hot.unionByName(_frames(spark)), hot_rows=5_000)
    made = out.where("PlayKey = 'hot'").groupBy(F.spark_partition_id().alias("task")).count()
    # at this size Spark would broadcast the frames and join them in one task
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        rows = [r["count"] for r in made.collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # a frame is late enough for the snaps up to 0.1 s after it; the last event is late enough for every snap
    want = sum(1 for i in range(n) for s in range(20) if i / 100 >= s * 10.0 - 0.1) * 20
    assert sum(rows) == want and len(rows) >= 4 and max(rows) < want / 2
