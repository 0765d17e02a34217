"""Feature builders on hand-made rows: rest days, game list duplicates, pivots, severity."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from playtrack.functions import columns as C
from playtrack.operators import features as FE
from playtrack.operators import skew as SK
from playtrack.operators.clean import clean_plays

PLAY_SCHEMA = ("PlayerKey string, GameID string, PlayKey string, RosterPosition string, PlayerDay int, "
               "PlayerGame int, StadiumType string, FieldType string, Temperature double, Weather string, "
               "PlayType string, PlayerGamePlay int, Position string, PositionGroup string")


def _plays(spark):
    rows = [
        ("7", "7-1", "7-1-1", "Safety", 1, 1, "Outdoor", "Natural", -999.0, "Sunny", "Pass", 1, "SS", "DB"),
        ("7", "7-1", "7-1-2", "Safety", 1, 1, "Outdoor", "Natural", -999.0, "Sunny", "0", 2, "SS", "DB"),
        ("7", "7-2", "7-2-1", "Safety", 8, 2, None, "Synthetic", 70.0, "Indoor", None, 1, "FS", "DB"),
        # game 7-3 has two weathers: the game list keeps two rows
        ("7", "7-3", "7-3-1", "Safety", 15, 3, "Dome", "Synthetic", 60.0, "Rain", "Rush", 1, "SS", "DB"),
        ("7", "7-3", "7-3-2", "Safety", 15, 3, "Dome", "Synthetic", 60.0, "Snow", "Rush", 2, "SS", "DB"),
    ]
    return spark.createDataFrame(rows, PLAY_SCHEMA)


def test_clean_plays(spark):
    c = {r.PlayKey: r for r in clean_plays(_plays(spark)).collect()}
    assert c["7-1-1"].Temperature == 61 and c["7-1-1"].StadiumType == "outdoor" and c["7-1-1"].Weather == "clear"
    assert c["7-1-2"].PlayType == "Missing"
    assert c["7-2-1"].StadiumType == "Missing" and c["7-2-1"].Weather == "Missing" and c["7-2-1"].PlayType == "Missing"


def test_rest_days_first_game(spark):
    games = FE.rest_days(FE.game_list(clean_plays(_plays(spark))))
    by_game = sorted((r.GameID, r.Rest_days) for r in games.collect())
    assert by_game[0] == ("7-1", 0)            # PlayerDay 1 - default 1
    assert ("7-2", 7) in by_game


def test_game_features_duplicate_game(spark):
    gf = FE.game_features(_plays(spark))
    counts = {r.GameID: r["count"] for r in gf.groupBy("GameID").count().collect()}
    assert counts == {"7-1": 1, "7-2": 1, "7-3": 2}
    g1 = gf.where(F.col("GameID") == "7-1").first()
    assert (g1.NumPlayTypePerGame, g1.MaxPlayGamePlay) == (2, 2)


def test_pivot_cells_null_when_absent(spark):
    t = spark.createDataFrame([("p", "clear", "outdoor", "Natural", 1), ("p", "rain", "outdoor", "Natural", 0),
                               ("q", "clear", "dome_open", "Synthetic", 0)],
                              "PlayerKey string, Weather string, StadiumType string, FieldType string, IsInjury int")
    for c in FE.PLAYER_AVERAGED:
        t = t.withColumn(c, F.lit(1.0))
    p = {r.PlayerKey: r for r in FE.player_features(t).collect()}
    assert p["p"].clear == 1 and p["p"].rain == 1 and p["p"].snow is None and p["q"].rain is None
    assert p["p"].sum_Injury == 1
    ref = {r.PlayerKey: r for r in FE.pivot_table(t, "Weather", ["clear", "overcast", "rain", "snow"]).collect()}
    assert all(ref[k][v] == p[k][v] for k in "pq" for v in ["clear", "overcast", "rain", "snow"])


def test_severity_and_label(spark):
    df = spark.createDataFrame([(1, 1, 0, 0), (1, 1, 1, 1), (None, 1, 1, 1)], "DM_M1 int, DM_M7 int, DM_M28 int, DM_M42 int")
    out = [(r.s, r.l, r.f) for r in df.select(C.severity().alias("s"), C.severity_level(C.severity()).alias("l"),
                                              C.positive_flag(C.severity()).alias("f")).collect()]
    assert out == [(2, "L", 1), (4, "H", 1), (None, "L", 0)]


def test_game_id_from_play_key(spark):
    df = spark.createDataFrame([("26624-1-1",), ("26624-12-3-x",)], "k string")
    assert [r.g for r in df.select(C.game_id_from_play_key("k").alias("g")).collect()] == ["26624-1", "26624-12"]


def test_kinematics_reference_divides_by_time(spark):
    rows = [("1-1-1", 0.0, "a", 0.0, 0.0, 0.0, 0.0, 10.0, 0.0), ("1-1-1", 2.0, "b", 4.0, 0.0, 0.0, 0.0, 10.0, 0.0),
            ("1-1-1", 1.0, "", 100.0, 0.0, 0.0, 0.0, 10.0, 0.0)]
    df = spark.createDataFrame(rows, "PlayKey string, time double, event string, x double, y double, dir double, "
                                     "dis double, o double, s double")
    ref = FE.track_kinematics(df).where(F.col("time") == 2.0).first()
    step = FE.track_kinematics(df, mode="per_step").where(F.col("time") == 2.0).first()
    assert ref.x_velocity == 2.0 and step.x_velocity == 2.0 and ref.o_minus_dir == 10.0


def test_chunked_lag_matches_window(spark):
    """Hot-play path: lag over time-range chunks equals the plain lag window,
    also across chunk boundaries."""
    rows = [(k, float(t), "e", float(t * t % 7), float(t % 5), 1.0, 0.1, 2.0, 3.0)
            for k in ["1-1-1", "1-1-2"] for t in range(1, 60)]
    df = spark.createDataFrame(rows, "PlayKey string, time double, event string, x double, y double, dir double, "
                                     "dis double, o double, s double")
    cols = ["PlayKey", "time", "x_distance", "y_distance", "time_period", "x_velocity", "velocity"]
    chunked = {tuple(r[c] for c in cols) for r in FE.track_kinematics(df, strategy="auto", hot_rows=10).collect()}
    plain = {tuple(r[c] for c in cols) for r in FE.track_kinematics(df, strategy="window").collect()}
    assert chunked == plain and len(plain) == 118
    prev = SK.previous_in_group(df, "PlayKey", ["time"], ["x", "time"], chunks=7)
    assert prev.where(F.col("_prev_time").isNull()).count() == 2          # only each play's first frame
    assert prev.where(~F.col("_has_prev")).count() == 2


def test_chunked_row_number_and_lag(spark):
    """Hot keys (threshold 5) take the chunked path; results equal the plain windows."""
    rows = [(k, i, float((i * 7) % 11)) for k, n in [("a", 40), ("b", 3), ("c", 25)] for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    rn = {(r.k, r.i): r.rn for r in SK.row_number_by(df, "k", ["i"], "rn", hot_rows=5).collect()}
    assert all(rn[(k, i)] == i + 1 for k, i in rn)
    lagged = {(r.k, r.i): r.p for r in SK.lag_in_group(df, "k", ["i"], "v", "p", default=-1.0, hot_rows=5).collect()}
    want = {(k, i): (-1.0 if i == 0 else float(((i - 1) * 7) % 11)) for k, i, _ in rows}
    assert lagged == want
    plain = {(r.k, r.i): r.rn for r in SK.row_number_in_group(df, "k", ["i"], "rn", chunks=9).collect()}
    assert plain == rn


def test_rest_days_hot_players(spark):
    games = spark.createDataFrame([("p", f"p-{g}", g * 3, g) for g in range(1, 30)] + [("q", "q-1", 5, 1)],
                                  "GamePlayerID string, GameID string, PlayerDay int, PlayerGame int")
    hot = {r.GameID: r.Rest_days for r in FE.rest_days(games, hot_rows=4).collect()}
    cold = {r.GameID: r.Rest_days for r in FE.rest_days(games, hot_rows=10**6).collect()}
    assert hot == cold and hot["p-1"] == 2 and hot["p-2"] == 3 and hot["q-1"] == 4


def test_hot_key_path_equals_plain_windows_on_many_rows(spark, tmp_path):
    """Sampled ranges differ between evaluations of a plan: 300,000 rows of one key, with payload, row by row."""
    n = 400_000
    rows = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 4 < 3, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("k"),
        ((F.col("id") * 7919) % n).alias("i"), (F.col("id") * 1.5).alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    rows.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    w = Window.partitionBy("k").orderBy("i")
    want = df.select("k", "i", F.row_number().over(w).alias("rn"), F.lag("v", 1, -1.0).over(w).alias("p"))
    for got, col in ((SK.row_number_by(df, "k", ["i"], "rn", hot_rows=100_000), "rn"),
                     (SK.lag_in_group(df, "k", ["i"], "v", "p", default=-1.0, hot_rows=100_000), "p")):
        wrong = got.select("k", "i", F.col(col).alias("got")).join(want, ["k", "i"]).where(~F.col("got").eqNullSafe(F.col(col)))
        assert got.count() == n and wrong.count() == 0


def test_game_facts_merge(spark):
    """Facts of two play lists together, play by play, are those of both; also beyond 64 plays, below zero and with nulls."""
    rows = [("7", f"7-{g}", f"7-{g}-{n}", "Safety" if n % 3 else None, g, g, "Outdoor", "Natural", 50.0, "Sunny",
             ["Pass", "Rush", None, "0"][n % 4], n if n % 11 else None, ["SS", "FS"][n % 2], "DB")
            for g in (1, 2) for n in [*range(-3, 150), 70, 70]]
    rows.append(("8", "8-1", "8-1-1", None, 1, 1, None, None, None, None, None, None, None, None))
    df = spark.createDataFrame(rows, PLAY_SCHEMA)
    parts = [df.where(F.pmod(F.hash("PlayKey"), F.lit(2)) == i) for i in (0, 1)]
    both = FE.merged_facts(*[FE.game_facts(p) for p in parts])
    got = sorted((tuple(r) for r in FE.game_features(df, both).collect()), key=str)
    assert got == sorted((tuple(r) for r in FE.game_features(df).collect()), key=str)
    clean = clean_plays(df)
    want = clean.groupBy("PlayerKey", "GameID").agg(
        F.countDistinct("RosterPosition").alias("r"), F.countDistinct("PlayType").alias("t"),
        F.countDistinct("Position").alias("p"), F.countDistinct("PlayerGamePlay").alias("n"))
    counts = FE.game_counts(both.marks).select("PlayerKey", "GameID", "NumRosterPosition", "NumPlayTypePerGame",
                                               "NumPositionPerGame", "MaxPlayGamePlay")
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, want.collect()))
