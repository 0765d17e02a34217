"""Machine-learning queries.

Exact oracles exist for the feature transforms (indexing, one-hot, assembly),
the key-hash split, metrics on a fixed scoring rule, dummy columns, the mean
imputer and the MAE of a mean predictor.  Fitted models (LR, RF, CV) are
checked on rows only.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import BODY_PARTS, FIELD_PIVOT, STADIUM_OPEN_CLOSED, WEATHER_QUALITY
from ..operators import clean as CL
from ..operators import features as FE
from ..operators import forest as FO
from ..operators import ml as ML
from ..operators import ranks as RK
from ..operators import reports as R
from .q_features import player_game_table, player_table, round_doubles
from .q_injury import ENV_CLEAN_CTE, injury_environment_clean_df, injury_environment_df, INJ_ENV_CTE
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources import files as IO
from ..sources.staging import source_state
from .registry import query
from .sql_blocks import PGF, PLAYER

HASH_SQL = "(cast(('0x'||substr(md5({k}),1,8)) as bigint) % 100)"


def _hash_sql(k: str) -> str:
    return HASH_SQL.format(k=k)


# -- feature transforms ------------------------------------------------------------
@query("ml_string_index",
       sql="""select Weather, cast(row_number() over (order by count(*) desc, Weather) - 1 as bigint) as Weather_index
 from pgf group by Weather""", ctes=PGF)
def ml_string_index(spark, sf):
    pgf = player_game_table(spark, sf)
    model = ML.indexer("Weather", "error").fit(pgf)
    return (model.transform(pgf.select("Weather").distinct())
            .withColumn("Weather_index", F.col("Weather_index").cast("bigint")))


@query("ml_string_index_ranks",
       sql="""select RosterPosition, cast(row_number() over (order by count(*) desc, RosterPosition) - 1 as bigint)
 as RosterPosition_index from pgf where RosterPosition is not null group by RosterPosition""", ctes=PGF)
def ml_string_index_ranks(spark, sf):
    """The index by ranks over ranges of (count, label): labels never meet on the driver (M1)."""
    return RK.string_index(player_game_table(spark, sf), "RosterPosition")


_ONE_HOT_SLOTS = 4   # five weather classes after cleaning, the last one dropped


@query("ml_one_hot",
       sql="select Weather, cast(i as bigint) as Weather_index, "
           + ", ".join(f"cast(case when i={s} then 1 else 0 end as double) as Weather_vec_{s}" for s in range(_ONE_HOT_SLOTS))
           + " from idx",
       ctes=PGF + ",\nidx AS (select Weather, row_number() over (order by count(*) desc, Weather) - 1 as i from pgf "
                  "group by Weather)")
def ml_one_hot(spark, sf):
    pgf = player_game_table(spark, sf)
    model = Pipeline(stages=[ML.indexer("Weather", "error"), ML.one_hot(["Weather"])]).fit(pgf)
    size = model.stages[-1].categorySizes[0] - 1
    out = model.transform(pgf.select("Weather").distinct())
    return ML.vector_columns(out.withColumn("Weather_index", F.col("Weather_index").cast("bigint")),
                             "Weather_vec", size)


_ASSEMBLED = ["Temperature", "Rest_days", "NumRosterPosition", "NumPlayTypePerGame", "NumPositionPerGame",
              "MaxPlayGamePlay"]


@query("ml_features",
       sql="select GameID, " + ", ".join(f"round(cast({c} as double), 6) as features_{i}"
                                         for i, c in enumerate(_ASSEMBLED)) + " from pgf", ctes=PGF)
def ml_features(spark, sf):
    pgf = player_game_table(spark, sf)
    out = ML.assembler(_ASSEMBLED).transform(pgf).select("GameID", "features")
    return ML.vector_columns(out, "features", len(_ASSEMBLED))


@query("ml_hash_split",
       sql=f"""select PlayKey, {_hash_sql('PlayKey')} as bucket,
 case when {_hash_sql('PlayKey')} < 70 then 'train' else 'test' end as split from plays""")
def ml_hash_split(spark, sf):
    from ..sources import staging as S
    b = C.hash_bucket("PlayKey")
    return S.plays(spark, sf).select("PlayKey", b.alias("bucket"),
                                     F.when(b < 70, "train").otherwise("test").alias("split"))


# -- metrics on a fixed scoring rule -------------------------------------------------
_RULE_SQL = "case when MaxPlayGamePlay >= 5 then 1 else 0 end"
_METRIC_CTES = PGF + f""",
cells AS (select cast(IsInjury as double) as l, cast({_RULE_SQL} as double) as p, count(*) as n from pgf group by 1, 2),
credits AS (select l as label, case when l=p then n else 0 end as tp, 0 as fp, case when l=p then 0 else n end as fn
  from cells union all select p, 0, case when l=p then 0 else n end, 0 from cells),
per AS (select label, cast(sum(tp) as bigint) as tp, cast(sum(fp) as bigint) as fp, cast(sum(fn) as bigint) as fn
  from credits group by label),
tot AS (select *, cast(sum(tp+fn) over () as bigint) as total from per),
lm AS (select label, tp+fn as support, total,
  coalesce(fp/nullif(total-tp-fn,0), 0) as fpr, coalesce(tp/nullif(tp+fn,0), 0) as tpr,
  coalesce(tp/nullif(tp+fp,0), 0) as precision, coalesce(tp/nullif(tp+fn,0), 0) as recall,
  coalesce(2*(tp/nullif(tp+fp,0))*(tp/nullif(tp+fn,0))/nullif((tp/nullif(tp+fp,0))+(tp/nullif(tp+fn,0)),0), 0) as f1
  from tot)"""


def scored_games(spark, sf):
    """Game table with a fixed prediction rule (many plays in the game -> 1)."""
    pgf = player_game_table(spark, sf)
    return pgf.withColumn("prediction", F.when(F.col("MaxPlayGamePlay") >= 5, 1.0).otherwise(0.0))


@query("ml_label_metrics",
       sql="select label, support, total, round(fpr, 6) as fpr, round(tpr, 6) as tpr, round(precision, 6) as precision, "
           "round(recall, 6) as recall, round(f1, 6) as f1 from lm", ctes=_METRIC_CTES)
def ml_label_metrics(spark, sf):
    return round_doubles(ML.label_metrics(scored_games(spark, sf), "IsInjury", "prediction"))


@query("ml_weighted_metrics",
       sql="""select round(sum(tpr*support)/max(total), 6) as accuracy,
 round(sum(support*1.0/total*fpr), 6) as weighted_fpr, round(sum(support*1.0/total*tpr), 6) as weighted_tpr,
 round(sum(support*1.0/total*f1), 6) as weighted_f1, round(sum(support*1.0/total*precision), 6) as weighted_precision,
 round(sum(support*1.0/total*recall), 6) as weighted_recall from lm""", ctes=_METRIC_CTES)
def ml_weighted_metrics(spark, sf):
    return round_doubles(ML.weighted_metrics(ML.label_metrics(scored_games(spark, sf), "IsInjury", "prediction")))


# -- dummies, imputation, MAE (environment table) ---------------------------------------
_DUMMIES = [("Weather", [label for label, _ in WEATHER_QUALITY]),
            ("StadiumType", [label for label, _ in STADIUM_OPEN_CLOSED]),
            ("FieldType", FIELD_PIVOT), ("BodyPart", BODY_PARTS)]


def dummy_table(spark, sf):
    df = injury_environment_clean_df(spark, sf)
    for col, values in _DUMMIES:
        df = R.dummies(df, col, values)
    return df


_DUMMY_NAMES = [f"{c}_{v}" for c, vs in _DUMMIES for v in vs]


@query("dummy_columns",
       sql="select GameID, PlayerKey, level_of_injury, " + ", ".join(
           f"case when {c}='{v}' then 1 else 0 end as \"{c}_{v}\"" for c, vs in _DUMMIES for v in vs)
           + " from envclean", ctes=ENV_CLEAN_CTE)
def dummy_columns(spark, sf):
    return dummy_table(spark, sf).select("GameID", "PlayerKey", "level_of_injury", *_DUMMY_NAMES)


@query("temperature_mean_impute",
       sql=f"""select GameID, PlayerKey, BodyPart,
 round(case when Temperature=-999 or Temperature is null then (select avg(Temperature) from injenv
   where {_hash_sql('GameID')} < 75 and Temperature<>-999) else Temperature end, 6) as Temperature,
 case when {_hash_sql('GameID')} < 75 then 'train' else 'test' end as split from injenv""", ctes=INJ_ENV_CTE)
def temperature_mean_impute(spark, sf):
    """-999 (and null) -> mean of the training part, applied to both parts."""
    env = injury_environment_df(spark, sf).withColumn(
        "split", F.when(C.hash_bucket("GameID") < 75, "train").otherwise("test"))
    model = CL.fit_mean_imputer(env.where(F.col("split") == "train"), "Temperature", -999.0)
    return round_doubles(model.transform(env).select("GameID", "PlayerKey", "BodyPart", "Temperature", "split"))


_TARGETS = ["level_of_injury"] + [f"BodyPart_{v}" for v in BODY_PARTS]


@query("ml_mae",
       sql="select round((" + " + ".join(
               f"avg(abs(\"{t}\" - (select \"m_{t}\" from tr)))" for t in _TARGETS) + f")/{len(_TARGETS)}, 6) as mae"
           + f" from dm where {_hash_sql('GameID')} >= 75",
       ctes=ENV_CLEAN_CTE + ",\ndm AS (select *, " + ", ".join(
           f"case when BodyPart='{v}' then 1 else 0 end as \"BodyPart_{v}\"" for v in BODY_PARTS) + " from envclean)"
           + ",\ntr AS (select " + ", ".join(f"avg(\"{t}\") as \"m_{t}\"" for t in _TARGETS)
           + f" from dm where {_hash_sql('GameID')} < 75)")
def ml_mae(spark, sf):
    """MAE, averaged over the targets, of the training-part mean predictor on
    the test part (the baseline the forest is measured against)."""
    # fit and test read the same rows: they are derived once
    path = IO.write_parquet(dummy_table(spark, sf).select("GameID", *_TARGETS), scratch_path(spark, "targets"))
    df = IO.read_parquet(spark, path)
    bucket = C.hash_bucket("GameID")
    train, test = df.where(bucket < 75), df.where(bucket >= 75)
    means = train.agg(*[F.avg(t).alias(t) for t in _TARGETS]).first()   # one row: the fitted model
    pred = test.withColumns({f"pred_{t}": F.lit(means[t]) for t in _TARGETS})
    return round_doubles(ML.mae(pred, [(t, f"pred_{t}") for t in _TARGETS]))


# -- fitted models (rows-only checks) ----------------------------------------------------
_GAME_NUMS = ML.GAME_MODEL_NUMBERS
_MODEL_CACHE: dict = {}
ROWS_PER_TRAINING_PARTITION = 100_000


def ensure_and_checkpoint(spark, df, key):
    """Reliable checkpoint into the shared ``spark.checkpoint.dir`` (survives
    executor loss; never a local checkpoint).

    Forests draw their samples per partition, so rows are dealt by ``key``
    into a number of partitions that follows from the row count alone, each in
    a total order: another cluster size gives the same models.
    """
    ensure_checkpoint_dir(spark)
    rows = df.checkpoint(eager=True)
    parts = max(1, -(-rows.count() // ROWS_PER_TRAINING_PARTITION))
    return rows.repartition(parts, key).sortWithinPartitions(*rows.columns).checkpoint(eager=True)


def _model_key(kind, spark, sf):
    """Fitted models are kept for one state of the source files."""
    return kind, sf, spark.sparkContext.applicationId, source_state(spark, sf)


def _game_input(spark, sf):
    pgf = player_game_table(spark, sf)
    return pgf.select(*ML.GAME_MODEL_CATEGORIES, *_GAME_NUMS, "IsInjury", "GameID").na.fill(0)


_GAME_LR_INPUTS = [f"{c}_vec" for c in ["RosterPosition", "StadiumType", "FieldType"]] + ["Temperature", "Weather_vec"] \
    + _GAME_NUMS[1:]
GAME_TREES, GAME_DEPTH = 200, 20


def _once(kind, spark, sf, make):
    key = _model_key(kind, spark, sf)
    if key not in _MODEL_CACHE:
        _MODEL_CACHE[key] = make()
    return _MODEL_CACHE[key]


def game_data(spark, sf):
    """Rows of the per-game models and their 50/50 key-hash split."""
    def make():
        # The iterative fits read their input many times: cut the lineage once.
        data = ensure_and_checkpoint(spark, _game_input(spark, sf), "GameID")
        return data, *ML.hash_split(data, "GameID", 50)
    return _once("game", spark, sf, make)


def game_lr(spark, sf):
    def make():
        cats = ML.GAME_MODEL_CATEGORIES
        return Pipeline(stages=[*map(ML.indexer, cats), ML.one_hot(cats), ML.assembler(_GAME_LR_INPUTS),
                                ML.logistic_regression("IsInjury", "features", 100, 0.5)]).fit(game_data(spark, sf)[1])
    return _once("game-lr", spark, sf, make)


def game_forest(spark, sf):
    """``(names, splits, scored)`` of the per-game forest: a table of its splits' gains, and (IsInjury, score) of the test part."""
    def make():
        data, train, _ = game_data(spark, sf)
        cats = ML.GAME_MODEL_CATEGORIES
        indexed = Pipeline(stages=[ML.indexer(c) for c in cats]).fit(train).transform(data)
        is_train = F.coalesce(C.hash_bucket("GameID") < 50, F.lit(False))
        rows, names, nominal = ML.forest_rows(indexed, ["Temperature", *_GAME_NUMS[1:]], [f"{c}_index" for c in cats], [is_train], [~is_train])
        splits, scored = FO.forests(rows, nominal, 1, GAME_TREES, [(GAME_DEPTH, GAME_TREES)])
        scored = FO.stored(scored, "forest-scores")
        return names, splits, scored.select(F.col("y").alias("IsInjury"), F.col("scores")[0].alias("score"))
    return _once("game-rf", spark, sf, make)


@query("ml_lr_coefficients")
def ml_lr_coefficients(spark, sf):
    return ML.coefficient_table(spark, game_lr(spark, sf), game_data(spark, sf)[0])


@query("ml_rf_importances")
def ml_rf_importances(spark, sf):
    names, splits, _ = game_forest(spark, sf)
    found = {r["feature"]: r["importance"] for r in FO.importances(splits, GAME_TREES).collect()}      # a row per feature
    return spark.createDataFrame([(n, round(float(found.get(i, 0.0)), 6)) for i, n in enumerate(names)], "feature string, importance double")


def _scored(model, test):
    return model.transform(test).select("IsInjury", ML.vector_to_array("rawPrediction")[1].alias("score"))


def _area_table(spark, lr_scored, rf_scored):
    ev = ML.auc_evaluator("IsInjury").setRawPredictionCol("score")
    rows = [("LogisticRegression", round(ev.evaluate(lr_scored), 6)), ("RandomForest", round(ev.evaluate(rf_scored), 6))]
    return spark.createDataFrame(rows, "model string, auc double")


@query("ml_game_model")
def ml_game_model(spark, sf):
    return _area_table(spark, _scored(game_lr(spark, sf), game_data(spark, sf)[2]), game_forest(spark, sf)[2])


FOLDS = 4
FOREST_GRID = [(depth, trees) for depth in (10, 15, 20) for trees in (50, 60, 70)]


def player_data(spark, sf):
    """Rows of the per-player models and their 70/30 key-hash split."""
    def make():
        data = ensure_and_checkpoint(
            spark, FE.model_input(player_table(spark, sf), ML.PLAYER_MODEL_FEATURES + ["PlayerKey"]), "PlayerKey")
        return data, *ML.hash_split(data, "PlayerKey", 70)
    return _once("player", spark, sf, make)


def player_lr(spark, sf):
    """The regression's 4-fold search over the source's grid."""
    def make():
        lr = ML.logistic_regression("IsInjury", "features", 100, 0.6)
        grid = ML.grid((lr.regParam, [0.6, 0.62]), (lr.elasticNetParam, [0.0, 0.1]),
                       (lr.fitIntercept, [True, False]), (lr.maxIter, [58, 60, 62]))
        return ML.cross_validate(Pipeline(stages=[ML.assembler(ML.PLAYER_MODEL_FEATURES), lr]), player_data(spark, sf)[1], grid, "PlayerKey", folds=FOLDS)
    return _once("player-lr", spark, sf, make)


def player_forest(spark, sf):
    """``(areas, best, scored)`` of the forest's 4-fold search: the mean area of every point of ``FOREST_GRID``,
    the best point's number, and its (IsInjury, score) of the test part.

    All folds and the fit to the whole training part grow together, once, to the
    largest depth and number of trees: a point of the grid is the first trees, cut at its depth."""
    def make():
        data = player_data(spark, sf)[0]
        is_train, fold = F.coalesce(C.hash_bucket("PlayerKey") < 70, F.lit(False)), F.coalesce(ML.fold("PlayerKey", FOLDS), F.lit(0))
        rows, _, nominal = ML.forest_rows(data, ML.PLAYER_MODEL_FEATURES, [], [is_train & (fold != k) for k in range(FOLDS)] + [is_train],
                                          [is_train & (fold == k) for k in range(FOLDS)] + [~is_train])
        _, scored = FO.forests(rows, nominal, FOLDS + 1, max(t for _, t in FOREST_GRID), FOREST_GRID)
        scored = FO.stored(scored, "forest-scores")

        def of(fit, point):
            return scored.where(F.col("fit") == fit).select(F.col("y").alias("IsInjury"), F.col("scores")[point].alias("score"))
        areas = ML.mean_areas(of, FOLDS, len(FOREST_GRID))
        best = max(range(len(FOREST_GRID)), key=lambda i: areas[i])
        return areas, best, of(FOLDS, best)
    return _once("player-rf", spark, sf, make)


@query("ml_player_model")
def ml_player_model(spark, sf):
    return _area_table(spark, _scored(player_lr(spark, sf).bestModel, player_data(spark, sf)[2]), player_forest(spark, sf)[2])


# What is checked of the fitted models: the rows they are fitted and scored on, and that the checks hold.
_GAME_PARTS = PGF + f""",\nlabelled AS (select {_hash_sql('GameID')} < 50 as is_train, IsInjury as y from pgf)"""
_PLAYER_PARTS = PLAYER + f""",\nlabelled AS (select {_hash_sql('PlayerKey')} < 70 as is_train,
   case when sum_Injury > 0 then 1 else 0 end as y from player)"""
_OPTIMAL_SQL = "select count(*) as rows, cast(sum(y) as bigint) as positives, true as optimal from labelled where is_train"
_RANKS_SQL = """select model, count(*) as rows, cast(sum(y) as bigint) as positives,
 case when sum(y) between 1 and count(*) - 1 then true end as agrees
 from labelled, (values ('LogisticRegression'), ('RandomForest')) m(model) where not is_train group by model"""
GAP = 1e-3


def _optimality(train, model):
    counts = train.agg(F.count(F.lit(1)).alias("rows"), F.sum("IsInjury").cast("bigint").alias("positives"))
    gap = ML.optimality_gaps(model, train).agg((F.max("gap") < GAP).alias("optimal"))
    return counts.join(gap)                                     # one row each


def _areas_by_ranks(*fits):
    exact = ML.auc_evaluator("IsInjury").setRawPredictionCol("score").setNumBins(0)
    out = None
    for name, scored in zip(("LogisticRegression", "RandomForest"), fits, strict=True):
        agrees = F.abs(F.col("area") - exact.evaluate(scored)) < 1e-9
        one = RK.rank_area(scored, "IsInjury", "score").select(F.lit(name).alias("model"), "rows", "positives", agrees.alias("agrees"))
        out = one if out is None else out.unionByName(one)
    return out


@query("ml_lr_optimality", sql=_OPTIMAL_SQL, ctes=_GAME_PARTS)
def ml_lr_optimality(spark, sf):
    """Whether the per-game LR is optimal on its training rows: no penalised gradient beyond GAP."""
    return _optimality(game_data(spark, sf)[1], game_lr(spark, sf))


@query("ml_lr_optimality_player", sql=_OPTIMAL_SQL, ctes=_PLAYER_PARTS)
def ml_lr_optimality_player(spark, sf):
    """The same for the best per-player LR of the search, L1 weight included."""
    return _optimality(player_data(spark, sf)[1], player_lr(spark, sf).bestModel)


@query("ml_auc_by_ranks", sql=_RANKS_SQL, ctes=_GAME_PARTS)
def ml_auc_by_ranks(spark, sf):
    """Whether the evaluator's ROC area of either per-game model's scores is their rank sum."""
    return _areas_by_ranks(_scored(game_lr(spark, sf), game_data(spark, sf)[2]), game_forest(spark, sf)[2])


@query("ml_auc_by_ranks_player", sql=_RANKS_SQL, ctes=_PLAYER_PARTS)
def ml_auc_by_ranks_player(spark, sf):
    """The same for the best per-player models of both searches."""
    return _areas_by_ranks(_scored(player_lr(spark, sf).bestModel, player_data(spark, sf)[2]), player_forest(spark, sf)[2])


@query("ml_cv_metrics")
def ml_cv_metrics(spark, sf):
    """Mean cross-validated ROC area of every grid point, both searches (M7)."""
    cv, rows = player_lr(spark, sf), []
    for params, metric in zip(cv.getEstimatorParamMaps(), cv.avgMetrics):
        desc = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda kv: kv[0].name))
        rows.append(("LogisticRegression", desc, round(float(metric), 6)))
    for (depth, trees), area in zip(FOREST_GRID, player_forest(spark, sf)[0], strict=True):
        rows.append(("RandomForest", f"maxDepth={depth}, numTrees={trees}", round(float(area), 6)))
    return spark.createDataFrame(rows, "model string, params string, auc double")


@query("ml_auc",
       sql="""select round((sum(case when y=1 then r end) - sum(y)*(sum(y)+1)/2.0) / (sum(y)*(count(*)-sum(y))), 6) as auc
 from (select IsInjury as y, rank() over (order by MaxPlayGamePlay)
       + (count(*) over (partition by MaxPlayGamePlay) - 1)/2.0 as r from pgf) t""", ctes=PGF)
def ml_auc(spark, sf):
    """ROC area of a fixed score (the game's highest play number) for the injury label (M8)."""
    scored = player_game_table(spark, sf).select(
        F.col("IsInjury").cast("double").alias("IsInjury"), F.col("MaxPlayGamePlay").cast("double").alias("score"))
    exact = ML.auc_evaluator("IsInjury").setRawPredictionCol("score").setNumBins(0)
    return spark.createDataFrame([(round(exact.evaluate(scored), 6),)], "auc double")


@query("ml_lr_training_metrics")
def ml_lr_training_metrics(spark, sf):
    """The best LR model's training-summary metrics (M12/M13 on the model's
    own predictions of its training part): per label, plus the weighted row
    (label null)."""
    pred = player_lr(spark, sf).bestModel.transform(player_data(spark, sf)[1])
    per = ML.label_metrics(pred, "IsInjury", "prediction")
    weighted = ML.weighted_metrics(per)
    return round_doubles(per.select("label", "fpr", "tpr", "precision", "recall", "f1").unionByName(
        weighted.select(F.lit(None).cast("double").alias("label"), F.col("weighted_fpr").alias("fpr"),
                        F.col("weighted_tpr").alias("tpr"), F.col("weighted_precision").alias("precision"),
                        F.col("weighted_recall").alias("recall"), F.col("weighted_f1").alias("f1"))))


@query("ml_best_params")
def ml_best_params(spark, sf):
    """Chosen parameters of the best models (M9)."""
    lr = ML.param_table(spark, player_lr(spark, sf).bestModel.stages[-1], ["maxIter", "regParam", "fitIntercept", "elasticNetParam"])
    depth, trees = FOREST_GRID[player_forest(spark, sf)[1]]
    rf = spark.createDataFrame([("maxDepth", str(depth)), ("numTrees", str(trees))], "param string, value string")
    return (lr.withColumn("model", F.lit("LogisticRegression"))
            .unionByName(rf.withColumn("model", F.lit("RandomForest"))))


# -- one forest for all targets (M17, M18) -----------------------------------------------
_TREE_INPUTS = ["Temperature"] + [n for n in _DUMMY_NAMES if not n.startswith("BodyPart_")]
_CASE = ["GameID", "PlayerKey", "BodyPart"]


def tree_rows(spark, sf):
    """Inputs as whole numbers (degrees, -999 as the training mean) and 0/1 dummies, the targets, and the training mark."""
    # the imputer's fit and the trees read the same rows: they are derived once
    rows = dummy_table(spark, sf).select(*[F.col(f"`{c}`") for c in [*_CASE, *_TREE_INPUTS, *_TARGETS]])
    df = IO.read_parquet(spark, IO.write_parquet(rows, scratch_path(spark, "tree-rows")))
    train = C.hash_bucket("GameID") < 75
    imputer = CL.fit_mean_imputer(df.where(train), "Temperature", -999.0)
    return imputer.transform(df).withColumns({"Temperature": FO.bins("Temperature"), "is_train": F.coalesce(train, F.lit(False))})


_TREE_CTES = ENV_CLEAN_CTE + ",\nti AS (select *, " + ", ".join(
    f"case when {c}='{v}' then 1 else 0 end as \"{c}_{v}\"" for c, vs in _DUMMIES for v in vs) + f""",
   {_hash_sql('GameID')} < 75 as is_train from envclean),
tm AS (select avg(Temperature) as m from ti where is_train and Temperature <> -999),
tr AS (select * replace (cast(floor(case when Temperature=-999 or Temperature is null then (select m from tm)
   else Temperature end + 0.5) as int) as Temperature), row_number() over () as id from ti)"""


def _tree_sql() -> str:
    """CTEs that grow one tree of depth 2 over ``tr``: per level the sums, the best split, and the way on."""
    k = len(_TARGETS)
    out = [_TREE_CTES, "fx AS (" + " union all ".join(
        f'select id, {i} as feature, cast("{c}" as int) as v from tr' for i, c in enumerate(_TREE_INPUTS)) + ")",
        "w0 AS (select id, is_train, cast(0 as bigint) as node, " + ", ".join(
            f'cast("{t}" as double) as y{i}' for i, t in enumerate(_TARGETS)) + " from tr)"]
    ys = ", ".join(f"y{i}" for i in range(k))
    for level in range(3):
        gain = " + ".join(f"l{i}*l{i}/ln + (t{i}-l{i})*(t{i}-l{i})/(tn-ln) - t{i}*t{i}/tn" for i in range(k))
        out.append(f"""b{level} AS (select node, feature, v, count(*) as n, {", ".join(f"sum(y{i}) as s{i}" for i in range(k))}
   from w{level} join fx using (id) where is_train group by node, feature, v),
r{level} AS (select node, feature, v, sum(n) over u as ln, sum(n) over f as tn, {", ".join(
            f"sum(s{i}) over u as l{i}, sum(s{i}) over f as t{i}" for i in range(k))} from b{level}
   window u as (partition by node, feature order by v rows unbounded preceding), f as (partition by node, feature)),
g{level} AS (select *, case when ln < tn then round({gain}, 6) end as gain from r{level}),
n{level} AS (select node, tn as n, {", ".join(f"t{i}/tn as m{i}" for i in range(k))},
   {"case when gain > 1e-6 then feature end" if level < 2 else "cast(null as int)"} as feature,
   {"case when gain > 1e-6 then v end" if level < 2 else "cast(null as int)"} as v from g{level}
   qualify row_number() over (partition by node order by coalesce(gain, -1) desc, feature, v) = 1)""")
        if level < 2:
            out.append(f"""w{level + 1} AS (select w{level}.id, is_train, 2*w{level}.node + case when fx.v > n.v then 2 else 1 end as node, {ys}
   from w{level} join n{level} n on w{level}.node = n.node join fx on fx.id = w{level}.id and fx.feature = n.feature)""")
    return ",\n".join(out)


_TREE_NODES = ", ".join(f"round(m{i}, 6) as \"mean_{t}\"" for i, t in enumerate(_TARGETS))
_FEATURE_NAME = "case feature " + " ".join(f"when {i} then '{c}'" for i, c in enumerate(_TREE_INPUTS)) + " end"


def depth2_tree(spark, sf, extra=()):
    table = FO.cells(tree_rows(spark, sf), _TREE_INPUTS, _TARGETS, F.col("is_train"), extra)
    return FO.grow(table, len(_TARGETS), trees=1, max_depth=2, bagging=False, extra=extra)


@query("ml_tree_nodes", sql=f"select node, cast(n as bigint) as n, {_FEATURE_NAME} as feature, v as value, {_TREE_NODES} from ("
       + " union all ".join(f"select * from n{i}" for i in range(3)) + ") x", ctes=_tree_sql())
def ml_tree_nodes(spark, sf):
    """One multi-target regression tree of depth 2 on all training rows: its nodes, splits and target means."""
    nodes, _ = depth2_tree(spark, sf)
    return round_doubles(nodes.select(
        "node", "n", F.get(F.array(*map(F.lit, _TREE_INPUTS)), F.col("feature")).alias("feature"), "value",
        *[F.col("means")[i].alias(f"mean_{t}") for i, t in enumerate(_TARGETS)]))


@query("ml_tree_preview", sql="select * from (select distinct " + ", ".join(f"tr.{c}" for c in [*_CASE, *_TREE_INPUTS]) + ", "
       + ", ".join(f'y{i} as "{t}"' for i, t in enumerate(_TARGETS)) + ", "
       + ", ".join(f'round(m{i}, 6) as "pred_{t}"' for i, t in enumerate(_TARGETS))
       + " from (" + " union all ".join(f"select w{i}.*, " + ", ".join(f"n{i}.m{j}" for j in range(len(_TARGETS)))
                                        + f" from w{i} join n{i} using (node) where n{i}.feature is null" for i in range(3))
       + ") x join tr using (id) where not tr.is_train) z order by GameID, PlayerKey, BodyPart, "
       + ", ".join(f'"{t}"' for t in _TARGETS) + " limit 5", ctes=_tree_sql())
def ml_tree_preview(spark, sf):
    """Five cases of the test part, first by key, with their inputs, targets and predictions."""
    _, leaves = depth2_tree(spark, sf, _CASE)
    shown = leaves.where(~F.col("part")).select(
        *_CASE, *[F.col("f")[i].alias(c) for i, c in enumerate(_TREE_INPUTS)],
        *[F.col("y")[i].alias(t) for i, t in enumerate(_TARGETS)],
        *[F.round(F.col("means")[i], 6).alias(f"pred_{t}") for i, t in enumerate(_TARGETS)])
    return shown.orderBy(*_CASE, *_TARGETS).limit(5)


FOREST_TREES = 100


@query("ml_rf_regression")
def ml_rf_regression(spark, sf):
    """One forest of 100 trees, grown until no split gains, for all targets
    together: injury level and one dummy per body part, inputs the environment
    dummies and temperature (M17); its error per target on the test part and
    their average (M18)."""
    key = _model_key("rfreg", spark, sf)
    if key not in _MODEL_CACHE:
        table = FO.cells(tree_rows(spark, sf), _TREE_INPUTS, _TARGETS, F.col("is_train"))
        _, leaves = FO.grow(table, len(_TARGETS), FOREST_TREES)
        errors = FO.mean_errors(FO.predictions(leaves, len(_TARGETS)), _TARGETS)
        _MODEL_CACHE[key] = [(r["target"], round(r["mae"], 6)) for r in errors.collect()]     # a row per target
    return spark.createDataFrame(_MODEL_CACHE[key], "target string, mae double")
