"""Checks that the fitted models' reports can fail: planted signal, best point of the grid, sums, sort orders."""

import os

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from __spark_entry__ import queries
from playtrack.operators import ml as ML

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def planted(spark):
    """``signal`` decides the label, ``noise`` does not."""
    n = F.xxhash64("id", F.lit("noise")) % 1000
    return spark.range(600).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 2).cast("double").alias("IsInjury"),
        (F.col("id") % 2 * 2.0 + F.abs(F.xxhash64("id") % 100) / 100.0).alias("signal"), (n / 1000.0).alias("noise"))


def test_names_follow_the_input_slots(spark, planted):
    assembler = ML.assembler(["noise", "signal"])
    lr = Pipeline(stages=[assembler, ML.logistic_regression("IsInjury", "features", 50, 0.01)]).fit(planted)
    weights = {r["feature"]: r["coefficient"] for r in ML.coefficient_table(spark, lr, planted).collect()}
    assert weights["signal"] > 1 and abs(weights["noise"]) < weights["signal"] / 3
    rf = Pipeline(stages=[assembler, ML.random_forest("IsInjury", "features", 20, 5)]).fit(planted)
    parts = {r["feature"]: r["importance"] for r in ML.importance_table(spark, rf, planted).collect()}
    assert parts["signal"] > 0.9 and abs(sum(parts.values()) - 1) < 1e-4
    assert ML.auc_evaluator("IsInjury").evaluate(rf.transform(planted)) > 0.99


def test_search_takes_the_best_point_and_repeats(spark, planted):
    lr = ML.logistic_regression("IsInjury", "features", 50, 0.01)
    grid = ML.grid((lr.regParam, [0.0, 0.5]), (lr.maxIter, [1, 30]))
    runs = [ML.cross_validate(Pipeline(stages=[ML.assembler(["noise", "signal"]), lr]), data, grid, "k", parallelism=p)
            for data, p in ((planted, 1), (planted.repartition(7), 4))]
    assert runs[0].avgMetrics == pytest.approx(runs[1].avgMetrics, abs=1e-6)
    best = max(range(len(grid)), key=lambda i: runs[0].avgMetrics[i])
    for param, value in grid[best].items():
        assert runs[0].bestModel.stages[-1].getOrDefault(param.name) == value


def test_the_search_finds_spark_s_areas_in_few_passes(spark, monkeypatch):
    """Against a fit of Spark's for every fold and point; a feature without variance, and points that differ in ``maxIter`` alone."""
    n = [F.xxhash64("id", F.lit(c)) % 100 / 100.0 for c in "abc"]
    data = spark.range(400).select(F.col("id").cast("string").alias("k"), n[0].alias("a"), (n[1] * 500 + 90).alias("b"), F.lit(3.0).alias("c"),
                                   (n[0] * 2 + n[1] + 3 * n[2] > 0.4).cast("double").alias("IsInjury"))
    lr = ML.logistic_regression("IsInjury", "features", 100, 0.1)
    grid = ML.grid((lr.regParam, [0.01, 0.3]), (lr.elasticNetParam, [0.0, 0.1]), (lr.fitIntercept, [True, False]), (lr.maxIter, [98, 100]))
    assembler = ML.assembler(["a", "b", "c"])
    passes, plain = [], ML.RG._sums
    monkeypatch.setattr(ML.RG, "_sums", lambda rows, models, scale: passes.append(len(models)) or plain(rows, models, scale))
    found = ML.cross_validate(Pipeline(stages=[assembler, lr]), data, grid, "k")
    assert len(passes) < 20 and passes[0] == 2 * 2 * 2 * 4
    assert found.getEstimatorParamMaps() == grid and found.avgMetrics[::2] == found.avgMetrics[1::2]
    rows, ev = assembler.transform(data).withColumn("_fold", ML.fold("k")).cache(), ML.auc_evaluator("IsInjury")
    for i in (0, 2, 4, 6, 8, 14):
        areas = [ev.evaluate(lr.fit(rows.where(F.col("_fold") != k), {**grid[i], lr.tol: 1e-10}).transform(rows.where(F.col("_fold") == k)))
                 for k in range(4)]
        assert found.avgMetrics[i] == pytest.approx(sum(areas) / 4, abs=1e-4)


def test_registered_model_reports(spark):
    q = queries()
    best = {(r["model"], r["param"]): r["value"] for r in q["ml_best_params"](spark, SF).select("model", "param", "value").collect()}
    for model in ("LogisticRegression", "RandomForest"):
        points = [r for r in q["ml_cv_metrics"](spark, SF).collect() if r["model"] == model]
        top = max(r["auc"] for r in points)
        shown = [dict(x.split("=") for x in r["params"].split(", ")) for r in points if r["auc"] >= top - 1e-6]
        own = {p: str(v) for (m, p), v in best.items() if m == model}
        assert any(all(float(own[k].replace("True", "1").replace("true", "1").replace("False", "0").replace("false", "0"))
                       == float(v.replace("True", "1").replace("False", "0")) for k, v in s.items()) for s in shown)
    importances = [r["importance"] for r in q["ml_rf_importances"](spark, SF).collect()]
    assert abs(sum(importances) - 1) < 1e-4
    errors = {r["target"]: r["mae"] for r in q["ml_rf_regression"](spark, SF).collect()}
    mean = errors.pop("average")
    assert abs(mean - sum(errors.values()) / len(errors)) < 1e-5


def test_sorted_reports_are_in_order(spark):
    rows = queries()["injury_by_roster_position"](spark, SF).collect()
    keys = [(-r["Severity"], r["RosterPosition"] is not None, r["RosterPosition"] or "") for r in rows]
    assert keys == sorted(keys) and len(keys) > 3
