"""Report invariants: histogram mass, shares, metrics, hash split."""

import math

from pyspark.sql import functions as F

from playtrack.functions import columns as C
from playtrack.operators import ml as ML
from playtrack.operators import reports as R


def test_histogram_mass_and_edges(spark):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 10, None]],
                               "v double")
    h = R.histogram(df, "v", bins=5).collect()
    assert sum(r.n for r in h) == 10
    assert math.isclose(sum(r.density * (r.hi - r.lo) for r in h), 1.0)
    assert max(r.bin for r in h) == 4          # the max value falls in the last (closed) bin


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    h = R.histogram(df, "v", bins=100).collect()
    assert [(r.bin, r.n) for r in h] == [(0, 2)]


def test_shares_add_to_100(spark):
    df = spark.createDataFrame([("a", True, 3), ("b", True, 1), ("a", False, 5)], "m string, g boolean, count long")
    s = R.share_of_total(df, "count", ["g"]).groupBy("g").agg(F.sum("share").alias("t")).collect()
    assert all(math.isclose(r.t, 100.0) for r in s)


def test_label_metrics(spark):
    rows = [(1.0, 1.0)] * 3 + [(1.0, 0.0)] * 1 + [(0.0, 1.0)] * 2 + [(0.0, 0.0)] * 4
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = {r.label: r for r in ML.label_metrics(df).collect()}
    assert m[1.0].tpr == 0.75 and m[1.0].precision == 0.6 and math.isclose(m[1.0].fpr, 2 / 6)
    assert m[0.0].tpr == 4 / 6 and m[0.0].support == 6 and m[0.0].total == 10
    w = ML.weighted_metrics(ML.label_metrics(df)).first()
    assert math.isclose(w.accuracy, 0.7)


def test_hash_split_is_a_partition(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    train, test = ML.hash_split(df, "k", 70)
    a, b = train.count(), test.count()
    assert a + b == 2000 and train.join(test, "k").count() == 0 and 1200 < a < 1600
    assert df.select(C.hash_bucket("k").alias("b")).agg(F.min("b"), F.max("b")).first() == (0, 99)
