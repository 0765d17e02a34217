"""Report tables: grouped counts, shares, histograms, chart data.

Every report is a distributed aggregate (partial aggregation before the
shuffle); nothing is collected to the driver.  Plot drawing is not built — the
numbers behind each plot are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """``groupBy(keys).count()`` with a BIGINT count column named ``name``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_plot_data(df: DataFrame, x: str, hue: str | None = None, facet: str | None = None) -> DataFrame:
    """The bars of a count plot: one row per (facet, x, hue) with its count."""
    keys = [k for k in (facet, x, hue) if k is not None]
    return count_by(df, *keys)


def distinct_count_by(df: DataFrame, key: str, of: str, name: str = "count") -> DataFrame:
    """Distinct ``(key, of)`` pairs counted per ``key``."""
    return count_by(df.select(key, of).distinct(), key, name=name)


def non_null_counts(df: DataFrame) -> DataFrame:
    """Non-null count of every column, one row (A10)."""
    return df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])


def distinct_counts(df: DataFrame, cols: dict) -> DataFrame:
    """``{output name: column}`` -> one row of exact distinct counts."""
    return df.agg(*[F.countDistinct(F.col(c)).alias(n) for n, c in cols.items()])


def share_of_total(df: DataFrame, count_col: str, within: list, name: str = "share") -> DataFrame:
    """Each count as a percentage of its group's total (shares add to 100)."""
    w = Window.partitionBy(*within) if within else Window.partitionBy()
    return df.withColumn(name, F.col(count_col) * 100.0 / F.sum(count_col).over(w))


def histogram(df: DataFrame, col: str, bins: int = 100, label: str | None = None) -> DataFrame:
    """Equal-width density histogram of ``col`` over its own [min, max].

    One pass over ``df`` makes (value, count) runs, which merge (partial
    aggregate); bounds, total and bins all follow from the runs, whose one
    shuffle both readers share.  Bins are ``floor((v-min)/width)`` with the
    last bin closed (``least(bin, bins-1)``); density is ``count / (n * width)``
    so the mass sums to 1.  A constant column gives one bin.  Only non-null
    values count.  Output: ``bin, lo, hi, n, density``.  The bounds are joined
    back as a one-row table (a proven size bound of one row), so no value
    passes through the driver.
    """
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    runs = v.groupBy("v").agg(F.count(F.lit(1)).alias("_n"))
    stats = runs.agg(F.min("v").alias("vmin"), F.max("v").alias("vmax"), F.sum("_n").alias("total"),
                     F.lit(1).alias("_k"))
    width = F.when(F.col("vmax") > F.col("vmin"), (F.col("vmax") - F.col("vmin")) / bins).otherwise(F.lit(1.0))
    b = F.least(F.floor((F.col("v") - F.col("vmin")) / width), F.lit(bins - 1)).cast("int")
    binned = (runs.withColumn("_k", F.lit(1)).join(F.broadcast(stats), "_k")
              .withColumn("bin", b).withColumn("width", width))
    out = (binned.groupBy("bin", "vmin", "width", "total")
           .agg(F.sum("_n").alias("n"))
           .select("bin",
                   (F.col("vmin") + F.col("bin") * F.col("width")).alias("lo"),
                   (F.col("vmin") + (F.col("bin") + 1) * F.col("width")).alias("hi"),
                   "n",
                   (F.col("n") / (F.col("total") * F.col("width"))).alias("density")))
    return out if label is None else out.withColumn("series", F.lit(label))


def mean_by(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(col).alias(name))


def percent_true_by(df: DataFrame, key: str, pivot: str, flag: str, values=(False, True)) -> DataFrame:
    """Mean of a boolean x 100 per ``key``, one column per ``pivot`` value."""
    return (df.groupBy(key).pivot(pivot, list(values))
            .agg((F.avg(F.col(flag).cast("int")) * 100).alias("pct")))


def dummies(df: DataFrame, col: str, values, prefix: str | None = None) -> DataFrame:
    """One 0/1 column per value of a fixed list (``pd.get_dummies`` on Spark)."""
    p = prefix or col
    return df.withColumns({f"{p}_{v}": F.when(F.col(col) == v, 1).otherwise(0) for v in values})
