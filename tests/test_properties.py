"""Property tests: the native category rules equal the UDF semantics of the
source (first list containing the value wins, else the fallback; None is in
no list), and the density histogram equals NumPy's."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from playtrack.functions.rules import (KEEP, STADIUM_FIVE_WAY, STADIUM_OPEN_CLOSED, STADIUM_THREE_WAY,
                                       STADIUM_TWO_WAY, WEATHER_FIVE_WAY, WEATHER_QUALITY, WEATHER_THREE_WAY,
                                       categorize)
from playtrack.operators import reports as R

RULE_SETS = [(STADIUM_FIVE_WAY, KEEP), (WEATHER_FIVE_WAY, KEEP), (STADIUM_THREE_WAY, "Unknown"),
             (STADIUM_TWO_WAY, "Unknown"), (WEATHER_THREE_WAY, "Unknown"), (WEATHER_QUALITY, "Unknown"),
             (WEATHER_QUALITY, KEEP), (STADIUM_OPEN_CLOSED, KEEP)]
ALL_VALUES = sorted({v for rules, _ in RULE_SETS for _, vs in rules for v in vs})


def python_rule(value, rules, default):
    for label, values in rules:
        if value in values:
            return label
    return value if default is KEEP else default


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ALL_VALUES), st.text(max_size=12), st.none()), min_size=1, max_size=40))
def test_categorize_equals_udf_semantics(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for i, (rules, default) in enumerate(RULE_SETS):
        df = df.withColumn(f"g{i}", categorize("v", rules, default))
    for row in df.collect():
        for i, (rules, default) in enumerate(RULE_SETS):
            assert row[f"g{i}"] == python_rule(row.v, rules, default)


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(7)
    values = np.round(rng.normal(180.0, 90.0, 2000), 3)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = sorted((r.bin, r.n, r.density) for r in R.histogram(df, "v", bins=100).collect())
    counts, edges = np.histogram(values, bins=100, density=False)
    dens, _ = np.histogram(values, bins=100, density=True)
    want = [(i, int(c), float(d)) for i, (c, d) in enumerate(zip(counts, dens)) if c]
    assert [(b, n) for b, n, _ in got] == [(b, n) for b, n, _ in want]
    assert all(math.isclose(a[2], b[2], rel_tol=1e-9) for a, b in zip(got, want))
