"""Category rules: semantics of null / unknown / keep, and SQL parity."""

import duckdb
from pyspark.sql import functions as F

from playtrack.functions.rules import (KEEP, STADIUM_FIVE_WAY, STADIUM_TWO_WAY, WEATHER_FIVE_WAY, WEATHER_QUALITY,
                                       WEATHER_THREE_WAY, categorize, categorize_sql)

VALUES = ["Outdoor", "Domed, Open", "Ourdoor", "Indoors", "Cloudy", 'Cloudy, light snow accumulating 1-3""',
          'Cloudy, light snow accumulating 1-3"', "Controlled Climate", "Snow", "nonsense", None, "0"]


def _spark_map(spark, rules, default):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    return {r.v: r.g for r in df.select("v", categorize("v", rules, default).alias("g")).collect()}


def _duck_map(rules, default):
    con = duckdb.connect()
    con.execute("create table t(v varchar)")
    con.executemany("insert into t values (?)", [(v,) for v in VALUES])
    return dict(con.sql(f"select v, {categorize_sql('v', rules, default)} from t").fetchall())


def test_keep_and_default(spark):
    keep = _spark_map(spark, STADIUM_FIVE_WAY, KEEP)
    assert keep["Outdoor"] == "outdoor" and keep["Domed, Open"] == "dome_open"
    assert keep["nonsense"] == "nonsense" and keep[None] is None
    unknown = _spark_map(spark, STADIUM_TWO_WAY, "Unknown")
    assert unknown[None] == "Unknown" and unknown["nonsense"] == "Unknown"
    assert unknown["Outdoor"] == "Open" and unknown["Ourdoor"] == "Unknown"


def test_quote_variants_are_distinct(spark):
    five = _spark_map(spark, WEATHER_FIVE_WAY, KEEP)
    assert five['Cloudy, light snow accumulating 1-3""'] == "snow"
    assert five['Cloudy, light snow accumulating 1-3"'] == 'Cloudy, light snow accumulating 1-3"'
    three = _spark_map(spark, WEATHER_THREE_WAY, "Unknown")
    assert three['Cloudy, light snow accumulating 1-3"'] == "Cloudy"
    quality = _spark_map(spark, WEATHER_QUALITY, "Unknown")
    assert quality["Controlled Climate"] == "Normal"
    assert five["Controlled Climate"] == "Missing"


def test_cloudy_is_stadium_and_weather(spark):
    assert _spark_map(spark, STADIUM_FIVE_WAY, KEEP)["Cloudy"] == "outdoor"
    assert _spark_map(spark, WEATHER_FIVE_WAY, KEEP)["Cloudy"] == "overcast"


def test_rules_spark_equals_sql(spark):
    """Spark and DuckDB agree on every value for every rule set."""
    for rules, default in [(STADIUM_FIVE_WAY, KEEP), (WEATHER_FIVE_WAY, KEEP), (STADIUM_TWO_WAY, "Unknown"),
                           (WEATHER_QUALITY, "Unknown"), (WEATHER_THREE_WAY, "Unknown")]:
        assert _spark_map(spark, rules, default) == _duck_map(rules, default)


def test_no_python_udf_in_rule_plan(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    plan = df.select(categorize(F.col("v"), WEATHER_QUALITY, "Unknown"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
