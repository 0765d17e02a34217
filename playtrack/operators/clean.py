"""Cleaning: fills, sentinels, category rules, imputation."""

from __future__ import annotations

from pyspark.ml.feature import Imputer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import (KEEP, PLAY_TEXT_COLUMNS, STADIUM_FIVE_WAY, WEATHER_FIVE_WAY, categorize)


def fill_text(df: DataFrame, value: str = "Missing", cols=PLAY_TEXT_COLUMNS) -> DataFrame:
    """Null text -> ``value`` in the given columns."""
    return df.na.fill(value, subset=list(cols))


def fill_numbers(df: DataFrame, value=0, cols=None) -> DataFrame:
    """Null numbers -> ``value`` (all numeric columns when ``cols`` is None)."""
    return df.na.fill(value) if cols is None else df.na.fill(value, subset=list(cols))


def replace_sentinel(df: DataFrame, col: str, sentinel, replacement) -> DataFrame:
    """``col == sentinel`` -> ``replacement``; other values (and null) are kept."""
    return df.withColumn(col, F.when(F.col(col) == sentinel, replacement).otherwise(F.col(col)))


def replace_below(df: DataFrame, col: str = "Temperature", bound: float = 0, replacement: float = 61) -> DataFrame:
    """Values below ``bound`` -> ``replacement`` (the -999 sentinel becomes 61 degrees)."""
    return df.withColumn(col, F.when(F.col(col) < bound, replacement).otherwise(F.col(col)))


def with_category(df: DataFrame, col: str, rules, default=KEEP, out: str | None = None) -> DataFrame:
    """Apply a rule set from ``functions.rules`` to ``col`` (into ``out`` or in place)."""
    return df.withColumn(out or col, categorize(col, rules, default))


def try_number(df: DataFrame, col: str, to: str = "double") -> DataFrame:
    """Text -> number; text that is not a number becomes null."""
    return df.withColumn(col, F.expr(f"try_cast(`{col}` as {to})"))


def clean_plays(plays: DataFrame) -> DataFrame:
    """Play-list cleaning of the feature job: fills, PlayType "0", stadium and weather
    five-way rules, negative temperature -> 61."""
    df = fill_text(plays, "Missing", PLAY_TEXT_COLUMNS)
    df = replace_sentinel(df, "PlayType", "0", "Missing")
    df = with_category(df, "StadiumType", STADIUM_FIVE_WAY)
    df = with_category(df, "Weather", WEATHER_FIVE_WAY)
    return replace_below(df, "Temperature", 0, 61)


def fit_mean_imputer(train: DataFrame, col: str, missing: float = -999.0, out: str | None = None):
    """Mean of ``col`` over ``train`` ignoring ``missing`` and nulls (one aggregate
    job); the returned model replaces both with it on any DataFrame."""
    imputer = Imputer(inputCols=[col], outputCols=[out or col], strategy="mean", missingValue=missing)
    return imputer.fit(train)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()
