"""Column expressions shared by the operators (all native Spark, codegen-able)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DM_COLUMNS = ["DM_M1", "DM_M7", "DM_M28", "DM_M42"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def severity(cols=DM_COLUMNS) -> Column:
    """Sum of the cumulative missed-days flags: a 1-4 grade (null if any is null)."""
    expr = _c(cols[0])
    for c in cols[1:]:
        expr = expr + _c(c)
    return expr


def severity_from_text(cols=DM_COLUMNS) -> Column:
    """Same grade from text columns: cast each (bad text -> null), then add."""
    expr = F.expr(f"try_cast({cols[0]} as int)")
    for c in cols[1:]:
        expr = expr + F.expr(f"try_cast({c} as int)")
    return expr.cast("int")


def severity_level(sev="Severity", threshold: int = 3) -> Column:
    return F.when(_c(sev) >= threshold, "H").otherwise("L")


def positive_flag(col) -> Column:
    """1 when the value is above 0, else 0 (null -> 0)."""
    return F.when(_c(col) > 0, 1).otherwise(0)


def season(player_day="PlayerDay", cut: int = 350) -> Column:
    return F.when(_c(player_day) < cut, 1).otherwise(2)


def game_id_from_play_key(play_key="PlayKey") -> Column:
    """``<player>-<game>-<play>`` -> ``<player>-<game>`` (split with limit 3)."""
    parts = F.split(_c(play_key), "-", 3)
    return F.concat(parts.getItem(0), F.lit("-"), parts.getItem(1))


def angle_gap_plain(o="o", direction="dir") -> Column:
    return F.abs(_c(o) - _c(direction))


def angle_gap(o="o", direction="dir") -> Column:
    """Circular gap between orientation and direction (degrees)."""
    o_, d_ = _c(o), _c(direction)
    return F.least(F.abs(o_ - d_), F.abs(o_ - (d_ - 360)), F.abs(o_ - (d_ + 360)))


def movement_class(gap="o_dir_diff", threshold: float = 45) -> Column:
    return F.when(_c(gap) >= threshold, "abnormal").otherwise("normal")


def in_list_flag(col, values) -> Column:
    """True when the value is in the constant list, else False (null -> False)."""
    return F.when(_c(col).isin(*values), True).otherwise(False)


def hash_bucket(key, buckets: int = 100) -> Column:
    """Deterministic bucket 0..buckets-1 from the first 8 hex digits of md5(key)."""
    return (F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint") % buckets)


def r6(col) -> Column:
    """Round to 6 places (used for every reported floating value)."""
    return F.round(_c(col), 6)
