"""Per-key windows that survive a key holding a large share of all rows.

A window partitioned by a key puts every row of that key into one task, so a
key with a third of the data would run on one core.  The helpers here split
such hot keys off:

* ``key_slots``: rows per hash slot of the key, a bounded number of slots.  No
  key has more rows than its slot, so a table without a heavy slot has no hot
  key, and its keys are never counted one by one.
* ``hot_keys``: keys with more than ``hot_rows`` rows, from a partial count
  (map-side combine); at most ``rows / hot_rows`` keys, which is the size
  bound that makes broadcasting the key list safe.
* ``split_by_key_size``: one small job checks for hot keys; without any, the
  plain form runs alone.  With some, normal keys keep the plain window form
  (anti join, partitioning kept) and hot keys run a chunked form, results
  unioned.  Both forms give the same rows.
* ``previous_in_group`` / ``row_number_in_group``: ``lag`` and
  ``row_number`` over time-ordered range chunks.  Rows are range-partitioned
  on (key, order), so one key spreads over many tasks; each chunk computes
  locally, and a carry table of at most (chunks + keys) rows supplies the
  previous chunk's last row or the row offset.

Hot-key threshold: ``spark.playtrack.hotKeyRows`` (default 1,000,000).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

HOT_ROWS_CONF = "spark.playtrack.hotKeyRows"
DEFAULT_HOT_ROWS = 1_000_000


SLOTS = 1 << 16
ROWS_PER_PART = 250_000      # of a keyed window or join: partitions grow in number with the rows, not in size


def hot_rows_of(df: DataFrame, hot_rows: int | None = None) -> int:
    if hot_rows is not None:
        return hot_rows
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))


def hot_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows (at most rows / hot_rows keys)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
            .where(F.col("_rows") > hot_rows).select(key))


def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS))


def key_slots(df: DataFrame, key: str) -> DataFrame:
    """``_slot, _rows``: rows per hash slot of the key (``SLOTS`` rows at most, however many keys there are)."""
    return df.groupBy(_slot(key).alias("_slot")).agg(F.count(F.lit(1)).alias("_rows"))


def measured_rows(df: DataFrame, key: str) -> tuple[int, int]:
    """Rows in all and in the fullest slot of the key: no key has more."""
    found = key_slots(df, key).agg(F.sum("_rows").alias("rows"), F.max("_rows").alias("most")).first()
    return found["rows"] or 0, found["most"] or 0


def dealt(df: DataFrame, keys, rows: int) -> DataFrame:
    """``df`` by ``keys`` in partitions of about ``ROWS_PER_PART`` rows; left as it is where Spark's own number is as large."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = range_count(rows, ROWS_PER_PART, least)
    return df if parts == least else df.repartition(parts, *keys)


def dealt_by_key(df: DataFrame, key: str, *more: str) -> DataFrame:
    """``df`` dealt by ``key`` (and ``more``) as its rows ask for (counted in one small job), or as it is if a key is hot."""
    rows, most = measured_rows(df, key)
    return dealt(df, [key, *more], rows) if most <= hot_rows_of(df) else df


def split_by_key_size(df: DataFrame, key: str, plain, chunked, hot_rows: int | None = None,
                      probe: DataFrame | None = None, deal: bool = False) -> DataFrame:
    """``plain(normal_rows)`` union ``chunked(hot_rows)``; ``plain(df)`` alone when no key is hot.

    ``probe`` (default ``df``) is where keys are counted: a cheaper upstream
    table with at least as many rows per key (e.g. plays for a per-player game
    list) finds a superset of the hot keys without computing ``df`` twice.
    With ``deal``, normal rows reach ``plain`` dealt by the key into partitions
    that follow the counted rows.
    """
    src = df if probe is None else probe.select(key)
    threshold = hot_rows_of(df, hot_rows)
    rows, most = measured_rows(src, key)
    normal = (lambda d: plain(dealt(d, [key], rows))) if deal else plain
    if most <= threshold:
        return normal(df)
    heavy = F.broadcast(key_slots(src, key).where(F.col("_rows") > threshold).select("_slot"))   # SLOTS rows at most
    keys = hot_keys(src.withColumn("_slot", _slot(key)).join(heavy, "_slot", "left_semi"), key, threshold)
    if keys.isEmpty():
        return normal(df)
    hot = F.broadcast(keys)                    # size bound: rows / hot_rows keys
    return normal(df.join(hot, key, "left_anti")).unionByName(chunked(df.join(hot, key, "left_semi")))


def stored_ranges(df: DataFrame, by, mark: str, ranges: int | None = None) -> DataFrame:
    """``df`` in ranges of ``by`` (an order), each row with the number of its range in ``mark``.

    Ranges come from a sample, and another evaluation of the plan may draw
    other ones.  So the dealt rows are written once to the shared folder, and
    everything that depends on range numbers reads them from there.  Unless
    ``ranges`` is given, the rows are stored first and counted: a range holds
    about as many as a key may have unsplit, so ranges grow in number, not in
    size, and neither sampling nor dealing computes ``df`` again.
    """
    spark = df.sparkSession
    if ranges is None:
        path = scratch_path(spark, "rows")
        df.write.parquet(path)
        df = spark.read.schema(df.schema).parquet(path)
        ranges = range_count(df.count(), hot_rows_of(df), int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(ranges, *by).withColumn(mark, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def range_count(rows: int, rows_of_range: int, least: int) -> int:
    return max(least, -(-rows // rows_of_range))


def _chunks(df: DataFrame, key: str, order, chunks: int | None) -> DataFrame:
    """``df`` in range chunks on (key, order), each row with its ``_chunk``."""
    return stored_ranges(df, [key, *order], "_chunk", chunks)


def previous_in_group(df: DataFrame, key: str, order, cols, chunks: int | None = None) -> DataFrame:
    """``_prev_<c>``: value of ``c`` on the previous row of the key by ``order``."""
    ranged = _chunks(df, key, order, chunks)
    w = Window.partitionBy(key, "_chunk").orderBy(*order)
    local = (ranged.withColumns({f"_prev_{c}": F.lag(c, 1).over(w) for c in cols})
             .withColumn("_first", F.row_number().over(w) == 1))
    last = ranged.groupBy(key, "_chunk").agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_last"))
    carry = (last.withColumn("_carry", F.lag("_last", 1).over(Window.partitionBy(key).orderBy("_chunk")))
             .select(key, "_chunk", "_carry"))
    out = local.join(carry, [key, "_chunk"], "left")
    return (out.withColumns({f"_prev_{c}": F.when(F.col("_first"), F.col(f"_carry.{c}"))
                             .otherwise(F.col(f"_prev_{c}")) for c in cols})
            .withColumn("_has_prev", ~F.col("_first") | F.col("_carry").isNotNull())
            .drop("_chunk", "_first", "_carry"))


def row_number_in_group(df: DataFrame, key: str, order, out: str, chunks: int | None = None) -> DataFrame:
    """``out`` = 1-based row number within the key by ``order`` (a full order)."""
    ranged = _chunks(df, key, order, chunks)
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy(key, "_chunk").orderBy(*order)))
    sizes = ranged.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    return (local.join(offsets, [key, "_chunk"], "left")
            .withColumn(out, (F.col("_rn") + F.col("_offset")).cast("int"))
            .drop("_chunk", "_rn", "_offset"))


def lag_in_group(df: DataFrame, key: str, order, col: str, out: str, default=None,
                 hot_rows: int | None = None, probe: DataFrame | None = None) -> DataFrame:
    """``out`` = ``lag(col, 1, default)`` per key by ``order``, hot keys chunked."""
    def plain(d):
        return d.withColumn(out, F.lag(col, 1, default).over(Window.partitionBy(key).orderBy(*order)))

    def chunked(d):
        p = previous_in_group(d, key, order, [col])
        v = F.col(f"_prev_{col}")
        value = v if default is None else F.when(F.col("_has_prev"), v).otherwise(F.lit(default))
        return p.withColumn(out, value).drop(f"_prev_{col}", "_has_prev")
    return split_by_key_size(df, key, plain, chunked, hot_rows, probe, deal=True)


def row_number_by(df: DataFrame, key: str, order, out: str, hot_rows: int | None = None,
                  probe: DataFrame | None = None) -> DataFrame:
    """``row_number()`` per key by ``order``, hot keys chunked (``probe``: see ``split_by_key_size``)."""
    def plain(d):
        return d.withColumn(out, F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("int"))
    return split_by_key_size(df, key, plain, lambda d: row_number_in_group(d, key, order, out), hot_rows, probe, deal=True)
