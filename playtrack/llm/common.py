"""Helpers shared by the training-data operators.

* ``saved`` writes a table under the shared scratch folder and reads it back:
  lineage ends there, so a lost executor costs a reread, not a rerun.
* ``sized_broadcast`` broadcasts a table only after measuring it; a larger
  table keeps Spark's own (shuffled) join.
* ``read_table`` and ``row_key`` fix how tables are read and how a document
  row is named when ids may be null or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrack.session import scratch_path

BROADCAST_BYTES = 64 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str, **options) -> DataFrame:
    """``df`` written to the shared scratch folder (with the writer's ``options``) and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized_broadcast(df: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its measured size is within ``limit`` bytes, else as it is.

    ``row_bytes``: bytes a row takes, as a number or a column expression.
    ``df`` should be cheap to read (a saved table).
    """
    width = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    size = df.agg(F.sum(width.cast("long")).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if size <= limit else df


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a document row: its id and a digest of its text.

    Rows that agree in both are repeats of one document and share its result;
    a null id or text is a value like any other.
    """
    return F.struct(F.col(doc_id).cast("long").alias("doc_id"),
                    F.xxhash64(F.length(text_or_empty(text)), text_or_empty(text)).alias("digest"))


def size_hint_partitions(rows: int, rows_per_partition: int, least: int = 1) -> int:
    """Partitions (blocks, buckets) so that each holds about ``rows_per_partition`` rows."""
    return max(least, -(-rows // rows_per_partition))
