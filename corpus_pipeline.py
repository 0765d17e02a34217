"""Training-data pipeline over ``documents``: five stages, each one of the library's operators.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and reread as the next stage's ``docs``:

1. ``language_id``: documents whose language cannot be told or is not accepted go.
2. ``line_dedup``: later occurrences of repeated three-line windows are cut from
   the texts; every document stays.
3. ``simhash``: one document of every near-duplicate group stays.
4. ``decontamination``: documents with a benchmark window go.
5. ``packing``: what is left is packed into sequences of 2048 tokens; rows are pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playtrack.llm import decontaminate, language_id, line_dedup, packing, simhash
from playtrack.llm.common import read_table, saved


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# fingerprints (XXH64 votes), components and token ids are beyond SQL; tests/llm compares with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
