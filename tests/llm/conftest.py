import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    def make(rows):
        full = [(*r, "en", "s0", None)[:5] if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)
    return make


@pytest.fixture
def odd_docs(make_docs):
    """Nulls in every column, empty and very long texts, repeated rows, repeated ids, clashing extra columns."""
    from pyspark.sql import functions as F

    long = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s1", 0), (None, "some text without an id here", "en", None, 5),
            (3, "a b\nc d\ne f\ng h", "en", "s1", 15), (3, "a b\nc d\ne f\ng h", "en", "s1", 15),
            (4, "a b\nc d\ne f\nother", None, "s1", None), (4, "same id, other text", "de", "s2", 19),
            (5, long, "en", "s1", len(long)), (6, long, "en", "s1", len(long)), (7, "  \n \n", "xx", "s1", 5)]
    clash = {c: F.lit("x") for c in ("digest", "fp", "spans", "component_id", "host", "rank", "units", "_row", "_key", "h")}
    return make_docs(rows).withColumns(clash)


@pytest.fixture
def no_docs(make_docs):
    return make_docs([])
