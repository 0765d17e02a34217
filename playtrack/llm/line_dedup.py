"""Line dedup: repeated windows of three consecutive lines, later occurrences removed.

Windows overlap and run over the non-blank lines of a document, compared
without surrounding spaces.  A window is named by two 64-bit hashes of its
lines.  Repeated windows are found globally by a partial aggregation that also
keeps the first place ``(doc_id, digest, window)``; every other occurrence
covers its three lines, the covered positions of a document merge, and those
lines go.  Blank lines and uncovered lines stay in place.

Scale: one narrow row per window is shuffled twice (count, then look up); the
look-up is a plain join of two direct inputs, which adaptive execution splits
when a window is in very many documents.

Defined cases: null text becomes empty; a document of fewer than three
non-blank lines has no window and stays as it is; of windows that tie on id
and digest (repeated rows) each row is the first occurrence, so repeated rows
get the same result; a repeated line inside a document keeps its first window
except where a later one overlaps it (the lines of a run are kept once); an
empty table stays empty; other columns pass through untouched, and ``n_chars``
follows the text if it is there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, saved, text_or_empty

WINDOW = 3


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(h1, h2, place)``: hashes of every window and its place ``(doc_id, digest, at)``."""
    lines = docs.select(row_key().alias("k"), F.filter(
        F.transform(F.split(text_or_empty(), "\n"), lambda x: F.trim(x)), lambda x: x != "").alias("lines"))
    at = lines.where(F.size("lines") >= size).select(
        "k", "lines", F.explode(F.sequence(F.lit(0), F.size("lines") - size)).alias("at"))
    own = [F.get("lines", F.col("at") + i) for i in range(size)]
    return at.select(F.xxhash64(*own).alias("h1"), F.xxhash64(F.lit(size), *reversed(own)).alias("h2"),
                     F.struct("k.doc_id", "k.digest", "at").alias("place"))


def later_windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(doc_id, digest, starts)``: windows of the document that occurred before, as line numbers."""
    own = windows(docs, size)
    repeated = saved(own.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
                     .where("n > 1").select("h1", "h2", "first"), "line-windows")
    later = own.join(repeated, ["h1", "h2"]).where(~F.col("place").eqNullSafe(F.col("first")))
    # bounded by the lines of the document
    return later.groupBy("place.doc_id", "place.digest").agg(F.collect_set("place.at").alias("starts"))


def _without(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, starts in parts:
        out = []
        for text, at in zip(texts, starts, strict=True):
            lines = text.split("\n")
            filled = [i for i, x in enumerate(lines) if x.strip(" ")]
            gone = {filled[s + i] for s in at for i in range(WINDOW)} if at is not None else set()
            out.append((text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone),
                        len(filled), len(gone)))
        yield pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])


def _cleaned(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       row_key().alias("_key"), text_or_empty().alias("_text"))
    later = later_windows(docs).select(F.struct("doc_id", "digest").alias("_of"), "starts")
    return rows.join(later, (F.col("_key.doc_id").eqNullSafe(F.col("_of.doc_id")))
                     & (F.col("_key.digest") == F.col("_of.digest")), "left").select(
        "_row", "_key", F.pandas_udf(_without, "struct<text string, n_lines long, n_removed long>")("_text", "starts").alias("_new"))


def dedup_report(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, n_lines, n_removed)``: non-blank lines before, lines removed, and the text left."""
    return _cleaned(docs).select(F.col("_key.doc_id").alias("doc_id"), "_new.text", "_new.n_lines", "_new.n_removed")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated windows removed from ``text``; same rows, same columns."""
    def column(name):
        if name == "text":
            return F.col("_new.text").alias(name)
        if name == "n_chars":
            return F.length("_new.text").cast(docs.schema[name].dataType).alias(name)
        return F.col(f"_row.`{name}`")
    return _cleaned(docs).select(*[column(c) for c in docs.columns])


REPORT_SQL = """
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents),
filled as (select *, row_number() over (partition by doc_id order by pos) as nr from lines where trim(line) <> ''),
win as (
    select doc_id, nr, trim(line) as a, lead(trim(line), 1) over w as b, lead(trim(line), 2) over w as c
    from filled window w as (partition by doc_id order by pos)),
seen as (select *, row_number() over (partition by a, b, c order by doc_id, nr) as nth from win where c is not null),
gone as (select distinct doc_id, nr + i as nr from seen, (values (0), (1), (2)) as v(i) where nth > 1),
marked as (
    select l.doc_id, l.pos, l.line, f.nr is not null as filled, g.nr is not null as gone
    from lines l left join filled f on l.doc_id = f.doc_id and l.pos = f.pos
    left join gone g on f.doc_id = g.doc_id and f.nr = g.nr)
select doc_id, coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as text,
       count(*) filter (where filled) as n_lines, count(*) filter (where gone) as n_removed
from marked group by doc_id
"""
