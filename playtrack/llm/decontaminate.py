"""Benchmark decontamination with DataFrame functions only.

Normalised windows of ``size`` consecutive words of the benchmark items (an
item of fewer words is one window) form a hash set.  Every window of every
document is hashed in place and probed; a hash hit is verified word by word.
The words inside a verified window are hit; documents (or the hit spans) can
then be removed.

Scale: the set is broadcast only if its measured size is within the limit;
beyond it the windows (each with its own words) are joined by shuffle on the hash.  Words, window hashes
and probes run in one generated stage per file split, and only verified hits
and one marker row per document, without the words, reach the (partial) aggregation per document.
The lists kept per document are bounded by its own words and by the items.

Defined cases: null text has no words; a document or item without words is
never hit; a null item id counts as one item but gives no text in the digest;
rows that repeat an id and text share one result, which the report gives once
a row; an empty benchmark hits nothing; empty documents give no rows; other columns pass through.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, saved, sized_broadcast, text_or_empty

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"     # fixed by the result's definition
SIZE = 10


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; other letters keep their case."""
    # plain lower() is the same on ASCII texts and much faster there
    lower = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def benchmark_windows(items: DataFrame, size: int = SIZE) -> DataFrame:
    """``(n, h, gram, items)``: distinct windows of ``n`` words, their hash, and the items that hold them."""
    w = items.select(F.col("item_id"), words(text_or_empty()).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(size))
    at = w.select("item_id", "w", n.alias("n"), F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("i"))
    grams = at.select("item_id", "n", F.concat_ws(" ", F.slice("w", F.col("i"), F.col("n"))).alias("gram"))
    # collected per window: at most the items; an array element keeps a null id
    return (grams.distinct().groupBy("n", "gram").agg(F.flatten(F.collect_list(F.array("item_id"))).alias("items"))
            .select("n", F.xxhash64("gram").alias("check"), "gram", "items")
            .withColumn("h", _hash_words(F.split("gram", " "), F.lit(0), size)).drop("check"))


def _hash_words(w: Column, at: Column, n: int) -> Column:
    """Hash of the ``n`` words of ``w`` from ``at``; missing words do not count."""
    return F.xxhash64(*[F.get(w, at + i) for i in range(n)])


def _hits(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Per row key: ``n_rows`` that have it, ``n_words``, hit windows ``(at, n)`` and lists of items."""
    grams = saved(benchmark_windows(items, size), "bench-windows")
    lengths = sorted(r["n"] for r in grams.select("n").distinct().collect())      # at most ``size`` numbers
    table = grams.select(F.col("n").alias("_n"), F.col("h").alias("_h"), "gram", "items")
    lookup = sized_broadcast(table, F.octet_length("gram") + F.size("items") * 8 + 64)
    spread = (docs.select(row_key().alias("k"), words(text_or_empty()).alias("w"))
              # place -1 stands for the document itself, so one pass gives its word count too
              .select("k", "w", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at")))
    if len(lengths) == 1:
        probe = spread.select("k", "w", "at", F.lit(lengths[0]).alias("n"),
                              _hash_words(F.col("w"), F.col("at"), lengths[0]).alias("h"))
    else:
        each = [F.struct(F.lit(n).alias("n"), _hash_words(F.col("w"), F.col("at"), n).alias("h")) for n in lengths]
        probe = spread.select("k", "w", "at", F.explode(F.array(*each) if each else F.array(
            F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("h")))).alias("x")).select("k", "w", "at", "x.n", "x.h")
    own = F.concat_ws(" ", F.slice("w", F.greatest(F.col("at") + 1, F.lit(1)), F.col("n")))
    inside = (F.col("at") >= 0) & (F.col("at") + F.col("n") <= F.size("w"))
    n_words, same = F.size("w"), inside & (own == F.col("gram"))
    if lookup is table:
        # a shuffled window takes its own words along, not those of its whole document
        probe = probe.where(inside | (F.col("at") < 0)).select(
            "k", "at", "n", "h", n_words.alias("n_words"), F.when(inside, own).alias("own"))
        n_words, same = F.col("n_words"), F.col("own") == F.col("gram")
    met = probe.join(lookup, (F.col("h") == F.col("_h")) & (F.col("n") == F.col("_n")) & same, "left")
    # the words stay behind: rows leave the join as copies, all those of a document at once, and the aggregation sorts a task's rows
    found = met.where((F.col("at") < 0) | F.col("gram").isNotNull()).select("k", "at", "n", n_words.alias("n_words"), "items")
    # each row has one marker per window length, and one if there are no windows
    return (found.groupBy("k").agg(F.floor(F.count(F.when(F.col("at") < 0, 1)) / max(len(lengths), 1)).alias("n_rows"),
                                   F.max("n_words").alias("n_words"),
                                   F.collect_set(F.when(F.col("at") >= 0, F.struct("at", "n"))).alias("spans"),
                                   F.collect_set("items").alias("items")))


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """``(doc_id, digest, n_rows, n_words, n_hit, item_ids, spans, contaminated)`` per distinct ``(doc_id, text)``.

    ``n_rows``: rows that hold it; ``spans``: hit windows as ``(at, n)``, counted in words from 0.
    """
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1)))
    return (_hits(docs, items, size)
            .select("k.doc_id", "k.digest", "n_rows", F.col("n_words").cast("long").alias("n_words"),
                    F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
                    F.array_distinct(F.flatten("items")).alias("item_ids"), F.array_sort("spans").alias("spans"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def remove_documents(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` without the contaminated ones; columns as they are."""
    found = saved(contamination(docs, items, size).where("contaminated").select("doc_id", "digest"), "bench-found")
    bad = sized_broadcast(found, 24)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_key().alias("_key"))
    clean = rows.join(bad, rows["_key.doc_id"].eqNullSafe(bad["doc_id"])
                      & (rows["_key.digest"] == bad["digest"]), "left_anti")
    return clean.select("_row.*")


def remove_spans(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """``(doc_id, text)``: hit words cut out; texts without a hit stay as they are.

    A cut text is its remaining normalised words joined by single spaces.
    """
    found = contamination(docs, items, size).where("contaminated").select("doc_id", "digest", "spans")
    rows = docs.select(row_key().alias("_key"), text_or_empty().alias("text"))
    both = rows.join(found, F.col("_key.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_key.digest") == F.col("digest")), "left")
    w = words(F.col("text"))
    hit = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1))))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.col("_n") - 1), F.col("_hit")), lambda i: F.get(F.col("_w"), i))
    # the words are made once, in a column of the row, before the positions are looked up
    cut = (both.where("spans is not null").select("_key", F.explode(F.array(F.struct(w.alias("w"), hit.alias("hit")))).alias("x"))
           .select("_key", F.col("x.w").alias("_w"), F.col("x.hit").alias("_hit"), F.size("x.w").alias("_n"))
           .select(F.col("_key.doc_id").alias("doc_id"), F.array_join(left, " ").alias("text")))
    return both.where("spans is null").select(F.col("_key.doc_id").alias("doc_id"), "text").unionByName(cut)


def report(found: DataFrame) -> DataFrame:
    """The digest columns of ``contamination``, once for every row of the documents."""
    names = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    digest = found.select("n_rows", "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                          F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), "contaminated")
    return digest.select("*", F.explode(F.sequence(F.lit(1), "n_rows"))).drop("n_rows", "col")


REPORT_SQL = r"""
with low as (
    select 'd' as kind, doc_id as id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
    from documents
    union all
    select 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark),
w as (select kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from low),
item as (
    select id as item_id, least(10, len(w)) as n, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i
    from w where kind = 'b' and len(w) > 0),
gram as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as gram from item),
sizes as (select distinct n from gram),
doc as (
    select id as doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as gram
    from (select id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) as i from w, sizes where kind = 'd')),
hit as (select d.doc_id, d.i, d.n, g.item_id from doc d join gram g on d.n = g.n and d.gram = g.gram),
places as (select doc_id, count(distinct p) as n_hit
           from (select doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids
          from (select distinct doc_id, cast(item_id as varchar) as s from hit) group by doc_id)
select w.id as doc_id, cast(len(w.w) as bigint) as n_words, coalesce(p.n_hit, 0) as n_hit,
       coalesce(i.n_items, 0) as n_items, sha256(coalesce(i.ids, '')) as items_sha256,
       coalesce(p.n_hit, 0) > 0 as contaminated
from w left join places p on p.doc_id = w.id left join items i on i.doc_id = w.id where w.kind = 'd'
"""
