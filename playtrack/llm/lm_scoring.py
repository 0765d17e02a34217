"""Stupid-backoff language-model scores, computed as a join of n-grams with hash-partitioned count tables.

    S(w | context) = c(context w) / c(context)      if c(context w) >= MIN_COUNT
                   = BACKOFF * S(w | shorter context)  otherwise
    S(w)           = c(w) / N

with counts over all documents.  A document's score is the sum of ``ln S``
over its words; n-grams do not cross documents.

The relations, in column blocks (numpy arrays in binary columns) so that one
row stands for many n-grams:

1. ``token_blocks``: the words of about ``BLOCK_TOKENS`` tokens of documents,
   as numbers into the block's own word list, written to the shared folder.
2. ``requests``: each block explodes into its distinct n-grams with their
   counts in the block, one row per hash bucket.
3. ``answers``: a bucket adds up the counts of equal n-grams over all blocks
   (this is its part of the count tables) and joins them back to the n-grams
   of each block.  As a block asks for an n-gram once, a word that is in every
   document is as cheap as any other: no bucket is skewed.
4. ``scores``: answers meet their block again; words are scored and summed per
   document.

Buckets grow with the corpus so that each stays near ``BUCKET_BYTES``; blocks
are bounded by tokens, and a longer text continues in the next block with its
last ``order - 1`` words as context.

Defined cases: null and empty texts have no words, score 0 and a null mean;
repeated rows count in the corpus as often as they occur and score alike; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

ORDER = 2
BACKOFF = 0.4
MIN_COUNT = 2
BLOCK_TOKENS = 1 << 20
BUCKET_BYTES = 16 << 20
BLOCK_SCHEMA = ("block long, rows binary, docs binary, no_doc binary, sizes binary, skips binary, "
                "words binary, hashes binary")


def _planes(a: np.ndarray) -> bytes:
    """The array with its lowest bytes first, then the next ones: high bytes are mostly zero, and compress."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _from_planes(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _sorted_planes(a: np.ndarray) -> bytes:
    return _planes(np.diff(a, prepend=a.dtype.type(0)))


def _from_sorted_planes(data: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(data, "<u8"), dtype=np.uint64)


class _Block:
    """Segments of documents: row number, document id, words, and how many of them are context only."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.rows, self.docs, self.no_doc, self.sizes, self.skips, self.words = [], [], [], [], [], []

    def add(self, row: int, doc: int | None, words: list[bytes], skip: int) -> None:
        number = self.number
        self.words += [number.setdefault(w, len(number)) for w in words]
        for to, value in ((self.rows, row), (self.docs, doc or 0), (self.no_doc, doc is None),
                          (self.sizes, len(words)), (self.skips, skip)):
            to.append(value)

    def batch(self, name: int) -> pa.RecordBatch:
        from xxhash import xxh3_64_intdigest

        hashes = np.fromiter(map(xxh3_64_intdigest, self.number), np.uint64, len(self.number))
        arrays = [np.array(self.rows, "<i8"), np.array(self.docs, "<i8"), np.array(self.no_doc, "<u1"),
                  np.array(self.sizes, "<i4"), np.array(self.skips, "<i4"), np.array(self.words, "<u4"), hashes]
        names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *(pa.array([_planes(a)], pa.binary()) for a in arrays)],
                                          names=names)


def token_blocks(docs: DataFrame, order: int = ORDER, tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The documents' words in blocks (``BLOCK_SCHEMA``); words are separated by ASCII white space, A-Z in lower case."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        block, made, row = _Block(), 0, 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["data"], strict=True):
                words = (text.as_py() or b"").lower().split()
                at, skip = 0, 0
                while True:
                    own = words[at - skip:at + max(tokens - len(block.words), 1)]
                    block.add(base + row, doc, own, skip)
                    at += len(own) - skip
                    if len(block.words) >= tokens:
                        yield block.batch(base + made)
                        block, made = _Block(), made + 1
                    if at >= len(words):
                        break
                    skip = min(order - 1, at)
                row += 1
        if block.rows:
            yield block.batch(base + made)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data")).mapInArrow(
        fill, BLOCK_SCHEMA)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two, well mixed in all bits."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xD6E8FEB86659FD93)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(32))


class _Grams:
    """The distinct n-grams of a block: per order their hashes, counts, and which one ends at each word."""

    def __init__(self, row, order: int):
        self.sizes = _from_planes(row["sizes"], "<i4").astype(np.int64)
        skips = _from_planes(row["skips"], "<i4").astype(np.int64)
        words = _from_planes(row["words"], "<u4").astype(np.int64)
        word_hash = _from_planes(row["hashes"], "<u8")
        starts = np.cumsum(self.sizes) - self.sizes
        self.of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.place = np.arange(len(words)) - starts[self.of] if len(words) else np.zeros(0, np.int64)
        self.real = self.place >= skips[self.of] if len(words) else np.zeros(0, bool)
        # the words before a continued segment are context: the n-gram orders known at a place follow from it
        self.hashes, self.counts, self.ends = [], [], []
        gram, hashed = words, word_hash
        for n in range(1, order + 1):
            if n > 1:
                has = np.flatnonzero(self.place >= n - 1)
                key = np.full(len(words), -1, np.int64)
                key[has] = gram[has - 1] * max(len(word_hash), 1) + words[has]
                distinct, inverse = np.unique(key[has], return_inverse=True)
                first, second = np.divmod(distinct, max(len(word_hash), 1))
                hashed = _mix(hashed[first], word_hash[second])
                gram = np.full(len(words), -1, np.int64)
                gram[has] = inverse
            here = gram[self.real & (gram >= 0)]
            self.hashes.append(hashed)
            self.counts.append(np.bincount(here, minlength=len(hashed)))
            self.ends.append(gram)
        self.sorted = [np.argsort(h, kind="stable") for h in self.hashes]

    def edges(self, n: int, buckets: int) -> np.ndarray:
        """Where the buckets begin in the sorted hashes of order ``n``."""
        step = (1 << 64) // buckets
        bounds = np.array([i * step for i in range(1, buckets)], np.uint64)
        inside = np.searchsorted(self.hashes[n][self.sorted[n]], bounds)
        return np.concatenate([[0], inside, [len(self.hashes[n])]])


def requests(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """``(bucket, n, block, grams, counts)``: the n-grams of a block in a bucket, sorted by hash."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams, out = _Grams(row, order), []
                for n in range(order):
                    h, c = grams.hashes[n][grams.sorted[n]], grams.counts[n][grams.sorted[n]].astype("<u4")
                    edges = grams.edges(n, buckets)
                    out += [(i, n, row["block"], _sorted_planes(h[a:b]), _planes(c[a:b]))
                            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
                if out:
                    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                        names=["bucket", "n", "block", "grams", "counts"])
    return blocks.mapInArrow(ask, "bucket int, n int, block long, grams binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """``(block, n, bucket, counts)``: corpus counts in the order in which the block asked."""
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        grams = np.concatenate([_from_sorted_planes(x) for x in pdf["grams"]])
        counts = np.concatenate([_from_planes(x, "<u4") for x in pdf["counts"]])
        order = np.argsort(grams, kind="stable")
        new = np.append(True, np.diff(grams[order]) != 0)
        number = np.cumsum(new) - 1
        total = np.bincount(number, counts[order])
        known = np.empty(len(grams), "<i8")
        known[order] = total[number]
        ends = np.cumsum([len(x) // 8 for x in pdf["grams"]])
        parts = [_planes(known[a:b]) for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)]
        return pd.DataFrame({"block": pdf["block"], "n": pdf["n"], "bucket": pdf["bucket"], "counts": parts})
    return asked.groupBy("bucket", "n").applyInPandas(count, "block long, n int, bucket int, counts binary")


def _scored(row, grams: _Grams, known: list[np.ndarray], total: int, backoff: float, min_count: int) -> pd.DataFrame:
    order = len(known)
    log = np.zeros(len(grams.of))
    if len(log):
        with np.errstate(divide="ignore"):
            found = np.log(known[0][grams.ends[0]] / total)
        reached = np.ones(len(log), np.int64)              # highest order whose context exists
        used = np.ones(len(log), np.int64)
        for n in range(2, order + 1):
            has = np.flatnonzero(grams.place >= n - 1)
            reached[has] = n
            c = known[n - 1][grams.ends[n - 1][has]]
            enough = c >= min_count
            at = has[enough]
            found[at] = np.log(c[enough] / known[n - 2][grams.ends[n - 2][at - 1]])
            used[at] = n
        log = np.where(grams.real, found + (reached - used) * np.log(backoff), 0.0)
    k = len(grams.sizes)
    return pd.DataFrame({
        "row": _from_planes(row["rows"], "<i8"),
        "doc_id": pd.array(_from_planes(row["docs"], "<i8"), "Int64"),
        "n_words": np.bincount(grams.of, grams.real, k).astype(np.int64) if len(log) else np.zeros(k, np.int64),
        "n_backed_off": (np.bincount(grams.of, grams.real & (used < reached), k).astype(np.int64)
                         if len(log) else np.zeros(k, np.int64)),
        "log_score": np.bincount(grams.of, log, k) if len(log) else np.zeros(k)})


def score(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, min_count: int = MIN_COUNT,
          block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(doc_id, n_words, n_backed_off, log_score, mean_log_score)`` of every row."""
    spark = docs.sparkSession
    blocks = saved(token_blocks(docs, order, block_tokens), "lm-blocks")
    total = _total_words(blocks)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-total * 12 * order // BUCKET_BYTES))
    replies = answers(requests(blocks, order, buckets))

    def meet(own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in own.to_dict("records"):
            known = []
            for n in range(order):
                part = got[got["n"] == n].sort_values("bucket")
                known.append(np.concatenate([_from_planes(x, "<i8") for x in part["counts"]] or [np.zeros(0, "<i8")]))
            # answers come in hash order; back to the order of the block's own n-grams
            grams = _Grams(row, order)
            placed = [np.empty(len(k), np.int64) for k in known]
            for n in range(order):
                placed[n][grams.sorted[n]] = known[n]
            frame = _scored(row, grams, placed, total, backoff, min_count)
            frame.loc[_from_planes(row["no_doc"], "<u1") > 0, "doc_id"] = pd.NA
            out.append(frame)
        return pd.concat(out)
    parts = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(
        meet, "row long, doc_id long, n_words long, n_backed_off long, log_score double")
    # a text that spans blocks has a part in each
    return (parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n_words").alias("n_words"),
                                     F.sum("n_backed_off").alias("n_backed_off"), F.sum("log_score").alias("log_score"))
            .select("doc_id", "n_words", "n_backed_off", "log_score",
                    F.try_divide("log_score", "n_words").alias("mean_log_score")))


def _total_words(blocks: DataFrame) -> int:
    """Words of the corpus, without the context that continued segments repeat."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for sizes, skips in zip(batch["sizes"].to_pylist(), batch["skips"].to_pylist(), strict=True):
                n += int(_from_planes(sizes, "<i4").sum(dtype=np.int64) - _from_planes(skips, "<i4").sum(dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])
    return blocks.select("sizes", "skips").mapInArrow(count, "n long").agg(F.sum("n").alias("n")).first()["n"] or 0


REPORT_SQL = r"""
with w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
t as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as b from w),
g as (select doc_id, i, b, lag(b) over (partition by doc_id order by i) as a from t),
one as (select b, count(*) as c from g group by b),
two as (select a, b, count(*) as c from g where a is not null group by a, b),
scored as (
    select g.doc_id,
           case when g.a is null then ln(one.c / (select count(*) from g))
                when two.c >= 2 then ln(two.c / ctx.c)
                else ln(0.4) + ln(one.c / (select count(*) from g)) end as s,
           case when g.a is not null and two.c < 2 then 1 else 0 end as backed
    from g join one on one.b = g.b left join two on two.a = g.a and two.b = g.b left join one ctx on ctx.b = g.a)
select w.doc_id, cast(len(w.w) as bigint) as n_words, cast(coalesce(sum(backed), 0) as bigint) as n_backed_off,
       round(coalesce(sum(s), 0.0), 3) as log_score, round(sum(s) / len(w.w), 5) as mean_log_score
from w left join scored on scored.doc_id = w.doc_id group by w.doc_id, w.w
"""

REPORT_SQL_3 = r"""
with w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
t as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as c from w),
g as (select doc_id, i, c, lag(c) over (partition by doc_id order by i) as b,
             lag(c, 2) over (partition by doc_id order by i) as a from t),
one as (select c, count(*) as n from g group by c),
two as (select b, c, count(*) as n from g where b is not null group by b, c),
three as (select a, b, c, count(*) as n from g where a is not null group by a, b, c),
scored as (
    select g.doc_id,
           case when three.n >= 2 then ln(three.n / pair.n)
                when two.n >= 2 then ln(two.n / ctx.n) + case when g.a is null then 0 else ln(0.4) end
                else ln(one.n / (select count(*) from g))
                     + ln(0.4) * (case when g.b is null then 0 when g.a is null then 1 else 2 end) end as s,
           case when g.a is not null then case when three.n < 2 then 1 else 0 end
                when g.b is not null and two.n < 2 then 1 else 0 end as backed
    from g join one on one.c = g.c left join two on two.b = g.b and two.c = g.c
    left join three on three.a = g.a and three.b = g.b and three.c = g.c
    left join one ctx on ctx.c = g.b left join two pair on pair.b = g.a and pair.c = g.b)
select w.doc_id, cast(len(w.w) as bigint) as n_words, cast(coalesce(sum(backed), 0) as bigint) as n_backed_off,
       round(coalesce(sum(s), 0.0), 3) as log_score, round(sum(s) / len(w.w), 5) as mean_log_score
from w left join scored on scored.doc_id = w.doc_id group by w.doc_id, w.w
"""
