"""Source divergence audit: how far the words of each source of a language are from those of its others.

1. ``kept_terms``: exact document frequencies, summed by language and term;
   those in ``least`` documents or more are kept.
2. ``perfect_hashes``: the kept terms of a language in shards by hash, one
   minimal perfect hash a shard, stored with its keys.
3. ``slot_counts``: the second pass looks every term up (its hash, then the
   stored key) and adds to the slots of its (language, source) group, dense
   arrays in the task.  Tasks send, per group and shard, the slots in use; these
   are summed by group and shard.  The hashes are broadcast only if their
   measured size is within the limit; beyond it, terms counted per task meet
   their slots in a join.
4. ``audit``: per shard of slots, the groups' counts as rows of a matrix give the
   shard's part of every pair of sources and each source's highest terms; parts
   are summed, highest terms ranked.

With ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))`` for each of the ``V`` kept
terms, all in integers, a term's divergence of ``p`` from ``q`` is
``floor((p - q)^2 / (p + q))``.

Scale: terms and slots are summed per task before they are shuffled.  A matrix
has ``SHARD_TERMS`` slots or about, and is worked off in blocks of ``_GROUPS``
sources, so its memory grows neither with the vocabulary nor with the sources.
The result itself has a row for each two sources of a language.

Defined cases: null text, language and source are ''; a group without kept terms
has ``N = 0``; a language without kept terms has pairs of value 0 and no terms;
repeated rows count as often as they occur; equal values rank by item; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import perfect_hash
from .common import BROADCAST_BYTES, saved

LEAST = 10
RANKS = 10
SCALE = 10 ** 9
SHARD_TERMS = 4096
DENSE_SLOTS = 1 << 24       # of 4 bytes, held by a task at once
FLUSH_TERMS = 400_000       # distinct terms that a task counts before it sends them
_ROWS = 500
_GROUPS = 256
# letters in lower case, everything else as a space; bytes from 128 on are parts of letters
_LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 128 else 32 for i in range(256))
_INT = np.dtype("<i4")


def _terms(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_LETTERS).split()


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.col("text").cast("binary").alias("data"))


def _texts(batches: Iterator[pa.RecordBatch], rows: int = _ROWS) -> Iterator[tuple[list[str], list[str], list]]:
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            part = batch.slice(low, rows)
            yield part["lang"].to_pylist(), part["source"].to_pylist(), part["data"].to_pylist()


def kept_terms(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(lang, term)`` of the terms in ``least`` rows or more of the language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, terms in found.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([t.decode("utf-8", "replace") for t in terms], pa.string()),
                     pa.array(list(terms.values()), pa.int64())], names=["lang", "term", "n"])
            found.clear()
        for langs, _, texts in _texts(batches):
            for lang, text in zip(langs, texts, strict=True):
                if lang not in found:
                    found[lang] = Counter()
                found[lang].update(set(_terms(text)))
            if sum(map(len, found.values())) > FLUSH_TERMS:
                yield from sent()
        yield from sent()
    return (_input(docs).mapInArrow(count, "lang string, term string, n long")
            .groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term"))


def perfect_hashes(terms: DataFrame, shards: int) -> DataFrame:
    """``(lang, shard, seed, displacements, terms)``: the terms of a shard in the order of their slots."""
    shard = F.expr(f"cast(shiftrightunsigned(xxhash64(term), 32) % {shards} as int)")

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        seed, displacements, placed = perfect_hash.build([t.encode() for t in pdf["term"]])
        return pd.DataFrame({"lang": [key[0]], "shard": [key[1]], "seed": [seed], "displacements": [displacements.tolist()],
                             "terms": [[t.decode() for t in placed]]})
    return (terms.withColumn("shard", shard).groupBy("lang", "shard")
            .applyInPandas(build, "lang string, shard int, seed int, displacements array<int>, terms array<string>"))


def _sharded(rows, shards: int) -> dict[str, perfect_hash.ShardedHash]:
    """The languages' perfect hashes; a shard without terms is empty."""
    none = perfect_hash.FIRST_SEED, np.zeros(0, np.int32), []
    by_lang: dict[str, list] = {}
    for lang, shard, seed, displacements, terms in rows:
        by_lang.setdefault(lang, [none] * shards)[shard] = (
            seed, np.frombuffer(displacements, _INT), terms.split(b"\n") if terms else [])
    return {lang: perfect_hash.ShardedHash(found) for lang, found in by_lang.items()}


class _Slots:
    """Dense counts of (lang, source) groups over the slots of their language."""

    def __init__(self, tables: dict[str, perfect_hash.ShardedHash]):
        self.tables, self.counts, self.held, self.words = tables, {}, 0, 0

    def add(self, langs, sources, texts) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, dict[str, list[bytes]]] = {}
        for lang, source, text in zip(langs, sources, texts, strict=True):
            by_lang.setdefault(lang, {}).setdefault(source, []).extend(_terms(text))
        for lang, groups in by_lang.items():
            table = self.tables.get(lang)
            number: dict[bytes, int] = {}
            tokens = {s: np.array([number.setdefault(t, len(number)) for t in terms], np.int64) for s, terms in groups.items()}
            slots = table.slots(list(number)) if table else np.full(len(number), -1, np.int64)
            for source, own in tokens.items():
                n = len(table.keys) if table else 0
                if (lang, source) not in self.counts:
                    if self.counts and self.held + n > DENSE_SLOTS:
                        yield from self.sent()
                elif self.words + len(own) >= 1 << 31:          # what 4 bytes can count
                    yield from self.sent()
                if (lang, source) not in self.counts:
                    self.counts[lang, source] = np.zeros(n, np.int32)
                    self.held += n
                self.words += len(own)
                at, times = np.unique(slots[own], return_counts=True)
                known = at >= 0
                self.counts[lang, source][at[known]] += times[known].astype(np.int32)

    def sent(self) -> Iterator[pa.RecordBatch]:
        """Per group and shard the slots in use and their counts; a group without any: shard 0, no slots."""
        for (lang, source), dense in self.counts.items():
            used = np.flatnonzero(dense)
            rows = [(lang, source, 0, b"", b"")] if not len(used) else []
            if len(used):
                table = self.tables[lang]
                shard = np.searchsorted(table.bases, used, "right") - 1
                cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
                for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(used)], strict=True):
                    i = int(shard[a])
                    rows.append((lang, source, i, (used[a:b] - table.bases[i]).astype(_INT).tobytes(),
                                 dense[used[a:b]].astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _COUNT_TYPES, strict=True)], names=_COUNT_NAMES)
        self.counts, self.held, self.words = {}, 0, 0


_COUNTS = "lang string, source string, shard int, slots binary, counts binary"
_COUNT_NAMES = [c.split()[0] for c in _COUNTS.split(", ")]
_COUNT_TYPES = [pa.string(), pa.string(), pa.int32(), pa.binary(), pa.binary()]


def _summed(parts: DataFrame, shards: int) -> DataFrame:
    """One row per group and shard.  Rows of a key follow each other and are added one by one."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, np.zeros(0, np.int64)

        def row() -> Iterator[pa.RecordBatch]:
            if key is not None:
                used = np.flatnonzero(total)
                values = (*key, used.astype(_INT).tobytes(), total[used].astype("<i8").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _COUNT_TYPES, strict=True)], names=_COUNT_NAMES)
        for batch in batches:
            for lang, source, shard, slots, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lang, source, shard) != key:
                    yield from row()
                    key, total = (lang, source, shard), np.zeros(0, np.int64)
                at = np.frombuffer(slots, _INT)
                if len(at):
                    if at[-1] >= len(total):                    # slots are sorted
                        total = np.concatenate([total, np.zeros(at[-1] + 1 - len(total), np.int64)])
                    total[at] += np.frombuffer(counts, "<i8")
        yield from row()
    key = ["lang", "source", "shard"]
    n = max(shards, int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return parts.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(add, _COUNTS)


def slot_counts(docs: DataFrame, hashed: DataFrame, shards: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``_COUNTS``: per group and shard the slots in use and their counts, one row each; every group has a row of shard 0 or more."""
    size = F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 9) + 4 * F.size("displacements"))
    if (hashed.agg(size).first()[0] or 0) > limit:
        return _slot_counts_joined(docs, hashed)

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pydict({
                "lang": [r["lang"] for r in rows], "shard": pa.array([r["shard"] for r in rows], pa.int32()),
                "seed": pa.array([r["seed"] for r in rows], pa.int32()),
                "displacements": pa.array([np.array(r["displacements"], _INT).tobytes() for r in rows], pa.binary()),
                "terms": pa.array(["\n".join(r["terms"]).encode() for r in rows], pa.binary())})
    packed = hashed.mapInArrow(flat, "lang string, shard int, seed int, displacements binary, terms binary")
    shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in packed.collect()])      # measured above

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Slots(_sharded(shared.value, shards))
        for rows in _texts(batches):
            yield from groups.add(*rows)
        yield from groups.sent()
    return _summed(_input(docs).mapInArrow(count, _COUNTS), shards)


def _slot_counts_joined(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """``slot_counts`` for perfect hashes too large to broadcast: terms, counted per task, are joined with their slots."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], Counter] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in found.items():
                # the empty term marks the group
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(terms) + 1), pa.string()), pa.array([source] * (len(terms) + 1), pa.string()),
                     pa.array(["", *(t.decode("utf-8", "replace") for t in terms)], pa.string()), pa.array([1, *terms.values()], pa.int64())],
                    names=["lang", "source", "term", "n"])
            found.clear()
        for rows in _texts(batches):
            for lang, source, text in zip(*rows, strict=True):
                if (lang, source) not in found:
                    found[lang, source] = Counter()
                found[lang, source].update(_terms(text))
            if sum(map(len, found.values())) > FLUSH_TERMS:
                yield from sent()
        yield from sent()
    counted = (_input(docs).mapInArrow(count, "lang string, source string, term string, n long")
               .groupBy("lang", "source", "term").agg(F.sum("n").alias("n")))
    slots = hashed.select("lang", "shard", F.posexplode("terms").alias("slot", "term"))
    known = counted.join(slots, ["lang", "term"]).select("lang", "source", "shard", "slot", "n")
    marks = counted.where("term = ''").select("lang", "source", F.lit(0).alias("shard"),
                                              F.lit(None).cast("int").alias("slot"), F.lit(0).cast("long").alias("n"))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf.dropna(subset=["slot"]).sort_values("slot")        # the slots of one shard at most
        return pd.DataFrame([(*key, own["slot"].to_numpy().astype(_INT).tobytes(), own["n"].to_numpy().astype("<i8").tobytes())],
                            columns=_COUNT_NAMES)
    return known.unionByName(marks).groupBy("lang", "source", "shard").applyInPandas(pack, _COUNTS)


def shares(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """``1 + floor(SCALE (count + 2) / (total + 2 terms))``; exact for totals below 9 10^15."""
    whole, rest = np.divmod(counts + 2, total + 2 * terms)
    for _ in range(3):                      # SCALE is 1000^3
        digit, rest = np.divmod(rest * 1000, total + 2 * terms)
        whole = whole * 1000 + digit
    return 1 + whole


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _shard_part(base, own: pd.DataFrame, ranks: int) -> Iterator[tuple]:
    """Rows ``(source, part, item, value)`` of one shard of a language's slots."""
    sources, totals = list(base["sources"]), np.array(base["totals"], np.int64)
    terms, n = ([] if base["terms"] is None else list(base["terms"])), int(base["n_terms"])
    number = {s: i for i, s in enumerate(sources)}
    place = [number[s] for s in own["source"]]
    slots = [np.frombuffer(x, _INT) for x in own["slots"]]
    counts = [np.frombuffer(x, "<i8") for x in own["counts"]]
    of_lang = np.zeros(len(terms), np.int64)
    for at, c in zip(slots, counts, strict=True):
        of_lang[at] += c

    def matrix(low: int) -> np.ndarray:
        block = np.zeros((min(_GROUPS, len(sources) - low), len(terms)), np.int64)
        for i, at, c in zip(place, slots, counts, strict=True):
            if low <= i < low + len(block):
                block[i - low, at] += c
        return shares(block, totals[low:low + len(block), None], n) if n else block
    q = shares(of_lang, totals.sum(), n) if n else of_lang
    sent = np.array([t.encode() for t in terms], object)
    for low in range(0, len(sources), _GROUPS):
        p = matrix(low)
        for high in range(low, len(sources), _GROUPS):
            other = p if high == low else matrix(high)
            for i in range(len(p)):
                first = i + 1 if high == low else 0
                values = distances(p[i], other[first:]).sum(axis=1) if n else np.zeros(len(other) - first, np.int64)
                for j, value in enumerate(values.tolist(), high + first):
                    yield sources[low + i], "pair", sources[j], value
                    yield sources[j], "pair", sources[low + i], value
        for i, at, c in zip(place, slots, counts, strict=True):
            if low <= i < low + len(p):
                mine = at[c > 0]
                mine = mine[p[i - low, mine] > q[mine]]
                value = distances(p[i - low, mine], q[mine])
                # of equal values the first by their bytes
                for j in sorted(range(len(mine)), key=lambda j: (-value[j], sent[mine[j]]))[:ranks]:
                    yield sources[i], "term", terms[mine[j]], int(value[j])


def audit(docs: DataFrame, least: int = LEAST, ranks: int = RANKS, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``(lang, source, part, item, value, rank)``."""
    terms = saved(kept_terms(docs, least), "divergence-terms")
    shards = max(1, -(-terms.count() // SHARD_TERMS))
    hashed = saved(perfect_hashes(terms, shards), "divergence-hashes")
    counted = saved(slot_counts(docs, hashed, shards, limit), "divergence-slots")

    def total(counts: pd.Series) -> pd.Series:
        return counts.map(lambda x: int(np.frombuffer(x, "<i8").sum()))
    groups = counted.groupBy("lang", "source").agg(F.sum(F.pandas_udf(total, "long")("counts")).alias("n"))
    # per language its sources: the result has a row for each two of them
    langs = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("g")).select(
        "lang", F.col("g.source").alias("sources"), F.col("g.n").alias("totals"))
    sizes = hashed.groupBy("lang").agg(F.sum(F.size("terms")).alias("n_terms"))
    # a language without terms has one shard, an empty one
    base = (langs.join(sizes, "lang", "left").join(hashed.select("lang", "shard", "terms"), "lang", "left")
            .select("lang", F.coalesce("shard", F.lit(0)).alias("shard"), "sources", "totals",
                    F.coalesce("n_terms", F.lit(0)).alias("n_terms"), "terms"))

    def part(key: tuple, own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rows = [(key[0], *row) for base in own.to_dict("records") for row in _shard_part(base, found, ranks)]
        return pd.DataFrame(rows, columns=["lang", "source", "part", "item", "value"])
    # a group without slots has a row in shard 0, which may have no terms
    some = counted.where(F.octet_length("slots") > 0).select(
        F.col("lang").alias("_lang"), F.col("shard").alias("_shard"), "source", "slots", "counts")
    parts = base.groupBy("lang", "shard").cogroup(some.groupBy("_lang", "_shard")).applyInPandas(
        part, "lang string, source string, part string, item string, value long")
    added = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    numbered = F.row_number().over(order)
    pairs = added.where("part = 'pair'").withColumn("rank", numbered)
    tops = added.where("part = 'term'").withColumn("rank", numbered).where(F.col("rank") <= ranks)
    return pairs.unionByName(tops)


REPORT_SQL = r"""
with d as (
    select row_number() over () as i, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
t as (select i, lang, source, unnest(w) as term from d),
kept as (select lang, term from t group by lang, term having count(distinct i) >= 10),
v as (select lang, count(*) as v from kept group by lang),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from t semi join kept using (lang, term) group by all),
gn as (select g.lang, g.source, coalesce(sum(n), 0) as total from g left join c using (lang, source) group by all),
gp as (
    select gn.lang, gn.source, kept.term, coalesce(c.n, 0) as n,
           1 + cast(1000000000 as hugeint) * (coalesce(c.n, 0) + 2) // (cast(gn.total as hugeint) + 2 * v.v) as p
    from gn join kept on kept.lang = gn.lang join v on v.lang = gn.lang
    left join c on c.lang = gn.lang and c.source = gn.source and c.term = kept.term),
lp as (
    select lang, term, 1 + cast(1000000000 as hugeint) * (sum(n) + 2) // (cast(any_value(total) as hugeint) + 2 * any_value(v)) as q
    from gp join (select lang, sum(total) as total from gn group by lang) using (lang) join v using (lang) group by lang, term),
pairs as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from gp a join gp b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
every_pair as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
    left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source),
terms as (
    select lang, source, 'term' as part, term as item, (p - q) * (p - q) // (p + q) as value
    from gp join lp using (lang, term) where n > 0 and p > q),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
    from (select * from every_pair union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank
from ranked where part = 'pair' or rank <= 10
"""
