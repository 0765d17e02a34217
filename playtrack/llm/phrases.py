"""Phrase collocation mining with mergeable Misra-Gries summaries.

Texts are cut into pieces at ``BREAKS`` and pieces into words; A-Z are lower-cased.
A phrase of 2 to ``longest`` words that occurs ``least`` times in its language
is a candidate; its score is ``a^2 / (l r)`` (times ``SCALE``, rounded down) at
the cut into two parts that makes it least.  Candidates of which a longer
candidate has at least ``inside`` percent of the occurrences are dropped.

1. ``word_blocks``: words of about ``BLOCK_TOKENS`` tokens as numbers into the
   block's own word list, written to the shared folder.
2. ``summaries``: the distinct n-grams of a block (hashes that depend on the
   language, ``SPARE_BITS`` wider than the corpus' mass) with their counts, one
   row per hash bucket.  Equal hashes can only add survivors, never lose one.
3. ``survivors``: a bucket merges its summaries into one of a capacity above
   its mass divided by ``least``.  A merged counter is short by at most
   mass / (capacity + 1), which is less than ``least``; so every n-gram that
   occurs ``least`` times still has a counter, and survives: a counter goes
   only if it and what merging took from it are below ``least`` together.
   Each block gets the survivors among its own.
4. ``exact_counts``: a second pass over the blocks counts the survivors as
   words, not as hashes (equal hashes of different words are told apart), and
   the counts are added up by language and phrase.
5. ``collocations``: joins and grouped aggregates over the counted phrases.

Scale: buckets and the partitions that hold them grow with the mass.  A block
names an n-gram once, so a phrase that is in every document is as cheap as any
other.  The count tables are joined on (language, phrase); their inputs are
direct, so adaptive execution splits a word that starts very many phrases.  Of
a language's ranks, each partition sends ``first`` rows at most.

Defined cases: null and empty texts have no words; a null language is ``und``;
repeated rows count as often as they occur; equal scores go by occurrences,
then by the phrase's bytes; a text longer than a block goes on in the next one
with its last words as context; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

LONGEST = 3
LEAST = 10
INSIDE = 50             # percent of a candidate's occurrences
FIRST = 2000            # ranks reported per language
SCALE = 1_000_000
NO_LANGUAGE = "und"
BREAKS = b".,;:!?\n\x0b\x0c\r"      # fixed by the result's definition
BLOCK_TOKENS = 1 << 19
BUCKET_BYTES = 16 << 20
SPARE_BITS = 10         # one n-gram in 2^10 or fewer shares its hash
BLOCK_SCHEMA = "block long, skip int, langs array<string>, n_tokens int, tokens binary, lang_of binary, words binary"
# letters in lower case, every break as the first one
_PLAIN = bytes(BREAKS[0] if i in BREAKS else i + 32 if 65 <= i <= 90 else i for i in range(256))
_BREAK = BREAKS[:1]
_TABLE_BITS = 22


def _planes(a: np.ndarray) -> bytes:
    """Unsigned 64-bit integers as the bytes that they need: how many, then all lowest bytes, all second ones, and so on."""
    width = -(-int(a.max(initial=0)).bit_length() // 8)
    planes = a.astype("<u8", copy=False).view(np.uint8).reshape(len(a), 8)[:, :width]
    return bytes([width]) + planes.T.tobytes()


def _unplaned(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], n).T
    return out.view("<u8").ravel()


def _sorted_hashes(a: np.ndarray) -> bytes:
    return _planes(np.diff(a, prepend=np.uint64(0)))


def _hashes(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unplaned(data, n), dtype=np.uint64)


class _Numbers(dict):
    """Word numbers of one language: a new word takes the next number of its block."""

    def __init__(self, block: _Block, lang: int):
        super().__init__({_BREAK: 0})
        self.block, self.lang = block, lang

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.block.words)
        self.block.words.append(word)
        self.block.lang_of.append(self.lang)
        return n


class _Block:
    """Words as numbers; number 0 is a break.  The first ``skip`` tokens are context that counts elsewhere."""

    def __init__(self):
        self.skip, self.tokens, self.words, self.lang_of = 0, [], [_BREAK], [0]
        self.numbers: dict[str, _Numbers] = {}

    def add(self, lang: str, words: list[bytes]) -> None:
        if lang not in self.numbers:
            self.numbers[lang] = _Numbers(self, len(self.numbers))
        self.tokens.extend(map(self.numbers[lang].__getitem__, words))

    def batch(self, name: int) -> pa.RecordBatch:
        columns = [pa.array([name], pa.int64()), pa.array([self.skip], pa.int32()),
                   pa.array([list(self.numbers)], pa.list_(pa.string())),
                   pa.array([len(self.tokens)], pa.int32()),
                   pa.array([_planes(np.array(self.tokens, "<u8"))], pa.binary()),
                   pa.array([_planes(np.array(self.lang_of, "<u8"))], pa.binary()),
                   pa.array([b" ".join(self.words)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])


def word_blocks(docs: DataFrame, longest: int = LONGEST, tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The documents' words in blocks (``BLOCK_SCHEMA``)."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        block, made = _Block(), 0
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["data"], strict=True):
                words = (text.as_py() or b"").translate(_PLAIN).replace(_BREAK, b" . ").split()
                words.append(_BREAK)                    # phrases end with the text
                at = 0
                while at < len(words):
                    if at:
                        context = words[max(at - longest + 1, 0):at]
                        block.add(lang, context)
                        block.skip = len(context)
                    own = words[at:at + max(tokens - len(block.tokens), 1)]
                    block.add(lang, own)
                    at += len(own)
                    if len(block.tokens) >= tokens:
                        yield block.batch(base + made)
                        block, made = _Block(), made + 1
        if block.tokens:
            yield block.batch(base + made)
    lang = F.coalesce(F.col("lang"), F.lit(NO_LANGUAGE)).alias("lang")
    return docs.select(lang, F.col("text").cast("binary").alias("data")).mapInArrow(fill, BLOCK_SCHEMA)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two, well mixed in all bits."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    for shift in (32, 29):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class _Grams:
    """The n-grams of a block."""

    def __init__(self, row, longest: int, bits: int = 64):
        self.longest, self.bits, self.skip = longest, bits, row["skip"]
        self.tokens = _unplaned(row["tokens"], row["n_tokens"]).astype(np.int32)
        self.words = row["words"].split(b" ")
        self.langs = list(row["langs"])
        self.lang_of = _unplaned(row["lang_of"], len(self.words))

    def word_hashes(self) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        seeds = [xxh3_64_intdigest(x) for x in self.langs] or [0]
        return np.fromiter((xxh3_64_intdigest(w, seeds[of]) for w, of in zip(self.words, self.lang_of.tolist(), strict=True)),
                           np.uint64, len(self.words))

    def word_counts(self) -> np.ndarray:
        """Occurrences of each word of the block's list that count here (the first is the break)."""
        counts = np.bincount(self.tokens[self.skip:], minlength=len(self.words))
        counts[0] = 0
        return counts

    def phrases(self, own: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per order from 2 the places where a phrase ends (it counts there), and its hash; one order in memory at a time."""
        own = own[self.tokens]
        whole, hashed = self.tokens > 0, own
        for n in range(2, self.longest + 1):
            whole = np.append(False, whole[:-1]) & (self.tokens > 0)
            hashed = _mix(np.append(np.uint64(0), hashed[:-1]), own)
            ends = np.flatnonzero(whole)
            ends = ends[np.searchsorted(ends, self.skip):].astype(np.int32)
            yield n, ends, self.narrow(hashed[ends])

    def narrow(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.bits)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: a batch may hold many blocks."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
        del batch
        pa.default_memory_pool().release_unused()


def summaries(blocks: DataFrame, longest: int, buckets: int, bits: int = 64) -> DataFrame:
    """``(bucket, block, n, grams, counts)``: a block's ``n`` distinct n-grams of all orders in a bucket, sorted by hash."""
    step = (1 << bits) // buckets
    bounds = np.array([i * step for i in range(1, buckets)], np.uint64)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = _Grams(row, longest, bits)
            words, n_words = block.word_hashes(), block.word_counts()
            grams, counts = np.unique(np.concatenate([h for _, _, h in block.phrases(words)]), return_counts=True)
            used = n_words > 0
            own = MisraGries(len(grams) + len(words))               # room for every n-gram: exact
            own.merge(np.concatenate([grams, block.narrow(words[used])]), np.concatenate([counts, n_words[used]]))
            edges = [0, *np.searchsorted(own.keys, bounds).tolist(), len(own.keys)]
            out = [(i, row["block"], b - a, _sorted_hashes(own.keys[a:b]), _planes(own.counts[a:b]))
                   for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
            if out:
                types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=["bucket", "block", "n", "grams", "counts"])
    return blocks.mapInArrow(summarise, "bucket int, block long, n int, grams binary, counts binary")


class MisraGries:
    """A summary of at most ``capacity`` counters over 64-bit keys; summaries merge.

    A counter is never above the key's true count and at most ``short`` below
    it, however the counts arrived; ``short`` is at most ``mass / (capacity + 1)``.
    """

    def __init__(self, capacity: int):
        self.capacity, self.short = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([self.counts, counts])[order]
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[new], np.add.reduceat(counts, new) if len(new) else counts
        if len(keys) > self.capacity:
            # the counter next after the largest ``capacity`` ones goes to zero; each of those loses as much
            less = np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1]
            counts = counts - less
            self.short += int(less)
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def at_least(self, least: int) -> np.ndarray:
        """All keys whose true count may be ``least``, sorted; needs a mass below ``least (capacity + 1)``."""
        return self.keys[self.counts + self.short >= least]


def survivors(asked: DataFrame, least: int, buckets: int, merged_at_once: int = 32) -> DataFrame:
    """``(block, n, grams)``: the block's n-grams of a bucket that its merged summary still holds."""
    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = [_unplaned(x, n) for x, n in zip(pdf["counts"], pdf["n"], strict=True)]
        summary = MisraGries(sum(int(c.sum()) for c in counts) // least + 1)
        grams = [_hashes(x, n) for x, n in zip(pdf["grams"], pdf["n"], strict=True)]
        for at in range(0, len(grams), merged_at_once):
            summary.merge(np.concatenate(grams[at:at + merged_at_once]),
                          np.concatenate(counts[at:at + merged_at_once]).astype(np.int64))
        often = summary.at_least(least)
        kept = [own[_among(own, often)[0]] if len(often) else own[:0] for own in grams]
        return pd.DataFrame({"block": pdf["block"], "n": [len(x) for x in kept], "grams": [_sorted_hashes(x) for x in kept]})
    least_parts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (asked.repartition(max(least_parts, buckets), "bucket").groupBy("bucket")
            .applyInPandas(reduce, "block long, n int, grams binary"))


def _counted(row, keep: np.ndarray, longest: int, bits: int = 64) -> pa.Table:
    """``(lang, phrase, a)``: a block's phrases whose hash is in ``keep`` (sorted), and each language's words (phrase null)."""
    grams = _Grams(row, longest, bits)
    hashes, n_words = grams.word_hashes(), grams.word_counts()
    totals = np.bincount(grams.lang_of, n_words, len(grams.langs)).astype(np.int64)
    langs, texts, counts = [np.arange(len(totals))], [None] * len(totals), [totals]

    def add(lang: np.ndarray, phrases: list[bytes], n: np.ndarray) -> None:
        langs.append(lang)
        texts.extend(phrases)
        counts.append(n)
    if len(keep):
        some = np.flatnonzero((n_words > 0) & _among(grams.narrow(hashes), keep)[0])
        add(grams.lang_of[some], [grams.words[i] for i in some.tolist()], n_words[some])
        # most phrases are told to be none of ``keep`` by the highest bits of their hash
        fewer = np.uint64(max(bits - _TABLE_BITS, 0))
        maybe = np.zeros(1 << min(bits, _TABLE_BITS), bool)
        maybe[keep >> fewer] = True
        for n, ends, hashed in grams.phrases(hashes):
            some = maybe[hashed >> fewer]
            ends, hashed = ends[some], hashed[some]
            hit, at = _among(hashed, keep)
            at, ends = at[hit], ends[hit]
            first = np.zeros(len(keep), np.int32)
            first[at[::-1]] = ends[::-1]
            # two phrases may share a hash: those that differ from the first with it are sent one by one
            same = np.ones(len(at), bool)
            for j in range(n):
                same &= grams.tokens[ends - j] == grams.tokens[first[at] - j]
            total = np.bincount(at[same], minlength=len(keep))
            some = np.flatnonzero(total)
            ends = np.concatenate([first[some], ends[~same]])
            numbers = grams.tokens[ends[:, None] + np.arange(1 - n, 1)]
            word = grams.words.__getitem__
            add(grams.lang_of[numbers[:, 0]], [b" ".join(map(word, x)) for x in numbers.tolist()],
                np.concatenate([total[some], np.ones(len(ends) - len(some), np.int64)]))
    names = pa.DictionaryArray.from_arrays(pa.array(np.concatenate(langs).astype(np.int32)), pa.array(grams.langs, pa.string()))
    return pa.table({"lang": names.dictionary_decode(), "phrase": pa.array(texts, pa.binary()).view(pa.string()),
                     "a": pa.array(np.concatenate(counts).astype(np.int64))})


def _among(hashes: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are in ``keep`` (sorted, not empty), and where."""
    at = np.searchsorted(keep, hashes)
    at[at == len(keep)] = 0
    return keep[at] == hashes, at


def exact_counts(blocks: DataFrame, kept: DataFrame, longest: int, least: int, bits: int = 64) -> DataFrame:
    """``(lang, phrase, a)`` of all phrases of ``least`` occurrences; with a null phrase: the words of a language."""
    def count(own: pa.Table, got: pa.Table) -> pa.Table:
        keep = np.sort(np.concatenate([np.zeros(0, np.uint64), *(
            _hashes(x, n) for x, n in zip(got["grams"].to_pylist(), got["n"].to_pylist(), strict=True))]))
        # every block has one row
        return pa.concat_tables(_counted(row, keep, longest, bits) for row in own.to_pylist())
    found = blocks.groupBy("block").cogroup(kept.groupBy("block")).applyInArrow(count, "lang string, phrase string, a long")
    return (found.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
            .where((F.col("a") >= least) | F.col("phrase").isNull()))


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``exact_counts`` of documents, written to the shared folder."""
    spark = docs.sparkSession
    blocks = saved(word_blocks(docs, longest, block_tokens), "phrase-blocks", **{"parquet.block.size": 16 << 20})
    mass = (blocks.agg(F.sum("n_tokens")).first()[0] or 0) * longest
    bits = min(64, max(32, mass.bit_length() + SPARE_BITS))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-mass * 12 // BUCKET_BYTES))
    kept = survivors(summaries(blocks, longest, buckets, bits), least, buckets)
    return saved(exact_counts(blocks, kept, longest, least, bits), "phrase-counts")


def _score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """``SCALE a^2 / (l r)`` rounded down, in decimals of 38 digits."""
    return F.expr(f"cast({a} as decimal(15,0)) * cast({a} as decimal(15,0)) * cast({SCALE} as decimal(7,0))"
                  f" div (cast({l} as decimal(15,0)) * cast({r} as decimal(15,0)))")


def collocations(counted: DataFrame, inside: int = INSIDE, first: int | None = FIRST) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)`` from ``phrase_counts``; all ranks if ``first`` is None."""
    totals = counted.where("phrase is null").select("lang", F.col("a").alias("n"))
    grams = counted.where("phrase is not null")
    cand = grams.select("lang", "phrase", "a", F.split("phrase", " ").alias("w")).where(F.size("w") > 1)
    size = F.size("w")
    cuts = cand.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, size - F.col("k")), " ").alias("right"))
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(grams.select("lang", F.col("phrase").alias(side), F.col("a").alias(count)), ["lang", side])
    scored = cuts.withColumn("score", _score("a", "l", "r")).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # every shorter phrase inside a candidate, with the most that a candidate around it occurs
    starts = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1), lambda m: F.transform(
            F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("w", i, m), " ")))))
    around = (cand.where(size > 2).select("lang", starts.alias("phrase"), F.col("a").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    free = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(order))
    if first is not None:
        ranked = ranked.where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE,
         first: int | None = FIRST) -> DataFrame:
    """The ranked collocations of every language."""
    return collocations(phrase_counts(docs, longest, least), inside, first)


REPORT_SQL = r"""
with d as (
    select row_number() over () as i, coalesce(lang, 'und') as lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
p as (select i, lang, unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')) as piece from d),
q as (select row_number() over () as i, lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
t as (select i, lang, unnest(range(1, len(w) + 1)) as pos, unnest(w) as a from q),
g as (select lang, a, lead(a) over (partition by i order by pos) as b, lead(a, 2) over (partition by i order by pos) as c from t),
f as (
    select lang, a as phrase, count(*) as f, 1 as k from g group by all union all
    select lang, a || ' ' || b, count(*), 2 from g where b is not null group by all union all
    select lang, a || ' ' || b || ' ' || c, count(*), 3 from g where c is not null group by all),
totals as (select lang, count(*) as n from g group by lang),
often as (select * from f where f >= 10),
cand as (select *, string_split(phrase, ' ') as w from often where k > 1),
cuts as (
    select lang, phrase, f, w, unnest(range(1, k)) as cut from cand),
scored as (
    select cuts.lang, cuts.phrase, cuts.f as a, cut, x.f as l, y.f as r,
           cast(1000000 as hugeint) * cuts.f * cuts.f // (cast(x.f as hugeint) * y.f) as score
    from cuts join often x on x.lang = cuts.lang and x.phrase = array_to_string(w[1:cut], ' ')
    join often y on y.lang = cuts.lang and y.phrase = array_to_string(w[cut + 1:], ' ')),
least_cut as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
longer as (
    select lang, w[1] || ' ' || w[2] as phrase, f from cand where k = 3 union all
    select lang, w[2] || ' ' || w[3], f from cand where k = 3),
free as (
    select * from least_cut s where not exists (
        select 1 from longer where longer.lang = s.lang and longer.phrase = s.phrase and 100 * longer.f >= 50 * s.a)),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from free)
select ranked.lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
       cast(n as bigint) as n, cast(score as bigint) as score
from ranked join totals on totals.lang = ranked.lang where rank <= 2000
"""
