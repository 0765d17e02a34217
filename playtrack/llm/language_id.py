"""Language identification by Bayesian evidence fusion.

The modelled languages are ``LANGUAGES`` and every other one that a row with a
text declares, however few its rows or many the languages.  The posterior over
them and ``und`` (none of them) combines

* text: hashed byte-trigram likelihoods, learned from all rows that declare a
  modelled language.  Neighbouring trigrams are not independent, so ``n`` of
  them weigh as ``n / (1 + n / SATURATION)``;
* the declared markup language, right with probability ``DECLARED_RIGHT``;
* a prior by host, smoothed hierarchically: a host's declared counts are
  shrunk towards those of its address suffix, these towards all rows, these
  towards equal shares.  The counts are grouped aggregations over all rows.

Scale: training sums trigram counts per task before one small shuffle.  The
model is a table of (language, bucket, weight) for the trigrams that a language
has; the others follow from its total.  It is broadcast only if its measured
size is within the limit; beyond it, the documents' bucket counts are joined
with it by bucket.  A document's score is a sum over its buckets, worked off in
slices, so memory grows neither with the text nor with the model.  The driver
holds a name and two numbers a language.  Host priors are joined by host:
broadcast if their measured size allows, else by shuffle.

Defined cases: a null or empty text gives no text evidence and is rejected as
``und`` (posterior 1): without text there is no language; an unknown or null
declared language gives no evidence; null hosts and suffixes are a host and a
suffix of their own; equal posteriors go to the language named first; repeated
rows get the same result; an empty table gives no rows, and a model without
training rows leaves the decision to the other evidence; other columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, read_table, saved, sized_broadcast

LANGUAGES = ("en", "fr", "de", "es")     # modelled in any table; others where a row declares them
UNKNOWN = "und"
BUCKETS = 1 << 16
SMOOTHING = 0.5
SATURATION = 200.0
DECLARED_RIGHT = 0.8
SHRINK = 20.0            # rows that a parent's share counts for
UNKNOWN_PRIOR = 0.01
LEAST_POSTERIOR = 0.5
_SLICE = 1 << 20
_TERMS = 1 << 18         # weights added at once
_HELD = 64               # languages that a task counts before it sends them
_ENTRY_BYTES = 16


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of the byte trigrams of a text in lower case, in slices."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    for at in range(0, max(len(data) - 2, 0), _SLICE):
        b = data[at:at + _SLICE + 2].astype(np.uint32)
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        yield ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def modelled(rows: DataFrame) -> tuple[str, ...]:
    """``LANGUAGES`` and every other language that a row with a text declares, by name."""
    more = rows.where(~F.col("declared").isin("", UNKNOWN, *LANGUAGES) & (F.trim("text") != "")).select("declared").distinct()
    return (*LANGUAGES, *sorted(r["declared"] for r in more.collect()))


def bucket_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's trigrams, and how many are in each."""
    total = np.zeros(BUCKETS, np.int64)
    for grams in trigrams(text):
        total += np.bincount(grams, minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass
class Model:
    """Log likelihoods: ``base[language]`` for a trigram that the language lacks, ``base + weight`` for one that it has."""

    languages: tuple[str, ...]
    base: np.ndarray
    weights: DataFrame          # (lang, bucket, weight)

    def entries(self) -> Entries:
        """The weights on the driver; their size is to be checked before."""
        found = self.weights.toPandas().sort_values(["bucket", "lang"])
        starts = np.searchsorted(found["bucket"].to_numpy(), np.arange(BUCKETS + 1))
        return Entries(self.base, starts, found["lang"].to_numpy(np.int32), found["weight"].to_numpy(float))


@dataclass
class Entries:
    """Weights by bucket: those of bucket ``b`` are ``starts[b]`` to ``starts[b + 1]``."""

    base: np.ndarray
    starts: np.ndarray
    lang: np.ndarray
    weight: np.ndarray

    def likelihoods(self, text: str) -> tuple[np.ndarray, int]:
        """Per language the log likelihood of a text, and the number of its trigrams."""
        bucket, times = bucket_counts(text)
        n, like = int(times.sum()), np.zeros(len(self.base))
        size = self.starts[bucket + 1] - self.starts[bucket]
        ends = np.cumsum(size)
        low = 0
        while low < len(bucket):
            high = max(int(np.searchsorted(ends, (ends[low - 1] if low else 0) + _TERMS, "right")), low + 1)
            own = size[low:high]
            at = np.repeat(self.starts[bucket[low:high]] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            like += np.bincount(self.lang[at], self.weight[at] * np.repeat(times[low:high], own), len(like))
            low = high
        return like + n * self.base, n


def train(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> Model:
    """A model of the languages from all rows (``text``, ``declared``) that declare one."""
    number = {x: i for i, x in enumerate(languages)}

    def count(batches):
        held: dict[int, np.ndarray] = {}

        def sent():
            for lang, total in held.items():
                bucket = np.flatnonzero(total)
                yield pd.DataFrame({"lang": lang, "bucket": bucket, "n": total[bucket]})
            held.clear()
        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["declared"], strict=True):
                if lang in number:
                    if number[lang] not in held and len(held) >= _HELD:
                        yield from sent()
                    total = held.setdefault(number[lang], np.zeros(BUCKETS, np.int64))
                    for grams in trigrams(text):
                        total += np.bincount(grams, minlength=BUCKETS)
        yield from sent()
    counted = saved(rows.where(F.col("declared").isNotNull() & F.col("text").isNotNull()).select("text", "declared")
                    .mapInPandas(count, "lang int, bucket int, n long")
                    .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    total = np.zeros(len(languages))
    for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect():      # a row per language
        total[r["lang"]] = r["n"]
    weights = counted.select("lang", "bucket", F.log((F.col("n") + SMOOTHING) / SMOOTHING).alias("weight"))
    return Model(languages, np.log(SMOOTHING / (total + SMOOTHING * BUCKETS)), weights)


def host_priors(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> tuple[DataFrame, list[float]]:
    """``(_host, _suffix, prior)`` of all hosts, and the prior of all rows together."""
    of = [F.sum(F.when(F.col("declared") == x, 1).otherwise(0)).cast("double") for x in languages]
    hosts = saved(rows.select(F.col("host").alias("_host"), F.col("suffix").alias("_suffix"), "declared")
                  .groupBy("_host", "_suffix").agg(F.array(*of).alias("n")), "language-hosts")
    parts = [F.sum(F.get("n", i)) for i in range(len(languages))]
    suffixes = hosts.groupBy("_suffix").agg(F.array(*parts).alias("s"))
    everything = hosts.agg(F.array(*parts).alias("a")).first()["a"] if not hosts.isEmpty() else [0.0] * len(languages)
    total = sum(everything)
    top = [(x + SHRINK / len(languages)) / (total + SHRINK) for x in everything]

    def shrunk(counts: str, parent: Column) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.transform(counts, lambda x, i: (x + SHRINK * F.get(parent, i)) / (n + SHRINK))
    level = suffixes.select("_suffix", shrunk("s", F.array(*map(F.lit, top))).alias("p"))
    both = hosts.alias("h").join(level.alias("l"), F.col("h._suffix").eqNullSafe(F.col("l._suffix")))
    return saved(both.select("h._host", "h._suffix", shrunk("n", F.col("p")).alias("prior")), "language-priors"), top


def _posterior(like: np.ndarray, n: int, declared: str | None, prior, number: dict[str, int]) -> tuple[str, float, str]:
    """Language, posterior and the language of the text alone; ``like``: per language the log likelihood of ``n`` trigrams."""
    k, languages = len(number), list(number)
    like = np.append(like, -n * np.log(BUCKETS))
    like /= 1.0 + n / SATURATION
    log = like.copy()
    log[:k] += np.log(np.asarray(prior, float) * (1 - UNKNOWN_PRIOR))
    log[k] += np.log(UNKNOWN_PRIOR)
    if declared in number:
        said = np.full(k + 1, (1 - DECLARED_RIGHT) / max(k - 1, 1))
        said[number[declared]] = DECLARED_RIGHT
        said[k] = 1 / k
        log += np.log(said)
    log = np.exp(log - log.max())
    names = (*languages, UNKNOWN)
    best = int(log.argmax())
    return names[best], float(log[best] / log.sum()), names[int(like.argmax())]


_FOUND = "struct<lang string, posterior double, text_lang string>"
_NOTHING = (UNKNOWN, 1.0, UNKNOWN)


def _blank(text: str | None) -> bool:
    return not text or not text.strip()


def identify(rows: DataFrame, model: Model, priors: tuple[DataFrame, list[float]],
             accept: tuple[str, ...] | None = None, least_posterior: float = LEAST_POSTERIOR,
             limit: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` (``_row``, ``text``, ``declared``, ``host``, ``suffix``) as ``_row`` with
    ``id`` = ``(lang, posterior, text_lang, accepted)``; accepted languages are the modelled ones unless given."""
    number = {x: i for i, x in enumerate(model.languages)}
    table, top = priors
    lookup = sized_broadcast(table, F.octet_length(F.concat_ws("", "_host", "_suffix")) + 8 * len(number) + 64)

    def with_prior(df: DataFrame) -> DataFrame:
        joined = df.join(lookup, df["host"].eqNullSafe(lookup["_host"]) & df["suffix"].eqNullSafe(lookup["_suffix"]), "left")
        return joined.withColumn("prior", F.coalesce("prior", F.array(*map(F.lit, top))))
    if model.weights.count() * _ENTRY_BYTES <= limit:
        shared = rows.sparkSession.sparkContext.broadcast(model.entries())     # measured

        @F.pandas_udf(_FOUND)
        def fused(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for texts, said, prior in parts:
                yield pd.DataFrame([_NOTHING if _blank(t) else _posterior(*shared.value.likelihoods(t), d, p, number)
                                    for t, d, p in zip(texts, said, prior, strict=True)], columns=["lang", "posterior", "text_lang"])
        found = with_prior(rows).select("_row", fused("text", "declared", "prior").alias("x"))
    else:
        found = _identify_joined(rows, model, with_prior, number)
    accepted = F.col("x.lang").isin(*(accept or model.languages)) & (F.col("x.posterior") >= least_posterior)
    return found.select("_row", F.col("x").withField("accepted", accepted).alias("id"))


def _identify_joined(rows: DataFrame, model: Model, with_prior, number: dict[str, int]) -> DataFrame:
    """``identify`` with a model too large to broadcast: bucket counts meet its weights in a join by bucket."""
    rows = saved(rows.withColumn("_n", F.monotonically_increasing_id()), "language-rows")
    base = model.base

    def count(batches):
        for pdf in batches:
            for n, text in zip(pdf["_n"], pdf["text"], strict=True):
                if not _blank(text):
                    bucket, times = bucket_counts(text)
                    # bucket -1: the number of all trigrams
                    yield pd.DataFrame({"_n": n, "bucket": np.append(-1, bucket), "times": np.append(times.sum(), times)})
    counted = rows.select("_n", "text").mapInPandas(count, "_n long, bucket int, times long")
    scores = (counted.join(model.weights, "bucket").groupBy("_n", "lang").agg(F.sum(F.col("times") * F.col("weight")).alias("score"))
              .withColumn("times", F.lit(0).cast("long")))
    marks = counted.where("bucket = -1").select("_n", F.lit(-1).alias("lang"), F.lit(0.0).alias("score"), "times")
    # per row at most one entry a language
    likes = scores.unionByName(marks).groupBy("_n").agg(F.collect_list("lang").alias("langs"), F.collect_list("score").alias("scores"),
                                                        F.sum("times").alias("n"))

    @F.pandas_udf(_FOUND)
    def fused(langs: pd.Series, scores: pd.Series, n: pd.Series, said: pd.Series, prior: pd.Series) -> pd.DataFrame:
        out = []
        for own, score, times, d, p in zip(langs, scores, n, said, prior, strict=True):
            if own is None:
                out.append(_NOTHING)
                continue
            like = np.append(int(times) * base, 0.0)        # the mark's entry, -1, is the last
            like[own] += score
            out.append(_posterior(like[:-1], int(times), d, p, number))
        return pd.DataFrame(out, columns=["lang", "posterior", "text_lang"])
    return with_prior(rows).join(likes, "_n", "left").select("_row", fused("langs", "scores", "n", "declared", "prior").alias("x"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents: the declared language is ``lang``, the host is ``source``; they have no address suffix."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text"),
                       F.lower(F.col("lang")).alias("declared"), F.col("source").alias("host"),
                       F.lit("").alias("suffix"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages: language declared in the markup, host and last label of the address, text without markup."""
    plain = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    said = F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2})", 1))
    return (pages.select(F.struct("page_id").alias("_row"), plain.alias("text"), said.alias("declared"),
                         F.lower(host).alias("host"))
            .withColumn("suffix", F.element_at(F.split("host", r"\."), -1)))


def accepted_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without those that are rejected; columns as they are."""
    rows = document_evidence(docs)
    known = modelled(rows)
    out = identify(rows, train(rows, known), host_priors(rows, known))
    return out.where("id.accepted").select("_row.*")


def identify_all(spark, sf_dir: str) -> DataFrame:
    """Every document and every page with its language.

    One text model of the languages that the documents declare is learned from
    all documents; each table has its own host priors.  ``doc_id`` is null in rows of pages, ``page_id`` in rows of documents.
    """
    docs = document_evidence(read_table(spark, sf_dir, "documents"))
    pages = page_evidence(read_table(spark, sf_dir, "pages"))
    known = modelled(docs)
    model = train(docs, known)
    none = F.lit(None).cast("long")
    a = identify(docs, model, host_priors(docs, known)).select(
        F.col("_row.doc_id").cast("long").alias("doc_id"), none.alias("page_id"), "id.*")
    b = identify(pages, model, host_priors(pages, known)).select(
        none.alias("doc_id"), F.col("_row.page_id").cast("long").alias("page_id"), "id.*")
    return a.unionByName(b)
