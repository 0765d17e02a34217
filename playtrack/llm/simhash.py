"""SimHash near-duplicates by a generalised pigeonhole.

Fingerprints are 64-bit majority votes over the XXH64 hashes of word shingles
(repeats included).  Fingerprints link when they differ in at most ``max_bits``
bits; documents are grouped by the connected components of the links.

Candidate search, over distinct fingerprints only (exact copies meet in a
partial aggregation):

1. Bit statistics (64 means, 64 x 64 co-occurrences) are summed per task.
   Correlated bits are grouped into the same part, so that the parts tell
   different things.
2. For several numbers of parts, every part gets its own threshold ``t`` (-1:
   the part is not probed) with ``sum(t + 1) = max_bits + 1``; by the general
   pigeonhole two fingerprints within ``max_bits`` agree within ``t`` bits on
   some part.  A dynamic program picks the thresholds with the fewest
   estimated candidates plus signatures; the collision counts behind the
   estimate are counted over all fingerprints.
3. Fingerprints meet under ``(part, value)`` and pairs are verified with
   ``bit_count(a xor b)``.  A value shared by more than ``GROUP`` fingerprints
   never emits its pairs: its members are linked through common neighbours
   (each fingerprint under itself and every copy with ``ceil(max_bits / 2)``
   bits flipped).  Two fingerprints within ``max_bits`` bits share such a
   neighbour, and at most 65 distinct fingerprints share one (for 2 bits), so
   the work stays linear in the group and no link is lost.

Components: minimum-label steps plus pointer jumping; each round is written to
the shared folder, so the lineage stays short.

Defined cases: null or empty text has fingerprint zero, linked like any other;
a text with fewer words than a shingle is one shingle; repeated rows fall into
one component; null ids take part but never name a component unless all ids
of it are null; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, sized_broadcast, text_or_empty

BITS = 64
SEED = 42
GROUP = 64          # a value with more fingerprints is linked through neighbours
_SLICE = 1 << 15    # shingles summed at a time


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit SimHash of one text."""
    import xxhash

    words = (text or b"").lower().split()       # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        n = len(words) - shingle + 1
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED))
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, _SLICE):
        size = min(_SLICE, n - start)
        block = np.fromiter(itertools.islice(hashes, size), np.uint64, size)
        bits = np.unpackbits(block.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > n, bitorder="little")
    return int(packed.view(np.int64)[0])


def _digest():
    return F.xxhash64(text_or_empty("text"))


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, digest, fp)`` of every row; the digest tells texts of one id apart."""
    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([fingerprint(t, shingle) for t in s], dtype="int64")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest"),
                       fp(F.col("text").cast("binary")).alias("fp"))


# ---- planning the parts -------------------------------------------------------------------------

def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, per-bit ones and bit co-occurrences of all fingerprints: 64 x 64 numbers a task, then summed."""
    def partial(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for pdf in batches:
            x = np.ascontiguousarray(pdf["fp"].to_numpy(np.int64))
            for s in range(0, len(x), _SLICE):
                part = x[s:s + _SLICE]
                bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
                bits = bits.astype(np.float32)
                total += bits.T @ bits
                n += len(part)
        if n:
            i, j = np.nonzero(total)
            yield pd.DataFrame({"i": np.append(i, -1), "j": np.append(j, -1), "n": np.append(total[i, j], n)})
    rows = (fps.select("fp").mapInPandas(partial, "i long, j long, n double")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())     # at most 64 * 64 + 1 rows
    both, n = np.zeros((BITS, BITS)), 0
    for r in rows:
        if r["i"] < 0:
            n = int(r["n"])
        else:
            both[r["i"], r["j"]] = r["n"]
    return n, np.diag(both).copy(), both


def correlated_parts(n: int, ones: np.ndarray, both: np.ndarray, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of near-equal width; strongly correlated bits share a group."""
    p = ones / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, out = set(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        seed = max(sorted(left), key=lambda b: sum(corr[b, x] for x in left))
        group = [seed]
        left.discard(seed)
        while len(group) < width:
            best = max(sorted(left), key=lambda b: sum(corr[b, g] for g in group))
            group.append(best)
            left.discard(best)
        out.append(sorted(group))
    return out


def allocate(costs: list[list[float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds per part by dynamic programming.

    ``costs[i][t + 1]`` is the estimated work of part ``i`` at threshold ``t``
    (``t = -1``: not probed); thresholds satisfy ``sum(t + 1) = max_bits + 1``.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for slots, extra in enumerate(row):
                total = used + slots
                if total <= max_bits + 1 and (total not in step or cost + extra < step[total][0]):
                    step[total] = (cost + extra, [*chosen, slots - 1])
        best = step
    return best[max_bits + 1]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << BITS) if m >= 1 << (BITS - 1) else m


def plan_parts(fps: DataFrame, max_bits: int) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of the parts to probe."""
    n, ones, both = bit_statistics(fps)
    p = ones / max(n, 1)
    differ = 2 * p * (1 - p)                     # two fingerprints differ in a bit
    layouts = {m: correlated_parts(n, ones, both, m) for m in range(1, max_bits + 3)}
    labels = [(m, i, bits) for m, layout in layouts.items() for i, bits in enumerate(layout)]
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_mask(bits))).alias("v"))
                     for k, (_, _, bits) in enumerate(labels)])
    met = (fps.select(F.explode(keys).alias("x")).groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("c"))
           .groupBy("k").agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2).alias("pairs")).collect())
    pairs = {r["k"]: r["pairs"] for r in met}    # one number a part
    chosen: tuple[float, list[tuple[list[int], int]]] | None = None
    for m, layout in layouts.items():
        costs = []
        for k, (_, _, bits) in [(k, x) for k, x in enumerate(labels) if x[0] == m]:
            near = np.zeros(max_bits + 2)        # chance to differ in exactly d of these bits
            near[0] = 1.0
            for b in bits:
                near[1:] = near[1:] * (1 - differ[b]) + near[:-1] * differ[b]
                near[0] *= 1 - differ[b]
            row = [0.0]
            for t in range(max_bits + 1):
                grown = near[:t + 1].sum() / max(near[0], 1e-300)
                signatures = n * sum(comb(len(bits), d) for d in range(t + 1))
                row.append((pairs.get(k, 0.0) + n * n * 2.0 ** -BITS) * grown + signatures)
            costs.append(row)
        cost, thresholds = allocate(costs, max_bits)
        if chosen is None or cost < chosen[0]:
            chosen = cost, [(bits, t) for bits, t in zip(layout, thresholds, strict=True) if t >= 0]
    return chosen[1]


# ---- probing and verifying ----------------------------------------------------------------------

def _flips(bits: list[int], radius: int) -> list[int]:
    """Every mask that flips at most ``radius`` of ``bits``."""
    return [_mask(list(c)) for r in range(radius + 1) for c in itertools.combinations(bits, r)]


def _spread(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """``(part, value, fp)``: each fingerprint under every value of every part that it probes."""
    keys = F.array(*[F.struct(F.lit(k).alias("part"),
                              F.col("fp").bitwiseAND(F.lit(_mask(bits))).bitwiseXOR(F.lit(flip)).alias("value"))
                     for k, (bits, t) in enumerate(parts) for flip in _flips(bits, t)])
    return fps.select("fp", F.explode(keys).alias("x")).select("x.part", "x.value", "fp")


def _within(members: str, max_bits: int, star: bool):
    """Links of one bounded list of fingerprints: verified pairs, or to the least member."""
    near = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= max_bits
    if star:
        return F.transform(F.slice(F.array_sort(members), 2, F.size(members)),
                           lambda b: F.struct(b.alias("a"), F.array_min(members).alias("b")))
    return F.flatten(F.transform(members, lambda a: F.transform(
        F.filter(members, lambda b: (a > b) & near(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Verified links ``(a, b)``, ``a > b``, whose components are those of all pairs within ``max_bits`` bits.

    ``fps``: distinct fingerprints (column ``fp``), a saved table.
    """
    parts = plan_parts(fps, max_bits)
    spread = _spread(fps, parts)
    crowded = saved(spread.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
                    .where(F.col("n") > GROUP).select("part", "value"), "simhash-crowded")
    hot = sized_broadcast(crowded, 32)
    few = (spread.join(hot, ["part", "value"], "left_anti").groupBy("part", "value")
           .agg(F.collect_list("fp").alias("m")).where(F.size("m") > 1)       # at most GROUP members
           .select(F.explode(_within("m", max_bits, star=False)).alias("l")))
    if crowded.isEmpty():
        return saved(few.select("l.a", "l.b").distinct(), "simhash-links")
    many = spread.join(hot, ["part", "value"], "left_semi").select("fp").distinct()
    flips = F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in _flips(list(range(BITS)), -(-max_bits // 2))])
    # distinct fingerprints around one centre: bounded by the number of flips
    around = (many.select("fp", F.explode(flips).alias("centre")).groupBy("centre")
              .agg(F.collect_list("fp").alias("m")).where(F.size("m") > 1)
              .select(F.explode(_within("m", max_bits, star=max_bits % 2 == 0)).alias("l")))
    return saved(few.unionByName(around).select("l.a", "l.b").distinct(), "simhash-links")


def components(edges: DataFrame) -> DataFrame:
    """``(fp, root)`` of every fingerprint that has a link; root is the least fingerprint reachable."""
    sym = saved(edges.select(F.col("a").alias("fp"), F.col("b").alias("to"))
                .unionByName(edges.select(F.col("b").alias("fp"), F.col("a").alias("to"))), "simhash-sym")
    labels = saved(sym.groupBy("fp").agg(F.least(F.min("to"), F.col("fp")).alias("root")), "simhash-labels")
    while True:
        told = (sym.join(labels, "fp").select(F.col("to").alias("fp"), "root")
                .unionByName(labels).groupBy("fp").agg(F.min("root").alias("root")))
        told = saved(told, "simhash-told")
        up = told.select(F.col("fp").alias("root"), F.col("root").alias("up"))
        jumped = told.join(up, "root").select("fp", F.col("up").alias("root"))
        new = saved(jumped, "simhash-labels")
        # a sum of distances falls with every change and stays only at the fixed point
        total = lambda d: d.agg(F.sum(F.col("root").cast("decimal(38,0)")).alias("t")).first()["t"]
        if total(new) == total(labels):
            return new
        labels = new


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``(doc_id, digest, fp, component_id, stays)`` of every row of ``docs`` (columns ``doc_id``, ``text``).

    ``stays`` marks the first document of the component: the least id (null
    last), then the least text digest.
    """
    fps = saved(fingerprints(docs, shingle), "simhash-fps")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    unique = saved(fps.groupBy("fp").agg(F.min(first).alias("first")), "simhash-unique")
    roots = components(links(unique.select("fp"), max_bits))
    placed = saved(unique.join(roots, "fp", "left")
                   .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-placed")
    least = saved(placed.groupBy("root").agg(F.min("first").alias("first")), "simhash-least")
    group_of = saved(placed.select("fp", "root").join(least, "root").select("fp", "first"), "simhash-groups")
    return fps.join(group_of, "fp").select(
        "doc_id", "digest", "fp", F.col("first.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))).alias("stays"))


def fingerprint_hex(col: str = "fp"):
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one document of every component: the one that ``stays``.

    Rows that repeat that document (same id, same text) leave one row.
    """
    marked = saved(near_duplicates(docs, shingle, max_bits).where("stays").select("doc_id", "digest"), "simhash-stay")
    stay = marked.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col("doc_id").cast("long").alias("_id"), _digest().alias("_digest"))

    def held_by(keys: DataFrame) -> DataFrame:
        return rows.join(keys, rows["_id"].eqNullSafe(keys["doc_id"]) & (rows["_digest"] == keys["digest"]), "left_semi")

    once, twice = (saved(stay.where(c), "simhash-stay") for c in ("n = 1", "n > 1"))
    kept = held_by(once).select("_row")
    if not twice.isEmpty():
        kept = kept.unionByName(held_by(twice).groupBy("_id", "_digest").agg(F.first("_row").alias("_row")).select("_row"))
    return kept.select("_row.*")
