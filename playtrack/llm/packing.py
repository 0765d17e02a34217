"""Sequence packing as a cutting-stock problem solved by column generation.

1. Texts become ids (plus the end id) and are cut into pieces of at most
   ``LENGTH`` ids: whole sequences first, then the rest of the document.
2. Pieces are counted by length: a histogram of at most ``LENGTH`` numbers, the
   only thing the driver gets from the corpus.  Items are what is packed, in
   classes ``STEP`` ids wide, rounded up.  Short pieces (below ``SHORT``) of one
   length make bundles of 2, 4 or 8 whose size is a whole number of ``STEP`` ids,
   so rounding costs them nothing; other pieces are items of their own.
3. Column generation on the histogram: a linear program over patterns (how
   many pieces of each class share a sequence) minimises sequences; a knapsack
   dynamic program over the dual prices finds the pattern with the best
   reduced cost.  It ends when none improves, or when a lower bound proves the
   program within ``GAP`` (or half a sequence) of its optimum.
4. Patterns are rounded down; the pieces left over (less than one sequence a
   pattern) are packed largest first.
5. Pieces are ranked within their length over all tasks (range partitions, a
   running number in each, bases from prefix sums of at most ``partitions +
   lengths`` counts).  The rank gives the item, and item ``r`` of a class takes
   the ``r``-th slot that the patterns offer to it.

Scale: ids are made once; after that only narrow rows move.  No class is ever
in one task: a class of a third of all pieces spreads over many ranges.

Defined cases: null and empty texts are one piece, the end id; ties in rank
order go by document id and start (repeated rows in any order: they are
alike); null ids are packed like others; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, size_hint_partitions
from .tokens import encoding

LENGTH = 2048
STEP = 8
SHORT = 64
ROWS_PER_RANGE = 1 << 20
END = 1
GAP = 5e-4
VOCABULARY = "byte_bpe_50k.json"


# ---- pieces -------------------------------------------------------------------------------------

def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, length: int = LENGTH,
           keep_ids: bool = False) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens[, ids])`` of every piece of every document."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    closing = np.array([end], "<u4").tobytes()

    def cut(batches):
        with encoding(vocabulary, keeps_space=True) as tokenizer:
            for batch in batches:
                for at in range(0, batch.num_rows, 200):
                    part = batch.slice(at, 200)
                    rows = []
                    for doc, ids in zip(part["doc_id"].to_pylist(), tokenizer.encode(part["text"].to_pylist()), strict=True):
                        ids += closing
                        n = len(ids) // 4
                        for s in range(0, n, length):
                            own = ids[4 * s:4 * (s + length)]
                            rows.append((doc, s, len(own) // 4, zlib.crc32(own), n, *([np.frombuffer(own, "<i4")] * keep_ids)))
                    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
                    types = [pa.int64()] * 5 + [pa.list_(pa.int32())] * keep_ids
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                     names=names)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(cut, schema)


# ---- column generation --------------------------------------------------------------------------

def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern within ``capacity`` (any number of each size), by dynamic programming."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right").tolist()    # sizes ascend
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fits[room]:
            value = best[room - sizes[:fits[room]]] + prices[:fits[room]]
            top = value.argmax()
            if value[top] > best[room] + 1e-12:
                best[room], took[room] = value[top], top
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            pattern[took[room]] += 1
            room -= sizes[took[room]]
    return float(best[capacity]), pattern


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """``(patterns, copies)`` of the linear program: columns of the last basis and their amounts.

    ``sizes`` ascend.  Ends when no pattern improves, or when a lower bound (all
    units over the capacity, or ``z / price``) is within ``gap`` or half a sequence.
    """
    volume = float(sizes @ demand) / capacity
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    amounts = inverse @ demand
    while True:
        prices = inverse.sum(axis=0)
        value, pattern = knapsack(sizes, prices, capacity)
        used = amounts.sum()
        bound = max(volume, used / value)
        if value <= 1 + 1e-9 or used - bound <= max(gap * used, 0.5):
            return basis.T.round().astype(np.int64), amounts
        step = inverse @ pattern
        ratio = np.where(step > 1e-10, amounts / np.where(step > 1e-10, step, 1), np.inf)
        leave = int(ratio.argmin())
        move = ratio[leave]
        amounts = amounts - move * step
        amounts[leave] = move
        amounts = np.maximum(amounts, 0)
        basis[:, leave] = pattern
        row = inverse[leave] / step[leave]
        inverse -= np.outer(step, row)
        inverse[leave] = row


def plan(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP) -> list[tuple[np.ndarray, int]]:
    """``(pattern, copies)`` that use every piece exactly once."""
    out: list[tuple[np.ndarray, int]] = []
    left = demand.astype(np.int64).copy()
    if left.sum():
        for pattern, amount in zip(*solve_patterns(sizes, demand.astype(float), capacity, gap), strict=True):
            used = pattern > 0
            copies = min(int(amount + 1e-9), int((left[used] // pattern[used]).min()))
            if copies:
                out.append((pattern, copies))
                left -= copies * pattern
    order = np.argsort(-sizes, kind="stable")
    while left.any():                            # less than one sequence a pattern is left
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for i in order:
            pattern[i] = min(left[i], room // sizes[i])
            room -= pattern[i] * sizes[i]
        used = pattern > 0
        copies = int((left[used] // pattern[used]).min())
        out.append((pattern, copies))
        left -= copies * pattern
    return out


def slots(sizes: np.ndarray, planned: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """``(units, low, high, each, first_sequence)``: which ranks of a class go to which sequences."""
    out, first, filled = [], 0, {int(s): 0 for s in sizes}
    for pattern, copies in planned:
        for i in np.flatnonzero(pattern):
            units, each = int(sizes[i]), int(pattern[i])
            out.append((units, filled[units], filled[units] + each * copies, each, first))
            filled[units] += each * copies
        first += copies
    return out


def items(histogram: dict[int, int], step: int = STEP, short: int = SHORT) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, low, high, per, units, first)``: ranks ``low`` to ``high`` of a length are items of ``per`` pieces
    and ``units`` steps, the first of them number ``first`` of that class."""
    out, number = [], {}
    for length, n in sorted(histogram.items()):
        per = step // math.gcd(length, step) if length < short else 1
        whole = n // per * per
        for low, high, each in ((0, whole, per), (whole, n, 1)):
            if high > low:
                units = -(-length * each // step)
                out.append((length, low, high, each, units, number.get(units, 0)))
                number[units] = number.get(units, 0) + (high - low) // each
    return out


# ---- assignment ---------------------------------------------------------------------------------

def _ranked(cut: DataFrame, rows: int) -> DataFrame:
    """``cut`` with the rank within its length, without a length ever being in one task."""
    ranges = size_hint_partitions(rows, ROWS_PER_RANGE, int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = ["length", "doc_id", "start", "ids_crc32"]
    ordered = cut.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    schema = ordered.schema.simpleString()[len("struct<"):-1].replace(":", " ")

    def number(batches):
        task, last, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            length = batch["length"].to_numpy()
            if not len(length):
                continue
            at = np.arange(len(length))
            run = np.maximum.accumulate(np.where(np.append(True, length[1:] != length[:-1]), at, 0))
            local = at - run + np.where((run == 0) & (length[0] == last), done, 0)
            last, done = length[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), task), pa.int32()), pa.array(local)],
                                             names=[*batch.schema.names, "task", "local"])
    numbered = saved(ordered.mapInArrow(number, f"{schema}, task int, local long"), "packing-ranks")
    # at most tasks + lengths rows
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = numbered.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")).select(
        "task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return numbered.join(F.broadcast(bases), ["task", "length"]).withColumn("rank", F.col("base") + F.col("local"))


def assign(cut: DataFrame, length: int = LENGTH, step: int = STEP) -> DataFrame:
    """``cut`` (a saved table of pieces) with ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    kinds = items(histogram, step)
    count: dict[int, int] = {}
    for _, low, high, per, units, _ in kinds:
        count[units] = count.get(units, 0) + (high - low) // per
    sizes = np.array(sorted(count), np.int64)
    demand = np.array([count[u] for u in sizes], np.int64)
    table = slots(sizes, plan(sizes, demand, length // step))      # bounded by classes x patterns
    bundled = spark.createDataFrame(kinds or [(0, 0, 0, 1, 0, 0)], "_length long, from long, to long, per long, units long, nr long")
    offered = spark.createDataFrame(table or [(0, 0, 0, 1, 0)], "_units long, low long, high long, each long, first long")
    item = _ranked(cut, sum(histogram.values())).join(
        F.broadcast(bundled), (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("to")))
    item = item.withColumn("item", F.expr("nr + (rank - from) div per"))
    placed = item.join(F.broadcast(offered), (F.col("units") == F.col("_units")) & (F.col("item") >= F.col("low"))
                       & (F.col("item") < F.col("high")))
    placed = placed.withColumn("sequence_id", F.expr("first + (item - low) div each"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("units"), "item", "rank")   # at most ``length`` pieces
    return placed.select(*cut.columns, "sequence_id",
                         (F.sum("length").over(inside) - F.col("length")).alias("offset"))


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, length: int = LENGTH, step: int = STEP,
         keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset``."""
    return assign(saved(pieces(docs, vocabulary, end, length, keep_ids), "packing-pieces"), length, step)


def sequences(packed: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """``(sequence_id, used, ids)`` from ``pack(..., keep_ids=True)``; padded to ``length`` except at a power of two."""
    joined = packed.groupBy("sequence_id").agg(            # a sequence holds at most ``length`` ids
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    used = F.size("ids")
    whole = F.bit_count(used) == 1
    return joined.select("sequence_id", used.alias("used"), F.when(whole, F.col("ids")).otherwise(
        F.concat("ids", F.array_repeat(F.lit(pad), F.lit(length) - used))).alias("ids"))
