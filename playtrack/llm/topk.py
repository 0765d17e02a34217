"""Exact top-k search by inner product with Fagin's threshold algorithm.

Every block of vectors keeps one sorted list per dimension.  A query walks all
lists from its good end (the largest values where its component is positive,
the smallest where it is negative).  Vectors met for the first time are scored
by random access.  The sum over the lists of component times the value at the
current depth bounds every vector not met yet; the walk stops when the k-th
score is greater than that bound.  (Equal is not enough: an unseen vector
could tie with a smaller id.)  The lists tell the bound of every depth of a
ladder beforehand, so a walk goes on at the depth that the k-th score asks for.

Scale: blocks are sorted once and stored, a row each.  A query first meets one
block; the k-th score there is its floor.  Then it meets all other blocks, one
copy of it a block, and walks stop at the floor, too: what a meeting returns is
no less than it, and at most ``k`` rows.  (The stated query set against all
rows, in blocks.)  Vectors are shuffled once into blocks, and block rows once a
meeting, whatever the number of queries; queries stream past their block in
Arrow batches, so a task holds one block and one batch.  A window whose rank
limit Spark also applies before the shuffle leaves ``k`` rows a query.
Nothing is broadcast.

Defined cases: vectors that are null or hold a null or non-finite component
take no part, neither as queries nor as candidates; vectors of different
length have no inner product and do not meet (empty ones meet with score 0);
ties go to the smaller id, null
ids last; repeated rows are candidates of each other (only the query's own
row is left out) and each repeated query row gets its own list; scores beyond
64 bits are held at the limit; a table without queries gives no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, size_hint_partitions

LEAST_BLOCK, MOST_BLOCK = 8192, 32768     # vectors of a block: a 64th of all, within these bounds
FIRST_DEPTH = 32
EXACT = 2.0 ** 53       # whole numbers below are exact in a double
_TOP = (1 << 63) - 1


class SortedLists:
    """The vectors of a block with one sorted list per dimension."""

    def __init__(self, vectors: np.ndarray, order: np.ndarray | None = None):
        n = len(vectors)
        self.vectors, self.scored = vectors, 0
        self.order = np.argsort(vectors, axis=0, kind="stable") if order is None else order
        # beyond an eighth of the lists, marking whom they name costs more than scoring all that is left
        self.depths = [FIRST_DEPTH << i for i in range(n.bit_length()) if FIRST_DEPTH << i <= n // 8] + [n]
        ends = np.array(self.depths[:-1], dtype=np.int64)       # the last depth has met every vector
        column = np.arange(vectors.shape[1])
        self.high, self.low = vectors[self.order[n - ends], column], vectors[self.order[ends - 1], column]

    def top(self, query: np.ndarray, own: int, k: int, rank: np.ndarray, floor=None) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best ``k`` that are no less than ``floor``.

        ``rank`` orders ties, ``own`` (or -1) is left out.
        """
        n, last = len(self.vectors), len(self.depths) - 1
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        bounds = self.high @ np.where(query > 0, query, 0) + self.low @ np.where(query < 0, query, 0)

        def enough(least) -> int:
            """The first step whose bound is less than ``least``."""
            done = np.flatnonzero(bounds < least)
            return int(done[0]) if len(done) else last

        seen = np.zeros(n, bool)
        if own >= 0:
            seen[own] = True
        places, scores, least = np.zeros(0, np.int64), np.zeros(0, self.vectors.dtype), floor
        step = 0 if least is None else enough(least)
        while True:
            if step == last:
                new = ~seen                      # also what no list of this query names
            else:
                new, depth = np.zeros(n, bool), self.depths[step]
                new[self.order[n - depth:, up]] = True
                new[self.order[:depth, down]] = True
                new &= ~seen
            seen |= new
            found = np.flatnonzero(new)
            self.scored += len(found)
            got = (self.vectors @ query)[found] if 2 * len(found) > n else self.vectors[found] @ query
            places, scores = np.append(places, found), np.append(scores, got)
            if len(scores) > k:                  # what cannot be among the best goes before the sort
                kth = np.partition(scores, -k)[-k] if scores.dtype != object else np.sort(scores)[-k]
                least = kth if least is None else max(least, kth)
            if least is not None:
                kept = scores >= least
                places, scores = places[kept], scores[kept]
            best = np.lexsort((rank[places], -scores))[:k]
            places, scores = places[best], scores[best]
            if len(scores) == k:
                least = scores[-1]
            if step == last or (least is not None and bounds[step] < least):
                return places, scores
            step = step + 1 if least is None else max(enough(least), step + 1)


def _block_row(rows: pd.DataFrame) -> pd.DataFrame:
    """One row a block: vectors, the order of every list, ids and row numbers as bytes."""
    x = np.array(rows["v"].tolist(), dtype=float).reshape(len(rows), -1)
    missing = pd.isna(rows["vec_id"]).to_numpy()
    ids = np.array([0 if m else int(i) for i, m in zip(rows["vec_id"], missing, strict=True)], np.int64)
    return pd.DataFrame([(int(rows["width"].iloc[0]), int(rows["block"].iloc[0]), x.tobytes(),
                          np.argsort(x, axis=0, kind="stable").astype(np.int32).tobytes(), ids.tobytes(),
                          missing.tobytes(), rows["row"].to_numpy(np.int64).tobytes())], columns=_BLOCK_COLUMNS)


_BLOCK_COLUMNS = ["width", "block", "vectors", "orders", "ids", "missing", "numbers"]
_BLOCK_SCHEMA = "width int, block long, vectors binary, orders binary, ids binary, missing binary, numbers binary"


class _Block:
    """A stored block, ready for queries."""

    def __init__(self, row):
        self.name = (row.width, row.block)
        self.ids, self.row = np.frombuffer(row.ids, np.int64), np.frombuffer(row.numbers, np.int64)
        self.x = np.frombuffer(row.vectors).reshape(len(self.ids), row.width)        # a width may be 0
        self.order = np.frombuffer(row.orders, np.int32).reshape(self.x.shape)
        self.missing = np.frombuffer(row.missing, bool)
        self.rank = np.empty(len(self.x), np.int64)
        self.rank[np.lexsort((self.row, self.ids, self.missing))] = np.arange(len(self.x))
        self.at = {r: i for i, r in enumerate(self.row.tolist())}
        self.most, self._lists = float(np.abs(self.x).max(initial=0)), {}

    def lists(self, exact: bool) -> SortedLists:
        """Lists over doubles where every score is exact so, else over whole Python numbers."""
        if exact not in self._lists:
            self._lists[exact] = SortedLists(self.x if exact else _whole(self.x), self.order)
        return self._lists[exact]

    def answers(self, query, k: int) -> list:
        q = np.asarray(query.v, dtype=float)
        exact = self.most * float(np.abs(q).max(initial=0)) * max(len(q), 1) < EXACT
        floor = None if pd.isna(query.floor) else int(query.floor)
        places, scores = self.lists(exact).top(q if exact else _whole(q), self.at.get(query.row, -1), k, self.rank, floor)
        return [(query.row, int(query.vec_id), None if self.missing[p] else int(self.ids[p]), int(self.row[p]),
                 int(max(min(int(s), _TOP), -_TOP - 1))) for p, s in zip(places.tolist(), scores.tolist(), strict=True)]


def _whole(x: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in x.ravel()], dtype=object).reshape(x.shape)


def _stream(k: int):
    """Rows of a partition by block, the block's own row before its queries."""
    def stream(batches):
        block = None
        for rows in batches:
            out = []
            for row in rows.itertuples(index=False):
                if row.vectors is not None:
                    block = _Block(row)
                elif block is not None and block.name == (row.width, row.block):     # else: no vector lies there
                    out += block.answers(row, k)
            yield pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "row", "score"]).astype({"vec_id": "Int64"})
    return stream


def whole_vectors(table: DataFrame, vec: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``(vec_id, v)``: ``floor(scale * x)`` as doubles, of the vectors that take part."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return (table.where(F.col(vec).isNotNull() & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v")))


def top_k(vectors: DataFrame, is_query, k: int = 5, block: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of all other rows for each row where ``is_query``.

    ``vectors``: ``vec_id`` and ``v``, whole numbers as doubles.  ``block``: vectors of a block.
    """
    rows = saved(vectors.select("vec_id", "v", F.size("v").alias("width"),
                                F.monotonically_increasing_id().alias("row")), "topk-rows")
    n = rows.count()
    blocks = size_hint_partitions(n, block or max(LEAST_BLOCK, min(MOST_BLOCK, n // 64)))

    def some_block(*salt):
        return F.pmod(F.xxhash64("row", *map(F.lit, salt)), F.lit(blocks)).cast("long")
    stored = saved(rows.withColumn("block", some_block()).groupBy("width", "block")
                   .applyInPandas(_block_row, _BLOCK_SCHEMA), "topk-blocks")
    queries = rows.where(is_query & F.col("vec_id").isNotNull()).withColumn("first", some_block(1))

    def meet(asked: DataFrame) -> DataFrame:
        """The answers to ``asked`` (queries with ``block`` and ``floor``)."""
        both = stored.unionByName(asked, allowMissingColumns=True)
        placed = both.repartition(blocks, "width", "block").sortWithinPartitions("width", "block", F.col("vectors").isNull())
        return placed.mapInPandas(_stream(k), "query_row long, query_id long, vec_id long, row long, score long")

    asked = queries.select("vec_id", "v", "width", "row", "first", F.col("first").alias("block"), F.lit(None).cast("long").alias("floor"))
    found = saved(meet(asked.drop("first")), "topk-first")
    if blocks > 1:
        least = F.when((F.count(F.lit(1)) >= k) & (F.min("score") > -_TOP), F.min("score"))      # no floor at the limit
        floors = found.groupBy(F.col("query_row").alias("row")).agg(least.alias("floor"))
        others = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")), lambda b: b != F.col("first")))
        rest = meet(asked.drop("block", "floor").join(floors, "row", "left").withColumn("block", others).drop("first"))
        found = found.unionByName(rest)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


REPORT_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id,
           list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as score
    from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from scored)
select query_id, cast(r as integer) as rank, vec_id, cast(score as bigint) as score from ranked where r <= 5
"""
