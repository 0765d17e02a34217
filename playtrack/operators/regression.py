"""The cross-validated search over logistic regressions (M4, M7), all folds and grid points in the same passes.

A search fits folds x points models, and a fit by itself passes over the rows at
every step of its optimiser: thousands of jobs.  Here one pass gives loss,
gradient and curvature of every model that is not done yet, at its own place
(numpy over Arrow batches, one row of sums per task); the driver takes the
steps, on numbers that depend on the features alone.

The objective is Spark's: mean log loss, an L2 and an L1 weight (``regParam``,
``elasticNetParam``) on the coefficients of features scaled by their deviation
in the fold's training rows, the intercept free.  A step is a Newton step (its
L1 part by coordinate descent), halved until the objective falls; ``maxIter``
bounds the steps, so points that differ in it alone are places of one way.
Features without variance have no coefficient; a fold whose training rows have
one label alone has none at all.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forest import stored

ROWS_PER_TASK = 50_000
MOST_TASKS = 512            # a row of sums each reaches the driver
_DONE = 1e-12               # relative fall of the objective that a step promises


class _Model:
    """One fold and weights: the place, the step under trial, and the places by steps taken."""

    def __init__(self, fold, l2, l1, intercept, std, n, positives, size):
        import numpy as np

        self.fold, self.l2, self.l1, self.n = fold, l2, l1, n
        # slot 0: the intercept; the others count if they vary
        self.free = np.concatenate([[intercept], std > 0])
        if positives in (0, n):
            self.free[:] = False
        self.at, self.step, self.size, self.value, self.taken = np.zeros(size + 1), np.zeros(size + 1), 1.0, None, 0
        self.places, self.done = [self.at], not self.free.any()

    def trial(self):
        return self.at + self.size * self.step

    def penalty(self, v):
        import numpy as np

        return self.l2 / 2 * float(v[1:] @ v[1:]) + self.l1 * float(np.abs(v[1:]).sum())

    def told(self, loss, gradient, curvature, most):
        """Loss, gradient and curvature (means over its rows, in scaled features) at ``trial()``."""
        v = self.trial()
        value = loss + self.penalty(v)
        if self.value is not None:
            if value > self.value + 1e-4 * self.size * self.promised and self.size > 1e-6:
                self.size /= 2
                return
            if value <= self.value:
                self.at, self.taken = v, self.taken + 1
                self.places.append(v)
            else:                                   # no fall left in the numbers
                self.done = True
                return
        self.value = value
        if self.taken >= most:
            self.done = True
            return
        self.step, self.size = self._newton(gradient, curvature), 1.0
        new = self.at + self.step
        self.promised = float(gradient @ self.step) + self.penalty(new) - self.penalty(self.at)
        self.done = -self.promised <= _DONE * max(abs(value), 1e-3)

    def _newton(self, gradient, curvature):
        import numpy as np

        free, step = np.flatnonzero(self.free), np.zeros(len(self.at))
        l2 = np.where(free > 0, self.l2, 0.0)
        g, at = gradient[free] + l2 * self.at[free], self.at[free]
        h = curvature[np.ix_(free, free)] + np.diag(l2)
        h = h + np.eye(len(free)) * (1e-12 * np.trace(h) / len(free) + 1e-300)
        if self.l1 == 0:
            step[free] = np.linalg.lstsq(h, -g, rcond=None)[0]
            return step
        x, diagonal = np.zeros(len(free)), np.diag(h)
        for _ in range(2000):
            widest = 0.0
            for j in range(len(free)):
                b = diagonal[j] * (at[j] + x[j]) - (g[j] + h[j] @ x)
                to = (b if free[j] == 0 else np.sign(b) * max(abs(b) - self.l1, 0.0)) / diagonal[j] - at[j]
                widest, x[j] = max(widest, abs(to - x[j])), to
            if widest <= 1e-13 * (1 + np.abs(at + x).max()):
                break
        step[free] = x
        return step


def _scales(rows: DataFrame, size: int, folds: int):
    """Per fold's training rows: how many, how many positives, and the features' deviations (the sample's)."""
    import numpy as np

    x = [F.get("x", F.lit(j)) for j in range(size)]
    each = {r["fold"]: r for r in rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"), F.array(*map(F.avg, x)).alias("mean"),
        F.array(*[F.var_pop(c) for c in x]).alias("var")).collect()}            # a row per fold
    found = []
    for k in range(folds):
        own = [r for fold, r in each.items() if fold != k]
        n = np.array([r["n"] for r in own], float)
        total = n.sum()
        if not total:
            found.append((0, 0, np.zeros(size)))
            continue
        means, variances = np.array([r["mean"] for r in own]), np.array([r["var"] for r in own])
        mean = n @ means / total
        spread = n @ (variances + (means - mean) ** 2)
        # rounding leaves a speck where a feature does not vary
        spread = np.where(spread <= 1e-12 * (total * mean ** 2), 0.0, spread)
        found.append((total, sum(r["hits"] for r in own), np.sqrt(spread / max(total - 1, 1))))
    return found


def _sums(rows: DataFrame, models, scale):
    """Loss, gradient and curvature of the models at their trials: sums over the rows they train on, in features divided by ``scale``."""
    import numpy as np

    d = len(scale) + 1
    b = np.stack([m.raw for m in models], 1)
    own = np.array([m.fold for m in models])
    pairs = np.triu_indices(d)

    def part(batches):
        import pyarrow as pa

        total = np.zeros((1 + d + len(pairs[0]), len(models)))
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(-1, d - 1) / scale
            x, y = np.concatenate([np.ones((len(x), 1)), x], 1), batch["y"].to_numpy()[:, None]
            trains = batch["fold"].to_numpy()[:, None] != own
            margin = x @ b
            p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            total[0] += ((np.logaddexp(0, margin) - y * margin) * trains).sum(0)
            total[1:1 + d] += x.T @ ((p - y) * trains)
            total[1 + d:] += (x[:, pairs[0]] * x[:, pairs[1]]).T @ (p * (1 - p) * trains)
        yield pa.record_batch({"sums": pa.array([total.ravel()], pa.list_(pa.float64()))})

    total = 0.0
    for r in rows.select("fold", "y", "x").mapInArrow(part, "sums array<double>").collect():      # a row per task, in their order
        total = total + np.array(r["sums"]).reshape(-1, len(models))
    for i, m in enumerate(models):
        h = np.zeros((d, d))
        h[pairs] = total[1 + d:, i]
        yield m, total[0, i], total[1:1 + d, i], h + np.triu(h, 1).T


def fold_scores(train: DataFrame, points, label: str, features: str, fold: str, folds: int) -> tuple[DataFrame, list[int]]:
    """``(scored, at)``: (fit, y, scores) of every row by its fold's models, and the place in ``scores`` of each point.

    ``points``: dicts of ``regParam``, ``elasticNetParam``, ``fitIntercept`` and ``maxIter``."""
    import numpy as np

    train = train.select(F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))
    parts = max(train.sparkSession.sparkContext.defaultParallelism, -(-train.count() // ROWS_PER_TASK))
    rows = stored(train.repartition(min(parts, MOST_TASKS)), "search-rows")
    first = rows.first()
    size = len(first["x"]) if first else 0
    scales = _scales(rows, size, folds)
    scale = np.max([s for _, _, s in scales], 0) if size else np.zeros(0)
    scale = np.where(scale > 0, scale, 1.0)
    kinds = sorted({(p["regParam"], p["elasticNetParam"], p["fitIntercept"]) for p in points})
    models = {(kind, k): _Model(k, kind[0] * (1 - kind[1]), kind[0] * kind[1], kind[2], scales[k][2], scales[k][0], scales[k][1], size)
              for kind in kinds for k in range(folds)}
    most = max(p["maxIter"] for p in points)

    def raw(v, k):
        """Weights for features divided by ``scale``, from those for features divided by the fold's deviations."""
        std = scales[k][2]
        return np.concatenate([v[:1], v[1:] * np.divide(scale, std, out=np.zeros(size), where=std > 0)])
    while open_ := [m for m in models.values() if not m.done]:
        for m in open_:
            m.raw = raw(m.trial(), m.fold)
        for m, loss, gradient, curvature in _sums(rows, open_, scale):
            c = raw(np.ones(size + 1), m.fold)
            m.told(loss / m.n, gradient * c / m.n, curvature * np.outer(c, c) / m.n, most)

    ways, at = [], []
    for p in points:
        kind = (p["regParam"], p["elasticNetParam"], p["fitIntercept"])
        taken = [models[kind, k].places[min(p["maxIter"], len(models[kind, k].places) - 1)] for k in range(folds)]
        way = np.stack([raw(v, k) for k, v in enumerate(taken)])                # folds x weights
        same = [i for i, w in enumerate(ways) if np.array_equal(w, way)]
        at.append(same[0] if same else len(ways))
        if not same:
            ways.append(way)
    weights = np.stack(ways, 2)                                                 # folds x weights x places

    def score(batches):
        import pyarrow as pa

        for batch in batches:
            x, k = batch["x"].flatten().to_numpy().reshape(-1, size) / scale, batch["fold"].to_numpy()
            x, out = np.concatenate([np.ones((len(x), 1)), x], 1), np.empty((len(x), weights.shape[2]))
            for fit in range(folds):
                out[k == fit] = x[k == fit] @ weights[fit]
            yield pa.record_batch({"fit": pa.array(k, pa.int32()), "y": batch["y"],
                                   "scores": pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), out.shape[1]).cast(pa.list_(pa.float64()))})

    return stored(rows.select("fold", "y", "x").mapInArrow(score, "fit int, y double, scores array<double>"), "search-scores"), at
