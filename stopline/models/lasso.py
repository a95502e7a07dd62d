"""The whole L1 path of a logistic model, with its cross-validation, all penalties advancing together.

One model a penalty for every fold and for all rows, started at the mean. A step is
one pass over the rows: it scores every row under all models that are not done and adds up, by Spark, the
models' gradients, their losses, the held-out losses of the folds, and weighted
cross-products at `KNOTS` models: at first spread along the path of all rows, then among the
models that are not done, for each fold its own. A model then
moves on the p x p numbers alone: coordinate descent on the quadratic at the nearest
of these models, warm from where it stands, over the coordinates that are not zero or want not
to be. The cross-products only steer; gradients and losses are exact, a step that
does not lower a model's penalised loss is taken back and damped, and a model stops when it
meets the optimality conditions of its own rows within `TOLERANCE`.

Only (folds + 1) x penalties x p numbers and `KNOTS` p x p tables reach the driver, whatever the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.models.trees import with_fold
from stopline.session import small_table, store

KNOTS = 18
SHARED_STEPS = 3     # steps in which all folds steer by the models of all rows
TOLERANCE = 1e-3     # of a model's own penalty
CELLS = 1 << 21      # numbers of a dense block of rows inside a task
BLOCK = 1 << 16      # numbers in one message of a task
STEP = 256           # rows scored at a time, so that their numbers stay in the processor's cache


@dataclass
class Path:
    """Penalties, and per model the coefficients: row 0 of `beta` is all rows, row 1 + f leaves fold f out."""
    names: list[str]
    lambdas: list[float]
    intercept: np.ndarray       # (folds + 1, penalties)
    beta: np.ndarray            # (folds + 1, penalties, p)
    fold_loss: np.ndarray       # (folds, penalties), mean log loss of the held-out rows
    loss: np.ndarray            # (penalties,), mean log loss of the model of all rows
    null_loss: float
    violation: np.ndarray       # (folds + 1, penalties), optimality gap as a share of the penalty
    steps: int

    @property
    def folds(self) -> int:
        return len(self.fold_loss)

    @property
    def mean(self) -> list[float]:
        return self.fold_loss.mean(0).tolist()

    @property
    def std(self) -> list[float]:
        return self.fold_loss.std(0).tolist()

    def at(self, penalty: float) -> int:
        return self.lambdas.index(penalty)


# ---- rows for numpy ----

def sparse_rows(df: DataFrame, key: str, folds: int, label: str = "label", features: str = "features") -> DataFrame:
    """(fold, label, slots, numbers): a vector column as plain arrays, the fold from a hash of the key."""
    vector = F.unwrap_udt(F.col(features))
    slots = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    return with_fold(df.select(key, label, features), key, folds).select(
        "fold", F.col(label).cast("double").alias("label"), slots.alias("slots"), vector["values"].alias("numbers"))


def dense_blocks(batch: pa.RecordBatch, p: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(fold, label, rows x p) for runs of rows of a batch of `sparse_rows`."""
    fold, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    slots, numbers = batch.column(2), batch.column(3)
    ends = slots.offsets.to_numpy().astype(np.int64)
    ends, at, value = ends - ends[0], slots.flatten().to_numpy(), numbers.flatten().to_numpy()
    size = max(1, CELLS // max(p, 1))
    for a in range(0, len(fold), size):
        b = min(a + size, len(fold))
        x = np.zeros((b - a, p))
        x[np.repeat(np.arange(b - a), np.diff(ends[a:b + 1])), at[ends[a]:ends[b]]] = value[ends[a]:ends[b]]
        yield fold[a:b], label[a:b], x


def added_up(rows: DataFrame, compute, size: int, few: bool = False) -> np.ndarray:
    """The sum over all rows of the `size` numbers that `compute(batches)` makes of a task's rows.

    Tasks send blocks of numbers, which are added block by block before they reach the driver; those of a `few` tasks there.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = compute(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["numbers"])

    if few:
        sums = np.zeros(size)
        for r in rows.mapInArrow(pack, "numbers binary").collect():
            sums += np.frombuffer(r["numbers"])
        return sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = compute(batches)
        if total is not None:
            parts = [total[i:i + BLOCK] for i in range(0, size, BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.float64()))], ["block", "numbers"])

    def add(block: pa.Table) -> pa.Table:
        values = np.sum([x.values.to_numpy() for x in block["numbers"]], axis=0)
        return pa.table({"block": block["block"][:1], "numbers": pa.array([values], pa.list_(pa.float64()))})

    schema = "block int, numbers array<double>"
    blocks = rows.mapInArrow(run, schema).groupBy("block").applyInArrow(add, schema).collect()
    out = np.zeros(size)
    for r in blocks:
        out[r["block"] * BLOCK:r["block"] * BLOCK + len(r["numbers"])] = r["numbers"]
    return out


def fold_moments(rows: DataFrame, p: int, folds: int):
    """Per fold: rows, positive rows, sums and sums of squares of every column."""
    def compute(batches):
        total = np.zeros((folds, 2 + 2 * p))
        for batch in batches:
            for fold, label, x in dense_blocks(batch, p):
                for f in np.unique(fold):
                    mine = fold == f
                    total[f, 0] += mine.sum()
                    total[f, 1] += label[mine].sum()
                    total[f, 2:2 + p] += x[mine].sum(0)
                    total[f, 2 + p:] += (x[mine] ** 2).sum(0)
        return total.ravel()
    m = added_up(rows, compute, folds * (2 + 2 * p)).reshape(folds, 2 + 2 * p)
    return m[:, 0], m[:, 1], m[:, 2:2 + p], m[:, 2 + p:]


# ---- one pass over the rows ----

def pass_over(rows: DataFrame, centre, scale, models: np.ndarray, folds: int, knots: Sequence[int],
              asked: np.ndarray | None = None):
    """(gradient sums, loss sums, held-out loss sums, cross-products) of the models `asked` for, all by default.

    `models`: (folds + 1, penalties, 1 + p) on centred and scaled columns, the intercept first. `knots` are places in
    the flat list of models. What belongs to a model not asked for is zero.
    """
    groups, penalties, q = models.shape
    p = q - 1
    wanted = np.ones(groups * penalties, bool) if asked is None else asked.ravel().copy()
    wanted[list(knots)] = True
    wanted = np.flatnonzero(wanted)
    n_models = len(wanted)
    flat = models.reshape(-1, q)[wanted].T.copy()
    leaves_out = np.repeat(np.arange(groups) - 1, penalties)[wanted]  # -1: none
    knots = np.searchsorted(wanted, np.asarray(knots, int))
    n_cross = q * q * len(knots)
    shared = rows.sparkSession.sparkContext.broadcast((flat, centre, scale))

    def compute(batches):
        beta, mid, unit = shared.value
        gradient = np.zeros((q, n_models))
        loss, held = np.zeros(n_models), np.zeros(n_models)
        cross = np.zeros((len(knots), q, q))
        for batch in batches:
            for fold, label, x in dense_blocks(batch, p):
                x = np.hstack([np.ones((len(x), 1)), (x - mid) / unit])
                pull = np.empty((len(x), len(knots)))
                for a in range(0, len(x), STEP):
                    part, y = x[a:a + STEP], label[a:a + STEP, None]
                    link = part @ beta
                    tail = np.exp(-np.abs(link))
                    cost = np.log1p(tail) + np.maximum(link, 0) - y * link
                    kept = (fold[a:a + STEP, None] != leaves_out).astype(float)
                    mine = cost * kept
                    loss += mine.sum(0)
                    held += (cost - mine).sum(0)
                    tail /= 1 + tail
                    share = np.where(link >= 0, 1 - tail, tail)
                    pull[a:a + STEP] = (share * (1 - share))[:, knots] * kept[:, knots]
                    gradient += part.T @ ((share - y) * kept)
                for i in range(len(knots)):
                    cross[i] += x.T @ (x * pull[:, i, None])
        return np.concatenate([gradient.ravel(), loss, held, cross.ravel()])

    total = added_up(rows, compute, n_models * (q + 2) + n_cross)
    shared.unpersist()
    cuts = np.cumsum([n_models * q, n_models, n_models])
    gradient, loss, held, cross = np.split(total, cuts)

    def spread(found, width=()):
        out = np.zeros((groups * penalties, *width))
        out[wanted] = found
        return out.reshape(groups, penalties, *width)
    return spread(gradient.reshape(q, n_models).T, (q,)), spread(loss), spread(held), cross.reshape(-1, q, q)


def descend(beta: np.ndarray, gradient: np.ndarray, cross: np.ndarray, pick: np.ndarray, limit: np.ndarray,
            damp: np.ndarray, share: float = 0.02, rounds: int = 100) -> np.ndarray:
    """Minimise each model's penalised quadratic: (models, q) steps.

    `cross[pick]` is a model's matrix, `limit` (models, q) its penalties by coordinate. Two sweeps of coordinate descent
    over all models settle which coordinates are not zero; on those each model then solves its linear
    system, and stops on the way where one reaches zero. A model is done at `share` of its first gap.
    """
    models, q = beta.shape
    step, slope = np.zeros_like(beta), gradient.copy()  # slope: gradient of the quadratic at beta + step
    goal = share * optimality_gap(beta, gradient, limit)
    left = np.arange(models)
    for _ in range(rounds):
        if not len(left):
            break
        matrix, more = pick[left], 1 + damp[left]
        now, pull, most = beta[left] + step[left], slope[left], limit[left]
        for j in [*range(q), *range(q)]:
            curve = cross[matrix, j, j] * more + 1e-12
            want = now[:, j] - pull[:, j] / curve
            new = np.sign(want) * np.maximum(np.abs(want) - most[:, j] / curve, 0)
            move = new - now[:, j]
            if move.any():
                now[:, j] = new
                pull += (move * more)[:, None] * cross[matrix, j, :]
        for i in range(len(left)):
            on = np.flatnonzero((now[i] != 0) | (most[i] == 0))
            part = cross[matrix[i]][np.ix_(on, on)] * more[i]
            part[np.diag_indices(len(on))] += 1e-12 + 1e-10 * part.diagonal()
            way = np.linalg.solve(part, -(pull[i, on] + most[i, on] * np.sign(now[i, on])))
            crossing = np.full(len(on), np.inf)
            ends = (most[i, on] > 0) & (now[i, on] * (now[i, on] + way) < 0)
            crossing[ends] = -now[i, on][ends] / way[ends]
            far = min(1.0, crossing.min(initial=np.inf))
            now[i, on] += far * way
            if far < 1:
                now[i, on[crossing.argmin()]] = 0.0
        step[left] = now - beta[left]
        slope[left] = gradient[left] + (1 + damp[left])[:, None] * np.einsum("mj,mjk->mk", step[left], cross[pick[left]])
        gap = optimality_gap(now, slope[left], most)
        left = left[gap > goal[left]]
    return step


def optimality_gap(beta: np.ndarray, gradient: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Largest breach of the optimality conditions over the coordinates; zero at the optimum."""
    at_zero = np.maximum(np.abs(gradient) - limit, 0)
    off_zero = np.abs(gradient + np.where(beta == 0, 0, limit) * np.sign(beta))
    return np.where(beta == 0, at_zero, off_zero).max(-1)


# ---- the path ----

def lasso_path(train: DataFrame, key: str, names: Sequence[str], penalties: int = 100, ratio: float = 1e-4,
               folds: int = 5, label: str = "label", features: str = "features",
               most_steps: int = 60) -> Path:
    """All penalties, log-spaced down from the least that empties the model, for all rows and without each fold.

    Columns are penalised by their spread over the rows a model sees. A fold that is empty is refused.
    """
    p = len(names)
    rows = store(sparse_rows(train, key, folds, label, features).repartition(
        4 * train.sparkSession.sparkContext.defaultParallelism), "lasso-rows")
    n, positive, sums, squares = fold_moments(rows, p, folds)
    if (n == 0).any() or not 0 < positive.sum() < n.sum():
        raise ValueError("the lasso needs both classes, and rows in every fold")

    def without(x):  # over all rows, then without each fold
        return np.concatenate([x.sum(0, keepdims=True), x.sum(0) - x])
    seen = without(n)
    centre = sums.sum(0) / n.sum()
    spread = np.sqrt(np.maximum(without(squares) / seen[:, None] - (without(sums) / seen[:, None]) ** 2, 0))
    scale = np.where(spread[0] > 1e-12, spread[0], 1.0)
    rate = without(positive) / seen
    rate = np.clip(rate, 1e-12, 1 - 1e-12)

    models = np.zeros((folds + 1, penalties, 1 + p))
    models[:, :, 0] = np.log(rate / (1 - rate))[:, None]
    weight = np.hstack([np.zeros((folds + 1, 1)), spread / scale])        # a column's penalty on the common scale
    fixed = np.hstack([np.zeros((folds + 1, 1), bool), spread <= 1e-12])  # constant columns stay out

    null = pass_over(rows, centre, scale, models[:, :1], folds, ())
    per_row = np.abs(null[0][0, 0] / seen[0])
    usable = ~fixed[0, 1:]
    top = float(np.max(per_row[1:][usable] / weight[0, 1:][usable])) if usable.any() else 1.0
    lambdas = top * ratio ** (np.arange(penalties) / max(penalties - 1, 1))
    limit = lambdas[None, :, None] * weight[:, None, :]
    limit = np.where(fixed[:, None, :], np.inf, limit)

    # where the cross-products are taken, and which of them a model steers by
    spread_out = np.unique(np.linspace(0, penalties - 1, min(KNOTS, penalties)).round().astype(int))
    knots, cross = [(0, int(k)) for k in spread_out], None
    shape = models.shape[:2]
    damp = np.zeros(shape)
    best, best_gradient = models.copy(), np.zeros_like(models)
    best_value = np.full(shape, np.inf)
    gap = np.full(shape, np.inf)
    held = np.zeros(shape)
    plain_loss = np.zeros(shape)
    trial, steps, going = models, 0, np.ones(shape, bool)
    penalty_of = lambda m: (np.where(fixed[:, None, :], 0, limit) * np.abs(m)).sum(-1)
    while steps < most_steps:
        gradient, loss, out, cross = pass_over(
            rows, centre, scale, trial, folds, [g * penalties + k for g, k in knots], going)
        steps += 1
        cross = cross / seen[[g for g, _ in knots]][:, None, None]
        gradient = gradient / seen[:, None, None]
        value = loss / seen[:, None] + penalty_of(trial)
        better = going & (value <= best_value + 1e-12 * np.abs(value))
        best = np.where(better[..., None], trial, best)
        best_gradient = np.where(better[..., None], gradient, best_gradient)
        best_value = np.where(better, value, best_value)
        plain_loss, held = np.where(better, loss, plain_loss), np.where(better, out, held)
        damp = np.where(better, damp / 4, np.maximum(4 * damp, 1.0))
        gap = optimality_gap(best, best_gradient, limit) / lambdas[None, :]
        going = gap > TOLERANCE
        if not going.any():
            break
        group, place = np.nonzero(going)
        far = np.array([[abs(k - j) + (0 if g == h else 2 * penalties if h == 0 else 4 * penalties)
                         for h, j in knots] for g, k in zip(group, place)])
        moved = descend(best[going], best_gradient[going], cross, far.argmin(1), limit[going], damp[going])
        trial = best.copy()
        trial[going] += moved
        if steps >= SHARED_STEPS:
            each = max(1, KNOTS // len(np.unique(group)))
            knots = [(int(g), int(k)) for g in np.unique(group)
                     for k in np.unique(place[group == g][np.linspace(0, (group == g).sum() - 1, each).round().astype(int)])]
    beta = best[:, :, 1:] / scale
    return Path(list(names), lambdas.tolist(), best[:, :, 0] - (beta * centre).sum(-1), beta,
                held[1:] / n[:, None], plain_loss[0] / seen[0],
                float(null[1][0, 0] / seen[0]), gap, steps)


def path_table(spark: SparkSession, path: Path) -> DataFrame:
    """One row per penalty: held-out loss, nonzero coefficients, share of the null deviance explained, gap."""
    rows = [(float(lam), float(m), float(s), int(k), float(1 - loss / path.null_loss), float(g))
            for lam, m, s, k, loss, g in zip(path.lambdas, path.mean, path.std, (path.beta[0] != 0).sum(1),
                                             path.loss, path.violation.max(0))]
    return small_table(spark, rows, "lambda double, mean_loss double, sd_loss double, nonzero bigint, "
                                    "deviance_ratio double, optimality_gap double")


def lambda_rule(path: Path, rule: str = "1se") -> float:
    """`min`: the penalty with the least loss. `1se`: the largest within one standard error."""
    best = min(range(len(path.mean)), key=lambda i: path.mean[i])
    if rule == "min":
        return path.lambdas[best]
    # the spread is that of a population, so its error divides by folds - 1
    limit = path.mean[best] + path.std[best] / math.sqrt(path.folds - 1)
    return max(lam for lam, m in zip(path.lambdas, path.mean) if m <= limit)


def path_coefficients(spark: SparkSession, path: Path, penalty: float, nonzero: bool = True) -> DataFrame:
    """(term, estimate) of the model of all rows at one penalty of the path, the intercept included."""
    k = path.at(penalty)
    rows = [("(Intercept)", float(path.intercept[0, k])),
            *[(t, float(b)) for t, b in zip(path.names, path.beta[0, k]) if b or not nonzero]]
    return small_table(spark, rows, "term string, estimate double")


def link_of(path: Path, penalty: float, features: str = "features") -> Column:
    """The linear predictor of a row under the model of all rows, in plain column expressions."""
    k = path.at(penalty)
    vector = F.unwrap_udt(F.col(features))
    beta = F.array(*[F.lit(float(b)) for b in path.beta[0, k]])
    slots = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    return F.aggregate(F.zip_with(slots, vector["values"], lambda i, v: v * F.get(beta, i)),
                       F.lit(float(path.intercept[0, k])), lambda s, x: s + x)


def predict(df: DataFrame, path: Path, penalty: float, features: str = "features") -> DataFrame:
    """`df` with the probability and the 0/1 prediction of the label."""
    link = link_of(path, penalty, features)
    return df.withColumn("probability", 1 / (1 + F.exp(-link))).withColumn(
        "prediction", (F.col("probability") > 0.5).cast("double"))
