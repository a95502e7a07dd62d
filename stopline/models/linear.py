"""The logistic model, the Gram matrix and stepwise selection."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.session import small_table


# ---- Gram matrix ----

def gram_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """(i, j, s) with s = sum of x_i * x_j, for i <= j, from one aggregate without a shuffle key.

    Meant for a few dozen columns; `gram` covers wide dummy coding.
    """
    cols = list(cols)
    pairs = [(a, b) for k, a in enumerate(cols) for b in cols[k:]]
    x = {c: F.col(c).cast("double") for c in cols}
    entries = [
        F.struct(F.lit(a).alias("i"), F.lit(b).alias("j"),
                 (F.sum(x[a] * x[b]) if digits is None
                  else F.round(F.sum(x[a] * x[b]), digits)).alias("s"))
        for a, b in pairs
    ]
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e"))


@dataclass
class Gram:
    """Cross-products of (1, x_1..x_p, y) over all rows."""
    matrix: np.ndarray
    names: list[str]

    @property
    def n(self) -> int:
        return int(round(self.matrix[0, 0]))


def gram(df: DataFrame, features: str, label: str, names: Sequence[str]) -> Gram:
    """Cross-products by Spark's tree aggregation over sparse vectors; only p x p numbers return."""
    rows = VectorAssembler(inputCols=["_one", features, label], outputCol="_v").transform(
        df.select(features, F.col(label).cast("double").alias(label),
                  F.lit(1.0).alias("_one"))).select("_v")
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "_v")).computeGramianMatrix()
    return Gram(matrix.toArray(), list(names))


# ---- stepwise selection on the Gram matrix ----

def _sweep(a: np.ndarray, k: int) -> None:
    """Pivot on k, in place; sweeping the same pivot again undoes it."""
    pivot = a[k, k]
    row = a[k, :] / pivot
    column = a[:, k].copy()
    a -= np.outer(column, row)
    a[k, :] = row
    a[:, k] = -column / pivot
    a[k, k] = 1 / pivot


def stepwise(spark: SparkSession, g: Gram, direction: str, max_terms: int = 300) -> DataFrame:
    """(method, size, term, rss, adj_r2, cp, bic): one row per subset size.

    `term` is the variable that enters at this size (forward) or the one that
    leaves next (backward). Columns that are linear combinations of others
    never enter. Works on the p x p matrix only.
    """
    if direction not in ("forward", "backward"):
        raise ValueError(direction)
    p, n = len(g.names), g.n
    y = p + 1
    a = g.matrix.astype(float).copy()
    _sweep(a, 0)
    spread = np.diag(a).copy()
    null_rss = a[y, y]
    usable = lambda j: a[j, j] > 1e-9 * max(spread[j], 1e-300)
    entered: list[tuple[int, float]] = []
    outside = set(range(1, p + 1))
    while outside and (direction == "backward" or len(entered) < max_terms):
        able = [j for j in outside if usable(j)]
        if not able:
            break
        best = max(able, key=lambda j: (a[j, y] ** 2 / a[j, j], -j))
        _sweep(a, best)
        outside.discard(best)
        entered.append((best, a[y, y]))
    path = [(k + 1, j, rss) for k, (j, rss) in enumerate(entered)]
    if direction == "backward":
        inside = [j for j, _ in entered]
        path = []
        while inside:
            rss = a[y, y]
            worst = min(inside, key=lambda j: (a[j, y] ** 2 / a[j, j], j))
            path.append((len(inside), worst, rss))
            _sweep(a, worst)
            inside.remove(worst)
        path = [step for step in reversed(path) if step[0] <= max_terms]

    full_size, full_rss = len(entered), entered[-1][1] if entered else null_rss
    if direction == "forward" and outside:
        rest = a.copy()
        for j in sorted(outside):
            if rest[j, j] > 1e-9 * max(spread[j], 1e-300):
                _sweep(rest, j)
                full_size += 1
        full_rss = rest[y, y]
    noise = full_rss / (n - full_size - 1)
    rows = []
    for size, j, rss in path:
        terms = size + 1
        adjusted = 1 - (rss / null_rss) * (n - 1) / (n - terms)
        rows.append((direction, size, g.names[j - 1], float(rss), float(adjusted),
                     float(rss / noise - n + 2 * terms),
                     float(n * math.log(rss / null_rss) + terms * math.log(n))))
    return small_table(
        spark, rows, "method string, size int, term string, rss double, adj_r2 double, "
                     "cp double, bic double")


def selection_sizes(steps: DataFrame) -> DataFrame:
    """(method, bic, rss, adj_r2, cp): the size each criterion prefers."""
    return steps.groupBy("method").agg(
        F.min_by("size", "bic").alias("bic"), F.min_by("size", "rss").alias("rss"),
        F.max_by("size", "adj_r2").alias("adj_r2"), F.min_by("size", "cp").alias("cp"))


def subset_coefficients(spark: SparkSession, g: Gram, terms: Sequence[str]) -> DataFrame:
    """Least-squares coefficients (term, estimate) of one chosen subset."""
    a = g.matrix.astype(float).copy()
    at = [0, *[g.names.index(t) + 1 for t in terms]]
    beta = np.linalg.solve(a[np.ix_(at, at)], a[at, -1])
    return small_table(spark, [(t, float(b)) for t, b in zip(["(Intercept)", *terms], beta)],
                       "term string, estimate double")


def independent_terms(g: Gram) -> list[int]:
    """Positions of the columns that are no linear combination of earlier ones."""
    a = g.matrix.astype(float).copy()
    _sweep(a, 0)
    spread, kept = np.diag(a).copy(), []
    for j in range(1, len(g.names) + 1):
        if a[j, j] > 1e-9 * max(spread[j], 1e-300):
            _sweep(a, j)
            kept.append(j - 1)
    return kept


# ---- logistic models ----

def logistic_glm(train: DataFrame, label: str = "label", features: str = "features",
                 max_iter: int = 25, terms: Sequence[int] | None = None) -> PipelineModel:
    """Unpenalised binomial model, fitted by iteratively reweighted least squares.

    `terms` are the columns to use (`independent_terms`): aliased ones would
    leave the normal equations singular and the standard errors undefined.
    """
    glm = GeneralizedLinearRegression(
        family="binomial", link="logit", labelCol=label, featuresCol=features,
        maxIter=max_iter, linkPredictionCol="link")
    if terms is None:
        return Pipeline(stages=[glm]).fit(train)
    pick = VectorSlicer(inputCol=features, outputCol=f"{features}_used", indices=list(terms))
    rows = pick.transform(train).select(label, f"{features}_used").persist()  # read once for all iterations
    model = PipelineModel([pick, glm.setFeaturesCol(f"{features}_used").fit(rows)])
    model.training_rows = rows  # the summary reads them; release with `unpersist`
    return model


def glm_coefficients(spark: SparkSession, model: PipelineModel, names: Sequence[str],
                     terms: Sequence[int] | None = None) -> DataFrame:
    """(term, estimate, std_error, z, p_value), the intercept first, aliased terms NULL."""
    glm = model.stages[-1]
    s = glm.summary
    used = [names[i] for i in (range(len(names)) if terms is None else terms)]
    estimates = [*glm.coefficients.toArray(), glm.intercept]  # the intercept is listed last
    known = {
        name: (float(b), float(se), float(z), float(p))
        for name, b, se, z, p in zip([*used, "(Intercept)"], estimates,
                                     s.coefficientStandardErrors, s.tValues, s.pValues)
    }
    rows = [(t, *known.get(t, (None,) * 4)) for t in ["(Intercept)", *names]]
    return small_table(
        spark, rows,
        "term string, estimate double, std_error double, z double, p_value double")


def glm_fit_statistics(spark: SparkSession, model: PipelineModel) -> DataFrame:
    s = model.stages[-1].summary
    values = {
        "null_deviance": s.nullDeviance, "residual_deviance": s.deviance, "aic": s.aic,
        "null_df": s.residualDegreeOfFreedomNull, "residual_df": s.residualDegreeOfFreedom,
        "iterations": s.numIterations,
    }
    return small_table(spark, [(k, float(v)) for k, v in values.items()],
                                 "metric string, value double")


def rank_coefficients(coefs: DataFrame, k: int = 12, largest: bool = True) -> DataFrame:
    order = F.desc("estimate") if largest else F.asc("estimate")
    return coefs.orderBy(order, "term").limit(k)
