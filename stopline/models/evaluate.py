"""Predictions to confusion counts, and the metrics that follow from four counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.session import small_table


def threshold_class(probability: Column, below: str = "Citation", above: str = "Warning",
                    cut: float = 0.5) -> Column:
    return F.when(probability < cut, below).otherwise(above)


def test_error(df: DataFrame, predicted: str, actual: str, digits: int = 6) -> DataFrame:
    wrong = (F.col(predicted) != F.col(actual)).cast("double")
    return df.agg(F.round(F.avg(wrong), digits).alias("test_error"))


def confusion_table(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """(prediction, reference, n)."""
    return df.groupBy(
        F.col(predicted).alias("prediction"), F.col(actual).alias("reference")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_counts(df: DataFrame, predicted: str, actual: str, positive: str,
                     run: Sequence[str] = ()) -> DataFrame:
    """One row of (tp, fp, fn, tn) per run, from one aggregate."""
    p, a = F.col(predicted) == positive, F.col(actual) == positive
    return df.groupBy(*run).agg(
        F.count_if(p & a).alias("tp"), F.count_if(p & ~a).alias("fp"),
        F.count_if(~p & a).alias("fn"), F.count_if(~p & ~a).alias("tn"))


def confusion_metrics(counts: DataFrame, digits: int = 6) -> DataFrame:
    """Add the closed-form metrics to rows of (tp, fp, fn, tn)."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn

    def over(part: Column, whole: Column) -> Column:
        return part / F.nullif(whole, F.lit(0.0))

    accuracy = over(tp + tn, n)
    chance = over((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    sensitivity, specificity = over(tp, tp + fn), over(tn, tn + fp)
    metrics = {
        "accuracy": accuracy,
        "no_information_rate": over(F.greatest(tp + fn, fp + tn), n),
        "kappa": over(accuracy - chance, 1 - chance),
        "sensitivity": sensitivity,
        "specificity": specificity,
        "pos_pred_value": over(tp, tp + fp),
        "neg_pred_value": over(tn, tn + fn),
        "prevalence": over(tp + fn, n),
        "detection_rate": over(tp, n),
        "detection_prevalence": over(tp + fp, n),
        "balanced_accuracy": (sensitivity + specificity) / 2,
    }
    return counts.withColumns({k: F.round(v, digits) for k, v in metrics.items()})


def metrics_long(metrics: DataFrame, ids: Sequence[str] = (), section: str = "confusion",
                 run: str | None = None) -> DataFrame:
    """(run, section, metric, value) rows, ready for `write_report`."""
    values = [c for c in metrics.columns if c not in ids]
    wide = metrics.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
    long = wide.unpivot(list(ids), values, "metric", "value")
    name = F.lit(run) if run is not None else F.concat_ws(" ", *ids)
    return long.select(name.alias("run"), F.lit(section).alias("section"), "metric", "value")


def long_form(df: DataFrame, section: str, ids: Sequence[str]) -> DataFrame:
    """(section, item, metric, value): every number of a result table, its rows named by `ids`."""
    values = [c for c in df.columns if c not in ids]
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in values]
    item = F.concat_ws(", ", *[F.col(c).cast("string") for c in ids])
    return df.select(F.lit(section).alias("section"), item.alias("item"), F.inline(F.array(*cells)))


# ---- exact tests on four counts, on the driver ----

def _beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_cdf(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    f, c, d = 1.0, 1.0, 0.0
    # terms needed grow with the square root of the counts
    for i in range(1_000 + int(100 * math.sqrt(a + b))):
        m = i // 2
        if i == 0:
            step = 1.0
        elif i % 2 == 0:
            step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / ((1 + step * d) or tiny)
        c = (1 + step / c) or tiny
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            return front * (f - 1)
    raise ArithmeticError(f"the beta function of {x}, {a}, {b} did not converge")


def _beta_quantile(p: float, a: float, b: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _beta_cdf(mid, a, b) < p else (low, mid)
    return (low + high) / 2


def exact_tests(tp: int, fp: int, fn: int, tn: int, level: float = 0.95) -> dict[str, float]:
    """Exact binomial interval of the accuracy, P[accuracy > no-information rate], McNemar p."""
    n, right = tp + fp + fn + tn, tp + tn
    tail = (1 - level) / 2
    nir = max(tp + fn, fp + tn) / n
    low = _beta_quantile(tail, right, n - right + 1) if right else 0.0
    high = _beta_quantile(1 - tail, right + 1, n - right) if right < n else 1.0
    off = fp + fn
    chi = max(abs(fp - fn) - 1, 0) ** 2 / off if off else 0.0
    return {
        "accuracy_low": low,
        "accuracy_high": high,
        "p_accuracy_above_nir": _beta_cdf(nir, right, n - right + 1) if right else 1.0,
        "mcnemar_p": math.erfc(math.sqrt(chi / 2)),
    }


def confusion_report(spark: SparkSession, counts: DataFrame, run: str) -> DataFrame:
    """All metrics of one run, the exact tests included, as (run, section, metric, value)."""
    row = counts.select("tp", "fp", "fn", "tn").first()
    tests = exact_tests(*row)
    extra = small_table(
        spark, [(run, "confusion", k, float(v)) for k, v in tests.items()],
        "run string, section string, metric string, value double")
    return metrics_long(confusion_metrics(counts), run=run).unionByName(extra)
