"""Registered queries: coding, splits, models, metrics, tree tables, selection, clusters.

The model queries start from the stored modelling frame and use all its rows. A session makes the
frame, the forests, the boosted grid, the lasso paths and the subset job once; the queries read them.
Fits have no SQL form; their properties are tested in `tests/`.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stopline import schema
from stopline.bindings.common import (
    CASES_SQL, CODED_SQL, cases, coded_lineitem, kept, query, table, with_order,
)
from stopline.bindings.jobs import model_table
from stopline.bindings.prepare import RULE_METRICS_SQL, rule_predictions
from stopline.models import cluster, encode, evaluate, grove, linear, trees
from stopline.operators import cleaning, stats
from stopline.plans import jobs

KEY = jobs.KEY
DEPTH = 20
FORESTS = [{"trees": t, "mtry": m} for t, m in ((50, 4), (100, 4), (150, 4), (50, 2), (50, 6))]


# ---- coding and metrics, checked by SQL ----

_DUMMIES = [("l_linestatus", ["F", "O"]),
            ("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])]


@query("SELECT l_orderkey, l_quantity, " + ", ".join(
    f"""cast({c} = '{v}' AS int) AS "{c}_{v}\"""" for c, levels in _DUMMIES for v in levels[1:])
    + f" FROM {CASES_SQL} c")
def design_matrix(spark, sf):
    return encode.dummy_columns(cases(spark, sf), [c for c, _ in _DUMMIES],
                                ["l_orderkey", "l_quantity"])


@query("""WITH long AS (SELECT l_orderkey * 8 + l_linenumber AS row_key, 1 AS place, cast(l_partkey AS string) AS level
      FROM lineitem UNION ALL SELECT l_orderkey * 8 + l_linenumber, 2, l_returnflag FROM lineitem),
    levels AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY level) AS k FROM (
      SELECT DISTINCT place, level FROM long) d),
    slots AS (SELECT place, level, 1 + row_number() OVER (ORDER BY place, level) AS slot FROM levels WHERE k > 1)
  SELECT row_key, slot, 1.0e0 AS value FROM long JOIN slots USING (place, level)
  UNION ALL SELECT l_orderkey * 8 + l_linenumber, 0, cast(l_quantity AS double) FROM lineitem WHERE l_quantity <> 0
  UNION ALL SELECT l_orderkey * 8 + l_linenumber, 1, cast(l_discount AS double) FROM lineitem WHERE l_discount <> 0""")
def design_triplets(spark, sf):
    """The design matrix without its zeros: a factor of all part keys, one of return flags, two numbers."""
    rows = table(spark, sf, "lineitem").withColumn("row_key", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return encode.design_triplets(rows, "row_key", ["l_partkey", "l_returnflag"], ["l_quantity", "l_discount"])


@query(RULE_METRICS_SQL)
def confusion_metrics(spark, sf):
    return evaluate.confusion_metrics(evaluate.confusion_counts(
        rule_predictions(spark, sf), "predicted", "outcome", "Citation"))


@query()
def confusion_report(spark, sf):
    """All metrics with the accuracy's interval, P[acc > NIR] and McNemar's test."""
    return evaluate.confusion_report(spark, evaluate.confusion_counts(
        rule_predictions(spark, sf), "predicted", "outcome", "Citation"), "rule")


@query(f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN l_quantity / 50.0e0 < 0.5 THEN 'Citation' ELSE 'Warning' END AS predicted
  FROM {CODED_SQL} l""")
def threshold_class(spark, sf):
    rows = coded_lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity")
    return rows.select("l_orderkey", "l_linenumber", evaluate.threshold_class(
        F.col("l_quantity") / 50.0).alias("predicted"))


@query(f"""SELECT round(avg(cast((CASE WHEN l_quantity > 25 THEN 'Citation' ELSE 'Warning' END)
  <> outcome AS int)), 6) AS test_error FROM {CODED_SQL} l
  WHERE outcome IN ('Citation', 'Warning')""")
def test_error(spark, sf):
    return evaluate.test_error(rule_predictions(spark, sf), "predicted", "outcome")


_GRAM = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS i, '{b}' AS j, round(sum(cast({a} AS double) * {b}), 4) AS s FROM lineitem"
    for k, a in enumerate(_GRAM) for b in _GRAM[k:]))
def gram_matrix(spark, sf):
    return linear.gram_matrix(table(spark, sf, "lineitem"), _GRAM, 4)


# ---- forests ----

def prepared(spark, sf, dummies=False, fraction=0.7, chosen=None):
    """(train, test, encoder, names) of the stored modelling frame without weak flags."""
    def make():
        frame = cleaning.drop_columns(model_table(spark, sf), schema.WEAK_FLAGS)
        if chosen:
            frame = frame.select(KEY, "violation_type", "label", *chosen)
        return jobs._prepare(frame, KEY, fraction, dummies)
    return kept(spark, sf, f"prepared {dummies} {fraction} {chosen and len(chosen)}", make)


def forests(spark, sf):
    """All five forests and their tables, fitted once for the queries below and the job."""
    return kept(spark, sf, "forests", lambda: jobs.forest_results(
        *prepared(spark, sf), KEY, FORESTS, DEPTH))


@query()
def random_forest(spark, sf):
    """Out-of-bag error and held-out results of the five forests."""
    return forests(spark, sf)["scores"]


@query()
def oob_replacement(spark, sf):
    """Out-of-bag class tables of the five forests."""
    return forests(spark, sf)["out_of_bag"]


@query()
def impurity_importance(spark, sf):
    return forests(spark, sf)["importance"]


@query()
def permutation_importance(spark, sf):
    """Mean share of a row's out-of-bag votes lost without a variable, overall and by class."""
    return forests(spark, sf)["permutation"]


@query()
def local_importance(spark, sf):
    """The same for every row and variable."""
    return forests(spark, sf)["local"]


@query()
def importance_chart_data(spark, sf):
    return trees.rank_importance(forests(spark, sf)["importance"], k=10)


@query()
def rank_importance(spark, sf):
    return trees.rank_importance(forests(spark, sf)["importance"])


@query()
def tree_nodes(spark, sf):
    return forests(spark, sf)["nodes"]


@query()
def min_depth_distribution(spark, sf):
    return forests(spark, sf)["min_depth"]


@query()
def forest_measures(spark, sf):
    return forests(spark, sf)["measures"]


@query()
def predict(spark, sf):
    return forests(spark, sf)["predicted"].select(
        KEY, "violation_type", "predicted", "prediction", F.round("probability", 9).alias("probability"))


@query()
def model_store(spark, sf):
    """Predictions of a saved and reloaded forest, with the number that differ."""
    out = forests(spark, sf)
    size = FORESTS[0]["trees"]
    again = grove.predicted(grove.votes(grove.load(spark, out["path"]), out["rows"].where("held"), KEY, out["bins"], size, [size]),
                            0, "violation_type")
    both = out["predicted"].select("block", "place", "prediction").join(
        again.select("block", "place", F.col("prediction").alias("again")), ["block", "place"], "full")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("again").eqNullSafe(F.col("prediction"))).alias("different"))


@query()
def job_forest(spark, sf):
    """All result tables of the forest sweep."""
    return jobs.forest_report(forests(spark, sf))


# ---- boosted trees ----

def boosted(spark, sf):
    """The whole grid of 18 points by 5 folds, fitted once for the queries below and the job."""
    return kept(spark, sf, "boosted", lambda: jobs.boosted_results(*prepared(spark, sf, fraction=0.6), KEY))


@query()
def gbt_grid_cv(spark, sf):
    return boosted(spark, sf)["cv"].drop("best")


@query()
def cv_results_table(spark, sf):
    return boosted(spark, sf)["cv"]


@query()
def scaled_importance(spark, sf):
    return boosted(spark, sf)["importance"].limit(20)


@query()
def job_gbt(spark, sf):
    """All result tables of the boosted grid."""
    return jobs.boosted_report(boosted(spark, sf))


# ---- logistic models ----

def linear_parts(spark, sf, chosen=None):
    """(train, test, names, Gram) of the dummy-coded frame."""
    train, test, _, names = prepared(spark, sf, True, 0.8, chosen)
    return kept(spark, sf, f"gram {chosen and len(chosen)}", lambda: (
        train, test, names, linear.gram(train, "features", "label", names)))


def _logistic(spark, sf, chosen=None):
    """Coefficients and fit statistics (estimate holds their value) of one logistic model."""
    out = jobs.logistic(*linear_parts(spark, sf, chosen))
    fit = out["fit"].select(F.lit("fit").alias("section"), F.col("metric").alias("term"), F.col("value").alias("estimate"))
    return stats.union_reports(
        out["coefficients"].select(F.lit("coefficient").alias("section"), "*"), fit)


@query()
def logistic_glm(spark, sf):
    return _logistic(spark, sf)


def lasso_results(spark, sf, rule="1se", drop_extra=()):
    """The whole path of 100 penalties by 5 folds, fitted once for the queries below and the job."""
    return kept(spark, sf, f"lasso {rule} {len(drop_extra)}", lambda: jobs.lasso(
        model_table(spark, sf), rule=rule, drop_extra=drop_extra))


@query()
def lasso_cv(spark, sf):
    return lasso_results(spark, sf)["path"].drop("is_min", "is_1se")


@query()
def lambda_rule(spark, sf):
    return lasso_results(spark, sf)["path"]


@query()
def nonzero_coefficients(spark, sf):
    return lasso_results(spark, sf)["coefficients"]


@query()
def rank_coefficients(spark, sf):
    """The 12 largest and smallest at the chosen penalty, and the 50 smallest of the forward subset of 128 terms."""
    out = lasso_results(spark, sf)
    forward = subset_results(spark, sf)["smallest_forward"]
    return stats.union_reports(*[out[t].select(F.lit(f"lasso {t}").alias("section"), "*") for t in ("largest", "smallest")],
                               forward.select(F.lit("forward smallest").alias("section"), "*"))


@query()
def refit_reduced(spark, sf):
    return lasso_results(spark, sf, "min", tuple(schema.LASSO_SECOND_DROP))["coefficients"]


@query()
def job_lasso(spark, sf):
    """All result tables of the lasso and of its reduced refit."""
    second = jobs.lasso_report(lasso_results(spark, sf, "min", tuple(schema.LASSO_SECOND_DROP)))
    return stats.union_reports(
        jobs.lasso_report(lasso_results(spark, sf)),
        second.withColumn("section", F.concat(F.lit("reduced "), "section")))


# ---- stepwise selection ----

def subset_results(spark, sf):
    return kept(spark, sf, "subset", lambda: jobs.subset(model_table(spark, sf)))


@query()
def forward_selection(spark, sf):
    return linear.stepwise(spark, linear_parts(spark, sf)[3], "forward")


@query()
def backward_selection(spark, sf):
    return linear.stepwise(spark, linear_parts(spark, sf)[3], "backward")


@query()
def selection_criteria(spark, sf):
    g = linear_parts(spark, sf)[3]
    return linear.selection_sizes(stats.union_reports(
        linear.stepwise(spark, g, "forward"), linear.stepwise(spark, g, "backward")))


@query()
def subset_refit(spark, sf):
    """Both models on the 14 chosen features: the logistic one, the forest's importances, and their errors."""
    out = subset_results(spark, sf)
    errors = out["errors"].where("run like '% subset'")
    return stats.union_reports(
        out["coefficients_subset"].select(F.lit("coefficient").alias("section"), "*"),
        out["fit_subset"].select(F.lit("fit").alias("section"), F.col("metric").alias("term"), F.col("value").alias("estimate")),
        out["importance_subset"].select(F.lit("forest importance").alias("section"), F.col("variable").alias("term"),
                                        F.col("importance").alias("estimate")),
        errors.select(F.lit("test error").alias("section"), F.col("run").alias("term"), F.col("test_error").alias("estimate")))


@query()
def job_subset(spark, sf):
    """All result tables of the subset job."""
    return jobs.subset_report(subset_results(spark, sf))


# ---- clusters ----

_PROFILE = ["l_returnflag", "l_linestatus", "l_linenumber", "o_orderpriority", "o_orderstatus"]
_DIFF = " + ".join(f"cast(a.{c} <> b.{c} AS int)" for c in _PROFILE)


def profiles(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", *_PROFILE[:3])
    rows = with_order(spark, sf, lines, *_PROFILE[3:])
    return cluster.distinct_profiles(rows, _PROFILE)


@query(f"""WITH p AS (SELECT *, row_number() OVER (ORDER BY {", ".join(_PROFILE)}) AS id
    FROM (SELECT DISTINCT {", ".join(_PROFILE)} FROM lineitem JOIN orders
      ON l_orderkey = o_orderkey) d),
  n AS (SELECT a.id, b.id AS nearest, ({_DIFF}) / {len(_PROFILE)}.0e0 AS distance
    FROM p a JOIN p b ON a.id <> b.id)
  SELECT id, min_by(nearest, distance * 1000000 + nearest) AS nearest,
    round(min(distance), 6) AS distance FROM n GROUP BY 1""")
def gower_pairs(spark, sf):
    """Each profile's nearest other profile; the full pair table is never made."""
    nearest = cluster.gower_nearest(profiles(spark, sf), _PROFILE)
    return nearest.withColumn("distance", F.round("distance", 6))


@query()
def complete_linkage(spark, sf):
    return cluster.complete_linkage(profiles(spark, sf), _PROFILE)


@query()
def cut_tree(spark, sf):
    found = profiles(spark, sf)
    merges = cluster.complete_linkage(found, _PROFILE)
    return cluster.cut_tree(found, merges, 5)
