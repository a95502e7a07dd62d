"""Forests and boosted trees: fitting, grids, tree tables and importances."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopline.models.evaluate import confusion_counts, confusion_metrics
from stopline.session import small_table


def random_forest(bins: int, trees: int = 100, mtry: int = 4, max_depth: int = 20,
                  label: str = "label", seed: int = 7) -> RandomForestClassifier:
    """A forest with `mtry` candidate columns per split over indexed factors.

    `bins` must cover the largest level dictionary.
    """
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=max_depth,
        featureSubsetStrategy=str(mtry), maxBins=max(32, bins), seed=seed)


def boosted_trees(bins: int, trees: int, depth: int, shrinkage: float, min_rows: int = 20,
                  label: str = "label", seed: int = 7) -> GBTClassifier:
    return GBTClassifier(
        labelCol=label, featuresCol="features", maxIter=trees, maxDepth=depth,
        stepSize=shrinkage, minInstancesPerNode=min_rows, maxBins=max(32, bins), seed=seed)


def score_counts(model, test: DataFrame, label: str) -> dict:
    """Counts and metrics of a model's predictions."""
    return prediction_counts(model.transform(test), label)


def prediction_counts(scored: DataFrame, label: str) -> dict:
    """Counts and metrics of 0/1 predictions."""
    scored = scored.select(F.col("prediction").cast("string").alias("p"), F.col(label).cast("string").alias("a"))
    return confusion_metrics(confusion_counts(scored, "p", "a", "1.0")).first().asDict()


def in_parallel(spark: SparkSession, tasks, parallelism: int) -> list:
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks))


def with_fold(df: DataFrame, key: str, folds: int, out: str = "fold") -> DataFrame:
    """Fold 0..folds-1 from a hash of the key: the same on every evaluation."""
    return df.withColumn(out, F.pmod(F.xxhash64(key), F.lit(folds)).cast("int"))


def stage_scores(stages: Sequence, test: DataFrame, label: str) -> list[dict]:
    """Metrics of every prefix of one boosted ensemble, from one pass over the rows."""
    scored = test.select("features", label)
    for i, model in enumerate(stages):
        scored = model.setPredictionCol(f"p{i}").setRawPredictionCol(f"raw{i}").setProbabilityCol(
            f"prob{i}").transform(scored)
    long = scored.select(F.col(label).cast("string").alias("a"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("stage"), F.col(f"p{i}").cast("string").alias("p")) for i in range(len(stages))])))
    counts = confusion_metrics(confusion_counts(long, "p", "a", "1.0", run=["stage"]))
    found = {r["stage"]: r.asDict() for r in counts.collect()}  # a row per stage
    return [found[i] for i in range(len(stages))]


def fit_gbt_grid(train: DataFrame, key: str, bins: int, trees: Sequence[int] = (10, 50, 100),
                 depths: Sequence[int] = (1, 2, 3), shrinkages: Sequence[float] = (0.01, 0.1),
                 min_rows: int = 20, folds: int = 5, label: str = "label",
                 parallelism: int = 8):
    """k-fold accuracy and kappa per grid point; the best point is refitted on all rows.

    One ensemble of the most trees is grown per (shrinkage, depth, fold), all of them side by side; boosting adds
    trees one by one, so its prefixes are the smaller models.
    `parallelism` has no effect, as no fit of the grid runs apart.
    Returns (model, best point, table of (shrinkage, depth, trees, accuracy, kappa and their spreads)).
    """
    from stopline.models.boosting import grid_counts

    spark = train.sparkSession
    folded = with_fold(train.select(key, "features", label), key, folds).persist()
    counted = grid_counts(folded, bins, trees, depths, shrinkages, min_rows, folds, label)
    counts = small_table(spark, [(*g, *c) for g, c in sorted(counted.items())],
                         "shrinkage double, depth int, fold int, trees int, tp bigint, fp bigint, fn bigint, tn bigint")
    found: dict = {}
    for s in confusion_metrics(counts).collect():  # a row per point and fold
        found.setdefault((s["shrinkage"], s["depth"], s["trees"]), []).append((s["accuracy"], s["kappa"] or 0.0))
    rows = []
    for point, values in sorted(found.items()):
        mean = [sum(v[i] for v in values) / folds for i in (0, 1)]
        spread = [(sum((v[i] - mean[i]) ** 2 for v in values) / max(folds - 1, 1)) ** 0.5 for i in (0, 1)]
        rows.append((*point, *mean, *spread))
    best = max(rows, key=lambda r: r[3])[:3]
    model = boosted_trees(bins, best[2], best[1], best[0], min_rows, label).fit(folded)
    folded.unpersist()
    table = small_table(
        spark, rows, "shrinkage double, depth int, trees int, accuracy double, kappa double, "
                     "accuracy_sd double, kappa_sd double")
    return model, best, table


# ---- tree tables ----

def tree_nodes(spark: SparkSession, model_path: str, names: Sequence[str]) -> DataFrame:
    """A saved forest as rows: one per node, with the split variable by name."""
    data = spark.read.parquet(f"{model_path}/data")
    lookup = small_table(spark, list(enumerate(names)), "feature int, variable string")
    node = F.col("nodeData")
    flat = data.select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        F.nullif(node["leftChild"], F.lit(-1)).alias("left"),
        F.nullif(node["rightChild"], F.lit(-1)).alias("right"),
        F.nullif(node["split"]["featureIndex"], F.lit(-1)).alias("feature"),
        node["split"]["leftCategoriesOrThreshold"].alias("split_code"),
        node["gain"].alias("gain"), node["rawCount"].alias("weight"),
        node["prediction"].alias("prediction"))
    return flat.join(F.broadcast(lookup), "feature", "left")


def node_depths(nodes: DataFrame) -> DataFrame:
    """Add the depth of each node: one grouped pass, a tree's nodes in one task, whatever the depth."""
    def depths(tree: pa.Table) -> pa.Table:
        at = {n: i for i, n in enumerate(tree["node"].to_pylist())}
        left, right = (tree[c].to_pylist() for c in ("left", "right"))
        depth, todo = [None] * len(at), [(0, 0)]
        while todo:
            node, d = todo.pop()
            i = at[node]
            depth[i] = d
            todo += [(child, d + 1) for child in (left[i], right[i]) if child is not None]
        return pa.table({"tree": tree["tree"], "node": tree["node"], "depth": pa.array(depth, pa.int32())})

    kinds = dict(nodes.dtypes)
    found = nodes.select("tree", "node", "left", "right").groupBy("tree").applyInArrow(
        depths, f"tree {kinds['tree']}, node {kinds['node']}, depth int")
    return nodes.join(found, ["tree", "node"])


def min_depth_distribution(nodes: DataFrame) -> DataFrame:
    """(tree, variable, minimal_depth): the first depth at which each tree uses a variable."""
    deep = node_depths(nodes).where("variable is not null")
    return deep.groupBy("tree", "variable").agg(F.min("depth").alias("minimal_depth"))


def impurity_importance(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """(variable, importance): mean impurity decrease, scaled to sum 1."""
    values = [float(v) for v in model.featureImportances.toArray()]
    return small_table(spark, list(zip(names, values)), "variable string, importance double")


def scaled_importance(importances: DataFrame, col: str = "importance") -> DataFrame:
    """Importances with the largest set to 100, in descending order."""
    top = Window.partitionBy(F.lit(1))
    return importances.withColumn(
        "overall", 100 * F.col(col) / F.max(col).over(top)
    ).orderBy(F.desc("overall"), "variable")


def rank_importance(importances: DataFrame, col: str = "importance",
                    k: int | None = None) -> DataFrame:
    ranked = importances.orderBy(F.desc(col), "variable")
    return ranked if k is None else ranked.limit(k)


def permutation_importance(model: PipelineModel, df: DataFrame, cols: Sequence[str], key: str,
                           label: str = "label", bucket_rows: int = 100_000) -> DataFrame:
    """Accuracy lost when one column is shuffled, overall and per class.

    Rows go into hash buckets of the unique key; inside a bucket, ordered by a
    second hash, each row also gets its predecessor's columns. One shuffle so
    provides a random partner for every column, and each row is then scored
    once as it is and once per column with the partner's value in place.
    """
    n = df.count()
    buckets = max(1, -(-n // bucket_rows))
    work = df.select(key, label, *cols).withColumn(
        "_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    order = Window.partitionBy("_bucket").orderBy(F.xxhash64(F.lit(1), F.col(key)), key)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mine = F.struct(*cols)
    paired = work.select(
        label, mine.alias("mine"),
        F.coalesce(F.lag(mine).over(order), F.last(mine).over(every)).alias("other"))
    variants = [F.struct(F.lit("").alias("variable"), *[F.col(f"mine.{c}") for c in cols])]
    variants += [
        F.struct(F.lit(swapped).alias("variable"),
                 *[F.col(f"{'other' if c == swapped else 'mine'}.{c}") for c in cols])
        for swapped in cols
    ]
    scored = model.transform(paired.select(label, F.inline(F.array(*variants))))
    right = (F.col("prediction") == F.col(label)).cast("double")
    per = scored.groupBy("variable").agg(
        F.avg(right).alias("all"),
        F.avg(F.when(F.col(label) == 1, right)).alias("pos"),
        F.avg(F.when(F.col(label) == 0, right)).alias("neg"))
    whole = Window.partitionBy(F.lit(1))  # one row per column

    def lost(c: str):
        base = F.max(F.when(F.col("variable") == "", F.col(c))).over(whole)
        return base - F.col(c)

    drops = per.select("variable", lost("all").alias("accuracy_decrease"),
                       lost("pos").alias("positive_decrease"),
                       lost("neg").alias("negative_decrease"))
    return drops.where("variable != ''")


def forest_measures(nodes: DataFrame, permuted: DataFrame | None = None) -> DataFrame:
    """Per variable: mean minimal depth, nodes, trees, times a root, gini decrease.

    The mean depth is over the trees that use the variable. With the result of
    `permutation_importance` or `accuracy_importance`, its accuracy decrease is joined on.
    """
    trees = nodes.agg(F.count_distinct("tree")).first()[0]
    deep = node_depths(nodes).where("variable is not null")
    per_tree = deep.groupBy("tree", "variable").agg(
        F.min("depth").alias("d"), F.count(F.lit(1)).alias("nodes"),
        F.count_if(F.col("depth") == 0).alias("roots"),
        F.sum(F.col("gain") * F.col("weight")).alias("gini"))
    out = per_tree.groupBy("variable").agg(
        F.avg("d").alias("mean_min_depth"), F.sum("nodes").alias("no_of_nodes"),
        F.count(F.lit(1)).alias("no_of_trees"), F.sum("roots").alias("times_a_root"),
        (F.sum("gini") / trees).alias("gini_decrease"))
    if permuted is not None:
        out = out.join(permuted.select("variable", "accuracy_decrease"), "variable", "left")
    return out
