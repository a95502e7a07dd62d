"""Forests whose bootstrap is known: out-of-bag votes, class tables and local importance.

A row's number of copies in a tree's sample is a Poisson quantile of a hash of (key, tree),
so every later pass can tell which trees have not seen a row. Trees are fitted one
by one, several at a time, and joined to one model; a forest of fewer trees is a prefix
of a larger one with the same settings. Votes are taken in one pass: each task
walks its rows down all trees, numpy arrays that travel as one broadcast, no larger than the model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopline.models.trees import in_parallel, score_counts
from stopline.session import discard_at_exit, new_path, small_table
from stopline.sources import tables

BITS = (1 << 53) - 1
# Chance that a row is in a bootstrap sample at most k times, k = 0, 1, ...; fixed by Poisson(1).
AT_MOST = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(10)]
CUTS = [int(p * (BITS + 1)) for p in AT_MOST]
BUCKET_ROWS = 100_000


def draw(key: str, tree: Column | int) -> Column:
    """53 random bits for a row and a tree."""
    tree = F.lit(tree) if isinstance(tree, int) else tree
    return F.xxhash64(F.lit("bag"), tree.cast("int"), F.col(key)).bitwiseAND(F.lit(BITS))


def copies(key: str, tree: int) -> Column:
    """How often a row is in a tree's bootstrap sample."""
    h = draw(key, tree)
    return sum(((h >= c).cast("int") for c in CUTS), F.lit(0))


# ---- models made of trees ----

def _array(spark: SparkSession, kind, items):
    out = spark.sparkContext._gateway.new_array(kind, len(items))
    for i, x in enumerate(items):
        out[i] = x
    return out


def joined_forest(spark: SparkSession, java_trees: Sequence, features: int) -> RandomForestClassificationModel:
    """One model of trees fitted apart."""
    kinds = spark._jvm.org.apache.spark.ml.classification
    trees = _array(spark, kinds.DecisionTreeClassificationModel, java_trees)
    java = kinds.RandomForestClassificationModel(f"joined_{len(java_trees)}", trees, features, 2)
    java.set(java.numTrees(), len(java_trees))
    return RandomForestClassificationModel(java)


def boosted_prefix(spark: SparkSession, model: GBTClassificationModel, size: int) -> GBTClassificationModel:
    """The boosted model after its first `size` trees."""
    java = model._java_obj
    kinds = spark._jvm.org.apache.spark.ml
    trees, weights = java.trees(), java.treeWeights()
    size = min(size, len(trees))
    return GBTClassificationModel(kinds.classification.GBTClassificationModel(
        f"{java.uid()}_{size}", _array(spark, kinds.regression.DecisionTreeRegressionModel, [trees[i] for i in range(size)]),
        _array(spark, spark._jvm.double, [float(weights[i]) for i in range(size)]), java.numFeatures(), 2))


def fit_trees(train: DataFrame, key: str, bins: int, count: int, mtry: int = 4, max_depth: int = 20,
              label: str = "label", seed: int = 7, parallelism: int | None = None) -> list:
    """Single trees (JVM objects), tree t fitted on its own bootstrap sample."""
    spark = train.sparkSession

    def task(tree: int):
        def run():
            rows = train.withColumn("copies", copies(key, tree).cast("double")).where("copies > 0")
            fit = RandomForestClassifier(
                labelCol=label, featuresCol="features", numTrees=1, maxDepth=max_depth, bootstrap=False,
                featureSubsetStrategy=str(mtry), maxBins=max(32, bins), weightCol="copies",
                seed=seed * 100_003 + tree).fit(rows)
            return fit._java_obj.trees()[0], fit.numFeatures
        return run
    return in_parallel(spark, [task(t) for t in range(count)], parallelism or min(16, spark.sparkContext.defaultParallelism))


def fit_forests(train: DataFrame, key: str, bins: int, grid: Sequence[Mapping], label: str = "label",
                seed: int = 7) -> dict[tuple[int, int], RandomForestClassificationModel]:
    """(trees, mtry) -> forest; settings that differ in the number of trees share their first ones."""
    most: dict = {}
    for g in grid:
        setting = g["mtry"], g.get("max_depth", 20)
        most[setting] = max(most.get(setting, 0), g["trees"])
    fitted = {s: fit_trees(train, key, bins, n, s[0], s[1], label, seed) for s, n in most.items()}
    out = {}
    for g in grid:
        trees = fitted[g["mtry"], g.get("max_depth", 20)][:g["trees"]]
        out[g["trees"], g["mtry"]] = joined_forest(train.sparkSession, [t for t, _ in trees], trees[0][1])
    return out


# ---- trees as arrays ----

@dataclass
class Trees:
    """All nodes of a forest: split column (-1 at a leaf), cut or set of codes, children, class of the node."""
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    codes: np.ndarray      # row of `members`, or -1
    members: np.ndarray    # (sets, codes) of bool
    left: np.ndarray
    right: np.ndarray
    vote: np.ndarray

    def used(self, tree: int) -> np.ndarray:
        end = self.roots[tree + 1] if tree + 1 < len(self.roots) else len(self.feature)
        f = self.feature[self.roots[tree]:end]
        return np.unique(f[f >= 0])

    def walk(self, tree: int, x: np.ndarray) -> np.ndarray:
        """The class each row gets from one tree."""
        node = np.full(len(x), self.roots[tree])
        going = np.flatnonzero(self.feature[node] >= 0)
        while len(going):
            here = node[going]
            value = x[going, self.feature[here]]
            sets = self.codes[here]
            to_left = value <= self.cut[here]
            if len(self.members):
                code = np.clip(value, 0, self.members.shape[1] - 1).astype(np.int64)
                to_left = np.where(sets >= 0, self.members[np.maximum(sets, 0), code], to_left)
            node[going] = np.where(to_left, self.left[here], self.right[here])
            going = going[self.feature[node[going]] >= 0]
        return self.vote[node]


def read_trees(spark: SparkSession, model_path: str) -> Trees:
    """A saved forest as arrays: what scoring holds on the driver and in a broadcast anyway."""
    node = F.col("nodeData")
    t = spark.read.parquet(f"{model_path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
        node["split"]["leftCategoriesOrThreshold"].alias("code"), node["split"]["numCategories"].alias("categories"),
        node["prediction"].cast("int").alias("vote")).orderBy("tree", "id").toArrow()
    tree = t["tree"].to_numpy()
    roots = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
    base = np.repeat(roots, np.diff(np.append(roots, len(tree))))
    inner = t["left"].to_numpy() >= 0
    feature = np.where(inner, t["feature"].to_numpy(), -1)
    by_code = inner & (t["categories"].to_numpy() >= 0)
    lists = t["code"].to_pylist()
    cut = np.array([c[0] if i and not b else -np.inf for c, i, b in zip(lists, inner, by_code)])
    codes = np.where(by_code, np.cumsum(by_code) - 1, -1)
    members = np.zeros((int(by_code.sum()), int(t["categories"].to_numpy().max(initial=0)) + 1), bool)
    for row, at in enumerate(np.flatnonzero(by_code)):
        members[row, np.array(lists[at], np.int64)] = True
    return Trees(roots, feature, cut, codes, members, t["left"].to_numpy() + base, t["right"].to_numpy() + base,
                 t["vote"].to_numpy())


def saved(spark: SparkSession, model) -> str:
    """Path of a model stored under the shared work folder, removed at exit."""
    path = new_path(spark, "forest")
    tables.save_model(model, path)
    discard_at_exit(spark, path)
    return path


# ---- out-of-bag votes ----

def _dense(slots: pa.ListArray, numbers: pa.ListArray, p: int) -> np.ndarray:
    ends = slots.offsets.to_numpy().astype(np.int64)
    x = np.zeros((len(slots), p))
    x[np.repeat(np.arange(len(slots)), np.diff(ends)), slots.flatten().to_numpy()] = numbers.flatten().to_numpy()
    return x


def _plain(features: str, name: str) -> list[Column]:
    vector = F.unwrap_udt(F.col(features))
    slots = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    return [slots.alias(f"{name}_slots"), vector["values"].alias(f"{name}_numbers")]


def with_partner(df: DataFrame, key: str, features: str = "features", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add `partner`, the features of another row: a shuffle of every column at once.

    Rows go into hash buckets of the unique key; inside a bucket, in the order of a second hash, a
    row's partner is its predecessor.
    """
    buckets = max(1, -(-df.count() // bucket_rows))
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    order = Window.partitionBy("_bucket").orderBy(F.xxhash64(F.lit(1), F.col(key)), key)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn("partner", F.coalesce(F.lag(features).over(order), F.last(features).over(every))).drop("_bucket")


def out_of_bag(train: DataFrame, key: str, trees: Trees, width: int, sizes: Sequence[int] = (),
               importance: bool = False, label: str = "label") -> DataFrame:
    """(key, label, seen, positive, lost): one row per training row.

    `seen` and `positive` hold, for each number of trees in `sizes`, how many of these trees have not seen the row and
    how many of those vote 1. With `importance`, `lost` holds for every column how many right votes turn wrong, less
    those that turn right, when the row has its partner's value there (null otherwise).
    """
    count = len(trees.roots)
    sizes = list(sizes) or [count]
    shared = train.sparkSession.sparkContext.broadcast(trees)
    rows = with_partner(train.select(key, label, "features"), key) if importance else train
    draws = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda t: draw(key, t))
    rows = rows.select(key, F.col(label).cast("double").alias("label"), draws.alias("draws"), *_plain("features", "mine"),
                       *(_plain("partner", "other") if importance else ()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            unseen = batch.column(2).flatten().to_numpy().reshape(n, count) < CUTS[0]
            x = _dense(batch.column(3), batch.column(4), width)
            z = _dense(batch.column(5), batch.column(6), width) if importance else None
            label = batch.column(1).to_numpy()
            seen, positive = np.zeros((n, len(sizes)), np.int32), np.zeros((n, len(sizes)), np.int32)
            lost = np.zeros((n, width), np.int32)
            for t in range(count):
                at = np.flatnonzero(unseen[:, t])
                mine = x[at]
                vote = forest.walk(t, mine)
                for i, size in enumerate(sizes):
                    if t < size:
                        seen[at, i] += 1
                        positive[at, i] += vote == 1
                if importance:
                    right = vote == label[at]
                    for j in forest.used(t):
                        changed = mine.copy()
                        changed[:, j] = z[at, j]
                        lost[at, j] += right.astype(np.int32) - (forest.walk(t, changed) == label[at])
            lists = [pa.array(list(v), pa.list_(pa.int32())) for v in (seen, positive)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *lists,
                 pa.array(list(lost) if importance else [None] * n, pa.list_(pa.int32()))],
                [key, "label", "seen", "positive", "lost"])

    kind = dict(train.dtypes)[key]
    return rows.mapInArrow(run, f"`{key}` {kind}, label double, seen array<int>, positive array<int>, lost array<int>")


def oob_class_table(votes: DataFrame, at: int = 0) -> DataFrame:
    """(label, votes_1, votes_0, class_error): out-of-bag classes by actual class; ties count as 0."""
    known = votes.where(F.get("seen", F.lit(at)) > 0).withColumn(
        "one", 2 * F.get("positive", F.lit(at)) > F.get("seen", F.lit(at)))
    return known.groupBy("label").agg(
        F.count_if("one").alias("votes_1"), F.count_if(~F.col("one")).alias("votes_0"),
        F.avg((F.col("one").cast("double") != F.col("label")).cast("double")).alias("class_error"))


def local_importance(votes: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """(key, label, variable, decrease): share of a row's out-of-bag votes lost without the variable, from 0 up."""
    names = F.array(*[F.lit(n) for n in names])
    lost = votes.where(F.get("seen", F.lit(0)) > 0).select(
        key, "label", F.get("seen", F.lit(0)).alias("n"), F.posexplode("lost").alias("i", "v"))
    return lost.select(key, "label", F.get(names, F.col("i")).alias("variable"), (F.col("v") / F.col("n")).alias("decrease"))


def accuracy_importance(votes: DataFrame, names: Sequence[str]) -> DataFrame:
    """(variable, accuracy_decrease, positive_decrease, negative_decrease): the mean local importance, by class."""
    known = votes.where(F.get("seen", F.lit(0)) > 0)
    sums = known.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.get("lost", F.lit(i)) / F.get("seen", F.lit(0))).alias(f"s{i}") for i in range(len(names))])
    long = sums.select("label", "n", F.inline(F.array(*[
        F.struct(F.lit(name).alias("variable"), F.col(f"s{i}").alias("s")) for i, name in enumerate(names)])))
    of = lambda c: F.sum(F.when(F.col("label") == c, F.col("s"))) / F.sum(F.when(F.col("label") == c, F.col("n")))
    return long.groupBy("variable").agg(
        (F.sum("s") / F.sum("n")).alias("accuracy_decrease"), of(1).alias("positive_decrease"),
        of(0).alias("negative_decrease"))


def forest_scores(spark: SparkSession, models: Mapping, votes: Mapping, test: DataFrame, label: str = "label") -> DataFrame:
    """One row per forest: out-of-bag error, then errors and counts on the held-out rows.

    `votes`: (trees, mtry) -> (out-of-bag votes, place of the forest's size in them).
    """
    return scores_table(spark, [(*g, oob_error(*votes[g]), score_counts(model, test, label)) for g, model in models.items()])


def oob_error(votes: DataFrame, at: int = 0) -> float:
    """Share of the rows whose out-of-bag class is wrong, of those that some tree has not seen."""
    return votes.where(F.get("seen", F.lit(at)) > 0).agg(F.avg((
        (2 * F.get("positive", F.lit(at)) > F.get("seen", F.lit(at))).cast("double") != F.col("label")).cast("double"))).first()[0]


def scores_table(spark: SparkSession, found: Sequence[tuple]) -> DataFrame:
    """The rows of `forest_scores` from (trees, mtry, out-of-bag error, counts and metrics on the held-out rows)."""
    rows = [(count, mtry, e, 1 - s["accuracy"], s["accuracy"], s["kappa"], s["tp"], s["fp"], s["fn"], s["tn"])
            for count, mtry, e, s in found]
    return small_table(spark, rows, "trees int, mtry int, oob_error double, holdout_error double, accuracy double, "
                                    "kappa double, tp bigint, fp bigint, fn bigint, tn bigint")
