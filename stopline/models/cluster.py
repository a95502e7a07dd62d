"""Clustering of categorical profiles: k-modes for any number, linkage and cuts for few."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.models.encode import as_factors
from stopline.operators.selection import dense_row_id
from stopline.operators.stats import profile_level_counts
from stopline.session import small_table

# Linkage compares every profile with every other, so it is refused beyond
# this many. Rows do not count, only distinct level combinations do.
MAX_PROFILES = 50_000
TASK_DISTANCES = 2_000_000  # distances worth a task of their own


def distinct_profiles(df: DataFrame, cols: Sequence[str], id_col: str = "id") -> DataFrame:
    """Distinct level combinations with their row count `weight` and an id 1..n.

    Equal rows are at distance 0 and merge first, so nothing is lost. Their
    number is bounded by the level dictionaries, not by the rows.
    """
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("weight"))
    return dense_row_id(counted, cols, id_col, unique=True)


def gower(left: Sequence, right: Sequence):
    """Share of columns that differ, as a column expression for two sides of a join."""
    differ = [(~a.eqNullSafe(b)).cast("int") for a, b in zip(left, right)]
    return sum(differ[1:], differ[0]) / F.lit(float(len(differ)))


class _Profiles:
    """Level codes of all profiles on the driver, after their number has been checked."""

    def __init__(self, profiles: DataFrame, cols: Sequence[str], id_col: str,
                 numeric: Sequence[str], limit: int):
        size = profiles.count()
        if size > limit:
            raise ValueError(f"{size} distinct profiles; merge levels, raise the limit of "
                             f"{limit}, or use bisecting_clusters")
        table = profiles.select(id_col, *cols, *numeric).orderBy(id_col).toPandas()
        self.ids = table[id_col].to_numpy()
        self.codes = np.column_stack(
            [pd.factorize(table[c], use_na_sentinel=False)[0] for c in cols]
        ).astype(np.int32)
        scaled = []
        for c in numeric:
            v = table[c].to_numpy(float)
            scaled.append((v - v.min()) / ((v.max() - v.min()) or 1.0))
        self.numbers = np.column_stack(scaled) if scaled else np.empty((len(table), 0))
        self.columns = len(cols) + len(numeric)


def _distances(codes: np.ndarray, numbers: np.ndarray, row: int) -> np.ndarray:
    """Summed differences of one profile to all profiles."""
    apart = (codes != codes[row]).sum(axis=1).astype(float)
    return apart + np.abs(numbers - numbers[row]).sum(axis=1)


def _nearest_clusters(spark, shared, owner: np.ndarray, stale) -> list:
    """The nearest cluster of each `stale` cluster under complete linkage, from the tasks.

    A task takes some clusters and returns one row for each; no pair is emitted.
    Ties go to the smaller pair of ids.
    """
    owners = spark.sparkContext.broadcast(owner)

    def search(batches):
        codes, numbers = shared.value
        own = owners.value
        order = np.argsort(own, kind="stable")
        heads, starts = np.unique(own[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        for batch in batches:
            rows = []
            for cluster in batch["cluster"]:
                k = np.searchsorted(heads, cluster)
                far = np.zeros(len(own))
                for member in order[starts[k]:ends[k]]:
                    far = np.maximum(far, _distances(codes, numbers, member))
                to = np.maximum.reduceat(far[order], starts)
                to[k] = np.inf
                best = np.flatnonzero(to == to.min())
                # Of equally near clusters, the smaller id gives the smaller pair.
                rows.append((cluster, heads[best[0]], to[best[0]]))
            yield pd.DataFrame(rows, columns=["cluster", "nearest", "distance"])

    heads = [(int(h),) for h in sorted(stale)]
    members = int(np.isin(owner, list(stale)).sum())
    tasks = min(len(heads), spark.sparkContext.defaultParallelism,
                1 + members * len(owner) // TASK_DISTANCES)
    clusters = small_table(spark, heads, "cluster long")
    clusters = clusters.repartition(tasks) if tasks > 1 else clusters.coalesce(1)
    found = clusters.mapInPandas(search, "cluster long, nearest long, distance double").collect()
    owners.unpersist()
    return found


def gower_nearest(profiles: DataFrame, cols: Sequence[str], id_col: str = "id",
                  numeric: Sequence[str] = (), limit: int = MAX_PROFILES) -> DataFrame:
    """(id, nearest, distance): each profile's closest other profile, smallest id on ties."""
    spark = profiles.sparkSession
    held = _Profiles(profiles, cols, id_col, numeric, limit)
    shared = spark.sparkContext.broadcast((held.codes, held.numbers))
    found = _nearest_clusters(
        spark, shared, np.arange(len(held.ids)), range(len(held.ids)))
    shared.unpersist()
    rows = [(int(held.ids[r["cluster"]]), int(held.ids[r["nearest"]]),
             r["distance"] / held.columns) for r in found if np.isfinite(r["distance"])]
    return small_table(spark, rows, f"`{id_col}` long, nearest long, distance double")


def complete_linkage(profiles: DataFrame, cols: Sequence[str], id_col: str = "id",
                     numeric: Sequence[str] = (), limit: int = MAX_PROFILES) -> DataFrame:
    """The merge tree: (step, left, right, height, size), heights ascending.

    Rounds of mutual nearest neighbours: every round finds each cluster's
    nearest cluster in Spark tasks and merges the mutual pairs. Complete linkage is
    reducible, so this gives the tree of one-merge-at-a-time. A merged cluster
    keeps its smaller id, and `size` counts profiles. `numeric` columns join
    the distance as range-scaled differences.
    """
    spark = profiles.sparkSession
    held = _Profiles(profiles, cols, id_col, numeric, limit)
    shared = spark.sparkContext.broadcast((held.codes, held.numbers))
    owner = np.arange(len(held.ids))
    merges, round_no, found = [], 0, {}
    stale = set(range(len(owner)))
    while len(held.ids) - len(merges) > 1:
        for r in _nearest_clusters(spark, shared, owner, stale):
            found[r["cluster"]] = (r["nearest"], r["distance"])
        pairs = [(c, to, d) for c, (to, d) in found.items() if c < to and found[to][0] == c]
        for a, b, distance in pairs:
            owner[owner == b] = a
            del found[b]
            merges.append((distance / held.columns, round_no, a, b, int((owner == a).sum())))
        # Merging only moves clusters apart, so a nearest cluster that did not
        # merge is still the nearest.
        merged = {c for a, b, _ in pairs for c in (a, b)}
        stale = {c for c, (to, _) in found.items() if c in merged or to in merged}
        round_no += 1
    shared.unpersist()
    merges.sort()
    rows = [(i + 1, int(held.ids[a]), int(held.ids[b]), float(h), size)
            for i, (h, _, a, b, size) in enumerate(merges)]
    return small_table(spark, rows, "step int, left long, right long, height double, size int")


def cut_tree(profiles: DataFrame, merges: DataFrame, k: int, id_col: str = "id",
             out: str = "cluster", limit: int = MAX_PROFILES) -> DataFrame:
    """Profiles with a cluster 1..k: all merges but the last k-1, numbered by first id."""
    spark = profiles.sparkSession
    ids = [r[0] for r in profiles.select(id_col).orderBy(id_col).limit(limit + 1).collect()]
    if len(ids) > limit:
        raise ValueError(f"more than {limit} profiles")
    owner = {i: i for i in ids}

    def head(i):
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    steps = merges.orderBy("step").limit(max(0, len(ids) - k)).select("left", "right").collect()
    for a, b in steps:
        a, b = sorted((head(a), head(b)))
        owner[b] = a
    number: dict = {}
    rows = [(i, number.setdefault(head(i), len(number) + 1)) for i in ids]
    labels = small_table(spark, rows, f"`{id_col}` long, `{out}` int")
    return profiles.join(F.broadcast(labels), id_col)


def label_rows(df: DataFrame, labelled: DataFrame, cols: Sequence[str],
               out: str = "cluster") -> DataFrame:
    """Bring the clusters back to all rows. The profile table is small by its checked limit."""
    small = labelled.select(*[F.col(c).alias(f"_{c}") for c in cols], out)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols]
    return df.join(F.broadcast(small), same, "left").drop(*[f"_{c}" for c in cols])


def bisecting_clusters(profiles: DataFrame, cols: Sequence[str], k: int, out: str = "cluster",
                       seed: int = 7) -> DataFrame:
    """An approximation for more profiles than linkage allows: weighted bisecting k-means."""
    text = as_factors(profiles, cols)
    model = Pipeline(stages=[
        StringIndexer(inputCols=list(cols), outputCols=[f"{c}_ix" for c in cols],
                      handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_ix" for c in cols],
                      outputCols=[f"{c}_hot" for c in cols], dropLast=False),
        VectorAssembler(inputCols=[f"{c}_hot" for c in cols], outputCol="features"),
        BisectingKMeans(k=k, weightCol="weight", predictionCol=out, seed=seed),
    ]).fit(text)
    keep = [*profiles.columns, out]
    return model.transform(text).select(*keep).withColumn(out, F.col(out) + 1)


# ---- k-modes ----

def _differing(cols: Sequence[str], mode: Sequence) -> Column:
    """In how many columns a row differs from a mode; NULL is a level."""
    return sum(((~F.col(c).cast("string").eqNullSafe(F.lit(v))).cast("int") for c, v in zip(cols, mode)), F.lit(0))


def nearest_mode(cols: Sequence[str], modes: Sequence[Sequence]) -> Column:
    """Struct (differing, cluster) of the nearest mode, the first of equally near ones."""
    return F.array_min(F.array(*[
        F.struct(_differing(cols, m).alias("differing"), F.lit(i + 1).alias("cluster")) for i, m in enumerate(modes)]))


def k_modes(profiles: DataFrame, cols: Sequence[str], k: int, weight: str = "weight", rounds: int = 100) -> list[tuple]:
    """At most `k` modes of weighted profiles: a level for every column, as text.

    Starts with the heaviest profile and then each time the one with the largest
    weight times distance from its nearest mode. A round assigns every profile by one
    expression and takes the most frequent level of each (cluster, column), the least of
    equally frequent ones, from a grouped count. Ends when the modes repeat, or after
    `rounds`. Only k rows of modes, and k rows a column, reach the driver. Fewer
    distinct profiles than `k` give fewer modes.
    """
    values = F.struct(*[F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate(cols)])
    modes: list[tuple] = []
    while len(modes) < k:
        far = nearest_mode(cols, modes)["differing"] if modes else F.lit(1)
        best = profiles.agg(F.max(F.struct((F.col(weight) * far).alias("far"), values.alias("v"))).alias("m")).first()["m"]
        if best is None or best["far"] == 0:
            break
        modes.append(tuple(best["v"]))
    seen = set()
    while modes and tuple(modes) not in seen and len(seen) < rounds:
        seen.add(tuple(modes))
        near = profiles.withColumn("cluster", nearest_mode(cols, modes)["cluster"])
        most = F.min(F.struct((-F.col("count")).alias("n"), "value"))
        found = profile_level_counts(near, weight, "cluster", cols).groupBy("cluster", "variable").agg(most.alias("m"))
        levels = {(r["cluster"], r["variable"]): r["m"]["value"] for r in found.collect()}
        # a cluster without members keeps its mode
        modes = [tuple(levels.get((i + 1, c), m[j]) for j, c in enumerate(cols)) for i, m in enumerate(modes)]
    return modes


def assign(df: DataFrame, cols: Sequence[str], modes: Sequence[Sequence], out: str = "cluster") -> DataFrame:
    """Rows with the number of their nearest mode: one expression, no join."""
    number = nearest_mode(cols, modes)["cluster"] if modes else F.lit(None).cast("int")
    return df.withColumn(out, number)
