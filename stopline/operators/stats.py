"""Counts, rates, summaries, histograms and top-k lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopline.operators.selection import exact_quantiles, extents, with_ntile
from stopline.session import small_table

OTHER = "(Other)"
MISSING = "NA's"


def _named(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- counts and rates ----

def count_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def share_in_group(counts: DataFrame, group: Sequence[str] | str, n: str = "n",
                   out: str = "rate", digits: int | None = 6) -> DataFrame:
    """n / sum(n) inside each group of an already counted (hence small) table."""
    group = [group] if isinstance(group, str) else list(group)
    share = F.col(n) / F.sum(n).over(Window.partitionBy(*group))
    return counts.withColumn(out, share if digits is None else F.round(share, digits))


def rate_by(df: DataFrame, factor: str | Column, response: str, positive: str | None = None,
            digits: int | None = 6, name: str | None = None) -> DataFrame:
    """(factor, response, n, rate): the share of each response inside a factor level.

    With `positive`, only that response is kept; its n and the level total come
    out of one grouped pass, so the rows are shuffled once, already counted.
    Levels without a positive row vanish, and NULL is a level of its own.
    """
    name = name or (factor if isinstance(factor, str) else "level")
    keyed = df.select(_named(factor).alias(name), response)
    if positive is None:
        return share_in_group(count_by(keyed, name, response), name, digits=digits)
    share = F.col("n") / F.col("total")
    return (
        keyed.groupBy(name)
        .agg(F.count_if(F.col(response) == positive).alias("n"),
             F.count(F.lit(1)).alias("total"))
        .where(F.col("n") > 0)
        .select(name, F.lit(positive).alias(response), "n",
                (share if digits is None else F.round(share, digits)).alias("rate"))
    )


def rate_by_all(df: DataFrame, factors: Sequence[str], response: str, positive: str,
                digits: int | None = 6) -> DataFrame:
    """`rate_by` for every factor in one scan: (factor, level, response, n, rate).

    Each row unfolds to one (factor, level) row per factor, which the map-side
    aggregate folds into level counts before anything is shuffled. Factors the
    frame does not have are left out.
    """
    present = [f for f in factors if f in df.columns]
    text = [F.col(f).cast("string").alias(f) for f in present]
    hit = (F.col(response) == positive).cast("int").alias("_hit")
    long = df.select(*text, hit).unpivot(["_hit"], present, "factor", "level")
    share = F.col("n") / F.col("total")
    return (
        long.groupBy("factor", "level")
        .agg(F.coalesce(F.sum("_hit"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("total"))
        .where(F.col("n") > 0)
        .select("factor", "level", F.lit(positive).alias(response), "n",
                (share if digits is None else F.round(share, digits)).alias("rate"))
    )


def rate_by_quantile(df: DataFrame, col: str, key: str, k: int, response: str, positive: str,
                     legacy: bool = False, span: tuple | None = None) -> DataFrame:
    """Rate per rank bucket of `col`; rows with NULL form the NULL bucket."""
    return rate_by(with_ntile(df.select(col, key, response), col, key, k, "bin", legacy, span),
                   "bin", response, positive)


# ---- summaries ----

def numeric_summary(df: DataFrame, cols: Sequence[str], exact: bool = True,
                    digits: int = 6) -> DataFrame:
    """(column, min, q1, median, mean, q3, max, n_null), one row per column.

    Exact quartiles are found by counting in value ranges; `exact=False` uses
    one pass of mergeable sketches. NaN counts as NULL.
    """
    spark, probs = df.sparkSession, [0.25, 0.5, 0.75]
    # All columns share the same passes, as (column, x) rows.
    missing = F.lit(None).cast("double")
    long = df.select(*[F.nanvl(F.col(c).cast("double"), missing).alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "x")
    x = F.col("x")
    parts = [F.min(x), F.max(x), F.avg(x), F.count(x), F.count_if(x.isNull())]
    if not exact:
        parts.append(F.percentile_approx(x, probs, 10000))
    seen = {r[0]: list(r)[1:] for r in long.groupBy("column").agg(
        *[p.alias(f"_{i}") for i, p in enumerate(parts)]).collect()}
    if exact:
        quartiles = exact_quantiles(
            long, "x", probs, {c: (s[0], s[1], s[3]) for c, s in seen.items()}, "column")
    else:
        quartiles = {c: s[5] for c, s in seen.items()}
    rows = []
    for c in cols:
        low, high, mean, _, nulls = seen.get(c, [None] * 3 + [0, 0])[:5]
        q1, median, q3 = quartiles.get(c) or [None] * 3
        rows.append((c, low, q1, median, mean, q3, high, nulls))
    names = ["min", "q1", "median", "mean", "q3", "max"]
    doubles = ", ".join(f"`{n}` double" for n in names)
    table = small_table(spark, rows, f"column string, {doubles}, n_null long")
    return table.withColumns({n: F.round(n, digits) for n in names})


def factor_summary(df: DataFrame, col: str, maxsum: int = 100) -> DataFrame:
    """(level, n): counts per level, NULLs as their own entry.

    With more levels than fit, the most frequent ones stay and the rest become
    "(Other)". Only `maxsum` rows are ever ranked together: a distributed top-k
    names them, and all other levels are summed in partial aggregates.
    """
    return fold_levels(df.groupBy(F.col(col).cast("string").alias("level")).agg(
        F.count(F.lit(1)).alias("n")), maxsum)


def fold_levels(counts: DataFrame, maxsum: int = 100) -> DataFrame:
    """`factor_summary` of levels that are counted already: (level, n)."""
    order = [F.desc("n"), F.asc("level")]
    top = (
        counts.where(F.col("level").isNotNull()).orderBy(*order).limit(maxsum)
        .withColumn("rank", F.row_number().over(Window.orderBy(*order)))
        .select("level", "rank")
    )
    # Levels without a rank share one NULL name, so they fold into one row.
    named = counts.join(F.broadcast(top), "level", "left").select(
        "rank", F.col("level").isNull().alias("missing"), "n",
        F.when(F.col("rank").isNotNull(), F.col("level")).alias("level"))
    folded = named.groupBy("rank", "missing", "level").agg(F.sum("n").alias("n"))
    # From here on there are at most maxsum + 2 rows.
    everything = Window.partitionBy(F.lit(1))
    room = F.lit(maxsum) - F.max(F.col("missing").cast("int")).over(everything)
    too_many = (F.max("rank").over(everything) > room) | F.max(
        F.col("rank").isNull() & ~F.col("missing")).over(everything)
    label = (
        F.when(F.col("missing"), MISSING)
        .when(~F.col("_over") | (F.col("rank") < F.col("_room")), F.col("level"))
        .otherwise(OTHER)
    )
    return (
        folded.withColumns({"_room": room, "_over": too_many})
        .groupBy(label.alias("level")).agg(F.sum("n").alias("n"))
    )


def logical_summary(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def time_extent(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, type, n, n_null, n_distinct) in one pass.

    Distinct values are estimated with mergeable sketches (error about 1%), since an exact
    count of every column would shuffle each column's values.
    """
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    per_column = [
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
            F.count(F.lit(1)).alias("n"), F.count_if(F.col(c).isNull()).alias("n_null"),
            F.hll_sketch_estimate(
                F.hll_sketch_agg(F.col(c).cast("string"), 14)).alias("n_distinct"),
        )
        for c in cols
    ]
    return df.agg(F.array(*per_column).alias("a")).select(F.inline("a"))


# ---- histograms ----

def histogram(df: DataFrame, col: str, response: str | None = None, width: float | None = None,
              bins: int | None = None, span: tuple | None = None) -> DataFrame:
    """(bin, center, [response,] n) for right-closed bins centred on multiples of the width.

    `bins=b` sets the width to range/(b-1). A smallest value lying on an edge
    joins the bin above it, and values within 1e-8 widths of an edge count as on it.
    `span` is (min, max, count) when already known.
    """
    data = df.select(col, *([response] if response else [])).where(F.col(col).isNotNull())
    low, high, _ = span or extents(data, [col])[col]
    if low is None:
        low = high = 0.0
    if width is None:
        width = float(high - low) / (bins - 1) or 0.1
    x = F.col(col)
    # The lowest bin starts at or below the minimum.
    first = F.floor(F.lit((low - width / 2) / width)) + 1
    index = F.greatest(F.ceil((x - width / 2) / F.lit(width) - 1e-8), first).cast("long")
    keys = ["bin", *([response] if response else [])]
    return (
        data.withColumn("bin", index).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("center", F.round(F.col("bin") * F.lit(width), 6))
        .select("bin", "center", *keys[1:], "n")
    )


# ---- frequencies and top-k ----

def frequency(df: DataFrame, col: str, ascending: bool = False) -> DataFrame:
    order = F.asc("n") if ascending else F.desc("n")
    return count_by(df, col).orderBy(order, F.asc(col))


def topk(df: DataFrame, col: str, k: int, where: Column | None = None,
         by: str | None = None, min_rank: int = 1) -> DataFrame:
    """Most frequent non-NULL levels, overall or inside each group of `by`.

    Rows are counted first. The overall list is a distributed top-k; the grouped
    one filters on a row number, which Spark also applies before its shuffle,
    so a hot group sends at most k rows per task.
    """
    kept = df if where is None else df.where(where)
    kept = kept.where(F.col(col).isNotNull())
    if by is None:
        return count_by(kept, col).orderBy(F.desc("n"), F.asc(col)).limit(k)
    order = Window.partitionBy(by).orderBy(F.desc("n"), F.asc(col))
    ranked = count_by(kept, by, col).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


def topk_by_flags(df: DataFrame, col: str, flags: Mapping[str, Column], k: int) -> DataFrame:
    """(flag, level, n, rank): the top-k list under each of several predicates, in one scan.

    A row takes part once for every predicate it meets.
    """
    met = F.filter(
        F.array(*[F.when(cond, F.lit(name)) for name, cond in flags.items()]),
        lambda name: name.isNotNull())
    rows = df.select(F.col(col).cast("string").alias("level"), F.explode(met).alias("flag"))
    return topk(rows, "level", k, by="flag")


# ---- one count for many lists ----

def level_cube(df: DataFrame, cols: Sequence[str], flags: Mapping[str, Column] | None = None,
               flagged: Sequence[str] = (), by: str | None = None, split: Sequence[str] = (),
               nested: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(column, outer, level, by, mask, n): the level counts of many columns from one scan.

    Each row counts once per column. The columns in `flagged` are also counted by which of the flags hold (bit i of `mask`
    for flag i), those in `split` by the value of `by`; a pair in `nested` is a column named `outer>inner`
    whose `outer` is the first one's level. Map-side counts, one shuffle; store it, and derive the lists.
    """
    text = lambda c: F.col(c).cast("string")
    mask = F.lit(0)
    for i, cond in enumerate((flags or {}).values()):
        mask = mask + F.when(cond, 1 << i).otherwise(0)
    nothing = F.lit(None).cast("string")

    def cell(name, outer, level, within, which):
        return F.struct(F.lit(name).alias("column"), outer.alias("outer"), level.alias("level"),
                        within.alias("by"), which.cast("int").alias("mask"))

    cells = [cell(c, nothing, text(c), text(by) if c in split else nothing, mask if c in flagged else F.lit(0))
             for c in cols] + [cell(f"{a}>{b}", text(a), text(b), nothing, F.lit(0)) for a, b in nested]
    return df.select(F.inline(F.array(*cells))).groupBy("column", "outer", "level", "by", "mask").agg(
        F.count(F.lit(1)).alias("n"))


def cube_levels(cube: DataFrame, column: str) -> DataFrame:
    """(level, n) of one column."""
    return cube.where(F.col("column") == column).groupBy("level").agg(F.sum("n").alias("n"))


def _first_of(counts: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc("level"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def cube_topk(cube: DataFrame, k: int, keys: Sequence[str] = ("column",)) -> DataFrame:
    """(*keys, level, n, rank): the `k` most frequent levels by column, and by what else `keys` names."""
    counts = cube.where(F.col("level").isNotNull()).groupBy(*keys, "level").agg(F.sum("n").alias("n"))
    return _first_of(counts, keys, k)


def cube_flags(cube: DataFrame, flags: Sequence[str]) -> DataFrame:
    """The cube's flagged counts once for every flag that holds, named in `flag`."""
    names = F.filter(F.array(*[F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.lit(f))
                               for i, f in enumerate(flags)]), lambda x: x.isNotNull())
    return cube.withColumn("flag", F.explode(names))


def arg_max_level(df: DataFrame, col: str) -> DataFrame:
    """The single most frequent level (level, n); the last name wins a tie."""
    best = F.max(F.struct(F.col("n"), F.col(col).alias("level")))
    return (
        count_by(df.where(F.col(col).isNotNull()), col)
        .agg(best.alias("b")).select("b.level", "b.n")
    )


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def order_by_time(df: DataFrame, ts: str, *tie: str) -> DataFrame:
    return df.orderBy(ts, *tie)


def union_reports(*reports: DataFrame) -> DataFrame:
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out


# ---- cluster profiles ----

def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Wide to long: ids, variable, value (all values as text)."""
    text = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in cols])
    return text.unpivot(list(ids), list(cols), "variable", "value")


def cluster_level_counts(df: DataFrame, key: str, cluster: str, cols: Sequence[str]) -> DataFrame:
    """Distinct members per (cluster, variable, value).

    Members are reduced to one row per (member, level) first, so the final
    count is an ordinary partial aggregate even for a cluster with most rows.
    """
    long = to_long(df, [key, cluster], cols).distinct()
    return long.groupBy(cluster, "variable", "value").agg(F.count(key).alias("count"))


def profile_level_counts(profiles: DataFrame, weight: str, cluster: str,
                         cols: Sequence[str]) -> DataFrame:
    """The same from distinct profiles that carry their number of members."""
    long = to_long(profiles, [weight, cluster], cols)
    return long.groupBy(cluster, "variable", "value").agg(F.sum(weight).alias("count"))


def cluster_level_share(counts: DataFrame, cluster: str, digits: int = 6) -> DataFrame:
    return share_in_group(counts, [cluster, "variable"], "count", "proportion", digits)


def cluster_profile(counts: DataFrame, cluster: str) -> DataFrame:
    """Counts and shares ordered by cluster, as a heat map wants them."""
    return cluster_level_share(counts, cluster).orderBy(cluster, "variable", "value")


def level_share_by_cluster(df: DataFrame, cluster: str, cols: Sequence[str],
                           clusters: Sequence, digits: int = 6,
                           weight: str | None = None) -> DataFrame:
    """Share of each level's rows in each cluster, one column per cluster.

    With `weight`, a row stands for that many.
    """
    long = to_long(df, [cluster, *([weight] if weight else [])], cols)
    rows = F.col(weight) if weight else F.lit(1)
    per = [F.sum(F.when(F.col(cluster) == k, rows).otherwise(0)).alias(f"c{k}") for k in clusters]
    counted = long.groupBy("variable", "value").agg(*per, F.sum(rows).alias("n"))
    return counted.select(
        "variable", "value",
        *[F.round(F.col(f"c{k}") / F.col("n"), digits).alias(f"c{k}") for k in clusters])


def cluster_sizes(df: DataFrame, cluster: str, weight: str | None = None) -> DataFrame:
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(cluster).agg(rows.alias("n"))
