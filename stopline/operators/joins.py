"""Joins: nearest hour, shared columns, membership, complement, repeated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.functions.calendar import round_hour
from stopline.operators.skew import join_any_size, key_counts, mark_counted
from stopline.session import store


def join_common(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on every column name the two sides share."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the two sides share no column name")
    return join_any_size(left, right, shared)


def join_nearest_hour(left: DataFrame, right: DataFrame, ts: str,
                      drop: Sequence[str] = ("address",)) -> DataFrame:
    """Round the left time to its nearest hour and join the hourly right side.

    The right side holds one row per hour, so it is broadcast once its size has
    been measured; were it larger, adaptive execution would split hot hours.
    """
    rounded = left.withColumn(ts, round_hour(F.col(ts)))
    return join_common(rounded, right).drop(*drop)


def repeat_flag(df: DataFrame, keys: Sequence[str] | str, out: str = "multi_infr") -> DataFrame:
    """True where the key occurs more than once in the frame."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return mark_counted(df.drop(out), keys, 2, out)


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str, n: str | None = None) -> DataFrame:
    """Keys that occur again, each once; `n` names an optional count column."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    repeated = key_counts(df, keys, n or "_n").where(F.col(n or "_n") > 1)
    return repeated if n else repeated.drop("_n")


def semi_lookup(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the lookup."""
    return join_any_size(df, lookup.select(key).dropDuplicates(), [key], "left_semi")


def anti_complement(df: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the sample. The key is unique, so no side is skewed."""
    return df.join(sample.select(key), key, "left_anti")


def profile_neighbours(profiles: DataFrame, cols: Sequence[str], key: str = "id") -> DataFrame:
    """Pairs of distinct profiles that differ in exactly one column: (i, j, differs).

    Each profile is written once per column, under the values of all its other
    columns, and an equi-join on those finds the partners. So the work grows
    with the profiles, and a full pair table is never made.
    """
    # Each view hides one column, so every struct is turned into the same text form.
    views = [
        F.struct(
            F.lit(c).alias("differs"),
            F.to_json(F.struct(*[F.col(o) for o in cols if o != c])).alias("rest"),
        )
        for c in cols
    ]
    masked = profiles.select(key, F.inline(F.array(*views)))
    left = masked.select(F.col(key).alias("i"), "differs", "rest")
    right = masked.select(F.col(key).alias("j"), "differs", "rest")
    return left.join(right, ["differs", "rest"]).where("i < j").select("i", "j", "differs")


def neighbour_classes(profiles: DataFrame, cols: Sequence[str], key: str = "id") -> DataFrame:
    """Profiles one column apart as classes: (key, differs, class, links), one row per profile and hidden column.

    Profiles that agree in all columns but `differs` are one class, named by its least
    key; `links` is the number of other members, each of which is one column away. Profiles that are alone
    under a column have no row there. So a class writes as many rows as it has members,
    where the pairs would grow with their square.
    """
    views = [F.struct(F.lit(c).alias("differs"), F.xxhash64(F.lit(i), *[F.col(o) for o in cols if o != c]).alias("h"),
                      F.to_json(F.struct(*[F.col(o) for o in cols if o != c])).alias("rest"))
             for i, c in enumerate(cols)]
    masked = profiles.select(key, F.inline(F.array(*views)))
    classes = masked.groupBy("differs", "h", "rest").agg(
        F.min(key).alias("class"), (F.count(F.lit(1)) - 1).alias("links")).where("links > 0")
    return join_any_size(masked, store(classes, "classes"), ["differs", "h", "rest"]).select(
        key, "differs", "class", "links")
