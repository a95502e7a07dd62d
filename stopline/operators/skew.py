"""Joins and group counts that hold whatever the key skew.

Counts are partial aggregates, so a hot key sends one row per task. Rows meet a
per-key side by a plain equi-join on stored sides: a side measured as small is
broadcast and no row is shuffled; otherwise both sides are shuffled, and
adaptive execution splits every partition that is too large, however many
hot keys there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline import session


def key_counts(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def mark_counted(df: DataFrame, keys: Sequence[str], least: int, out: str) -> DataFrame:
    """`out`: whether at least `least` rows share the row's keys; NULL keys count as equal.

    Only the keys that reach `least` are stored and joined back.
    """
    keys = list(keys)
    reached = key_counts(df, keys, "_n").where(F.col("_n") >= least).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.lit(True).alias("_reached"))
    reached = session.broadcast_if_small(session.store(reached, "keys"))
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(reached[f"_{k}"])
    return df.join(reached, same, "left").select(
        *[df[c] for c in df.columns], F.col("_reached").isNotNull().alias(out))


def join_any_size(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  how: str = "inner") -> DataFrame:
    """Inner, semi or anti join on `keys`, for a right side of any size.

    A right side measured as small is broadcast. A larger one is stored, so that
    the join reads it through an exchange of its own and adaptive execution can
    split hot keys.
    """
    keys = list(keys)
    small = session.data_bytes(right) <= session.BROADCAST_BYTES
    return left.join(F.broadcast(right) if small else session.store(right, "right"), keys, how)
