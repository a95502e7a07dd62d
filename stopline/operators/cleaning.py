"""Projections, repairs and row filters. Everything here is lazy and row-wise."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline import schema
from stopline.functions.calendar import parse_timestamp
from stopline.functions.text import contains_any, in_set
from stopline.operators.skew import join_any_size, mark_counted


# ---- projections, casts, repairs ----

def cast_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by name. Text that is no number becomes NULL instead of failing."""
    return df.withColumns({c: F.col(c).cast("string").try_cast(t) for c, t in types.items()})


def unite_datetime(df: DataFrame, date_col: str, time_col: str, out: str,
                   fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Join date and time text with a blank, parse, and drop the two parts."""
    text = F.concat(F.col(date_col), F.lit(" "), F.col(time_col))
    return df.withColumn(out, parse_timestamp(text, fmt)).drop(date_col, time_col)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop by name; names that are not there are ignored."""
    return df.drop(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename and move to the end, as copy-then-remove does."""
    kept = [F.col(c) for c in df.columns if c not in names]
    return df.select(*kept, *[F.col(old).alias(new) for old, new in names.items()])


def reorder_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.select(*order)


def fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def null_if(df: DataFrame, cols: Iterable[str], value=0, when: Column | None = None) -> DataFrame:
    """A sentinel becomes NULL, optionally only where `when` holds."""
    def repaired(c: str) -> Column:
        hit = F.col(c) == value
        return F.when(hit if when is None else hit & when, None).otherwise(F.col(c))

    return df.withColumns({c: repaired(c) for c in cols})


def overwrite(df: DataFrame, when: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns to constants where `when` is true; a None clears them."""
    return df.withColumns(
        {c: F.when(when, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()}
    )


def derive_equals(df: DataFrame, col: str, value, out: str) -> DataFrame:
    """Boolean `col == value`, false for NULL."""
    return df.withColumn(out, F.coalesce(F.col(col) == value, F.lit(False)))


def pedestrian_overwrite(df: DataFrame, description: str = "description") -> DataFrame:
    """Give pedestrian offences one common vehicle description.

    The second step reads the plate state the first one may have written.
    """
    text = F.col(description)
    marked = overwrite(df, contains_any(text, schema.PEDESTRIAN_PHRASES), {"state": "XX"})
    pedestrian = contains_any(text, ["PEDESTRIAN"]) & (F.col("state") == "XX")
    return overwrite(
        marked, F.coalesce(pedestrian, F.lit(False)),
        {"vehicle_type": "29 - Unknown", "year": None, "make": "None", "model": "None",
         "color": "N/A"},
    )


def minority_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Non-NULL rows outside the most frequent level, per column. One job.

    Levels are counted in one grouped pass; only per-column totals come back.
    """
    levels = df.select([F.col(c).cast("string").alias(c) for c in cols])
    counts = (
        levels.unpivot([], list(cols), "column", "level").where("level is not null")
        .groupBy("column", "level").count()
    )
    rows = counts.groupBy("column").agg((F.sum("count") - F.max("count")).alias("n")).collect()
    return {r["column"]: r["n"] for r in rows}


def drop_low_variance(df: DataFrame, cols: Sequence[str], min_rows: int = 1000) -> DataFrame:
    """Drop the columns whose minority levels hold fewer than `min_rows` rows."""
    counts = minority_counts(df, cols)
    return df.drop(*[c for c in cols if counts.get(c, 0) < min_rows])


# ---- row filters ----

def filter_between(df: DataFrame, col: str, after, before) -> DataFrame:
    """Both limits exclusive."""
    return df.where((F.col(col) > F.lit(after)) & (F.col(col) < F.lit(before)))


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(cols))


def complete_cases(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def filter_lat_range(df: DataFrame, col: str, low: float = schema.LAT_CLEAN[0],
                     high: float = schema.LAT_CLEAN[1]) -> DataFrame:
    """Drop values above `high` or in (0, low); a 0 stays and becomes NULL."""
    c = F.col(col)
    return null_if(df.where(~(c > high) & ~((c < low) & (c > 0))), [col])


def filter_lon_range(df: DataFrame, col: str, low: float = schema.LON_CLEAN[0],
                     high: float = schema.LON_CLEAN[1], as_written: bool = True) -> DataFrame:
    """Drop values below `low`, then those above `high` that are also > 0.

    As written, the second test only removes positive values; with
    `as_written=False` it mirrors the latitude rule and removes (high, 0).
    """
    c = F.col(col)
    side = (c > 0) if as_written else (c != 0)
    return null_if(df.where(~(c < low) & ~((c > high) & side)), [col])


def filter_in_list(df: DataFrame, col: str, allowed) -> DataFrame:
    """Keep listed values. `allowed` is a list, or a one-column DataFrame."""
    if isinstance(allowed, DataFrame):
        return join_any_size(df, allowed.toDF(col).dropDuplicates(), [col], "left_semi")
    return df.where(in_set(F.col(col), allowed))


def filter_contradictions(df: DataFrame, left: str, right: str,
                          pairs: Iterable[tuple] = schema.CONTRADICTORY_STATES) -> DataFrame:
    """Drop rows with a listed (left, right) pair; the rule list is a literal."""
    bad = F.lit(False)
    for a, b in pairs:
        bad = bad | ((F.col(left) == a) & (F.col(right) == b))
    return df.where(~bad)


def filter_year_by_type(df: DataFrame, year: str, kind: str,
                        kinds: Iterable[str] = schema.TYPES_NEEDING_YEAR) -> DataFrame:
    """Drop year 0 for kinds that need one. A NULL year with such a kind goes too."""
    return df.where(~((F.col(year) == 0) & F.col(kind).isin(list(kinds))))


def filter_year_range(df: DataFrame, year: str, low: int = schema.YEAR_CLEAN[0],
                      high: int = schema.YEAR_CLEAN[1]) -> DataFrame:
    """Drop years in (0, low) and above `high`; missing and 0 stay as NULL."""
    y = F.coalesce(F.col(year), F.lit(0))
    return null_if(df.where(~((y < low) & (y > 0)) & ~(y > high)), [year])


def filter_response(df: DataFrame, response: str,
                    keep: Sequence[str] = ("Warning", "Citation")) -> DataFrame:
    return df.where(F.col(response).isin(list(keep)))


def filter_not_in(df: DataFrame, drops: Mapping[str, Iterable]) -> DataFrame:
    """Drop listed levels; NULL is not in any list and stays."""
    for col, values in drops.items():
        df = df.where(~in_set(F.col(col), values))
    return df


def drop_rare_levels(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """Drop the rows of levels with fewer than `min_count` rows.

    NULL is kept.
    """
    return mark_counted(df, [col], min_count, "_kept").where(F.col("_kept") | F.col(col).isNull()).drop("_kept")
