"""Missing and wrong values per column, and the quality score."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline import schema
from stopline.functions.text import in_set


def missing_by_column(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, missing) from one pass."""
    cols = list(cols or df.columns)
    return _per_column(df, {c: {"missing": F.count_if(F.col(c).isNull())} for c in cols})


def _per_column(df: DataFrame, measures: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    rows = [
        F.struct(F.lit(c).alias("column"), *[m.alias(k) for k, m in per.items()])
        for c, per in measures.items()
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def range_violations(df: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """(column, below, above, zero, wrong): wrong = below + above - zero.

    Zero stands for a missing value and lies outside every range given here.
    """
    measures = {}
    for c, (low, high) in ranges.items():
        below = F.count_if(F.col(c) < low)
        above = F.count_if(F.col(c) > high)
        zero = F.count_if(F.col(c) == 0)
        measures[c] = {"below": below, "above": above, "zero": zero, "wrong": below + above - zero}
    return _per_column(df, measures)


def invalid_category_counts(df: DataFrame, domains: Mapping[str, Iterable]) -> DataFrame:
    """(column, invalid): rows outside the list; NULL counts as outside."""
    return _per_column(
        df, {c: {"invalid": F.count_if(~in_set(F.col(c), v))} for c, v in domains.items()})


def quality_report(df: DataFrame, ranges: Mapping[str, tuple] | None = None,
                   domains: Mapping[str, Iterable] | None = None,
                   zero_missing: Sequence[str] = ()) -> DataFrame:
    """(column, n, missing, wrong) for every column, in one pass.

    Columns in `zero_missing` count zeros as missing. A NULL in a column with a
    domain counts twice, as missing and as wrong.
    """
    ranges, domains = ranges or {}, domains or {}
    measures = {}
    for c in df.columns:
        missing = F.count_if(F.col(c).isNull())
        if c in zero_missing:
            missing = missing + F.count_if(F.col(c) == 0)
        wrong = F.lit(0).cast("long")
        if c in ranges:
            low, high = ranges[c]
            wrong = (F.count_if(F.col(c) < low) + F.count_if(F.col(c) > high)
                     - F.count_if(F.col(c) == 0))
        if c in domains:
            wrong = wrong + F.count_if(~in_set(F.col(c), domains[c]))
        measures[c] = {"n": F.count(F.lit(1)), "missing": missing, "wrong": wrong}
    return _per_column(df, measures)


def quality_score(report: DataFrame, digits: int = 2) -> DataFrame:
    """One row: bad cells, cells, and their ratio in percent."""
    bad = F.sum(F.col("missing") + F.col("wrong"))
    cells = F.sum("n")
    percent = F.round(bad * 100.0 / F.nullif(cells, F.lit(0)), digits)
    return report.agg(bad.alias("bad_cells"), cells.alias("cells"), percent.alias("percent_bad"))


def effective_share(df: DataFrame, structural: Sequence[str], digits: int = 6) -> DataFrame:
    """Share of all cells that are missing in the given columns."""
    cells = F.count(F.lit(1)) * len(df.columns)
    missing = sum((F.count_if(F.col(c).isNull()) for c in structural), F.lit(0))
    return df.agg(missing.alias("missing"), cells.alias("cells"),
                  F.round(missing / F.nullif(cells, F.lit(0)), digits).alias("share"))


def score_stops(df: DataFrame) -> DataFrame:
    """The score of a stops table with the domain's limits."""
    ranges = {"latitude": schema.LAT_SCORE, "longitude": schema.LON_SCORE,
              "year": schema.YEAR_SCORE}
    states = {c: schema.STATE_CODES for c in ("state", "driver_state", "dl_state")}
    return quality_score(quality_report(
        df, {c: r for c, r in ranges.items() if c in df.columns},
        {c: s for c, s in states.items() if c in df.columns}, ["latitude", "longitude"]))
