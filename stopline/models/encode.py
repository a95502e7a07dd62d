"""Dummy coding: sparse vectors for fitting, plain 0/1 columns for inspection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.operators.selection import dense_row_id
from stopline.operators.skew import join_any_size
from stopline.session import store


def as_factors(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    """Factor columns as text, so that booleans and numbers index alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in cats})


def fit_indexer(df: DataFrame, cats: Sequence[str]) -> PipelineModel:
    """Level dictionaries of the whole frame, in reverse alphabetical order.

    They are fitted before any split, so a level that only the test rows have
    is known. The last index, which dummy coding drops, is the first level.
    """
    indexer = StringIndexer(
        inputCols=list(cats), outputCols=[f"{c}_ix" for c in cats],
        stringOrderType="alphabetDesc")
    return Pipeline(stages=[indexer]).fit(as_factors(df, cats))


def encode(df: DataFrame, cats: Sequence[str], nums: Sequence[str],
           out: str = "features") -> PipelineModel:
    """Fitted dummy coding against the first level: a sparse vector, no intercept column."""
    indexer = fit_indexer(df, cats).stages[0]
    hot = OneHotEncoder(inputCols=[f"{c}_ix" for c in cats],
                        outputCols=[f"{c}_hot" for c in cats], dropLast=True)
    join = VectorAssembler(inputCols=[*[f"{c}_hot" for c in cats], *nums], outputCol=out)
    return Pipeline(stages=[indexer, hot, join]).fit(as_factors(df, cats))


def index_only(df: DataFrame, cats: Sequence[str], nums: Sequence[str],
               out: str = "features") -> PipelineModel:
    """Fitted level indexes without dummies, as trees want them."""
    indexer = fit_indexer(df, cats).stages[0]
    join = VectorAssembler(inputCols=[*[f"{c}_ix" for c in cats], *nums], outputCol=out)
    return Pipeline(stages=[indexer, join]).fit(as_factors(df, cats))


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the vector slots, from the column's metadata: `factor` + `level`."""
    attrs = df.schema[col].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind)
    return [name.replace("_hot_", "=", 1).removesuffix("_ix") for _, name in slots]


def dummy_columns(df: DataFrame, cats: Sequence[str], nums: Sequence[str] = ()) -> DataFrame:
    """The same coding as readable 0/1 columns `<factor>_<level>`."""
    levels = as_factors(df, cats).select(*cats).unpivot([], list(cats), "factor", "level")
    known: dict[str, list[str]] = {c: [] for c in cats}
    for row in levels.where("level is not null").distinct().orderBy("factor", "level").collect():
        known[row["factor"]].append(row["level"])
    text = {c: F.col(c).cast("string") for c in cats}
    dummies = [
        (text[c] == level).cast("int").alias(f"{c}_{level}")
        for c in cats for level in known[c][1:]
    ]
    return df.select(*nums, *dummies)


def max_levels(model: PipelineModel) -> int:
    """Size of the largest level dictionary; a forest needs that many bins."""
    return max((len(labels) for labels in model.stages[0].labelsArray), default=0)


def level_slots(df: DataFrame, cats: Sequence[str], first: int = 0) -> DataFrame:
    """(factor, level, slot): the stored dictionary of dummy coding against each factor's first level.

    Slots go by factor in the order of `cats`, then by level, from `first` up. The levels are numbered by ranges, and
    none reaches the driver.
    """
    text = as_factors(df, cats).select(*cats).unpivot([], list(cats), "factor", "level")
    place = F.array_position(F.array(*[F.lit(c) for c in cats]), F.col("factor")).cast("int")
    levels = store(text.where("level is not null").distinct().withColumn("place", place), "levels")
    base = levels.groupBy("factor").agg(F.min("level").alias("base"))  # a row per factor
    coded = levels.join(F.broadcast(base), "factor").where("level > base").drop("base")
    numbered = dense_row_id(coded, ["place", "level"], "slot", unique=True)
    return store(numbered.select("factor", "level", (F.col("slot") - 1 + first).alias("slot")), "slots")


def design_triplets(df: DataFrame, key: str, cats: Sequence[str], nums: Sequence[str] = (),
                    slots: DataFrame | None = None) -> DataFrame:
    """(key, slot, value): the design matrix without its zeros, whatever the number of levels.

    Numbers take the first slots, in order; then the levels by `level_slots`, whose result may be given. A
    missing number or level, and a factor's first level, has no entry.
    """
    slots = level_slots(df, cats, len(nums)) if slots is None else slots
    numbers = [F.struct(F.lit(i).cast("long").alias("slot"), F.col(c).cast("double").alias("value")) for i, c in enumerate(nums)]
    long = as_factors(df, cats).select(key, *cats).unpivot([key], list(cats), "factor", "level").where("level is not null")
    coded = join_any_size(long, slots, ["factor", "level"]).select(key, "slot", F.lit(1.0).alias("value"))
    if not nums:
        return coded
    return df.select(key, F.inline(F.array(*numbers))).where("value <> 0").unionByName(coded)
