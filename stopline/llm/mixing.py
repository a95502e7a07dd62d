"""Mixing to target weights by iterative proportional fitting, then calibrated sampling.

Tokens are counted per (source, language, topic). The counts are raked: the
factors of sources, languages and topics are set in turn so that the weighted
tokens meet each marginal, until all three hold. A document is kept with the
probability that its cell's weight asks for, by a hash of its id.

Every level that is found is raked to its own marginal, however many there are. The
cells that occur are a stored table. Up to `CELLS` of them are raked as arrays on the driver;
more are raked in Spark, by grouped sums per axis. Documents meet their cell's probability by a broadcast if the
cells measure few bytes, else by a join.

Targets are given as shares, or made from the counts: shares proportional to
tokens ** `temperature`. There is no topic in the tables, so the form of the text
(by its words and lines) stands for it; any expression may be given.

Defined results. Null levels are a level of their own, `(null)`. Documents without
tokens have weight like any of their cell. Repeated rows share one id and so are
kept or dropped together; a document without id is drawn by its text. An empty table gives no rows. Target levels without
tokens are left out and the others scaled up; levels without a target, where the axis has targets, get weight 0. Texts of
any length are read whole. ValueError if the documents have the column `into`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import store
from stopline.session import broadcast_if_small

CELLS = 1_000_000   # cells that the driver rakes: some 100 MB of arrays
TEMPERATURES = {"source": 0.7, "lang": 0.8, "topic": 1.0}
BUDGET = 0.7
ROUNDS = 500
TOLERANCE = 1e-9
NULL = "(null)"
AXES = ("source", "lang", "topic")


def n_tokens(text: Column) -> Column:
    """Words of the text, counted without building them."""
    x = F.coalesce(text, F.lit(""))
    return F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def form(text: Column) -> Column:
    """A stand-in for a topic: how the text is laid out."""
    x, n = F.coalesce(text, F.lit("")), n_tokens(text)
    return (F.when(F.instr(x, " | ") > 0, "table").when(n < 50, "note")
            .when(n < 300, "article").otherwise("long"))


def rake(cells: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Weights of a dense table of cells whose weighted marginals are the targets (shares of one total)."""
    codes = [c.ravel() for c in np.indices(cells.shape)]
    return rake_cells(cells.ravel(), codes, targets, rounds).reshape(cells.shape)


def rake_cells(tokens: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray],
               rounds: int = ROUNDS) -> np.ndarray:
    """The same for the cells that occur: `codes` has each cell's level on every axis."""
    weighted = tokens.astype(float)
    if not weighted.sum():
        return np.ones_like(weighted)
    goal = [t / t.sum() * weighted.sum() for t in targets]
    for _ in range(rounds):
        worst = 0.0
        for code, want in zip(codes, goal):
            have = np.bincount(code, weighted, len(want))
            factor = np.divide(want, have, out=np.ones_like(want), where=have > 0)
            worst = max(worst, float(np.abs(factor[have > 0] - 1).max(initial=0)))
            weighted = weighted * factor[code]
        if worst < TOLERANCE:
            break
    return np.divide(weighted, tokens, out=np.zeros_like(weighted), where=tokens > 0)


def calibrate(weights: np.ndarray, cells: np.ndarray, budget: float) -> np.ndarray:
    """min(1, c * weight), with c so that `budget` of all tokens are expected."""
    want = budget * cells.sum()
    low, high = 0.0, 1.0
    while (np.minimum(1, high * weights) * cells).sum() < want and high < 1e12:
        high *= 2
    for _ in range(100):
        c = (low + high) / 2
        low, high = (c, high) if (np.minimum(1, c * weights) * cells).sum() < want else (low, c)
    return np.minimum(1, high * weights)


def _named(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(NULL))


def goal_of(axis: str, levels: list[str], have: np.ndarray, targets) -> np.ndarray:
    """Target shares of the levels of one axis, made from their tokens where none are given."""
    if targets and axis in targets:
        goal = np.array([targets[axis].get(x, 0.0) for x in levels]) * (have > 0)
    else:
        goal = np.where(have > 0, np.power(np.maximum(have, 1), TEMPERATURES[axis]), 0)
    return goal if goal.sum() else have


def raked_here(cells: DataFrame, targets, budget: float) -> DataFrame:
    """(source, lang, topic, w, p) of at most `CELLS` cells, by arrays."""
    found = cells.toArrow()
    tokens = found["tokens"].to_numpy().astype(float)
    names, codes, goals = [], [], []
    for a in AXES:
        levels, code = np.unique(np.array(found[a].to_pylist(), object).astype(str), return_inverse=True)
        names.append(levels.tolist())
        codes.append(code)
        goals.append(goal_of(a, names[-1], np.bincount(code, tokens, len(levels)), targets))
    weights = rake_cells(tokens, codes, goals) if tokens.sum() else np.ones_like(tokens)
    chances = calibrate(weights, tokens, budget) if tokens.sum() else weights
    return cells.sparkSession.createDataFrame(pa.table(
        [*[found[a] for a in AXES], pa.array(np.round(weights, 9)), pa.array(np.round(chances, 9))],
        names=[*AXES, "w", "p"]))


def raked_in_spark(cells: DataFrame, targets, budget: float, rounds: int = ROUNDS, enough: float = 1e-6) -> DataFrame:
    """The same for any number of cells: factors of an axis come from grouped sums and are joined back."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    now = cells.select(*AXES, F.col("tokens").cast("double").alias("tokens"),
                       F.col("tokens").cast("double").alias("x"))
    goals = {}
    for a in AXES:
        have = now.groupBy(a).agg(F.sum("x").alias("have"))
        if targets and a in targets:
            given = list(targets[a].items())
            wanted = cells.sparkSession.createDataFrame(given or [("", 0.0)], f"{a} string, goal double")
            goal = have.join(F.broadcast(wanted), a, "left").select(
                a, "have", F.when(F.col("have") > 0, F.coalesce("goal", F.lit(0.0))).otherwise(0.0).alias("goal"))
        else:
            goal = have.select(a, "have", F.when(F.col("have") > 0, F.pow("have", F.lit(TEMPERATURES[a]))).otherwise(0.0).alias("goal"))
        goal = store(goal, "goals")
        whole = goal.agg(F.sum("goal")).first()[0] or 0.0
        goals[a] = goal.select(a, (F.col("goal") * (total / whole) if whole else F.col("have")).alias("goal"))
    for _ in range(rounds if total else 0):
        worst = 0.0
        for a in AXES:
            sums = now.groupBy(a).agg(F.sum("x").alias("have")).join(goals[a], a).where("have > 0")
            factors = store(sums.select(a, (F.col("goal") / F.col("have")).alias("f")), "factors")
            worst = max(worst, factors.agg(F.max(F.abs(F.col("f") - 1))).first()[0] or 0.0)
            now = store(now.join(broadcast_if_small(factors), a, "left").select(
                *AXES, "tokens", (F.col("x") * F.coalesce("f", F.lit(1.0))).alias("x")), "cells")
        if worst < enough:
            break
    weight = F.when(F.col("tokens") > 0, F.col("x") / F.col("tokens")).otherwise(0.0) if total else F.lit(1.0)
    now = store(now.select(*AXES, "tokens", weight.alias("w")), "cells")
    low, high = 0.0, 1.0
    for step in range(8 if total else 0):  # 32 scales a pass narrow the one that meets the budget
        tries = [high * 2.0 ** i for i in range(32)] if step == 0 else [low + (high - low) * i / 32 for i in range(1, 33)]
        sums = now.agg(*[F.sum(F.least(F.lit(1.0), F.col("w") * c) * F.col("tokens")) for c in tries]).first()
        first = next((i for i, s in enumerate(sums) if s >= budget * total), len(tries) - 1)
        low, high = (tries[first - 1] if first else low), tries[first]
    return now.select(*AXES, F.round("w", 9).alias("w"), F.round(F.least(F.lit(1.0), F.col("w") * high), 9).alias("p"))


def mixed(docs: DataFrame, topic: Column | None = None, targets: dict[str, dict[str, float]] | None = None,
          budget: float = BUDGET, into: str = "mix", text: str = "text") -> DataFrame:
    """`docs` with a struct `into`: source, lang, topic (as levels), n_tokens, weight, probability, kept."""
    if into in docs.columns:
        raise ValueError(f"the documents have a column {into}")
    topic = form(F.col(text)) if topic is None else topic
    facts = F.struct(_named(F.col("source")).alias("source"), _named(F.col("lang")).alias("lang"),
                     _named(topic).alias("topic"), n_tokens(F.col(text)).alias("n_tokens"))
    marked = docs.select(*[F.col(f"`{c}`") for c in docs.columns], facts.alias(into))
    counts = marked.groupBy(*[F.col(f"{into}.{a}").alias(a) for a in AXES]).agg(
        F.sum(f"{into}.n_tokens").alias("tokens"))
    cells = store(counts, "cells")  # one row per combination of levels found
    few = cells.limit(CELLS + 1).count() <= CELLS
    raked = raked_here(cells, targets, budget) if few else store(raked_in_spark(cells, targets, budget), "raked")
    probabilities = broadcast_if_small(raked.toDF("_s", "_l", "_t", "_w", "_p"))
    on = [F.col(f"{into}.{a}") == F.col(c) for a, c in zip(AXES, ("_s", "_l", "_t"))]
    drawn = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("mix"), F.col(text))).otherwise(
        F.xxhash64(F.lit("mix"), F.col("doc_id")))
    uniform = F.pmod(drawn, F.lit(1 << 40)) / F.lit(float(1 << 40))
    done = marked.join(probabilities, on[0] & on[1] & on[2], "left")
    return done.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(
        *[F.col(f"{into}.{a}").alias(a) for a in AXES], F.col(f"{into}.n_tokens").alias("n_tokens"),
        F.col("_w").alias("weight"), F.col("_p").alias("probability"),
        (uniform < F.col("_p")).alias("kept")).alias(into))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents, with their own columns."""
    into = "mix_report"
    while into in docs.columns:
        into += "_"
    return mixed(docs, into=into, **options).where(F.col(f"{into}.kept")).drop(into)


def mix_rows(docs: DataFrame) -> DataFrame:
    return mixed(docs.select("doc_id", "text", "source", "lang")).select("doc_id", "mix.*")
