"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame operations only.

Words and word pairs are hashed into `BUCKETS` buckets. Two multinomials over the
buckets are counted: the trusted target (documents labelled good) and the raw
corpus (all documents). A document's score is the mean over its words and pairs
of log(p_target / p_raw); a document below `THRESHOLD`, or failing a base rule,
goes. Target probabilities are smoothed with `SMOOTHING` pseudo-counts in the
raw proportions, so without trusted documents every score is 0 and only the base
rules decide.

All documents labelled good make the target; everything counts and judges all
rows. The ids of the target are broadcast where they measure few bytes, and the text
is not shuffled; more ids are joined to the rows' word hashes. Counts are
pre-aggregated per bucket, and the score is an expression on the row. Repeated
windows are found inside the row: only documents with a repeated window hash,
which a hash set shows, have their windows sorted.

Defined results. Null and empty texts have no words and fail the base rules.
Repeated rows are judged alike. A word pair needs two words. Labels with a null
id or class are no labels. Other columns are kept by `keep_good`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.session import broadcast_if_small

BUCKETS = 8192
SMOOTHING = 8192.0
THRESHOLD = -0.09
WINDOW = 8
SPACE = r"[\x20\x09-\x0D]"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def measured(docs: DataFrame, text: str = "text", into: str = "q") -> DataFrame:
    """`docs` with a struct `into` of the base counts and the array of word hashes."""
    if into in docs.columns:
        raise ValueError(f"the documents have a column {into}")
    x = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(x, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    step = docs.select(
        *names,
        F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)).alias("_h"),
        (F.length(x) - F.regexp_count(x, F.lit(SPACE))).cast("long").alias("_chars"),
        F.regexp_count(x, F.lit(r"[#*$%&|<>]")).cast("long").alias("_symbols"),
        lines.alias("_lines"))
    step = step.select(
        *names, "_h", "_chars", "_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_dup"),
        F.when(F.size("_h") >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.size("_h") - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice("_h", i, WINDOW)))).otherwise(
                F.array().cast("array<bigint>")).alias("_win"))
    # positions of windows whose hash is found twice, only where there is one
    step = step.withColumn("_at", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.array_sort(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    step = step.withColumn("_at", F.array_sort(F.filter(F.transform(
        "_at", lambda x, j: F.when(
            (F.get("_at", j + 1)["h"] == x["h"]) | (F.get("_at", j - 1)["h"] == x["h"]), x["i"])),
        lambda i: i.isNotNull())))
    repeat = F.aggregate(
        F.transform("_at", lambda p, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get("_at", j + 1) - p, F.lit(WINDOW))).cast("long")),
        F.lit(0).cast("long"), lambda a, b: a + b)
    n = F.size("_h").cast("long")
    step = step.select(*names, "_h", "_chars", "_symbols", "_dup", n.alias("_n"),
                       F.coalesce(repeat, F.lit(0).cast("long")).alias("_repeat"))
    return step.select(*names, F.struct(
        F.col("_n").alias("n_words"), F.col("_chars").alias("word_chars"), F.col("_symbols").alias("n_symbols"),
        F.col("_dup").alias("n_dup_lines"), F.col("_repeat").alias("n_repeat_words"),
        ((F.col("_n") < 20) | (100 * F.col("_repeat") > 30 * F.col("_n"))).alias("base_failed"),
        F.col("_h").alias("hashes")).alias(into))


def grams(hashes: Column) -> Column:
    """Bucket of every word and of every pair of neighbouring words."""
    pairs = F.zip_with(hashes, F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))),
                       lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    both = F.concat(hashes, F.filter(pairs, lambda h: h.isNotNull()))
    return F.transform(both, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def log_ratios(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
               label: str = "quality") -> list[float]:
    """log(p_target / p_raw) per bucket, counted over all documents."""
    good = (labels.where(F.col(label) == 1).where(F.col(doc_id).isNotNull())
            .select(F.col(doc_id).alias("good")).distinct())
    hashed = docs.select(F.col(doc_id).alias("d"),
                         F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)).alias("h"))
    rows = hashed.join(broadcast_if_small(good), F.col("d") == F.col("good"), "left").select(
        F.col("good").isNotNull().cast("long").alias("t"), F.explode(grams(F.col("h"))).alias("b"))
    counts = rows.groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("target")).collect()  # BUCKETS rows
    raw = [1] * BUCKETS
    target = [0] * BUCKETS
    for b, r, t in counts:
        raw[b] += r
        target[b] = t
    n_raw, n_target = sum(raw), sum(target)
    return [round(math.log((t + SMOOTHING * r / n_raw) / (n_target + SMOOTHING) * n_raw / r), 6)
            for r, t in zip(raw, target)]


def judged(docs: DataFrame, labels: DataFrame, into: str = "q", text: str = "text",
           doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with a struct `into`: base counts, base_failed, score and kept.

    The struct comes out of a generator of one row: Spark would push a filter on it
    below the projections and copy their nested expressions into the filter.
    """
    ratios = log_ratios(docs, labels, text, doc_id)
    # one constant array; folded once, looked up per n-gram
    weights = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    step = measured(docs, text, into)
    names = [F.col(f"`{c}`") for c in docs.columns]
    q = F.col(into)
    step = step.select(*names, q, grams(q["hashes"]).alias("_g"))
    score = F.aggregate("_g", F.lit(0.0), lambda s, b: s + F.get(weights, b)) / F.size("_g")
    step = step.select(*names, q, F.coalesce(F.when(F.size("_g") > 0, score), F.lit(0.0)).alias("_s"))
    counts = [q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed")]
    return step.select(*names, F.explode(F.array(F.struct(
        *counts, F.col("_s").alias("score"),
        (~q["base_failed"] & (F.col("_s") >= threshold)).alias("kept")))).alias(into))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with their own columns."""
    into = "quality_report"
    while into in docs.columns:
        into += "_"
    return judged(docs, labels, into, **options).where(F.col(f"`{into}`.kept")).drop(into)


def report_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: the base counts, the score and the verdict."""
    return judged(docs.select("doc_id", "text"), labels).select("doc_id", "q.*")
