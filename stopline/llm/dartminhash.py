"""Near-duplicate classes by DartMinHash signatures, banded joins and exact verification.

A text is the multiset of its runs of five words, each run weighted by its count.
The weighted element regions are unit cells (run, occurrence); every cell has an
endless hashed series of darts, each with a rank (a Poisson process of rate 1) and
one of `COORDINATES` coordinates. A signature keeps the earliest dart of each
coordinate among the darts that hit the text's regions, so two texts agree in a
coordinate with the probability of their weighted Jaccard similarity. Only ranks
up to t / weight are thrown, t = k (ln k + 2) darts whatever the length; a text with an
empty coordinate throws on.

`BANDS` bands of `ROWS` coordinates make buckets. Equal texts are one node. In a
bucket, every node is compared with a centre, the node that sits in the largest
buckets, then with the most central node of another component. What is still apart
meets by prefixes: cells are ordered from the rarest on, and of two texts of enough
similarity the first ninth of the shorter one's cells and the first fifth of the
longer one's must share a cell. So a bucket ends when its nodes are of one class or every
pair across classes has been refuted, and copies of one text that differ by rare words
each are not compared with each other.
Similarities are computed exactly; links of at least `SIMILARITY` are joined into
classes. A pair at the threshold is missed with probability
(1 - 0.8 ** ROWS) ** BANDS = 6e-7.

Hot groups: equal texts collapse by a pre-aggregated count; a centre with many
members is copied to groups of about `MEMBERS`, so no task holds more.

Defined results. Texts of fewer than five words are one run; null, empty and
wordless texts are equal to texts with the same bytes only (null is empty).
Words are runs of letters and digits (all non-ASCII characters count as such),
A-Z count as a-z. A class is named by its least
doc_id; repeated rows are rows of one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.llm.common import (
    BASE, WORDS, components, meet, mix, row_key, shingles, signed, store, string_buffers, text_chunks, text_key,
    word_hashes,
)

RUN = 5
SIMILARITY = (8, 10)
BANDS, ROWS = 20, 3
COORDINATES = BANDS * ROWS
DARTS = COORDINATES * (np.log(COORDINATES) + 2)


def text_shingles(data: np.ndarray, offsets: np.ndarray, size: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `size` words of each row, and the offset of each row's first."""
    words, rows = word_hashes(data, offsets, WORDS)
    n = np.diff(rows)
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    at = np.concatenate(([0], np.cumsum(counts)))
    runs = shingles(words, size) if len(words) >= size else np.zeros(0, np.uint64)
    out = np.zeros(at[-1], np.uint64)
    long_ = n >= size
    take = np.repeat(rows[:-1][long_] - at[:-1][long_], counts[long_])
    where = np.flatnonzero(np.repeat(long_, counts))
    out[where] = runs[where + take] if len(where) else 0
    for i in np.flatnonzero((n > 0) & ~long_):
        out[at[i]] = shingles(words[rows[i]:rows[i + 1]], size)[0]
    return out, at


def _arrival(cell: np.ndarray, step: int) -> np.ndarray:
    """Waiting time before the `step`-th dart of each cell."""
    u = (mix(cell + np.uint64(step * 0x632BE59BD9B4E019 & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64)
    return -np.log1p(-u / (1 << 53))


def regions(runs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells (run, occurrence) of each row, and the row of each cell, ascending."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((runs, row))
    s, row = runs[order], row[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    times = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
    return mix(s + mix(times.astype(np.uint64) + np.uint64(1))), row


def signatures(runs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Earliest dart of each coordinate, one line per row; 0 for rows without runs."""
    n_rows = len(at) - 1
    weight = np.diff(at)
    cells, row = regions(runs, at)
    out = np.zeros((n_rows, COORDINATES), np.uint64)
    open_rows = np.flatnonzero(weight)
    limit = DARTS / np.maximum(weight, 1)
    while len(open_rows):
        mine = np.zeros(n_rows, bool)
        mine[open_rows] = True
        here = mine[row]
        cell, of = cells[here], row[here]
        rank, step, found = np.zeros(len(cell)), 0, []
        while len(cell):
            rank = rank + _arrival(cell, step)
            hit = rank <= limit[of]
            cell, of, rank = cell[hit], of[hit], rank[hit]
            darts = mix(cell ^ mix(np.full(1, step + 0x5851F42D, np.uint64)))
            found.append((of, rank, darts))
            step += 1
        of, rank, darts = (np.concatenate(x) for x in zip(*found))
        slot = of * COORDINATES + (darts % np.uint64(COORDINATES)).astype(np.int64)
        by = np.lexsort((darts, rank, slot))
        slot = slot[by]
        earliest = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else by
        out.reshape(-1)[slot[earliest]] = darts[by][earliest]
        filled = np.bincount(slot[earliest] // COORDINATES, minlength=n_rows)
        open_rows = open_rows[filled[open_rows] < COORDINATES]
        limit[open_rows] *= 2
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; bands differ in their keys."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(BASE)
    for r in range(ROWS):
        keys = mix(keys + parts[:, :, r])
    return keys


def _lists(docs: DataFrame, name: str, lists) -> DataFrame:
    """`docs` (with `text`) with an array of longs in the place of `text`.

    lists: from the runs of some rows and their offsets, the values and their number in each row.
    """
    kept = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches):
        for batch in batches:
            values, counts = [np.zeros(0, np.int64)], [[0]]
            for _, _, data, offsets in text_chunks(batch.column("text")):
                some, n = lists(*text_shingles(data, offsets))
                values.append(signed(some))
                counts.append(n)
            ends = np.concatenate(counts).cumsum().astype(np.int32)
            arrays = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), arrays],
                                             names=[*(f.name for f in kept), name])

    schema = T.StructType([*kept, T.StructField(name, T.ArrayType(T.LongType()))])
    return docs.mapInArrow(run, schema)


def sketches(docs: DataFrame) -> DataFrame:
    """`docs` with `bands` in the place of `text`; no bands without words."""
    def bands(runs, at):
        some = np.diff(at) > 0
        return band_keys(signatures(runs, at))[some].ravel(), np.where(some, BANDS, 0)

    return _lists(docs, "bands", bands)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """A stored table of the different texts: node, t1, t2, doc (least doc_id), n rows, bands."""
    rows = sketches(docs.select("doc_id", *text_key(F.col("text")), "text"))
    texts = rows.groupBy("t1", "t2").agg(
        F.min("doc_id").alias("doc"), F.count("*").alias("n"), F.any_value("bands").alias("bands"))
    return store(texts.withColumn("node", F.monotonically_increasing_id()), "texts")


# ---- verification ----

def _counted(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    runs, _ = text_shingles(data, offsets)
    return np.unique(runs, return_counts=True)


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Weighted intersection and union of two counted sets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common, int(a[1].sum() + b[1].sum()) - common


def verify(pairs: DataFrame, texts: DataFrame, docs: DataFrame, least=SIMILARITY) -> DataFrame:
    """The (a, b) of the stored `pairs` whose texts are similar enough; b is the centre."""
    named = texts.select("node", "t1", "t2", row_key(F.col("doc")))
    source = docs.select(*text_key(F.col("text")), row_key(F.col("doc_id")), "text")
    dealt = meet(pairs.withColumn("info", F.lit(0)), named, source, ["t1", "t2", "dk"])
    num, den = least

    def run(batches):
        key, centre = None, None
        for batch in batches:
            ids = [batch.column(c).to_numpy() for c in ("centre", "group", "member", "node")]
            data, offsets = string_buffers(batch.column("text"))
            out_a, out_b = [], []
            for i, (c, g, m, node) in enumerate(zip(*(x.tolist() for x in ids))):
                one = data[offsets[i]:offsets[i + 1]]
                if m == 0:
                    if key != (c, g):
                        key, centre = (c, g), _counted(one, np.array([0, len(one)]))
                    continue
                common, union = similar(_counted(one, np.array([0, len(one)])), centre)
                if union and common * den >= num * union:
                    out_a.append(node)
                    out_b.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())],
                                             names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


# ---- classes ----

def _cross(now: DataFrame, centre: DataFrame) -> DataFrame:
    """Pairs of a node and its bucket's centre that are not in one component yet."""
    return now.join(centre, "key").where("root != root_b").select(F.col("node").alias("a"), "b").distinct()


def prefix_pairs(nodes: DataFrame, texts: DataFrame, docs: DataFrame, least=SIMILARITY) -> DataFrame:
    """(a, b): all pairs of `nodes` (node, root) of different roots that can be similar enough.

    Of an overlap of at least o cells, one is among the first n - o + 1 cells of either text in any
    common order; o is at least num / den of the longer text, and num / (num + den) of both. Cells
    that only one text has come first and are counted, not kept.
    """
    num, den = least
    named = texts.select("node", "t1", "t2", row_key(F.col("doc"))).join(nodes, "node")
    source = docs.select(*text_key(F.col("text")), row_key(F.col("doc_id")), "text")
    rows = source.join(named, ["t1", "t2", "dk"]).select("node", "root", "text").dropDuplicates(["node"])
    cells = _lists(rows, "cells", lambda runs, at: (regions(runs, at)[0], np.diff(at)))
    spread = store(cells.select("node", "root", F.size("cells").alias("size"), F.explode("cells").alias("cell")), "cells")
    shared = spread.join(spread.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1"), "cell")
    mine = Window.partitionBy("node")
    place = F.col("size") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("n", "cell"))
    first = store(shared.withColumn("place", place)
                  .where(F.expr(f"place <= size * {den - num} div {den} + 1")).drop("n"), "prefixes")
    other = first.where(F.expr(f"place <= size * {den - num} div {den + num} + 1")).select(
        "cell", F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("size").alias("size_b"),
        F.col("place").alias("place_b"))
    return (first.join(other, "cell").where("root != root_b")
            .where("size_b < size or (size_b = size and b < node)").where(f"size_b * {den} >= size * {num}")
            .where(f"(1 + least(size - place, size_b - place_b)) * {num + den} >= {num} * (size + size_b)")
            .select(F.col("node").alias("a"), "b").distinct())


def links(texts: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, root) of every node that is linked to another."""
    spread = texts.select("node", F.explode("bands").alias("key"))
    sizes = spread.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = store(spread.join(sizes, "key"), "buckets")
    rank = shared.groupBy("node").agg(F.sum("size").alias("rank"))
    shared = store(shared.drop("size").join(rank, "node"), "ranked")
    most = F.max(F.struct("rank", (-F.col("node")).alias("node"), "root")).alias("c")
    centre = (F.col("key"), (-F.col("c.node")).alias("b"), F.col("c.root").alias("root_b"))
    edges = tried = None
    roots = shared.select("node", F.col("node").alias("root")).limit(0)
    for step in ("centre", "second centre", "rest"):
        now = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        parts = now.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y")
        now = store(now.join(parts.select("key"), "key"), "open")
        first = now.groupBy("key").agg(most).select(*centre)
        if step == "centre":
            pairs = _cross(now, first)
        elif step == "second centre":
            others = now.join(first, "key").where("root != root_b").select("key", "node", "rank", "root")
            pairs = _cross(now, others.groupBy("key").agg(most).select(*centre))
        else:  # what two centres have left apart
            pairs = prefix_pairs(now.select("node", "root").distinct(), texts, docs)
        both = pairs.withColumns({"lo": F.least("a", "b"), "hi": F.greatest("a", "b")})
        if tried is not None:
            both = both.join(tried, ["lo", "hi"], "left_anti")
        pairs = store(both, "candidates")
        now_tried = pairs.select("lo", "hi").distinct()
        tried = now_tried if tried is None else tried.unionByName(now_tried)
        if pairs.isEmpty():
            continue
        found = store(verify(pairs.select("a", "b"), texts, docs), "links")
        edges = found if edges is None else edges.unionByName(found)
        if not found.isEmpty():
            roots = components(edges)
    return roots


def classes(docs: DataFrame) -> DataFrame:
    """A stored row for every different text: t1, t2, doc (its least doc_id), class_id, class_size, keeper."""
    docs = docs.select("doc_id", "text")
    texts = distinct_texts(docs)
    named = (texts.select("node", "t1", "t2", "doc", "n").join(links(texts, docs), "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    groups = named.groupBy("root").agg(
        F.min(F.struct(F.col("doc").isNull().alias("z"), "doc", "node")).alias("k"), F.sum("n").alias("class_size"))
    return store(named.join(groups, "root").select(
        "t1", "t2", "doc", F.col("k.doc").alias("class_id"), "class_size",
        (F.col("node") == F.col("k.node")).alias("keeper")), "classes")


def class_rows(docs: DataFrame) -> DataFrame:
    """One row per document: class, its size, and whether this row would stay."""
    docs = docs.select("doc_id", "text")
    found = classes(docs)
    return (docs.select("doc_id", *text_key(F.col("text"))).join(found, ["t1", "t2"])
            .select("doc_id", "class_id", F.col("class_size").cast("long").alias("class_size"),
                    (F.col("keeper") & F.col("doc_id").eqNullSafe(F.col("doc"))).alias("kept")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class, the one with the least doc_id, with the columns of `docs`."""
    keep = classes(docs).where("keeper").select(
        "t1", "t2", row_key(F.col("doc")))
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], *text_key(F.col("text")),
                       row_key(F.col("doc_id")))
    rows = rows.join(keep, ["t1", "t2", "dk"]).dropDuplicates(["t1", "t2", "dk"])
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])
