"""Shared helpers: stored tables, digests, word hashes of a whole Arrow batch, components."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.session import BROADCAST_BYTES, broadcast_if_small, data_bytes, discard, new_path

# Functions of this package travel with the tasks: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules["stopline.llm"])

# Text handled at once inside a task: whole documents are packed up to this many bytes.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under the shared folder and read it back: compressed, and no lineage.

    The files are removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession, *stored: DataFrame) -> None:
    """Remove the files of tables made by `store` that nothing reads any more."""
    for df in stored:
        for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            discard(spark, path)


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text; equal texts agree, null is like empty."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]


# ---- 64-bit hashes in numpy; unsigned arithmetic wraps ----

def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
# A random odd number for each byte value, from a fixed seed.
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
_WORD_POWERS = powers(BASE, 1 << 12)
_FAR_POWERS = powers(0xC2B2AE3D27D4EB4F, 1 << 12)


def byte_class(pattern_bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(pattern_bytes)] = True
    return out


# Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z are a-z.
WORDS = byte_class([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is like empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about `size` bytes: first row, last row + 1, bytes, row offsets."""
    data, offsets = string_buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray,
                ) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the rows, and the offset of each row's first word.

    A word is a maximal run of bytes in `letters`; rows end words. A-Z count as a-z.
    """
    inside = letters[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    cut = offsets[offsets < len(data)]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    rows = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), rows
    ends = np.flatnonzero(inside & ~np.append(inside[1:] & before[1:-1], False)) + 1
    sizes = ends - starts
    at = np.flatnonzero(inside)
    within = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    codes = BYTE_CODES[LOWER[data[at]]] * _WORD_POWERS[within & 0xFFF]
    if sizes.max() > 4096:
        codes *= _FAR_POWERS[(within >> 12) & 0xFFF]
    sums = np.add.reduceat(codes, np.cumsum(sizes) - sizes)
    return mix(sums + sizes.astype(np.uint64)), rows


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; fewer words, but not none, are one shingle."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    out = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(BASE) + words[i:n - size + 1 + i])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# ---- texts that are to be compared ----

# Texts that meet one centre in a group, and texts that are worth a task.
MEMBERS, TASK_TEXTS = 500, 100


def row_key(doc_id: Column) -> Column:
    """A document's id as text, for joins that must match null with null."""
    return F.coalesce(doc_id.cast("string"), F.lit("")).alias("dk")


def meet(pairs: DataFrame, named: DataFrame | None, source: DataFrame, keys: list[str], size: int | None = None) -> DataFrame:
    """Rows (centre, group, member, node, info, text), sorted so that each group's centre comes first.

    pairs: (a, b, info), b the centre. named: (node, *keys); source: (*keys, text). A centre with
    many members is copied to groups of about `MEMBERS`, so no task gathers more. size: the number of pairs, if
    known; then `pairs` are stored, and few of them go to fewer tasks. Without `named` a node is its own key.
    """
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / MEMBERS).cast("long").alias("groups"))
    if size is not None:
        sizes = broadcast_if_small(sizes)
    to = lambda group, member, info: F.struct(
        F.col("b").alias("centre"), group.alias("group"), F.lit(member).alias("member"), info.alias("info"))
    kind = pairs.schema["info"].dataType
    members = pairs.join(sizes, "b").select(
        F.col("a").alias("node"), to(F.pmod(F.xxhash64("a"), "groups"), 1, F.col("info")).alias("to"))
    centres = sizes.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("g")).select(
        F.col("b").alias("node"), to(F.col("g"), 0, F.lit(None).cast(kind)).alias("to"))
    wanted = members.unionByName(centres).groupBy("node").agg(F.collect_list("to").alias("to"))
    if named is None:
        wanted = wanted.withColumn("_n", F.col("node")).withColumnRenamed("node", keys[0])
        nodes = pairs.select(F.explode(F.array("a", "b")).alias(keys[0])).distinct()
        if data_bytes(nodes) <= BROADCAST_BYTES:  # other texts stay where they are
            source = source.join(F.broadcast(nodes), keys, "left_semi")
    else:
        wanted = wanted.join(named, "node").select("to", F.col("node").alias("_n"), *keys)
    sent = (source.join(wanted, keys)
            .select(F.col("_n").alias("node"), "text", F.explode("to").alias("to")).select("to.*", "node", "text"))
    spark = pairs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size is not None:
        count = min(count, max(spark.sparkContext.defaultParallelism, -(-size // TASK_TEXTS)))
    return sent.repartition(count, "centre", "group").sortWithinPartitions("centre", "group", "member", "node")


# ---- connected components ----

def _fingerprint(edges: DataFrame):
    """Number of edges and the sum of their hashes: two longs that tell whether a step changed any."""
    return edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge, root the least node it is connected to.

    Alternating large-star and small-star steps; every step pre-aggregates the
    least neighbour before its shuffle, and rounds grow with the logarithm of
    a component's size. Nothing but a count reaches the driver.
    """
    now = store(
        edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct(), "stars")
    old = _fingerprint(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("m").alias("u"), "v").where("u < v").distinct())
        # small star: each node's smaller neighbours point to the least of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(least, "v")
                 .select(F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("v")),
                                           F.struct(F.col("m").alias("u"), F.col("u").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u < v").distinct())
        now = store(small, "stars")
        new = _fingerprint(now)
        if old == new:
            break
        old = new
    roots = now.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct()
