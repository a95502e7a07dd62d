"""Phrase collocations: suffix pointers routed by leading words and sorted by three-way partitions.

Every word starts a suffix of at most `DEPTH` words that ends with its piece. Words are
counted first; a suffix ends before a word found fewer than `LEAST` times, since no
phrase with that word can count. A task sorts the suffixes of its documents, folds equal
ones, and sends them, packed, to the bucket of their leading word, or of their two leading words
where the first is common. In a bucket a multikey three-way quicksort takes the
pointers apart word by word: the pointers equal to the pivot are the occurrences of
one phrase, so their number is its count, and they go on to the next word; a part with
fewer than `LEAST` occurrences is given up at once. Small parts are sorted directly
and read off as runs.

A bucket with more than `BUCKET` suffixes, which only a common pair can cause, is
dealt once more by the words behind the pair; its partial counts are added up in Spark. So no
task holds more than about a bucket, and equal suffixes travel once per task.

Words are known by 64-bit hashes of (lang, word). They are sent as ranks where the
words found `LEAST` times fit `DICTIONARY_BYTES`, else as hashes and no word is left out; results are alike.

Defined results. Null texts have no words; a null lang is `und`. Repeated rows count as rows.
Ties of a cut go to the smallest first part, ties of phrases to the first in UTF-8 byte order. Texts of any
length are read whole. Without documents there are no phrases. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopline.llm.common import LOWER, byte_class, mix, signed, store, string_buffers, text_chunks, word_hashes
from stopline.session import broadcast_if_small

DEPTH, LEAST, TOP = 4, 30, 2000
BUCKET = 2_000_000          # suffixes in a bucket, about
FLUSH = 2_000_000           # suffixes a task sorts at once
DIRECT = 4096               # a part this small is sorted directly
DICTIONARY_BYTES = 32 << 20

BREAKS = byte_class(b".,;:!?\n\x0b\x0c\r")
LETTERS = ~BREAKS & ~byte_class(b" \t")


# ---- words of a batch ----

def lang_code(lang: str | None) -> int:
    return int.from_bytes(hashlib.blake2b((lang or "und").encode(), digest_size=8).digest(), "little")


def read_words(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Per run of rows: key and piece of every word, and what is needed to name the words."""
    langs = batch.column(0).fill_null("und").to_pylist()
    codes = np.array([lang_code(x) for x in langs], np.uint64)
    for first, last, data, offsets in text_chunks(batch.column(1)):
        hashes, rows = word_hashes(data, offsets, LETTERS)
        if not len(hashes):
            continue
        inside = LETTERS[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        before[offsets[offsets < len(data)]] = False
        starts = np.flatnonzero(inside & ~before[:-1])
        row = np.repeat(np.arange(last - first), np.diff(rows))
        # a piece is told by the breaks and the rows before it
        piece = np.cumsum(BREAKS[data])[starts] + row
        yield mix(hashes ^ codes[first:last][row]), piece, starts, row, data, offsets, langs[first:last]


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, _, starts, row, data, offsets, langs in read_words(batch):
            found, at, n = np.unique(keys, return_index=True, return_counts=True)
            stop = np.append(np.flatnonzero(~LETTERS[data]), len(data))
            ends = np.minimum(stop[np.searchsorted(stop, starts[at])], offsets[row[at] + 1])
            low = LOWER[data].tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array([langs[r] for r in row[at]], pa.string()),
                pa.array([low[a:b].decode() for a, b in zip(starts[at], ends)], pa.string()),
                pa.array(signed(found)), pa.array(n.astype(np.int64))], ["lang", "word", "key", "n"])


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, key, n) of all words of all documents."""
    rows = docs.select(F.col(lang), F.col(text)).mapInArrow(
        count_batches, "lang string, word string, key long, n long")
    return rows.groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


# ---- suffixes, packed and routed ----

def pack(columns: list[np.ndarray]) -> bytes:
    """Sorted suffixes and their counts; the first word as differences."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    return zstandard.compress(b"".join(np.ascontiguousarray(c).tobytes() for c in (first, *columns[1:])), 1)


def unpack(blob: bytes, n: int, kind) -> list[np.ndarray]:
    data = zstandard.decompress(blob)
    size = n * np.dtype(kind).itemsize
    columns = [np.frombuffer(data, kind, n, i * size) for i in range(DEPTH)]
    return [np.cumsum(columns[0], dtype=kind), *columns[1:], np.frombuffer(data, np.uint32, n, DEPTH * size)]


def fold(columns: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct suffixes and their added counts."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.append(True, np.zeros(len(order) - 1, bool))
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(weights[order], at)


def suffix_columns(ids: np.ndarray, piece: np.ndarray) -> list[np.ndarray]:
    """The words of every suffix of two words or more; 0 is behind its end, and stands for a word left out."""
    n = len(ids)
    columns, alive = [ids], ids != 0
    for d in range(1, DEPTH):
        ahead = np.zeros(n, ids.dtype)
        ahead[:n - d] = ids[d:]
        same = np.zeros(n, bool)
        same[:n - d] = piece[d:] == piece[:n - d]
        alive = alive & same & (ahead != 0)
        columns.append(np.where(alive, ahead, ids.dtype.type(0)))
    keep = columns[1] != 0
    return [c[keep] for c in columns]


def bucket_of(columns: list[np.ndarray], buckets: int, common: np.ndarray) -> np.ndarray:
    first, second = (c.astype(np.uint64) for c in columns[:2])
    at = np.searchsorted(common, columns[0]) if len(common) else np.zeros(len(first), np.int64)
    is_common = common[np.minimum(at, len(common) - 1)] == columns[0] if len(common) else np.zeros(len(first), bool)
    h = mix(first * np.uint64(0x9E3779B97F4A7C15) + np.where(is_common, mix(second + np.uint64(1)), np.uint64(0)))
    return (h % np.uint64(buckets)).astype(np.int64)


PACKED = "bucket long, part int, n long, blob binary"


def packed_rows(columns, weights, place) -> Iterator[tuple]:
    """(place, entries, blob) for each bucket's entries, in their order."""
    order = np.argsort(place, kind="stable")
    at = place[order]
    edges = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(at))
    for a, b in zip(edges[:-1], edges[1:]):
        mine = order[a:b]
        for i in range(0, len(mine), FLUSH):
            part = mine[i:i + FLUSH]
            yield int(at[a]), len(part), pack([c[part] for c in columns] + [weights[part].astype(np.uint32)])


def route(dictionary, common, buckets: int):
    """Documents to packed suffixes. `dictionary` is a broadcast (sorted keys, rank of each), or None."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            columns = [np.concatenate(c) for c in zip(*held)]
            columns, weights = fold(columns, np.ones(len(columns[0]), np.int64))
            rows = list(packed_rows(columns, weights, bucket_of(columns, buckets, common.value)))
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([0] * len(rows), pa.int32()),
                pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
                ["bucket", "part", "n", "blob"])

        for batch in batches:
            for keys, piece, *_ in read_words(batch):
                if dictionary is None:
                    ids = np.maximum(keys, np.uint64(1))
                else:
                    known, ranks = dictionary.value
                    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                    ids = np.where(known[at] == keys, ranks[at], np.uint32(0))
                columns = suffix_columns(ids, piece)
                if len(columns[0]):
                    held.append(columns)
                    size += len(columns[0])
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return run


def deal_again(parts: dict[int, int], kind):
    """Entries of buckets that are too large, by all their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, n, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "n", "blob"))):
                *columns, weights = unpack(blob, n, kind)
                h = np.zeros(n, np.uint64)
                for c in columns:
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64) + np.uint64(1))
                place = (h % np.uint64(parts[bucket])).astype(np.int64)
                rows = list(packed_rows(columns, weights, place))
                yield pa.RecordBatch.from_arrays([
                    pa.array([bucket] * len(rows), pa.int64()), pa.array([r[0] + 1 for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
                    ["bucket", "part", "n", "blob"])
    return run


# ---- counting by three-way partitions ----

def frequent_prefixes(columns: list[np.ndarray], weights: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(a pointer, words, count) for each prefix of 2 words or more that occurs `least` times or more."""
    found: list[tuple[int, int, int]] = []
    rng = np.random.RandomState(1)

    def direct(p: np.ndarray, depth: int):
        order = p[np.lexsort([c[p] for c in columns[depth:][::-1]])]
        new = np.append(True, np.zeros(len(order) - 1, bool))
        for d in range(depth, DEPTH):
            c = columns[d][order]
            new[1:] |= c[1:] != c[:-1]
            if d == 0:
                continue
            at = np.flatnonzero(new)
            sums = np.add.reduceat(weights[order], at)
            ok = (sums >= least) & (c[at] != 0)
            found.extend(zip(order[at[ok]].tolist(), [d + 1] * int(ok.sum()), sums[ok].tolist()))

    parts = [(np.arange(len(weights)), 0)]
    while parts:
        p, depth = parts.pop()
        if not len(p) or weights[p].sum() < least:
            continue
        if len(p) <= DIRECT:
            direct(p, depth)
            continue
        word = columns[depth][p]
        sample = np.sort(word[rng.randint(0, len(p), 15)])
        pivot = sample[7]
        same = p[word == pivot]
        parts += [(p[word < pivot], depth), (p[word > pivot], depth)]
        count = int(weights[same].sum())
        if pivot != 0 and count >= least:
            if depth:
                found.append((int(same[0]), depth + 1, count))
            if depth + 1 < DEPTH:
                parts.append((same, depth + 1))
    return found


PHRASES = "w array<long>, a long"


def count_bucket(dictionary, kind, least: int):
    """Packed suffixes of one bucket to its phrases and counts."""
    def run(rows: pa.Table) -> pa.Table:
        blobs = [unpack(b, n, kind) for b, n in zip(rows["blob"].to_pylist(), rows["n"].to_pylist())]
        *columns, weights = (np.concatenate(c) for c in zip(*blobs))
        # parts of a bucket dealt again hold parts of the counts of pairs and triples
        found = frequent_prefixes(columns, weights.astype(np.int64), least if rows["part"][0].as_py() == 0 else 1)
        names = None
        if dictionary is not None:
            known, ranks = dictionary.value
            names = np.zeros(len(known) + 1, np.uint64)
            names[ranks] = known
        words = []
        for p, size, _ in found:
            w = np.array([c[p] for c in columns[:size]])
            words.append((w if names is None else names[w]).astype(np.uint64).view(np.int64))
        return pa.table({"w": pa.array(words, pa.list_(pa.int64())),
                         "a": pa.array([a for *_, a in found], pa.int64())})
    return run


def phrase_counts(docs: DataFrame, words: DataFrame, least: int = LEAST, text: str = "text", lang: str = "lang",
                  bucket: int = BUCKET, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """(w, a): all phrases of 2 to `DEPTH` words with their counts, `least` or more."""
    spark = docs.sparkSession
    total, frequent = words.agg(F.sum("n"), F.count_if(F.col("n") >= least)).first()
    buckets = max(1, -(-(total or 0) // bucket))
    # a word this common is routed with the word behind it; there are at most 8 a bucket
    common = words.where(F.col("n") > bucket // 8).select("key").toArrow()["key"].to_numpy().view(np.uint64)
    if 12 * frequent <= dictionary_bytes:
        table = words.where(F.col("n") >= least).select("key", "n").toArrow()
        known, n = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
        order = np.argsort(known)
        known, n = known[order], n[order]
        if not len(known):
            return spark.createDataFrame([], PHRASES)
        ranks = np.zeros(len(known), np.uint32)
        ranks[np.lexsort((known, -n))] = np.arange(1, len(known) + 1)
        dictionary, kind = spark.sparkContext.broadcast((known, ranks)), np.uint32
        common = ranks[np.searchsorted(known, common)]
    else:
        dictionary, kind = None, np.uint64
    routed = docs.select(F.col(lang), F.col(text)).mapInArrow(
        route(dictionary, spark.sparkContext.broadcast(np.sort(common)), buckets), PACKED)
    routed = store(routed, "suffixes")
    # a part of a bucket is told for each bucket above twice the size: at most total / bucket of them
    large = {b: -(-n // bucket) for b, n in routed.groupBy("bucket").agg(F.sum("n").alias("n")).where(
        F.col("n") > 2 * bucket).collect()}
    if large:
        over = F.col("bucket").isin(list(large))
        routed = routed.where(~over).unionByName(
            routed.where(over).mapInArrow(deal_again(large, kind), PACKED))
    found = routed.groupBy("bucket", "part").applyInArrow(count_bucket(dictionary, kind, least), PHRASES)
    return found.groupBy("w").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


# ---- scores and ranks ----

def scored(phrases: DataFrame, words: DataFrame, contained: int = 80) -> DataFrame:
    """(w, a, l, r, score): the lowest cut of each phrase that no longer phrase holds `contained` percent of."""
    wide = "decimal(20,0)"
    parts = phrases.select("w", F.col("a").alias("f")).unionByName(
        words.where(F.col("n") >= 1).select(F.array("key").alias("w"), F.col("n").alias("f")))
    inner = phrases.where(F.size("w") > 2).select("w", F.col("a").alias("f"), F.explode(
        F.sequence(F.lit(2), F.size("w") - 1)).alias("size"))
    inner = inner.select("f", "size", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("i"))
    inner = inner.select(F.slice("w", F.col("i"), F.col("size")).alias("w"), "f").groupBy("w").agg(F.max("f").alias("held"))
    left = phrases.join(inner, "w", "left")
    left = left.where(F.col("held").isNull() | (
        F.col("held").cast(wide) * 100 < F.col("a").cast(wide) * contained)).drop("held")
    cuts = left.select("w", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("w", "a", "k", F.slice("w", F.lit(1), F.col("k")).alias("first"),
                       F.slice("w", F.col("k") + 1, F.size("w")).alias("rest"))
    cuts = (cuts.join(parts.select(F.col("w").alias("first"), F.col("f").alias("l")), "first")
            .join(parts.select(F.col("w").alias("rest"), F.col("f").alias("r")), "rest"))
    score = F.expr(f"(cast(a as {wide}) * cast(2000000 as decimal(7,0))) div (cast(l as {wide}) + cast(r as {wide}))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b")
    return cuts.groupBy("w", "a").agg(best).select("w", "a", "b.l", "b.r", F.col("b.score").cast("long").alias("score"))


def collocation_rows(docs: DataFrame, top: int = TOP, least: int = LEAST, **options) -> DataFrame:
    """The `top` phrases of each lang by score."""
    words = store(word_counts(docs), "words")
    phrases = store(phrase_counts(docs, words, least, **options), "phrases")
    used = words.where(F.col("n") >= least)  # no word of a phrase is rarer
    rows = store(scored(phrases, used), "collocations")
    named = rows.select("w", F.posexplode("w").alias("i", "key")).join(used.select("key", "lang", "word"), "key")
    named = named.groupBy("w").agg(
        F.first("lang").alias("lang"), F.concat_ws(" ", F.transform(
            F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"])).alias("phrase"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    rows = rows.join(named, "w").join(broadcast_if_small(totals), "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents) p),
starts AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM lists),
f AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f
    FROM starts, generate_series(1, 4) AS s(m) WHERE i + m - 1 <= len(ws) GROUP BY ALL),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 30),
held AS (SELECT lang, array_to_string(ws[i:i + s - 1], ' ') AS phrase, max(a) AS held FROM (
    SELECT lang, ws, a, m, s, unnest(generate_series(1, m - s + 1)) AS i
    FROM cand, generate_series(2, 3) AS g(s) WHERE s < m) x GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN held h USING (lang, phrase)
    WHERE held IS NULL OR 100 * held::HUGEINT < 80 * a::HUGEINT),
cuts AS (SELECT k.*, c, array_to_string(ws[1:c], ' ') AS p1, array_to_string(ws[c + 1:], ' ') AS p2
    FROM kept k, generate_series(1, 3) AS g(c) WHERE c < m),
best AS (SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, (2000000 * a::HUGEINT) // (x.f + y.f) AS score, c
    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p1 JOIN f y ON y.lang = cuts.lang AND y.phrase = p2),
one AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM one)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
    (SELECT sum(f.f) FROM f WHERE f.m = 1 AND f.lang = ranked.lang)::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
