"""Benchmark decontamination with suffix arrays of the training text.

Every task is a run of whole documents, the shard. The shard's suffixes are
sorted by their first `window` words, and every benchmark suffix is found in
that suffix array by binary search; a found range is the list of locations.
Matches are then lengthened word by word to the longest verbatim match. Suffixes
whose first words start no benchmark suffix are left out of the array, since no
search can end at them. No document row is shuffled.

The benchmark is the stated query set: it is taken in blocks of about
`BLOCK_BYTES`, each broadcast for one pass over the documents.

Defined results. Null and empty texts have no words and no hits. An item
shorter than the window, but not empty, is one window; null and empty items
are none. Repeated document rows each give their own row; repeated item ids
count once. Other columns of the documents are kept as they are.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.llm.common import BASE, WORDS, mix, store, string_buffers, text_chunks, word_hashes

WINDOW = 10
BLOCK_BYTES = 16 << 20
_LEAD, _BITS = 3, 1 << 20

REPORT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()), T.StructField("doc_word", T.LongType()),
        T.StructField("item_word", T.LongType()), T.StructField("n_words", T.LongType())]))),
])


class TestSuffixes:
    """The suffixes of one block of items, over the ranks of the block's own words."""

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        data, offsets = string_buffers(pa.array(texts, pa.string()))
        words, rows = word_hashes(data, offsets, WORDS)
        self.window, self.ids, self.rows = window, ids, rows
        self.vocabulary = np.unique(words)
        self.ranks = (np.searchsorted(self.vocabulary, words) + 1).astype(np.uint32)
        sizes = np.diff(rows)
        self.item = np.repeat(np.arange(len(ids)), sizes)
        left = np.repeat(rows[1:], sizes) - np.arange(len(words))  # words to the item's end
        whole = np.repeat(np.minimum(sizes, window), sizes)
        start = np.flatnonzero(left >= whole)
        self.start, self.size = start, whole[start]
        self.lead = int(min(_LEAD, self.size.min())) if len(start) else 0
        if self.lead:
            self.bits = np.zeros(_BITS, bool)
            self.bits[(lead_codes(self.ranks, self.lead)[start] & np.uint64(_BITS - 1)).astype(np.int64)] = True
            low = suffix_matrix(self.ranks, start, start + self.size, window)
            high = low.copy()
            high[np.arange(window)[None, :] >= self.size[:, None]] = 0xFFFFFFFF
            self.low, self.high = sort_keys(low), sort_keys(high)


def lead_codes(ranks: np.ndarray, size: int) -> np.ndarray:
    """A code of the `size` ranks from each position on; past the end they count as 0."""
    out = np.zeros(len(ranks), np.uint64)
    for i in range(size):
        out *= np.uint64(BASE)
        out[:len(ranks) - i] += ranks[i:]
    return mix(out)


def suffix_matrix(ranks: np.ndarray, start: np.ndarray, end: np.ndarray, window: int) -> np.ndarray:
    """The first `window` ranks of each suffix; 0 past its end."""
    at = start[:, None] + np.arange(window)[None, :]
    return np.where(at < end[:, None], ranks[np.minimum(at, len(ranks) - 1)], 0).astype(np.uint32)


def sort_keys(matrix: np.ndarray) -> np.ndarray:
    """Rows of ranks as byte strings that sort as the rows do."""
    return np.ascontiguousarray(matrix.astype(">u4")).view(f"S{4 * matrix.shape[1]}").ravel()


def search(test: TestSuffixes, data: np.ndarray, offsets: np.ndarray):
    """Word count of each row, and all (document position, test suffix) matches of a shard."""
    words, rows = word_hashes(data, offsets, WORDS)
    none = np.zeros(0, np.int64)
    if not test.lead or not len(words):
        return rows, np.zeros(0, np.uint32), none, none
    near = np.minimum(np.searchsorted(test.vocabulary, words), len(test.vocabulary) - 1)
    ranks = np.where(test.vocabulary[near] == words, near + 1, 0).astype(np.uint32)
    codes = lead_codes(ranks, test.lead) & np.uint64(_BITS - 1)
    start = np.flatnonzero(test.bits[codes.astype(np.int64)])
    if not len(start):
        return rows, ranks, none, none
    ends = rows[np.searchsorted(rows, start, side="right")]
    keys = sort_keys(suffix_matrix(ranks, start, ends, test.window))
    order = np.argsort(keys, kind="stable")  # the suffix array
    suffixes, keys = start[order], keys[order]
    low = np.searchsorted(keys, test.low, side="left")
    counts = np.maximum(np.searchsorted(keys, test.high, side="right") - low, 0)
    which = np.repeat(np.arange(len(low)), counts)
    at = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return rows, ranks, suffixes[at], which


def row_reports(test: TestSuffixes, column: pa.Array) -> list[tuple]:
    out = []
    for first, last, data, offsets in text_chunks(column):
        rows, ranks, at, which = search(test, data, offsets)
        row = np.searchsorted(rows, at, side="right") - 1
        begin, size = test.start[which], test.size[which]
        item = test.item[begin]
        # lengthen every match: it ends where the row, the item or the agreement ends
        longest, open_ = size.copy(), np.arange(len(at))
        row_end, item_end = rows[row + 1], test.rows[item + 1]
        while len(open_):
            d, t = at[open_] + longest[open_], begin[open_] + longest[open_]
            inside = (d < row_end[open_]) & (t < item_end[open_])
            open_ = open_[inside][ranks[d[inside]] == test.ranks[t[inside]]]
            longest[open_] += 1
        by = np.argsort(row, kind="stable")
        edge = np.searchsorted(row[by], np.arange(last - first + 1))
        n_words = np.diff(rows)
        for i in range(last - first):
            mine = by[edge[i]:edge[i + 1]]
            if not len(mine):
                out.append((int(n_words[i]), [], []))
                continue
            begins = at[mine] - rows[i]
            spans = merge_spans(np.stack([begins, begins + longest[mine]], 1))
            best = {}
            for j, m in enumerate(mine.tolist()):
                got = (int(longest[m]), -int(begins[j]), -int(begin[m] - test.rows[item[m]]))
                name = test.ids[item[m]]
                best[name] = max(best.get(name, got), got)
            out.append((int(n_words[i]), spans, [(k, -d, -t, n) for k, (n, d, t) in sorted(best.items())]))
    return out


def merge_spans(spans: np.ndarray) -> list[tuple[int, int]]:
    """Union of half-open intervals, in order."""
    if not len(spans):
        return []
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.append(True, spans[1:, 0] > reach[:-1]))
    return list(zip(spans[new, 0].tolist(), reach[np.append(new[1:] - 1, len(spans) - 1)].tolist()))


def contamination(docs: DataFrame, benchmark: DataFrame, into: str = "report", window: int = WINDOW,
                  text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """`docs` with a struct column `into`: n_words, n_hit, hit spans of words (half open),
    and for each item that occurs its longest verbatim match and where it lies."""
    if into in docs.columns:
        raise ValueError(f"the documents have a column {into}")
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"),
                             F.col(item_text).alias("x")).where("x is not null")
    total = items.agg(F.sum(F.octet_length("x") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    out = docs
    schema = T.StructType([*docs.schema.fields, T.StructField(into, REPORT)])
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("i", "x"), F.lit(blocks)) == block) if blocks > 1 else items
        rows = sorted(part.collect())  # a block, so bounded
        sent = docs.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows], window))
        out = out.mapInArrow(_pass(sent, text, into, schema), schema)
        if block + 1 < blocks:
            out = store(out, "contamination")
    return out


def _pass(sent, text: str, into: str, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(schema[into].dataType)

    def run(batches):
        test = TestSuffixes(*sent.value)
        for batch in batches:
            new = row_reports(test, batch.column(text))
            old = batch.column(into).to_pylist() if into in batch.schema.names else [None] * len(new)
            reports = []
            for (n, spans, matches), before in zip(new, old):
                if before is not None:
                    spans = merge_spans(np.array([(s["first"], s["last"]) for s in before["spans"]] + spans,
                                                 np.int64).reshape(-1, 2))
                    best = {m["item_id"]: tuple(m.values()) for m in before["matches"]}
                    for m in matches:
                        best[m[0]] = max(best.get(m[0], m), m, key=lambda x: x[3])
                    matches = [best[k] for k in sorted(best)]
                reports.append({
                    "n_words": n, "n_hit": sum(b - a for a, b in spans),
                    "spans": [{"first": a, "last": b} for a, b in spans],
                    "matches": [dict(zip(("item_id", "doc_word", "item_word", "n_words"), m)) for m in matches]})
            names = [n for n in batch.schema.names if n != into]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(reports, kind)],
                                             names=[*names, into])
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of a benchmark item occurs, with their own columns."""
    into = "contamination_report"
    while into in docs.columns:
        into += "_"
    return contamination(docs, benchmark, into, **options).where(F.col(f"{into}.n_hit") == 0).drop(into)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def digest_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: counts of words, hit words and items, and a digest of the items."""
    done = contamination(docs.select("doc_id", "text"), benchmark)
    ids = F.array_sort(F.transform("report.matches", lambda m: m["item_id"]))
    return done.select(
        "doc_id", F.col("report.n_words").alias("n_words"), F.col("report.n_hit").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
        (F.col("report.n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS ws FROM documents),
b AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS win
    FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, p, k, array_to_string(ws[p:p + k - 1], ' ') AS win
    FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM w, ks WHERE len(ws) >= k)),
m AS (SELECT r, p, k, item_id FROM dw JOIN bw USING (k, win)),
hit AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(p, p + k)) AS i FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM m) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
