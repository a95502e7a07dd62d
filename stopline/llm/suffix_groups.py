"""Removal of repeated byte strings, decided by linear grouping suffix sorting.

Every byte covered by a string of `LENGTH` bytes that also starts elsewhere goes.
The text is judged window by window of `LENGTH` bytes, and equal windows must
meet without shuffling windows:

1. Every window is owned by the `GRAM`-byte string in it with the least hash (the
   leftmost of equals), a choice that depends on the window alone. A task emits
   one anchor per owner: the string's hash, and a hash of all bytes its windows
   cover. Anchors whose string is found once end here. Anchors whose covered bytes
   are found twice have only repeated windows.
2. The rest lie at an edge of a repeated passage. Their windows are cut into blocks
   of `BLOCK`, and the same two tests are made with the bytes common to a block's
   windows and the bytes they cover.
3. Blocks that share their common bytes but not all covered bytes are sorted: the
   common bytes become one symbol, and the suffix array of the group's strings
   puts equal windows side by side. The array is built by grouping suffixes by
   their Lyndon prefixes in descending order with previous-smaller pointers, then
   emitting each group's order; there is no recursion and no renaming.

Hot strings only ever meet as counted hashes; counts are made before the shuffle.
Groups of more than `GROUP` different blocks are not sorted in one task: their
windows are counted by hash, which spreads them (`wide_groups`); exact as well.
Texts are shuffled twice at most: to their edge anchors, and to their spans.

Defined results. A null text is empty: no bytes, no spans, digest of nothing.
Matches never cross rows; a repeated row repeats the strings of the other, so both
lose them. Strings are judged on the input, not on what is left. Spans that
touch or overlap are one run.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import BASE, BASE_INVERSE, BYTE_CODES, mix, powers, signed, store, string_buffers

LENGTH = 400
BLOCK = 36
WINDOWS = 4 * BLOCK
GRAM = LENGTH + 1 - WINDOWS
GROUP = 512
SEGMENT = 1 << 20
SYMBOLS = 1 << 16


# ---- suffix sorting ----

def grouped_suffixes(text: list[int]) -> list[int]:
    """Suffix array of `text`, whose last symbol is its only least one.

    First the suffixes are put in groups by their Lyndon prefixes: groups are taken
    in descending order, each member's previous smaller suffix is found by pointers,
    and the suffixes pointed to are split off their groups, those pointed to more
    often above the others. Then the groups, which are in order, are filled from
    left to right.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n  # index in order
    start = [0] * n  # first index of a suffix's group
    size = [0] * (n + 1)
    begin = 0
    for i, s in enumerate(order):
        if text[s] != text[order[begin]]:
            begin = i
        place[s], start[s] = i, begin
        size[begin] += 1
    previous = [-1] * n
    end = n
    while end:
        begin = start[order[end - 1]]
        pointed: dict[int, int] = {}
        for s in sorted(order[begin:end]):
            p = s - 1
            while p >= 0 and start[p] >= begin:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            if len(pointed) == 1 or max(pointed.values()) == 1:
                classes = [list(pointed)]
            else:
                by_times: dict[int, list[int]] = {}
                for p, times in pointed.items():
                    by_times.setdefault(times, []).append(p)
                classes = [by_times[k] for k in sorted(by_times, reverse=True)]
            for members in classes:
                moved: dict[int, int] = {}
                for p in members:  # to the back of its group
                    g = start[p]
                    done = moved.get(g, 0) + 1
                    moved[g] = done
                    to, at = g + size[g] - done, place[p]
                    other = order[to]
                    order[to], order[at] = p, other
                    place[p], place[other] = to, at
                for g, count in moved.items():
                    size[g] -= count
                    new = g + size[g]
                    size[new] = count
                    for i in range(new, new + count):
                        start[order[i]] = new
        end = begin
    out = [-1] * n
    free = list(range(n))  # next index of the group that starts here
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = start[s]
            out[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = previous[s]
    return out


def repeated_windows(groups: list[list[tuple[bytes, bytes]]]) -> list[list[np.ndarray]]:
    """For every (left, right) of every group: for each j, whether the window of its last j
    left bytes, the group's common bytes and the first BLOCK - 1 - j right bytes is found in
    another pair of the group. A window that the bytes do not fill is not."""
    out: list[list[np.ndarray]] = []
    text: list[int] = []
    cores: list[tuple[int, np.ndarray]] = []  # core position, and where the answer goes

    def sort():
        if not cores:
            return
        data = np.array([*text, *[1] * BLOCK], np.int64)
        valid = np.full(len(text) + 1, -1, np.int64)
        for k, (core, mark, left, right) in enumerate(cores):
            j = np.arange(max(0, BLOCK - 1 - right), min(left, BLOCK - 1) + 1)
            valid[core - j] = k * BLOCK + j
        array = np.array(grouped_suffixes([*text, 0]))
        array = array[valid[array] >= 0]
        windows = data[array[:, None] + np.arange(BLOCK)[None, :]]
        same = (windows[1:] == windows[:-1]).all(1) if len(array) > 1 else np.zeros(0, bool)
        found = np.zeros(len(array), bool)
        found[1:] |= same
        found[:-1] |= same
        for code in valid[array[found]].tolist():
            cores[code // BLOCK][1][code % BLOCK] = True

    for g, pairs in enumerate(groups):
        if len(text) > SYMBOLS:
            sort()
            text, cores = [], []
        answers = []
        for left, right in pairs:
            mark = np.zeros(BLOCK, bool)
            answers.append(mark)
            cores.append((len(text) + len(left), mark, len(left), len(right)))
            text += [x + 2 for x in left]
            text.append(258 + g)
            text += [x + 2 for x in right]
            text.append(1)
        out.append(answers)
    sort()
    return out


# ---- hashes of strings in a text ----

_POWERS = powers(BASE, SEGMENT + LENGTH + 1)
_INVERSES = powers(BASE_INVERSE, SEGMENT + LENGTH + 1)
_SECOND = BYTE_CODES * np.uint64(0xA24BAED4963EE407) ^ (BYTE_CODES >> np.uint64(17))


class Hashes:
    """Hashes of any substring of a text of at most SEGMENT + LENGTH bytes."""

    def __init__(self, data: np.ndarray):
        self.one = self._sums(BYTE_CODES, data)
        self.two = None
        self.data = data

    @staticmethod
    def _sums(codes, data):
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * _POWERS[:len(data)], out=out[1:])
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.one[b] - self.one[a]) * _INVERSES[a])

    def strong(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """From two independent sums."""
        if self.two is None:
            self.two = self._sums(_SECOND, self.data)
        return mix(self.of(a, b) + mix((self.two[b] - self.two[a]) * _INVERSES[a] + (b - a).astype(np.uint64)))


def least_in_windows(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owners of the text's windows: position, first and last window, key, and hash of what they cover.

    A segment's last owner may have windows in the next one, which therefore starts at that owner's first.
    """
    found = []
    base, last = 0, len(data) - LENGTH
    while base <= last:
        part = data[base:base + SEGMENT + LENGTH - 1]
        n = len(part)
        hashes = Hashes(part)
        grams = np.arange(n - GRAM + 1)
        gram = hashes.of(grams, grams + GRAM)
        # the low bits hold the position: of equal hashes the leftmost is least
        owner = least_in_windows((gram & ~np.uint64(0x1FFFFF)) | grams.astype(np.uint64), WINDOWS)
        owner = (owner & np.uint64(0x1FFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        final = np.append(first[1:], len(owner)) - 1
        at = owner[first]
        cover = mix(hashes.strong(first, final + LENGTH) + (at - first).astype(np.uint64))
        whole = len(first) - (base + SEGMENT <= last)
        found.append(tuple(x[:whole] for x in (
            at + base, first + base, final + base, hashes.strong(at, at + GRAM), cover)))
        base = base + int(first[-1]) if whole < len(first) else last + 1
    return tuple(np.concatenate(x) for x in zip(*found))


def _arrays(columns: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(x) if x.dtype == np.uint64 else x.astype(np.int64)) for x in
         (np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns)], names=names)


def all_anchors(rows: DataFrame) -> DataFrame:
    """(d, t, at, first, final, key, cover) of every owner in `rows` (d, t, text)."""
    names = ["d", "t", "at", "first", "final", "key", "cover"]

    def run(batches):
        for batch in batches:
            d, t = (batch.column(c).to_numpy() for c in ("d", "t"))
            data, offsets = string_buffers(batch.column("text"))
            columns: list[list[np.ndarray]] = [[] for _ in names]
            held = 0
            for i in np.flatnonzero(np.diff(offsets) >= LENGTH).tolist():
                got = anchors(data[offsets[i]:offsets[i + 1]])
                n = len(got[0])
                for c, x in zip(columns, (np.full(n, d[i]), np.full(n, t[i]), *got)):
                    c.append(x)
                held += n
                if held > 200_000:
                    yield _arrays(columns, names)
                    columns, held = [[] for _ in names], 0
            yield _arrays(columns, names)

    return rows.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def blocks_of(data: np.ndarray, edges: list[dict]) -> list[tuple]:
    """The blocks of some owners of one text: key, cover, least window, left and right bytes, open."""
    out = []
    size = len(data)
    for e in edges:
        at = e["at"]
        low = max(0, at - 2 * LENGTH)
        hashes = Hashes(data[low:at + 2 * LENGTH])
        for g in range((at - e["final"]) // BLOCK, (at - e["first"]) // BLOCK + 1):
            a = at - BLOCK * g  # common bytes: a .. a + LENGTH - BLOCK + 1
            b = a + LENGTH - BLOCK + 1
            left, right = max(0, a - BLOCK + 1), min(size, b + BLOCK - 1)
            x = np.array([a, left, b], np.int64) - low
            y = np.array([b, a, right], np.int64) - low
            core, one, two = hashes.strong(x, y)
            mark = np.array([(e["key"] + g) & (1 << 64) - 1], np.uint64)
            key = mix(mix(mark) + core)
            cover = mix(mix(one + key) + two)
            out.append((int(signed(key)[0]), int(signed(cover)[0]), a, data[left:a].tobytes(),
                        data[b:right].tobytes(), e["open"]))
    return out


def edge_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of `rows` (d, t, text, edges)."""
    kinds = {"d": pa.int64(), "t": pa.int64(), "key": pa.int64(), "cover": pa.int64(), "a": pa.int64(),
             "l": pa.binary(), "r": pa.binary(), "open": pa.bool_()}

    def run(batches):
        for batch in batches:
            data, offsets = string_buffers(batch.column("text"))
            out = []
            for i, (d, t, edges) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("d", "t", "edges")))):
                out += [(d, t, *b) for b in blocks_of(data[offsets[i]:offsets[i + 1]], edges)]
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())],
                                             names=list(kinds))

    return rows.select("d", "t", "text", "edges").mapInArrow(
        run, "d bigint, t bigint, key bigint, cover bigint, a bigint, l binary, r binary, open boolean")


def sorted_groups(groups: DataFrame) -> DataFrame:
    """Spans of open blocks (d, t, x, y) from `groups` (members: open, d, t, a, l, r)."""
    def run(batches):
        for batch in batches:
            members = batch.column("members").to_pylist()
            marks = repeated_windows([[(m["l"], m["r"]) for m in g] for g in members])
            out = []
            for g, answers in zip(members, marks):
                for m, mark in zip(g, answers):
                    if m["open"] and mark.any():
                        j = np.flatnonzero(mark)
                        for run_ in np.split(j, np.flatnonzero(np.diff(j) > 1) + 1):
                            out.append((m["d"], m["t"], m["a"] - int(run_[-1]), m["a"] - int(run_[0]) + LENGTH))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["d", "t", "x", "y"])

    return groups.select("members").mapInArrow(run, "d bigint, t bigint, x bigint, y bigint")


def wide_groups(members: DataFrame) -> DataFrame:
    """The same for the members of large groups: every window is counted by its hash."""
    j = F.col("j")
    windows = (members.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(BLOCK - 1))))
               .where((j <= F.octet_length("l")) & (F.lit(BLOCK - 1) - j <= F.octet_length("r")))
               .withColumn("w", F.xxhash64(
                   "key", "j", F.substring(F.col("l"), F.octet_length("l") - j + 1, j),
                   F.substring(F.col("r"), F.lit(1), F.lit(BLOCK - 1) - j))))
    twice = windows.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w")
    return windows.where("open").join(twice, "w").select(
        "d", "t", (F.col("a") - j).alias("x"), (F.col("a") - j + LENGTH).alias("y"))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(d, t, x, y): spans of bytes whose windows are found elsewhere; they may overlap."""
    found = store(all_anchors(rows), "anchors")
    again = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = store(found.join(again, "key"), "again")
    row = F.struct("d", "t", "at", "first", "final")
    same = store(found.groupBy("key", "cover").agg(F.count("*").alias("n"), F.min(row).alias("row")), "covers")
    whole = (found.join(same.where("n > 1").select("key", "cover"), ["key", "cover"])
             .select("d", "t", F.col("first").alias("x"), (F.col("final") + LENGTH).alias("y")))
    # strings with several covers of which one is found once: all covers, one row each
    edge = same.groupBy("key").agg(F.count("*").alias("m"), F.min("n").alias("n")).where("m > 1 and n = 1")
    edges = (same.join(edge.select("key"), "key")
             .groupBy("row.d", "row.t").agg(F.collect_list(F.struct(
                 "row.at", "row.first", "row.final", "key", (F.col("n") == 1).alias("open"))).alias("edges")))
    blocks = store(edge_blocks(rows.join(edges, ["d", "t"])), "blocks")
    again = blocks.groupBy("key").agg(F.count("*").alias("n"), F.max("open").alias("open")).where("n > 1 and open")
    blocks = blocks.join(again.select("key"), "key")
    block = F.struct("d", "t", "a", "l", "r", "open")
    same = store(blocks.groupBy("key", "cover").agg(F.count("*").alias("n"), F.min(block).alias("b")), "block-covers")
    sure = (blocks.where("open").join(same.where("n > 1").select("key", "cover"), ["key", "cover"])
            .select("d", "t", "a", F.octet_length("l").alias("nl"), F.octet_length("r").alias("nr"))
            .select("d", "t", (F.col("a") - F.col("nl")).alias("x"),
                    (F.col("a") + (LENGTH - BLOCK + 1) + F.col("nr")).alias("y")).where(F.col("y") - F.col("x") >= LENGTH))
    members = same.select("key", "b.d", "b.t", "b.a", "b.l", "b.r", (F.col("b.open") & (F.col("n") == 1)).alias("open"))
    sizes = members.groupBy("key").agg(F.count("*").alias("m"), F.max("open").alias("any")).where("m > 1 and any")
    members = store(members.join(sizes.select("key", "m"), "key"), "members")
    small = members.where(F.col("m") <= GROUP).groupBy("key").agg(
        F.collect_list(F.struct("open", "d", "t", "a", "l", "r")).alias("members"))
    spans = whole.unionByName(sure).unionByName(sorted_groups(small))
    return spans.unionByName(wide_groups(members.where(F.col("m") > GROUP)))


def with_spans(docs: DataFrame, into: str = "spans", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`docs` with `into`, the overlapping spans to remove; null where there are none."""
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    d = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    t = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(d.alias("d"), t.alias("t"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = repeated_spans(rows).distinct().groupBy("d", "t").agg(F.collect_list(F.struct("x", "y")).alias(into))
    kept = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], d.alias("d"), t.alias("t"))
    done = kept.join(spans, ["d", "t"], "left")
    return done.select(*[F.col(n).alias(c) for c, n in names.items()], into)


def runs_of(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["x"], s["y"]) for s in spans or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`docs` with the repeated bytes taken out of the text; a cut character is left out whole."""
    into = "_spans"
    done = with_spans(docs, into, text, doc_id)
    names, place = docs.columns, docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = [None if x is None else kept_bytes(x.encode(), runs_of(s)).decode(errors="ignore")
                     for x, s in zip(batch.column(text).to_pylist(), batch.column(into).to_pylist())]
            columns = [batch.column(c) for c in names]
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return done.mapInArrow(run, docs.schema)


def digest_rows(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, bytes removed, runs removed, and a digest of what is left."""
    def run(batches):
        for batch in batches:
            out = []
            for x, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data, runs = (x or "").encode(), runs_of(spans)
                out.append((len(data), sum(b - a for a, b in runs), len(runs),
                            hashlib.sha256(kept_bytes(data, runs)).hexdigest()))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    docs = docs.select("doc_id", "text")
    return with_spans(docs).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
