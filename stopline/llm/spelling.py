"""Spelling variants: words one edit apart, found in a bidirectional FM-index, grouped under common forms.

The vocabulary is counted in Spark. A word one edit away from w keeps one half of w
whole, so every word is a query twice, under its left half and under its right half,
and is indexed under each half that a query one letter longer or shorter would have.
Keys are dealt to shards. A task lays its shard's words out as one delimited text and
indexes it and its mirror image (`Index`). A query matches one half letter by letter
outwards from the middle, up to the delimiter, while the interval of suffix ranks in
the mirror image is kept in step; from that interval it goes on across the other half,
allowing one inserted, deleted or replaced letter, up to the other delimiter. What is
left of an interval names the words found. A word found by its left half is not
counted again by its right half.

Shards hold about `SHARD` words. The words of a key with more than that are dealt to a
grid of parts, each part of the queries meeting each part of the words, so no task
holds more. A word has at most (2 * letters + 1) * alphabet neighbours, and they are
folded to a count and the best one before they leave the task.

Defined results. Null texts have no words, a null id counts as an empty one. Repeated rows are
counted as rows. Among near words of equal count the first in code-point order is the
form. Texts of any length are read whole. Without documents there are no words. Other columns are
not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import store
from stopline.session import broadcast_if_small

LETTERS = "A-Za-zÀ-ÿ"
TYPO = 199
LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
SHARD = 40_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---- vocabulary ----

def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", letters: int = LEAST_LETTERS,
               least: int = LEAST_COUNT, typo: int | None = TYPO) -> DataFrame:
    """(word, n): words of at least `letters` code points that occur `least` times or more.

    With `typo`, the occurrences of a word in a document whose checksum it divides lack one letter.
    """
    # a word that loses a letter has one more before
    runs = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"([{LETTERS}]{{{letters},}})"), 1)
    words = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("word"))
    if typo:
        h = F.crc32(F.concat("d", F.lit(":"), "word"))
        at = F.pmod(h, F.length("word")).cast("int")
        words = words.withColumn("word", F.when(h % typo == 0, F.concat(
            F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))).otherwise(F.col("word")))
    return (words.where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least))


# ---- the index of one shard ----

def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Suffix array by doubling: ranks of prefixes of 1, 2, 4, ... letters until all differ."""
    n = len(codes)
    rank = codes.astype(np.int64)
    step = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:max(n - step, 0)] = rank[step:] + 1
        both = rank * (int(rank.max()) + 2 if n else 1) + ahead
        order = np.argsort(both, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(both[order[1:]] != both[order[:-1]])
        rank = new
        if n < 2 or rank[order[-1]] == n - 1:
            return order
        step *= 2


class Side:
    """One direction of the index: suffix ranks of a text and the letters before them.

    The letters are kept bit by bit, the highest first, each level sorted by the bits above;
    one walk down the levels counts a letter and all smaller ones in many intervals at once.
    """

    def __init__(self, codes: np.ndarray, letters: int):
        self.order = suffix_order(codes)
        self.before = codes[self.order - 1]
        self.letters = letters
        self.first = np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=letters))))
        self.levels = []
        at = self.before
        for bit in reversed(range(max(1, (letters - 1).bit_length()))):
            ones = (at >> bit) & 1
            zeros = np.concatenate(([0], np.cumsum(1 - ones)))
            self.levels.append((bit, zeros, int(zeros[-1])))
            at = at[np.argsort(ones, kind="stable")]
        self.starts = self._walk(np.zeros(letters, np.int64), np.zeros(letters, np.int64), np.arange(letters))[0]

    def _walk(self, lo, hi, c):
        smaller = np.zeros(len(lo), np.int64)
        for bit, zeros, total in self.levels:
            zlo, zhi = zeros[lo], zeros[hi]
            one = (c >> bit) & 1 == 1
            smaller += np.where(one, zhi - zlo, 0)
            lo = np.where(one, total + lo - zlo, zlo)
            hi = np.where(one, total + hi - zhi, zhi)
        return lo, hi, smaller

    def extend(self, lo, hi, c):
        """The intervals once letter c stands before what they match, and how many smaller letters do."""
        a, b, smaller = self._walk(lo, hi, c)
        base = self.first[c] - self.starts[c]
        return base + a, base + b, smaller

    def children(self, lo, hi):
        """(interval, letter) for every letter that stands before a suffix of an interval."""
        wide = hi - lo > self.letters
        narrow = np.flatnonzero(~wide)
        sizes = (hi - lo)[narrow]
        which = np.repeat(narrow, sizes)
        at = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[which]
        pairs = which * self.letters + self.before[at]
        all_letters = np.repeat(np.flatnonzero(wide), self.letters) * self.letters
        all_letters = all_letters + np.tile(np.arange(self.letters), int(wide.sum()))
        pairs = np.unique(np.concatenate((pairs, all_letters)))
        return pairs // self.letters, pairs % self.letters


class Index:
    """A delimited vocabulary, indexed forwards and backwards. Letter 0 delimits."""

    def __init__(self, words: list[str], others: list[str] = ()):
        self.words = words
        text = "\0" + "".join(w + "\0" for w in words)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        used = np.unique(np.concatenate(
            (points, np.frombuffer("".join(others).encode("utf-32-le"), np.uint32))))
        self.code = {chr(p): i for i, p in enumerate(used)}
        codes = np.searchsorted(used, points)
        self.size = len(codes)
        self.at = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words]))).astype(np.int64)
        self.sides = Side(codes, len(used)), Side(codes[::-1].copy(), len(used))

    def coded(self, words: list[str], width: int) -> np.ndarray:
        """Letters of the words, padded with delimiters to one more than `width`."""
        out = np.zeros((len(words), width + 1), np.int64)
        for i, w in enumerate(words):
            out[i, :len(w)] = [self.code[x] for x in w]
        return out

    def one_error(self, words: list[str], mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, indexed word): words with the same left half (right half if `mirrored`) and one error beyond."""
        if not words or not self.words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        near, far = self.sides[::-1] if mirrored else self.sides
        cuts = [len(w) // 2 for w in words]
        heads = [w[k:] if mirrored else w[:k][::-1] for w, k in zip(words, cuts)]
        tails = [w[:k][::-1] if mirrored else w[k:] for w, k in zip(words, cuts)]
        q, lo, hi = self._exact(near, heads)
        tail_sizes = np.array([len(t) for t in tails])
        tail = self.coded(tails, max(len(t) for t in tails))
        # one error at each place of the other half, then the rest exactly
        found = [[], [], [], []]  # query, interval, letters of the tail used

        def branch(mask, a, b, used):
            for part, x in zip(found, (q[mask], a, b, used)):
                part.append(x)

        for j in range(tail.shape[1]):
            inside = j < tail_sizes[q]
            here = tail[q, j]
            which, c = far.children(lo, hi)
            other = (c != 0) & (c != here[which])
            which, c = which[other], c[other]
            a, b, _ = far.extend(lo[which], hi[which], c)
            branch(which, a, b, np.full(len(which), j))  # inserted
            put = inside[which]
            branch(which[put], a[put], b[put], np.full(int(put.sum()), j + 1))  # replaced
            ahead = tail[q, np.minimum(j + 1, tail.shape[1] - 1)]
            gone = np.flatnonzero(inside & (here != ahead))
            branch(gone, lo[gone], hi[gone], np.full(len(gone), j + 1))  # deleted; of equal letters the last
            q, lo, hi = q[inside], lo[inside], hi[inside]
            lo, hi, _ = far.extend(lo, hi, here[inside])
            alive = hi > lo
            q, lo, hi = q[alive], lo[alive], hi[alive]
        q, lo, hi, used = (np.concatenate(x) for x in found)
        done = [np.zeros(0, np.int64)] * 3
        while len(q):
            last = used == tail_sizes[q]
            lo, hi, _ = far.extend(lo, hi, tail[q, used])
            used = used + 1
            alive = hi > lo
            end = alive & last
            done = [np.concatenate((x, y[end])) for x, y in zip(done, (q, lo, hi))]
            on = alive & ~last
            q, lo, hi, used = q[on], lo[on], hi[on], used[on]
        q, lo, hi = done
        which = np.repeat(q, hi - lo)
        at = np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
        place = far.order[at]  # where the delimited word starts, read from its far end
        row = (np.searchsorted(self.at, place) if mirrored
               else np.searchsorted(self.at, self.size - 1 - place) - 1)
        return which, row

    def _exact(self, near: Side, heads: list[str]):
        """Match whole halves outwards; (query, interval in the mirror image) of those found with their delimiter."""
        size = np.array([len(h) for h in heads])
        head = self.coded(heads, int(size.max()))
        q = np.arange(len(heads))
        lo, hi, far_lo = np.zeros(len(q), np.int64), np.full(len(q), self.size), np.zeros(len(q), np.int64)
        out = [np.zeros(0, np.int64)] * 3
        for i in range(head.shape[1]):
            lo, hi, smaller = near.extend(lo, hi, head[q, i])
            far_lo = far_lo + smaller
            alive = hi > lo
            end = alive & (size[q] == i)
            out = [np.concatenate((x, y[end])) for x, y in zip(out, (q, far_lo, far_lo + hi - lo))]
            on = alive & ~end
            q, lo, hi, far_lo = q[on], lo[on], hi[on], far_lo[on]
        return out


# ---- all words against all words ----

def routed(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """(shard, key, mirrored, asks, word, n): queries and indexed words, met by a common half."""
    size, word = F.length("word"), F.col("word")

    def row(mirrored: bool, asks: bool, length):
        # the half that a query of this length keeps: its left one is the shorter
        k = F.floor((length + int(mirrored)) / 2).cast("int")
        half = word.substr(size - k + 1, k) if mirrored else word.substr(F.lit(1), k)
        return F.struct(F.xxhash64(F.lit(mirrored), half).alias("key"), F.lit(mirrored).alias("mirrored"),
                        F.lit(asks).alias("asks"), k.alias("k"))

    rows = F.array_distinct(F.array(*[
        r for m in (False, True) for r in (row(m, True, size), *(row(m, False, size + d) for d in (-1, 0, 1)))]))
    rows = words.select("word", "n", F.explode(rows).alias("r")).select("word", "n", "r.key", "r.mirrored", "r.asks")
    rows = store(rows, "routed-words")
    counts = rows.groupBy("key").agg(F.count_if(~F.col("asks")).alias("c"))
    hot = store(counts.where(F.col("c") > shard).select(
        "key", F.ceil(F.col("c") / shard).cast("int").alias("parts")), "hot-halves")
    total = rows.where("not asks").count()
    shards = max(1, -(-total // shard))
    split = rows.join(broadcast_if_small(hot), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    # a grid of parts: each part of the queries meets each part of the words
    mine = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    split = split.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = [F.when(F.col("asks"), F.col(a)).otherwise(F.col(b)) for a, b in (("mine", "other"), ("other", "mine"))]
    place = F.when(F.col("parts") > 1, F.xxhash64("key", *cell)).otherwise(F.pmod("key", F.lit(shards)))
    return split.select(place.alias("shard"), "key", "mirrored", "asks", "word", "n")


FOUND = "word string, n long, n_near long, form string, form_n long"


def search_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """For each query of a shard: how many words it finds, and the best of them."""
    rows = rows.sort_values(["word", "key"], kind="stable")
    indexed, asking = rows[~rows.asks], rows[rows.asks].reset_index(drop=True)
    words = indexed.word.tolist()
    names, keys, counts = np.array(words, object), indexed.key.to_numpy(), indexed.n.to_numpy()
    index = Index(words, asking.word.tolist())
    hits = []
    for mirrored in (False, True):
        at = np.flatnonzero(asking.mirrored.to_numpy() == mirrored)
        queries = asking.word.to_numpy()[at].tolist()
        q, row = index.one_error(queries, mirrored)
        ok = keys[row] == asking.key.to_numpy()[at[q]] if len(q) else np.zeros(0, bool)
        if mirrored and len(q):  # words with the same left half are found by that
            ok &= np.array([names[r][:len(queries[i]) // 2] != queries[i][:len(queries[i]) // 2]
                            for i, r in zip(q, row)], bool)
        hits.append((at[q[ok]], row[ok]))
    q, row = (np.concatenate(x) for x in zip(*hits))
    # rows are in word order, so the first of the greatest counts is the first by name
    order = np.lexsort((row, -counts[row], q))
    q, row = q[order], row[order]
    first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    near = np.bincount(q, minlength=len(asking))
    form = np.full(len(asking), None, object)
    form_n = np.zeros(len(asking), np.int64)
    form[q[first]], form_n[q[first]] = names[row[first]], counts[row[first]]
    return pd.DataFrame({"word": asking.word, "n": asking.n, "n_near": near, "form": form,
                         "form_n": pd.array(form_n, "Int64")}).assign(
        form_n=lambda d: d.form_n.where(pd.notna(d.form)))


def near_words(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """(word, n, n_near, near, near_n): the number of words one edit apart, and the most frequent of them."""
    found = routed(words, shard).groupBy("shard").applyInPandas(search_shard, FOUND)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct(
        (-F.col("form_n")).alias("m"), F.col("form").alias("w"))))
    return found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n", "n_near", F.col("b.w").alias("near"), (-F.col("b.m")).alias("near_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for links (word, form): forms followed to the last, twice as far each round."""
    now = store(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = store(now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        if not now.where("moved").head(1):
            return now.drop("moved")
        now = now.drop("moved")


def variant_rows(docs: DataFrame, times: int = TIMES, shard: int = SHARD, **options) -> DataFrame:
    """One row per word: its form, the last form behind that, and its neighbours."""
    words = store(vocabulary(docs, **options), "vocabulary")
    near = near_words(words, shard)
    much = F.col("near_n").cast("decimal(20,0)") >= F.col("n").cast("decimal(20,0)") * times
    rows = store(near.select("word", "n", "n_near", F.when(much, F.col("near")).alias("form"),
                             F.when(much, F.col("near_n")).alias("form_n")), "variants")
    last = roots(rows.where("form is not null"))
    return rows.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
