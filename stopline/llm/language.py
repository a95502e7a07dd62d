"""Language shares of a document: a mixture of n-gram models, fitted by expectation-maximisation.

Every language is a smoothed multinomial over hashed byte trigrams of lower-cased
text, other than letters folded to single blanks. A document's trigrams are taken as
a mixture of languages. The set of languages starts with the likeliest one and
grows by the language with the steepest gain while the log-likelihood, fitted by
EM, rises by more than the penalty `PENALTY * log(trigrams)`.

Models are fitted on a bounded sample: about `SAMPLE` documents of each language,
chosen by a hash of the id. All documents are predicted, over their whole texts,
in one pass without a shuffle; the models are languages x `BUCKETS` numbers.

Defined results. A null text, or one without a letter, is `und` with score 0; so
is every text if nothing could be learnt. Of equally likely languages the first
by name wins. Repeated rows are predicted alike. The score is the share of the
predicted language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import text_chunks

BUCKETS = 1 << 16
SAMPLE = 5_000
PENALTY = 3.0
ROUNDS = 40
LEAST_SHARE = 0.02
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True


def trigram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of each row, and the offset of each row's first."""
    folded = np.where(_LETTER[data], data, 32).astype(np.uint32)
    blank = folded == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # of a run of blanks, the first
    begins = np.concatenate(([0], np.cumsum(keep)))[offsets]
    x = folded[keep]
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    codes = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    codes = ((codes * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)
    inside = np.ones(len(codes), bool)
    for back in (1, 2):  # trigrams over a row's end
        cut = begins[1:-1] - back
        inside[cut[(cut >= 0) & (cut < len(codes))]] = False
    total = np.concatenate(([0], np.cumsum(inside)))
    return codes[inside], total[np.minimum(begins, len(codes))]


class Model:
    """Probabilities of the buckets in each language, names in order."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smooth = counts + 0.1
        self.p = smooth / smooth.sum(1, keepdims=True)
        self.log_p = np.log(self.p).astype(np.float32)

    def shares(self, codes: np.ndarray, single: np.ndarray) -> dict[int, float]:
        """Languages of a document and their shares; single: log-likelihood of each alone."""
        chosen = [int(np.argmax(single))]
        best, weights = float(single[chosen[0]]), np.ones(1)
        if len(self.names) == 1 or not len(codes):
            return {chosen[0]: 1.0}
        grams, n = np.unique(codes, return_counts=True)
        p = self.p[:, grams]
        total, cost = n.sum(), PENALTY * np.log(max(2, n.sum()))
        mixed = p[chosen[0]]
        while len(chosen) < len(self.names):
            slope = p @ (n / mixed)
            slope[chosen] = 0
            new = int(np.argmax(slope))
            if slope[new] <= total:  # no share of any other language raises the likelihood
                break
            trial = [*chosen, new]
            w, q = np.append(weights * 0.9, 0.1), p[trial]
            for _ in range(ROUNDS):
                mixed_new = w @ q
                w_new = w * (q @ (n / mixed_new)) / total
                done = np.abs(w_new - w).max() < 1e-4
                w = w_new
                if done:
                    break
            mixed_new = w @ q
            gain = float(n @ np.log(mixed_new)) - float(n @ np.log(mixed))
            if gain <= cost:
                break
            chosen, weights, mixed, best = trial, w, mixed_new, best + gain
        keep = weights >= LEAST_SHARE
        weights = weights[keep] / weights[keep].sum()
        return dict(zip(np.array(chosen)[keep].tolist(), weights.tolist()))

    def predict(self, column: pa.Array) -> tuple[list[str], list[float], list[list[dict]]]:
        lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_pylist()
        names, scores, all_shares = [], [], []
        for first, last, data, offsets in text_chunks(pc.utf8_lower(column)):
            codes, at = trigram_codes(data, offsets)
            single = np.stack([row_sums(self.log_p[k][codes], at) for k in range(len(self.names))], 1)
            for i in range(last - first):
                if not lettered[first + i]:
                    shares = {}
                else:
                    shares = self.shares(codes[at[i]:at[i + 1]], single[i])
                by_size = sorted(shares.items(), key=lambda x: (-x[1], x[0]))
                names.append(self.names[by_size[0][0]] if by_size else "und")
                scores.append(min(1.0, by_size[0][1]) if by_size else 0.0)
                all_shares.append([{"lang": self.names[k], "share": s} for k, s in by_size])
        return names, scores, all_shares


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[at[1:]] - total[at[:-1]]


def trigram_counts(rows: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, bucket, n) over whole texts; each task counts its rows before the shuffle."""
    def count(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(lang).to_pylist()
            for first, last, data, offsets in text_chunks(pc.utf8_lower(batch.column(text))):
                codes, at = trigram_codes(data, offsets)
                for i in range(last - first):
                    into = found.setdefault(langs[first + i], np.zeros(BUCKETS, np.int64))
                    np.add.at(into, codes[at[i]:at[i + 1]], 1)
        for name, counts in found.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])],
                names=["lang", "bucket", "n"])

    found = rows.select(lang, text).mapInArrow(count, "lang string, bucket int, n bigint")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id",
        sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Names and trigram counts of the languages, from about `sample` rows of each."""
    rows = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = dict(rows.groupBy(lang).count().collect())  # a row per language
    share, steps = F.lit(0), 1 << 20
    for name, n in sizes.items():
        share = F.when(F.col(lang) == name, min(steps, -(-steps * sample // n))).otherwise(share)
    chosen = rows.where(F.pmod(F.xxhash64(F.lit("sample"), doc_id), F.lit(steps)) < share)
    counts = trigram_counts(chosen, lang, text).toPandas()  # languages x BUCKETS rows at most
    names = sorted(counts["lang"].unique().tolist())
    out = np.zeros((len(names), BUCKETS))
    out[np.searchsorted(names, counts["lang"]) if names else [], counts["bucket"]] = counts["n"]
    return names, out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """`docs` with lang_pred, score and languages (each with its share)."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    added = T.StructType.fromDDL(
        "lang_pred string, score double, languages array<struct<lang:string,share:double>>")
    if set(added.names) & set(docs.columns):
        raise ValueError(f"the documents have a column of {added.names}")
    kind = to_arrow_type(added["languages"].dataType)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        names, counts = sent.value
        fitted = Model(names, counts) if names else None
        for batch in batches:
            n = batch.num_rows
            got = fitted.predict(batch.column(text)) if fitted else (["und"] * n, [0.0] * n, [[]] * n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(got[0], pa.string()), pa.array(got[1], pa.float64()), pa.array(got[2], kind)],
                names=[*batch.schema.names, *added.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def prediction_rows(docs: DataFrame) -> DataFrame:
    """One row per document; learnt from the documents that are not held out."""
    docs = docs.select("doc_id", "text", "lang")
    model = fit(docs.where(fold(F.col("doc_id")) != 0))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return (predict(docs.select("doc_id", "text"), model)
            .select("doc_id", held.alias("held_out"), "lang_pred", "score", "languages"))
