"""The likelihood-ratio verdicts against a version in plain Python, and their plans under a filter."""

import math
import re
import struct

import pytest
import xxhash

from stopline.llm import quality


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def gram_buckets(text):
    words = [signed(xxhash.xxh64(w.encode(), 42).intdigest()) for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
    pairs = [signed(xxhash.xxh64(struct.pack("<q", b), xxhash.xxh64(struct.pack("<q", a), 42).intdigest()).intdigest())
             for a, b in zip(words, words[1:])]
    return [h % quality.BUCKETS for h in words + pairs]


@pytest.fixture(scope="module")
def tables(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_score_and_verdict_of_every_document(tables):
    docs, labels = tables
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    grams = [(r["doc_id"], gram_buckets(r["text"])) for r in docs.collect()]
    raw, target = [1] * quality.BUCKETS, [0] * quality.BUCKETS
    for d, gs in grams:
        for g in gs:
            raw[g] += 1
            target[g] += d in good
    n_raw, n_target, s = sum(raw), sum(target), quality.SMOOTHING
    ratio = [math.log((t + s * r / n_raw) / (n_target + s) * n_raw / r) for r, t in zip(raw, target)]
    want = {d: sum(ratio[g] for g in gs) / len(gs) if gs else 0.0 for d, gs in grams}
    rows = quality.report_rows(docs, labels).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=2e-6)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.THRESHOLD)
    assert 0 < sum(r["kept"] for r in rows) < len(rows)


def test_a_filter_on_any_column_splits_a_text_no_more_often(tables):
    def splits(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("split(")

    docs, labels = tables
    plain = quality.report_rows(docs, labels)
    for c in plain.columns:
        assert splits(plain.where(f"cast({c} as double) > 0")) == splits(plain) == 2
    assert splits(quality.keep_good(docs, labels)) == 2
