"""Collocations against a version in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stopline.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(ws)
            for m in range(1, 5):
                f[lang].update(tuple(ws[i:i + m]) for i in range(len(ws) - m + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = Counter()
        for q, a in cand.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    held[q[i:i + m]] = max(held[q[i:i + m]], a)
        found = []
        for p, a in cand.items():
            if 100 * held[p] >= 80 * a and held[p]:
                continue
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p), l, r))
        found.sort(key=lambda x: (x[0], x[1], x[2].encode()))
        out += [(lang, i + 1, p, -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(found[:top])]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def awkward_rows():
    rng = random.Random(4)
    words = ["The", "the", "of", "é", "É", "ab", "x-y", "#", "zz", "𝄞", "long" * 60]
    rows = []
    for i in range(260):
        n = rng.choice([0, 1, 3, 120])
        text = "".join(rng.choice(words) + rng.choice([" "] * 12 + ["\t ", ", ", ".", "\n", "\x0b"]) for _ in range(n))
        rows.append((rng.choice(["en", "fr", None, "und"]), text))
    rows += [("en", None), ("en", ""), (None, " \n. "), ("xx", "same same same " * 20_000), rows[3], rows[3], ("", "a b " * 40)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, lang, t, "clash", 1, 2) for i, (lang, t) in enumerate(awkward_rows())]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string, word string, n int, key int").repartition(5)


def test_phrases_of_awkward_texts(docs):
    want = brute(awkward_rows())
    assert len(want) > 50 and any(r[3] != 30 for r in want)
    assert rows_of(collocations.collocation_rows(docs)) == want


def test_words_without_a_dictionary(docs):
    assert rows_of(collocations.collocation_rows(docs, dictionary_bytes=0)) == brute(awkward_rows())


@pytest.mark.parametrize("dictionary_bytes", [0, 1 << 20])
def test_common_pairs_are_dealt_again(docs, monkeypatch, dictionary_bytes):
    """Buckets of 20 suffixes: every common word is routed by pairs, every common pair by all its words."""
    dealt = []
    plain = collocations.deal_again
    monkeypatch.setattr(collocations, "deal_again", lambda parts, kind: dealt.append(parts) or plain(parts, kind))
    got = collocations.collocation_rows(docs, bucket=20, dictionary_bytes=dictionary_bytes)
    assert rows_of(got) == brute(awkward_rows()) and dealt and max(dealt[0].values()) > 1


def test_the_best_of_each_language(docs):
    assert rows_of(collocations.collocation_rows(docs, top=3, least=10)) == brute(awkward_rows(), 10, 3)


def test_three_way_partitions_count_every_prefix(monkeypatch):
    rng = np.random.RandomState(2)
    columns = [rng.randint(1, 4, 5000).astype(np.uint32)]
    for _ in range(3):
        columns.append(np.where(columns[-1] == 0, 0, rng.randint(0, 4, 5000)).astype(np.uint32))
    weights = rng.randint(1, 3, 5000)
    want = Counter()
    for *w, n in zip(*(c.tolist() for c in columns), weights.tolist()):
        for size in range(2, 5):
            if w[size - 1]:
                want[tuple(w[:size])] += n
    for direct in (0, 16, 10_000):
        monkeypatch.setattr(collocations, "DIRECT", direct)
        got = collocations.frequent_prefixes(columns, weights, 40)
        named = {tuple(int(c[p]) for c in columns[:size]): n for p, size, n in got}
        assert len(named) == len(got) and named == {w: n for w, n in want.items() if n >= 40}


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert rows_of(collocations.collocation_rows(empty)) == []
    rare = spark.createDataFrame([(1, "en", "a b c")], "doc_id long, lang string, text string")
    assert rows_of(collocations.collocation_rows(rare)) == []
