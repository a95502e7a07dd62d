"""Spelling variants against a version in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from stopline.llm import spelling

LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def edits(word, letters):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return ({a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters}
            | {a + c + b for a, b in cuts for c in letters}) - {word}


def brute(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    letters, out = {x for w in n for x in w}, {}
    for w, c in n.items():
        near = sorted((u for u in edits(w, letters) if u in n), key=lambda u: (-n[u], u))
        form = near[0] if near and n[near[0]] >= 5 * c else None
        out[w] = (form, c, len(near), n[form] if form else None)
    rows = []
    for w, (form, c, near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, c, near, form_n))
    return sorted(rows, key=repr)


def awkward_rows(seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(40)] + [
        "aaaaaa", "aaaaaaa", "aaaaaaaa", "Straße", "ÀÉÎÕÜÿ", "àéîõüÿ", "internationalisation" * 3]
    words = base + [rng.choice(sorted(edits(w.lower(), "abé"))) for w in base for _ in range(4)]
    rows = []
    for i in range(300):
        rows.append((i, rng.choice([" ", "\n", "1", "-"]).join(
            rng.choice(words) if rng.random() < .3 else rng.choice(base[:20] + base[-8:])
            for _ in range(rng.choice([0, 1, 30])))))
    rows += [(400, "chained " * 200 + "chaineds " * 40 + "chainedso " * 7)]
    rows += [(None, "aaaaaa Aaaaaa"), (7, None), (8, ""), (9, "x" * 50_000 + " " + "aaaaaa " * 400), rows[2], rows[2]]
    return rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward_rows(), "doc_id long, text string").selectExpr(
        "*", "'x' as word", "1 as n", "'y' as form", "2 as key").repartition(5)


def test_variants_of_awkward_words(docs):
    want = brute(awkward_rows())
    assert any(r[1] and r[1] != r[2] for r in want) and len(want) > 60  # chains of forms are there
    assert collected(spelling.variant_rows(docs)) == want


def test_halves_too_common_for_one_task_meet_in_a_grid(docs):
    """With room for three words a shard, every half is split."""
    assert collected(spelling.variant_rows(docs, shard=3)) == brute(awkward_rows())


def test_variants_of_the_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert collected(spelling.variant_rows(docs)) == want and any(r[1] for r in want)


def test_no_documents(spark):
    assert spelling.variant_rows(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_index_finds_every_word_one_edit_away():
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 8))) for _ in range(300)})
    index = spelling.Index(words)
    for mirrored in (False, True):
        got = set(zip(*(x.tolist() for x in index.one_error(words, mirrored))))
        want = set()
        for i, w in enumerate(words):
            for j, u in enumerate(words):
                k = len(w) // 2
                if u in edits(w, "abc") and (u.endswith(w[k:]) if mirrored else u.startswith(w[:k])):
                    want.add((i, j))
        assert want <= got and all(words[j] in edits(words[i], "abc") for i, j in got)
        assert got == want
