"""The text operators against brute-force versions on small rows with awkward cases."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from stopline.llm import (
    chat, compact_windows, dartminhash, decontaminate, language, mixing, quality, resharding, suffix_groups,
    url_filter,
)
from stopline.llm.common import components

WORDS = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("a", "e", "io", "ur", "an")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "ta", "no"]) for _ in range(n))


def case_texts():
    base, passage = prose(1, 160), prose(2, 70)
    edited = base.split()
    edited[80] = "changed"
    return [
        (1, base), (2, base), (3, " ".join(edited)), (4, prose(3, 120)), (5, None), (6, ""), (6, ""),
        (7, prose(4, 40) + " " + passage + " " + prose(5, 40)), (8, prose(6, 60) + " " + passage), (9, "one two"),
        (10, prose(7, 9000)), (11, "  \t\n "), (12, "a" * 900), (None, prose(8, 30)), (13, "ünï " * 30),
        (14, prose(9, 60)), (14, prose(9, 60)), (15, "# * $\n# * $\n" + prose(10, 30)),
    ]


DDL = "doc_id bigint, text string, lang string, source string, q string, spans string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "xx", None if d is None else f"s{d % 3}", "extra", "clash") for d, t in case_texts()]
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- 6: suffix groups ----

def test_grouped_suffixes_is_the_suffix_array():
    rng = random.Random(5)
    for _ in range(300):
        text = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_groups.grouped_suffixes(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute_repeats(rows, length=400):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        left = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_bytes(docs, empty):
    assert collected(suffix_groups.digest_rows(docs)) == brute_repeats(case_texts())
    assert suffix_groups.digest_rows(empty).count() == 0


def test_repeats_of_wide_groups(spark, monkeypatch):
    passage = prose(20, 90)
    rows = [(i, prose(100 + i, 30) + " " + passage[i % 7:] + " " + prose(200 + i, 30)) for i in range(24)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_repeats(rows)
    assert collected(suffix_groups.digest_rows(frame)) == want
    monkeypatch.setattr(suffix_groups, "GROUP", 2)
    assert collected(suffix_groups.digest_rows(frame)) == want


def test_repeats_across_segments(spark, monkeypatch):
    """An owner cut by the end of a segment is one owner: its bytes are not repeated by that."""
    passage = prose(30, 70)
    rows = [(1, prose(31, 3000)), (2, prose(32, 900) + " " + passage + " " + prose(33, 900)),
            (3, prose(34, 200) + " " + passage), (4, None)]
    data = np.frombuffer(rows[0][1].encode(), np.uint8)
    whole = suffix_groups.anchors(data)
    monkeypatch.setattr(suffix_groups, "SEGMENT", 1 << 11)
    assert all((x == y).all() for x, y in zip(whole, suffix_groups.anchors(data), strict=True))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert collected(suffix_groups.digest_rows(frame)) == brute_repeats(rows)


def test_text_without_repeats(docs):
    left = {r["doc_id"]: r["text"] for r in suffix_groups.without_repeats(docs.drop("spans")).collect()}
    assert left[1] == "" and left[5] is None and left[4] == prose(3, 120)


# ---- 5: decontamination ----

def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(
        str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def test_decontamination(spark, docs, empty, monkeypatch):
    items = [(1, prose(1, 160)[200:500]), (2, "One two"), (3, None), (4, ""), (5, prose(77, 30)),
             (20, prose(2, 70)), (20, prose(2, 70)), (6, "ünï")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    windows = set()
    for i, t in items:
        w = alnum(t)
        k = min(10, len(w))
        windows |= {(str(i), tuple(w[p:p + k])) for p in range(len(w) - k + 1) if k}
    want = []
    for d, t in case_texts():
        w, hit, ids = alnum(t), set(), set()
        for i, win in windows:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p:p + len(win)]) == win:
                    hit |= set(range(p, p + len(win)))
                    ids.add(i)
        want.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    assert collected(decontaminate.digest_rows(docs, bench)) == sorted(want, key=repr)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)  # several blocks of items
    assert collected(decontaminate.digest_rows(docs, bench)) == sorted(want, key=repr)
    assert decontaminate.digest_rows(empty, bench).count() == 0
    assert not any(r[-1] for r in collected(decontaminate.digest_rows(docs, bench.limit(0))))
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)


def test_longest_matches(spark):
    text = prose(31, 50)
    item = " ".join(text.split()[12:37]) + " end"
    got = decontaminate.contamination(spark.createDataFrame([(1, text)], "doc_id bigint, text string"),
                                      spark.createDataFrame([(9, item)], "item_id bigint, text string")).first()["report"]
    assert [tuple(m) for m in got["matches"]] == [("9", 12, 0, 25)]


# ---- 3: near duplicates ----

def test_near_duplicate_classes(docs, empty):
    got = {}
    for r in dartminhash.class_rows(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["class_id"], r["class_size"]))
    assert got[1] == got[2] == got[3] == [(1, 3)]
    assert got[14] == [(14, 2)] * 2
    assert got[4] == [(4, 1)] and got[7] == [(7, 1)] and got[8] == [(8, 1)]
    assert got[5] == [(5, 3)] and got[6] == [(5, 3)] * 2  # null and empty texts are one text
    kept = dartminhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 4, 5, 7, 8, 9, 10, 11, 12, None, 13, 14, 15], key=str)
    assert dartminhash.class_rows(empty).count() == 0


def test_signatures_estimate_weighted_similarity():
    a = np.arange(1, 401, dtype=np.uint64)
    b = np.arange(81, 481, dtype=np.uint64)
    agree = []
    for shift in range(30):
        x, y = (dartminhash.mix(v + np.uint64(1000 * shift)) for v in (a, b))
        s = dartminhash.signatures(np.concatenate([x, y]), np.array([0, 400, 800]))
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - 320 / 480) < 0.04


def test_near_copies_of_one_text_are_one_class(spark):
    rows, base = [], prose(40, 150).split()
    for i in range(60):
        words = list(base)
        words[(i * 7) % 150] = f"edit{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, prose(900 + i, 100)) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.class_rows(frame).collect()}
    assert all(got[i] == 0 for i in range(60)) and all(got[1000 + i] == 1000 + i for i in range(20))


def test_prefixes_lose_no_similar_pair(spark):
    """Copies of a text that is absent itself: each with other edits, some with the same ones."""
    rng, rows = random.Random(12), []
    for base in range(3):
        words = prose(40 + base, 90).split()
        for copy in range(25):
            mine = list(words)
            for k in range(rng.randint(1, 4)):
                mine[rng.randrange(0, 90, 18) + k] = f"new{rng.randint(1, 3)}"
            rows.append((len(rows), " ".join(mine[:rng.randint(74, 90)])))
    rows.append((len(rows), rows[0][1] + " " + rows[0][1]))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = dartminhash.distinct_texts(frame)
    nodes = texts.select("node", texts.node.alias("root"))
    name = {r["node"]: r["doc"] for r in texts.collect()}
    got = {frozenset((name[r["a"]], name[r["b"]])) for r in dartminhash.prefix_pairs(nodes, texts, frame).collect()}
    bags = {d: dartminhash._counted(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
            for d, t in rows if d in name.values()}
    similar = {frozenset((x, y)) for x in bags for y in bags if x < y
               for common, union in [dartminhash.similar(bags[x], bags[y])] if 10 * common >= 8 * union}
    assert len(similar) > 20 and similar <= got
    assert len(got) < len(bags) * (len(bags) - 1) // 2 // 2


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (10, 3), (7, 6), (6, 8)] + [(20 + i, 21 + i) for i in range(30)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert {k: v for k, v in got.items() if k < 20} == {1: 1, 2: 1, 3: 1, 10: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6}
    assert {v for k, v in got.items() if k >= 20} == {20}


# ---- 10: compact windows ----

def test_compact_windows_cover_every_passage():
    rng = np.random.RandomState(3)
    hashed = rng.randint(0, 1 << 30, 200).astype(np.uint64)
    got = list(zip(*compact_windows.compact_windows(hashed, 20)))
    for a in range(200):
        for b in range(a + 20, 201):
            c = a + int(hashed[a:b].argmin())
            assert sum(x <= a and b <= y and m == c for x, m, y in got) == 1


def test_passages(docs, empty):
    rows = compact_windows.passage_rows(docs).collect()
    found = {(r["doc_id"], r["partner_doc_id"]) for r in rows}
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 7, 8, 14}
    assert (7, 8) in found and (8, 7) in found
    at = {r["doc_id"]: (r["first_word"], r["end_word"]) for r in rows}
    assert at[7] == (40, 110) and at[8] == (60, 130) and at[1] == (0, 160)
    assert compact_windows.passage_rows(empty).count() == 0


def test_passages_of_edited_families_and_stock_phrases(spark):
    """Every pair of whole texts compared: the same words are in passages."""
    rows = []
    for family in range(2):  # copies of one text, each with edits of its own and of its neighbours
        words = prose(600 + family, 130).split()
        for copy in range(8):
            mine = list(words)
            for k in range(copy // 2, copy // 2 + 4):
                mine[(k * 13 + copy % 2) % 130] = f"new{k}"
            rows.append((len(rows), " ".join(mine)))
    stock = prose(650, 49).split()
    for k in range(120):  # a phrase of all these texts, in a passage of two of them; one has a word more
        phrase = stock[:25] + [f"more{k}"] * (k % 2) + stock[25:]
        parts = [prose(1000 + k, 30), prose(2000 + k // 2, 21), *phrase, prose(3000 + k // 2, 22), prose(4000 + k, 30)]
        rows.append((len(rows), " ".join(parts)))
    runs = {d: compact_windows.text_shingles(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0]
            for d, t in rows}
    want = {d: set() for d in runs}
    for d in runs:
        for e in runs:
            if d != e:
                for a, b, p, q, _ in compact_windows.passages(runs[d], runs[e], (0, len(runs[d]), 0, len(runs[e]))):
                    want[d] |= set(range(a, b + compact_windows.RUN - 1))
                    want[e] |= set(range(p, q + compact_windows.RUN - 1))
    got = {d: set() for d in runs}
    for r in compact_windows.passage_rows(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        got[r["doc_id"]] |= set(range(r["first_word"], r["end_word"]))
    lacking = {d: len(want[d] - got[d]) for d in want if want[d] - got[d]}
    assert sum(map(bool, want.values())) > 100 and lacking == {}


# ---- 4: quality ----

def test_quality_counts(spark, docs, empty):
    labels = spark.createDataFrame([(4, 1, 0), (7, 1, 0), (None, 1, 0), (8, None, 1)],
                                   "doc_id bigint, quality int, toxic int")
    want = []
    for d, t in case_texts():
        w = [x for x in re.split("[\x20\x09-\x0d]+", t or "") if x]
        lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        many, rep = Counter(wins), set()
        for i, win in enumerate(wins):
            if many[win] > 1:
                rep |= set(range(i, i + 8))
        want.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")),
                     len(lines) - len(set(lines)), len(rep), len(w) < 20 or 100 * len(rep) > 30 * len(w)))
    got = quality.report_rows(docs, labels)
    assert collected(got.drop("score", "kept")) == sorted(want, key=repr)
    assert all(not (r["kept"] and r["base_failed"]) for r in got.collect())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.where("kept").count()
    assert quality.report_rows(empty, labels).count() == 0
    assert {r["score"] for r in quality.report_rows(docs, labels.limit(0)).collect()} == {0.0}


def test_log_ratios_are_the_two_multinomials(spark):
    import xxhash

    rows = [(1, "a b a"), (2, "c d")]
    got = quality.log_ratios(spark.createDataFrame(rows, "doc_id bigint, text string"),
                             spark.createDataFrame([(1, 1)], "doc_id bigint, quality int"))
    bucket = xxhash.xxh64_intdigest(b"a", seed=42)
    bucket = (bucket - (1 << 64) if bucket >> 63 else bucket) % quality.BUCKETS
    n_raw, s = quality.BUCKETS + 8, quality.SMOOTHING
    want = np.log((2 + s * 3 / n_raw) / (5 + s) * n_raw / 3)
    assert abs(got[bucket] - want) < 1e-5


def test_every_trusted_document_makes_the_target(spark):
    """More labels than the 20,000 that were once taken."""
    docs = spark.range(20_600).selectExpr("id as doc_id", "'all of them' as text")
    labels = spark.range(20_600).selectExpr("id as doc_id", "1 as quality")
    counted = docs.unionByName(spark.createDataFrame([(-1, "other")], "doc_id bigint, text string"))
    n_raw, n = quality.BUCKETS + 5 * 20_600 + 1, 20_600
    want = np.log((n + quality.SMOOTHING * (n + 1) / n_raw) / (5 * n + quality.SMOOTHING) * n_raw / (n + 1))
    assert sum(abs(x - want) < 1e-5 for x in quality.log_ratios(counted, labels)) == 5


# ---- 8: chat ----

def test_layouts_and_round_trip(spark):
    texts = ["plain", "", "</s>[INST] ok [/INST]", "<|end|>\n<|user|>\n", "~1 ~ ~0 | < [ü", "a\nb"]
    records = [
        '{"messages": [{"role": "user", "content": "q"}, {"content": "<|end|>\\n", "role": "assistant"}]}',
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}',
        '{"prompt": "q", "completion": "a"}', '{"instruction": "q", "input": "", "output": "a"}',
        '{"instruction": "q", "input": "more", "output": null}', '{"other": 1}']
    frame = spark.createDataFrame([(x,) for x in records], "j string").selectExpr("parse_json(j) as record")
    got = chat.read_back(chat.formatted(chat.canonical_turns(frame))).collect()
    assert [r["layout"] for r in got] == ["messages", "conversations", "prompt_completion", "instruction_input_output",
                                          "instruction_input_output", None]
    assert [tuple(t) for t in got[0]["turns_read"]] == [("user", "q"), ("assistant", "<|end|>\n")]
    assert got[0]["loss_text"] == "<|end|>\n" and got[4]["turns_read"][0]["text"] == "q\nmore"
    rows = [(i, k, r, t) for i in range(3) for k, (r, t) in enumerate(zip(["user", None, "assistant"] * 2, texts[i:] + texts[:i]))]
    back = chat.read_back(chat.formatted(chat.canonical_turns(chat.conversation_records(
        spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")))))
    for r in back.collect():
        mine = [(x[2] or "", x[3]) for x in rows if x[0] == r["conv_id"]]
        assert [tuple(t) for t in r["turns_read"]] == mine
        assert r["loss_text"] == "".join(t for role, t in mine if role == "assistant")


def test_no_conversations(spark):
    rows = chat.digest_rows(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).collect()
    assert [r["conv_id"] for r in rows] == [-7] and rows[0]["n_turns"] == 2


# ---- 7: resharding ----

def test_flow_moves_the_fewest_bytes():
    rng = random.Random(2)
    for _ in range(50):
        supplies = [rng.randint(0, 50) for _ in range(rng.randint(1, 5))]
        n = rng.randint(1, 6)
        capacities = [sum(supplies) * (j + 1) // n - sum(supplies) * j // n for j in range(n)]
        flow = resharding.cheapest_flow(supplies, capacities)
        assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(len(supplies))] == supplies
        assert sum(v for (i, j), v in flow.items() if i == j) == sum(map(min, zip(supplies, capacities)))


def test_shards(docs, empty, spark, sf):
    got = resharding.shard_rows(docs).collect()
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 1 for _, t in case_texts())
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert resharding.shard_rows(empty).count() == 0
    sizes = {r["shard"]: r["sum(size)"] for r in resharding.shard_rows(
        spark.read.parquet(f"{sf}/documents.parquet")).groupBy("shard").sum("size").collect()}
    assert len(sizes) == 8 and max(sizes.values()) < 1.1 * min(sizes.values())


def test_rewrite_touches_only_what_moves(spark, tmp_path):
    rows = [(i, prose(i, 20), i % 2) for i in range(200)]
    spark.createDataFrame(rows, "doc_id bigint, text string, shard int").write.partitionBy("shard").parquet(f"{tmp_path}/old")
    done = resharding.rewrite(spark, f"{tmp_path}/old", f"{tmp_path}/new", 3)
    new = spark.read.parquet(f"{tmp_path}/new")
    assert new.count() == 200 and new.groupBy("shard").count().count() == 3 and -1 not in done.values()


# ---- 9: mixing ----

def test_raking_meets_all_marginals():
    rng = np.random.RandomState(1)
    cells = rng.randint(1, 100, (4, 3, 2)).astype(float)
    targets = [rng.rand(k) + 0.1 for k in cells.shape]
    weighted = cells * mixing.rake(cells, targets)
    for axis, t in enumerate(targets):
        have = weighted.sum(axis=tuple(k for k in range(3) if k != axis))
        assert np.allclose(have / have.sum(), t / t.sum(), atol=1e-6)
    chances = mixing.calibrate(mixing.rake(cells, targets), cells, 0.5)
    assert chances.max() <= 1 and abs((chances * cells).sum() / cells.sum() - 0.5) < 1e-6


def test_mixing(docs, empty, spark, sf):
    rows = mixing.mix_rows(docs.drop("q")).collect()
    assert len(rows) == len(case_texts()) and {r["source"] for r in rows} == {"s0", "s1", "s2", "(null)"}
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns
    assert mixing.mix_rows(empty).count() == 0
    real = mixing.mix_rows(spark.read.parquet(f"{sf}/documents.parquet")).toPandas()
    expected = (real["probability"] * real["n_tokens"]).sum()
    assert abs(expected / real["n_tokens"].sum() - mixing.BUDGET) < 1e-3


# ---- 1: language ----

def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.prediction_rows(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 100 and (got["lang_pred"] == got["lang"]).mean() > 0.97


def test_language_mixture_and_empty_cases(spark, docs, empty):
    train = spark.createDataFrame([(i, prose(i, 200), "aa") for i in range(10)] + [
        (20 + i, " ".join(w[::-1].upper() + "zq" for w in prose(i, 200).split()), "bb") for i in range(10)],
        "doc_id bigint, text string, lang string")
    model = language.fit(train)
    one, two = prose(50, 100), " ".join(w[::-1] + "zq" for w in prose(51, 100).split())
    frame = spark.createDataFrame([(1, one), (2, two), (3, one + " " + two), (4, None), (5, " 12 #"), (6, "")],
                                  "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in language.predict(frame, model).collect()}
    assert got[1]["lang_pred"] == "aa" and got[2]["lang_pred"] == "bb" and got[1]["score"] > 0.95
    assert {x["lang"] for x in got[3]["languages"]} == {"aa", "bb"} and got[3]["score"] < 0.8
    assert [(got[k]["lang_pred"], got[k]["score"]) for k in (4, 5, 6)] == [("und", 0.0)] * 3
    assert language.prediction_rows(empty).count() == 0
    assert language.prediction_rows(docs).count() == len(case_texts())


# ---- 2: URLs ----

def test_urls(spark):
    urls = [(1, "http://a.example.org/es/9?x=1"), (2, "https://Example.ORG/en/1"), (3, "http://org/x"), (4, None),
            (5, "no scheme"), (6, "http://b.com/fr/1#top"), (7, "http://b.com"), (8, "http://spamfarm.net/en/2"),
            (9, "http://x.net/a://b"), (10, ""), (1, "http://a.example.org/es/9?x=1"), (11, "http://myexample.org/es/1")]
    pages = spark.createDataFrame([(i, u, "<p>spam farm my example the</p>") for i, u in urls],
                                  "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in url_filter.verdict_rows(pages).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == (
        "a.example.org", "/es/9", "example.org/es/", "block")
    assert got[2]["host"] == "example.org" and got[2]["rule"] == "example.org/en/1" and got[3]["rule"] == "org/"
    assert [(got[k]["host"], got[k]["path"], got[k]["rule"]) for k in (4, 5, 10)] == [("", "", None)] * 3
    assert got[6]["rule"] == "com/fr/" and got[7]["rule"] is None and got[7]["path"] == ""
    assert got[8]["verdict"] == "block" and got[11]["rule"] == "org/"
    assert "host=spam host=farm" in got[8]["tokens"]
    assert got[9]["path"] == "/a://b" and len(got) == 11
    assert url_filter.verdict_rows(pages.limit(0)).count() == 0


def test_segmentation_is_the_likeliest_split():
    log_p = {"the": -2.0, "rapist": -6.0, "therapist": -7.0, "a": -3.0}
    assert url_filter.segment("therapist", log_p, 1e4) == ["therapist"]
    assert url_filter.segment("thea", log_p, 1e4) == ["the", "a"]
    assert "".join(url_filter.segment("q" * 60, log_p, 1e4)) == "q" * 60
