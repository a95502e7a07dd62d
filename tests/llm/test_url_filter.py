"""The URL filter against a plain recomputation of words, splits, labels, model, score and verdict."""

import itertools
import math
from collections import Counter

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from stopline.llm import url_filter as u

DDL = "page_id bigint, url string, html string"


def words_of(html):
    plain = regex.sub(r"<[^>]*>", " ", html or "")
    plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in plain)
    return regex.findall(r"\p{L}+", plain)


def best_split(name, counts, total):
    """All 2^(n - 1) splits of a short name, the likeliest by sum, ties by the shortest words from the end."""
    def cost(w):
        n = counts.get(w, 0) if len(w) <= u.LONGEST_WORD else 0
        n = max(u.SEED * total, n or 1) if w in u.BLOCK_WORDS else n
        return math.log(n / total) if n else -math.log(total) - 2.3 * len(w)

    found = []
    for cuts in itertools.product((0, 1), repeat=len(name) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(name)]
        split = [name[a:b] for a, b in zip(at, at[1:])]
        found.append((round(sum(map(cost, split)), 9), [-len(w) for w in split[::-1]], split))
    return max(found)[2]


def recomputed(pages):
    counts = Counter(w for _, _, html in pages for w in words_of(html))
    total = max(1, sum(counts.values()))
    rows, seen = [], {}
    for page_id, url, html in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = regex.match(r"[^/?#]*", rest)[0]
        path = regex.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(t), t, v) for v, t in u.RULES if (host + "/").endswith(t.split("/")[0] + "/")
                and (host == t.split("/")[0] or host.endswith("." + t.split("/")[0]))
                and path.startswith(t[t.index("/"):])]
        _, rule, said = max(fits) if fits else (0, None, None)
        tokens = []
        for piece in regex.findall(r"\p{L}+|\p{Nd}+", host):
            if piece.isdigit():
                tokens.append("host=#")
            else:
                if piece not in seen:
                    seen[piece] = best_split(piece, counts, total)
                tokens += [f"host={w}" for w in seen[piece]]
        tokens += ["path=#" if p.isdigit() else f"path={p}" for p in regex.findall(r"[\p{L}\p{N}]+", path.lower())]
        has = set(words_of(html))
        label = "block" if has & set(u.BLOCK_WORDS) else "allow" if has and said != "block" else None
        rows.append((page_id, host, path, rule, said, tokens, label))
    bucket = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) % u.BUCKETS
    of = {k: Counter(bucket(t) for r in rows if r[6] == k for t in r[5]) for k in ("block", "allow")}
    n = {k: max(1, sum(c.values())) for k, c in of.items()}
    docs = Counter(r[6] for r in rows)

    def ratio(t):
        block, allow = of["block"][bucket(t)], of["allow"][bucket(t)]
        if not block + allow:
            return 0.0
        part = u.SMOOTHING * (block + allow) / (n["block"] + n["allow"])
        return math.log((block / n["block"] + part) / (allow / n["allow"] + part))

    prior = math.log((docs["block"] + 1) / (docs["allow"] + 1))
    out = []
    for page_id, host, path, rule, said, tokens, _ in rows:
        score = prior + sum(map(ratio, tokens))
        out.append((page_id, host, path, rule, said or ("block" if score > 0 else "allow"), score, " ".join(tokens)))
    return out


def compare(frame, pages):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[6])
    got, want = sorted(map(tuple, frame.collect()), key=key), sorted(recomputed(pages), key=key)
    assert [r[:5] + r[6:] for r in got] == [r[:5] + r[6:] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], abs=1e-4)


def test_whole_query_is_the_recomputed_one(spark, sf):
    table = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    pages = [tuple(r) for r in table.collect()]
    odd = [(None, None, None), (-1, "no scheme", "<p>spam"), (-2, "https://X9.Org?/a", ""), (-3, "x://", "ads ads"),
           (-3, "x://", "ads ads"), (-4, "ftp://ünï-casinowin.net/É/٣/7", None)]
    compare(u.verdict_rows(table.unionByName(spark.createDataFrame(odd, DDL))), pages + odd)


def test_hosts_are_judged_by_words_of_other_hosts(spark):
    """No host of the judged pages gave a label: their texts are missing, their names are built of learnt words."""
    clean = [(i, f"http://gardenhouse{i % 9}.net/en/{i}", "the garden of a house is green") for i in range(200)]
    toxic = [(300 + i, f"http://{a}royal.net/en/{i}", "royal casino and betting the") for i, a in enumerate(["casino", "lucky"] * 20)]
    judged = [(900, "http://luckycasino.info/x", None), (901, "http://greenhouse.info/x", None),
              (902, "http://casinoroyal.info", ""), (903, "http://garden.info/en/1", None)]
    learnt = toxic + [(800, "http://lucky.net", "lucky royal casino")] + clean
    got = {r["page_id"]: r for r in u.verdict_rows(spark.createDataFrame(learnt + judged, DDL)).collect()}
    assert [got[k]["verdict"] for k in (900, 901, 902, 903)] == ["block", "allow", "block", "allow"]
    assert got[900]["tokens"] == "host=lucky host=casino host=info path=x"


def test_a_word_is_no_label_in_the_url(spark):
    pages = [(1, "http://casino.net", "a green house"), (2, "http://house.net", "a green house")]
    got = u.verdict_rows(spark.createDataFrame(pages * 5, DDL)).collect()
    assert {r["verdict"] for r in got} == {"allow"}


def test_rare_words_count_however_many_words_there_are(spark):
    """200,000 words found once: a host built of two of them is split into them, as on a small table."""
    letters = "abcdefghijklmnopqrst"
    name = F.concat(F.lit("z"), *[F.substring(F.lit(letters), F.pmod(F.floor(F.col("id") / 20 ** k), F.lit(20)).cast("int") + 1, 1)
                                  for k in range(5)])
    many = spark.range(200_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://n"), "id", F.lit(".net")).alias("url"),
                                       F.concat(name, F.lit(" the")).alias("html"))
    counts, total = u.word_counts(many, "html")
    assert total == 400_000 and counts.count() == 200_001
    hosts = spark.createDataFrame([("zaaaaazbaaaa.net",), ("the.zcccaa9",), ("",)], "host string")
    got = {r["host"]: r["tokens"] for r in u.host_tokens(hosts, counts, total).collect()}
    assert got == {"zaaaaazbaaaa.net": ["host=zaaaaa", "host=zbaaaa", "host=net"],
                   "the.zcccaa9": ["host=the", "host=zcccaa", "host=#"]}


def test_long_urls_clashes_and_empty_tables(spark):
    long = "http://" + "thehouse" * 2000 + ".net/" + "a/" * 20_000
    pages = spark.createDataFrame([(1, long, "the house", "x"), (2, None, None, "y")], DDL + ", `a.b` string")
    got = {r["page_id"]: r for r in u.judged(pages).collect()}
    assert got[1]["tokens"][:4] == ["host=the", "host=house"] * 2 and len(got[1]["tokens"]) == 4001 + 20_000
    assert got[1]["a.b"] == "x" and got[2]["tokens"] == [] and got[2]["verdict"] == "allow"
    assert u.judged(pages).columns == ["page_id", "url", "a.b", "host", "path", "rule", "tokens", "score", "verdict"]
    for name in ("host", "score", "_label"):
        with pytest.raises(ValueError, match=name):
            u.judged(pages.withColumn(name, F.lit(1)))
    assert u.verdict_rows(pages.limit(0)).count() == 0
