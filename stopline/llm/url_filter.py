"""URL filter: host and path rules, then naive Bayes over segmented names.

Host labels are split into words by a unigram Viterbi search over all words of the
pages' texts: every distinct run of letters of a host (a piece) gets the counts of its own
substrings of up to `LONGEST_WORD` letters, so the dictionary has no bound and is sent
nowhere whole. The words of `BLOCK_WORDS` count as a share of `SEED` of all words at least.
Host words and path tokens are hashed into `BUCKETS` features of a multinomial naive Bayes
model. Its labels come from the texts, never from the urls: a page whose text has a word of
`BLOCK_WORDS` against all others with a word that no rule blocks. All pages are judged.

Word and feature counts are pre-aggregated before their shuffles. Hosts and pieces
are distinct before they are split. Pieces meet their words, hosts their pieces, and
pages their host by joins whose other side has one row a key: it is broadcast if it is
measured small, else adaptive execution splits a hot host. No group gathers a host's pages.

Defined results. A null url, or one without `://`, has empty host and path, no
rule, no tokens, and the verdict of the prior. Of the fitting rules the longest wins; of
equally long ones the first by text. Of equally likely splits the one whose last word is
shortest is taken, and so on from the end. Repeated rows are judged alike. A page of null or empty text
trains nothing and is judged. An empty table gives an empty result. Very long urls
are split whole; a piece yields at most `LONGEST_WORD` substrings a letter. Other
columns stay; a column named like one of the results is an error.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import store
from stopline.session import broadcast_if_small

SEED = 1e-5
BUCKETS = 8192
SMOOTHING = 0.1
# Rules and words that mark unwanted hosts.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
BLOCK_WORDS = ("spam", "pills", "casino", "porn", "xxx", "viagra", "malware", "phishing",
               "adult", "bets", "betting", "ads", "spyware", "warez")
LONGEST_WORD = 24
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def text_words(text: Column) -> Column:
    """Words (runs of letters, A-Z lower-cased) of a page outside its tags."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^>]*>", " ")
    return F.regexp_extract_all(F.translate(plain, _UPPER, _LOWER), F.lit(r"(\p{L}+)"), F.lit(1))


def word_counts(texts: DataFrame, text: str) -> tuple[DataFrame, int]:
    """(w, n) of all words that a host can be split into, and the count of all words, 1 at least."""
    counts = store(texts.select(F.explode(text_words(F.col(text))).alias("w"))
                   .groupBy("w").agg(F.count("*").alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.where(F.length("w") <= LONGEST_WORD), total


def segment(name: str, log_p: dict[str, float], total: float) -> list[str]:
    """The likeliest split into words; an unknown word costs more the longer it is."""
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        choice = max(
            ((best[start] + log_p.get(name[start:end], -math.log(total) - 2.3 * (end - start)), start)
             for start in range(max(0, end - LONGEST_WORD), end)))
        best.append(choice[0])
        back.append(choice[1])
    words, end = [], len(name)
    while end:
        words.append(name[back[end]:end])
        end = back[end]
    return words[::-1]


def substrings(pieces: DataFrame) -> DataFrame:
    """(piece, w): the distinct substrings of up to `LONGEST_WORD` letters of every piece."""
    def run(batches):
        for batch in batches:
            out: list[tuple[str, str]] = []
            for piece in batch.column("piece").to_pylist():
                out += [(piece, w) for w in {piece[i:j] for i in range(len(piece))
                                             for j in range(i + 1, min(len(piece), i + LONGEST_WORD) + 1)}]
                if len(out) > 1 << 15:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["piece", "w"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["piece", "w"])

    return pieces.mapInArrow(run, "piece string, w string")


def split_pieces(pieces: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(piece, words): the likeliest split of distinct pieces by the counts of their own substrings."""
    def run(batches):
        least = SEED * total
        for batch in batches:
            names, out = batch.column("piece").to_pylist(), []
            for name, known in zip(names, batch.column("known").to_pylist()):
                n = {k["w"]: k["n"] for k in known or []}
                n |= {w: max(least, n.get(w, 1)) for w in BLOCK_WORDS if w in name}
                out.append(segment(name, {w: math.log(c / total) for w, c in n.items()}, total))
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(out, pa.list_(pa.string()))],
                                             names=["piece", "words"])

    known = (substrings(pieces).join(broadcast_if_small(counts), "w")
             .groupBy("piece").agg(F.collect_list(F.struct("w", "n")).alias("known")))
    return pieces.join(known, "piece", "left").select("piece", "known").mapInArrow(
        run, "piece string, words array<string>")


def host_tokens(hosts: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(host, tokens): the words of distinct hosts in order; a run of digits is `#`."""
    parts = hosts.select("host", F.posexplode(
        F.regexp_extract_all("host", F.lit(r"(\p{L}+|\p{Nd}+)"), F.lit(1))).alias("at", "piece"))
    digits = F.col("piece").rlike(r"^\p{Nd}")
    pieces = store(parts.where(~digits).select("piece").distinct(), "pieces")
    words = store(split_pieces(pieces, counts, total), "split")
    split = (parts.join(broadcast_if_small(words), "piece", "left")
             .select("host", "at", F.when(digits, F.array(F.lit("#"))).otherwise(F.col("words")).alias("words")))
    done = split.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("parts"))
    return done.select("host", F.transform(F.flatten("parts.words"), lambda w: F.concat(F.lit("host="), w)).alias("tokens"))


def path_tokens(path: Column) -> Column:
    parts = F.regexp_extract_all(F.lower(path), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return F.transform(parts, lambda p: F.concat(
        F.lit("path="), F.when(p.rlike(r"^\p{Nd}+$"), "#").otherwise(p)))


def bayes(rows: DataFrame, tokens: Column, label: Column) -> tuple[float, list[float]]:
    """Log prior ratio and log likelihood ratio per bucket, block against allow.

    Pseudo-counts are a share of each class in the proportions of all tokens, so a
    token that no class has seen says nothing.
    """
    rows = rows.select(tokens.alias("t"), label.alias("label")).where("label is not null")
    n = dict(rows.groupBy("label").count().collect())  # two rows
    counts = (rows.select("label", F.explode("t").alias("t"))
              .groupBy(F.pmod(F.xxhash64("t"), F.lit(BUCKETS)).cast("int").alias("b"))
              .agg(F.count(F.when(F.col("label") == "block", 1)).alias("block"),
                   F.count(F.when(F.col("label") == "allow", 1)).alias("allow")).collect())  # BUCKETS rows
    n_block, n_allow = (max(1, sum(r[k] for r in counts)) for k in (1, 2))
    ratios = [0.0] * BUCKETS
    for b, block, allow in counts:
        part = SMOOTHING * (block + allow) / (n_block + n_allow)
        ratios[b] = round(math.log((block / n_block + part) / (allow / n_allow + part)), 6)
    return round(math.log((n.get("block", 0) + 1) / (n.get("allow", 0) + 1)), 6), ratios


def judged(pages: DataFrame, url: str = "url", text: str = "html", rules=RULES) -> DataFrame:
    """`pages` with host, path, rule, tokens, score and verdict; other columns but `text` stay."""
    added = ["host", "path", "rule", "tokens", "score", "verdict"]
    clash = {*added, "_rule_verdict", "_label", "_words"} & set(pages.columns)
    if clash:
        raise ValueError(f"the pages have the columns {sorted(clash)}")
    counts, total = word_counts(pages, text)
    host, path = host_and_path(F.col(url))
    rows = pages.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("_rule_verdict", verdict).withColumn("_words", text_words(F.col(text)))
    marked = F.arrays_overlap("_words", F.array(*map(F.lit, BLOCK_WORDS)))
    clean = (F.size("_words") > 0) & (F.coalesce("_rule_verdict", F.lit("allow")) == "allow")
    rows = store(rows.withColumn("_label", F.when(marked, "block").when(clean, "allow")).drop(text, "_words"), "urls")
    hosts = store(rows.select("host").distinct(), "hosts")
    of_host = store(host_tokens(hosts, counts, total), "host-words")
    tokens = F.concat(F.coalesce("tokens", F.array().cast("array<string>")), path_tokens(F.col("path")))
    rows = rows.join(broadcast_if_small(of_host), "host", "left").withColumn("tokens", tokens)
    prior, ratios = bayes(rows, F.col("tokens"), F.col("_label"))
    weights = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    score = F.aggregate("tokens", F.lit(prior), lambda s, t: s + F.get(
        weights, F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int")))
    rows = rows.withColumn("score", score).withColumn("verdict", F.coalesce(
        "_rule_verdict", F.when(F.col("score") > 0, "block").otherwise("allow")))
    return rows.select(*[f"`{c}`" for c in pages.columns if c != text], *added)


def verdict_rows(pages: DataFrame) -> DataFrame:
    done = judged(pages.select("page_id", "url", "html"))
    return done.select("page_id", "host", "path", "rule", "verdict", "score",
                       F.array_join("tokens", " ").alias("tokens"))
