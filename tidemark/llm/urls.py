"""URL filter: rules by host and path, else a naive Bayes score of the words a host is made of.

Names in hosts are split into words by the cheapest path through a unigram model. The model's counts are
of the words in the table's own paths, hyphenated labels and page titles. Urls whose host contains a seed word are the
block class that naive Bayes learns from; it then also blocks by the words that keep them company.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, cut, small, table, text_of

#: (verdict, host, path). Fixed values of the query.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Words that mark a host as one to block, for training. Those of three letters have to stand alone.
SEEDS = (
    "adult ads adserver bet bets betting casino crack escort gambling hentai jackpot keygen lottery malware nude "
    "payday pharma phishing pill pills poker porn replica scam sex slots spam torrent tracker viagra warez xxx"
).split()
#: A seed counts as this share of all words in the unigram model.
SEED_SHARE = 1e-3
#: Pages that a seed word in a host counts for on its own, and those that draw a token's share of block to that of all tokens.
SEED_HITS, SMOOTHING = 1000, 5
#: Letters of the longest word that a name is split into, and of the longest name that is split: a label
#: of a host has no more. Longer names are one word.
WORD_LETTERS, NAME_LETTERS = 24, 63
#: Log-odds are summed as whole millionths, so that the order of summing doesn't matter.
UNIT = 1_000_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty without ``://``. ASCII letters of the host are lower-cased."""
    url, pattern = F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(url, pattern, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the last one wraps the others
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        name, verdict = F.when(fits, of + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


# -- segmentation


def word_counts(urls: DataFrame, titles: DataFrame) -> DataFrame:
    """(word, n) over the words of paths and titles, and the parts of host labels that have hyphens.

    Other labels may be several words in one, so they are no evidence for words.
    """

    def words(text: Column) -> Column:
        return F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")

    parted = F.array_join(F.filter(F.split("host", r"\."), lambda label: label.contains("-")), "/")
    found = urls.select(words(F.concat_ws("/", parted, "path"))).unionAll(titles.select(words(F.col("title"))))
    return found.where(F.length("word").between(1, WORD_LETTERS)).groupBy("word").agg(F.count("*").alias("n"))


def names_of(hosts: DataFrame) -> DataFrame:
    """(host, name) for each run of letters in a host."""
    return hosts.select("host", F.explode(F.split("host", r"[^\p{L}]+")).alias("name")).where("name <> ''")


def split_name(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The cheapest split of a name. A word that isn't known costs more with each letter; ties go to longer words."""
    if len(name) > NAME_LETTERS:
        return [name]
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
    for end in range(1, len(name) + 1):
        choices = []
        for start in range(max(0, end - WORD_LETTERS), end):
            n = counts.get(name[start:end])
            cost = math.log(total / n) if n else math.log(total) + (end - start) * math.log(10)
            choices.append((best[start][0] + cost, best[start][1] + 1, start))
        best.append(min(choices))
    words, end = [], len(name)
    while end:
        start = best[end][2]
        words.append(name[start:end])
        end = start
    return words[::-1] or [name]


def segmented(names: DataFrame, counts: DataFrame, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """(name, word) for each word of each distinct name, repeats included.

    Only the parts of names are looked up among the counts, so the counts are never copied to executors.
    """
    total = max(1, counts.agg(F.sum("n")).first()[0] or 0)
    known_seeds = counts.sparkSession.createDataFrame([(s, max(1, int(total * SEED_SHARE))) for s in seeds], "word string, n long")
    counts = counts.unionByName(known_seeds).groupBy("word").agg(F.sum("n").alias("n"))
    distinct = names.select("name").distinct()
    part = F.expr(
        f"flatten(transform(sequence(1, length(name)), i -> "
        f"transform(sequence(1, least({WORD_LETTERS}, length(name) - i + 1)), k -> substring(name, i, k))))"
    )
    short = F.length("name") <= NAME_LETTERS
    parts = distinct.where(short).select("name", F.explode(part).alias("word")).distinct()
    known = parts.join(counts, "word").groupBy("name").agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("counts"))
    rows = distinct.join(known, "name", "left").select("name", F.to_json(F.arrays_zip("words", "counts")).alias("known"))

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"name": [], "word": []}
        for name, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = {x["words"]: x["counts"] for x in json.loads(known or "[]")}
            for word in split_name(name, found, total):
                out["name"].append(name)
                out["word"].append(word)
        return out

    return by_batch(rows, run, "name string, word string")


# -- naive Bayes


def path_words(urls: DataFrame, *keep: str) -> DataFrame:
    """The words of paths as tokens; digits count as one kind."""
    words = F.split(F.regexp_replace(F.lower("path"), r"\d+", "#"), r"[^\p{L}#]+")
    return urls.select(*keep, F.explode(words).alias("word")).where("word <> ''").withColumn("token", F.concat(F.lit("p:"), "word")).drop("word")


def log_odds(blocked: Column, allowed: Column, share: float) -> Column:
    """How much a token speaks for block, in millionths; nothing where it wasn't seen.

    Its share of block is drawn to that of all tokens, so a token that was seen once says little.
    """
    rate = (blocked + SMOOTHING * share) / (allowed + SMOOTHING * (1 - share))
    return F.round((F.log(rate) - math.log(share / (1 - share))) * UNIT).cast("long")


def judged(pages: DataFrame, rules=RULES, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """page_id, host, path, rule, verdict and score (log-odds of block) of every row of ``pages`` (page_id, url, html).

    A url that is null or has no ``://`` has an empty host and path, no tokens, and the score of the prior.
    A score of exactly zero allows. Very long urls are read whole. Rows repeated are repeated; an empty table gives
    no rows; further columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    title = F.regexp_extract(text_of("html"), r"(?is)<title[^>]*>([^<]*)", 1)
    rows = cut(pages.select("page_id", host.alias("host"), path.alias("path"), title.alias("title")))
    urls = cut(rows.groupBy("host", "path").agg(F.count("*").alias("times")))
    hosts = urls.groupBy("host").agg(F.sum("times").alias("n"))
    names = names_of(hosts)
    words = segmented(names, word_counts(rows.select("host", "path"), rows.select("title")), seeds)
    seed = F.col("word").isin(*seeds) & ((F.length("word") > 3) | (F.col("word") == F.col("name")))
    host_words = names.join(words, "name").select("host", F.concat(F.lit("h:"), "word").alias("token"), seed.alias("seed"))
    host_words = cut(host_words.groupBy("host", "token").agg(F.max("seed").alias("seed"), F.count("*").alias("times")))

    bad = F.coalesce(F.col("bad"), F.lit(False))
    hosts = cut(hosts.join(host_words.groupBy("host").agg(F.max("seed").alias("bad")), "host", "left").select("host", "n", bad.alias("bad")))
    host_side = small(hosts)
    own = host_words.join(host_side, "host").withColumn("own", F.col("n") * F.col("times"))
    seen = own.select("token", "own", "bad").unionAll(
        path_words(urls, "host", "times").join(host_side, "host").select("token", "times", "bad")
    )

    def count(where: Column, n: str) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(n))), F.lit(0))

    tokens = cut(seen.groupBy("token").agg(count(F.col("bad"), "own").alias("blocked"), count(~F.col("bad"), "own").alias("allowed")))
    sums = tokens.agg(F.coalesce(F.sum("blocked"), F.lit(0)), F.coalesce(F.sum("allowed"), F.lit(0))).first()
    share = (sums[0] + 1) / (sums[0] + sums[1] + 2)
    pages_of = hosts.agg(count(F.col("bad"), "n"), count(~F.col("bad"), "n")).first()
    prior = round(UNIT * math.log((pages_of[0] + 1) / (pages_of[1] + 1)))

    by_seed = F.when(F.col("seed"), F.lit(SEED_HITS)).otherwise(0)
    by_others = F.col("allowed") - F.when(F.col("bad"), 0).otherwise(F.col("own"))
    weight = F.col("times") * log_odds(F.col("blocked") + by_seed, by_others, share)
    host_odds = own.join(small(tokens.where(F.col("token").startswith("h:"))), "token").groupBy("host").agg(F.sum(weight).alias("host_odds"))
    path_weights = tokens.where(F.col("token").startswith("p:")).select("token", log_odds(F.col("blocked"), F.col("allowed"), share).alias("odds"))
    path_weights = small(cut(path_weights))
    path_odds = path_words(urls, "host", "path").join(path_weights, "token").groupBy("host", "path").agg(F.sum("odds").alias("path_odds"))
    total = F.coalesce("path_odds", F.lit(0)) + F.coalesce("host_odds", F.lit(0)) + prior
    scores = urls.join(path_odds, ["host", "path"], "left").join(small(cut(host_odds)), "host", "left").select("host", "path", total.alias("odds"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.join(scores, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("odds") > 0, "block").otherwise("allow")).alias("verdict"),
        (F.col("odds") / UNIT).alias("score"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))
