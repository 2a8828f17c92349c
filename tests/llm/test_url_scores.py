"""Scores of urls against a plain naive Bayes, and what is found with seed words held out."""

import math
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import urls

PAGE = "page_id long, url string, html string"
SPLIT = re.compile(r"[\W\d_]+")


def plain_scores(rows, seeds=urls.SEEDS):
    """page_id -> score, by loops over rows."""
    parts = []
    for r in rows:
        rest = (r.url or "").split("://", 1)
        host = re.split(r"[/?#]", rest[1])[0] if len(rest) == 2 else ""
        path = re.split(r"[?#]", rest[1][len(host) :])[0] if len(rest) == 2 else ""
        title = re.search(r"(?is)<title[^>]*>([^<]*)", r.html or "")
        parts.append((r.page_id, host.lower(), path, title[1] if title else ""))

    counts = Counter()
    for _, host, path, title in parts:
        hyphened = "/".join(x for x in host.split(".") if "-" in x)
        for word in SPLIT.split(f"{hyphened}/{path}".lower()) + SPLIT.split(title.lower()):
            if 1 <= len(word) <= urls.WORD_LETTERS:
                counts[word] += 1
    total = max(1, sum(counts.values()))
    for seed in seeds:
        counts[seed] += max(1, int(total * urls.SEED_SHARE))

    words = {}  # host -> word -> (times, is a seed)
    for host in {p[1] for p in parts}:
        words[host] = defaultdict(lambda: [0, False])
        for name in filter(None, SPLIT.split(host)):
            for word in urls.split_name(name, counts, total):
                entry = words[host][word]
                entry[0] += 1
                entry[1] |= word in seeds and (len(word) > 3 or word == name)
    bad = {h: any(seed for _, seed in w.values()) for h, w in words.items()}
    n = Counter(p[1] for p in parts)

    def path_tokens(path):
        return [f"p:{w}" for w in re.split(r"[^a-zà-öø-ÿßœ#]+", re.sub(r"\d+", "#", path.lower())) if w]

    seen = {True: Counter(), False: Counter()}
    for _, host, path, _ in parts:
        seen[bad[host]].update(path_tokens(path))
        for word, (times, _) in words[host].items():
            seen[bad[host]][f"h:{word}"] += times
    b, a = sum(seen[True].values()), sum(seen[False].values())
    share = (b + 1) / (a + b + 2)
    pages = Counter(bad[p[1]] for p in parts)

    def odds(blocked, allowed):
        rate = (blocked + urls.SMOOTHING * share) / (allowed + urls.SMOOTHING * (1 - share))
        return math.log(rate) - math.log(share / (1 - share))

    out = {}
    for page_id, host, path, _ in parts:
        score = math.log((pages[True] + 1) / (pages[False] + 1))
        for word, (times, seed) in words[host].items():
            token = f"h:{word}"
            own = 0 if bad[host] else times * n[host]
            score += times * odds(seen[True][token] + urls.SEED_HITS * seed, seen[False][token] - own)
        score += sum(odds(seen[True][t], seen[False][t]) for t in path_tokens(path))
        out[page_id] = score
    return out


def test_scores_equal_a_plain_naive_bayes(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    expected = plain_scores(pages.collect())
    found = {r.page_id: r for r in urls.op3_url_filter(spark, sf).collect()}
    assert found.keys() == expected.keys()
    for page_id, row in found.items():
        assert abs(row.score - expected[page_id]) < 1e-4
        if row.rule is None:
            assert row.verdict == ("block" if expected[page_id] > 0 else "allow")


def spam_pages():
    """Hosts that share their words with others of the kind: (host, path), block hosts first."""
    offers = ["bonus", "winner", "cheap", "deal"]
    clean = ["garden", "city", "music", "river", "school", "market"]
    block = [f"{seed}-{offer}.com" for seed in ("casino", "viagra", "warez", "pills", "torrent", "lottery") for offer in offers]
    allow = [f"{x}-{y}.com" for x in clean for y in clean if x != y]
    return block, allow


@pytest.mark.parametrize("hidden", ["lottery", "viagra"])
def test_hosts_of_a_hidden_seed_are_found_by_their_company(spark, hidden):
    """One seed word of six is taken away: its hosts are found by what they share with the rest."""
    block, allow = spam_pages()
    rows = [(i, f"http://{h}/a/{i}", "<title>x</title>") for i, h in enumerate((block + allow) * 4)]
    found = urls.judged(spark.createDataFrame(rows, PAGE), rules=(), seeds=[s for s in urls.SEEDS if s != hidden]).collect()
    blocked = {r.host for r in found if r.verdict == "block"}
    held_out = {h for h in block if h.startswith(hidden)}
    assert len(blocked & held_out) / len(held_out) >= 0.9  # recall
    assert not blocked & set(allow)  # precision
    assert set(block) - held_out <= blocked


def test_a_large_host_cannot_vouch_for_itself(spark):
    """An unlabelled host with half of all rows is judged by the words it shares with others; seeds alone suffice."""
    block, allow = spam_pages()
    hosts = (block + allow) * 3 + ["bonuswinner.com"] * 400 + ["river-escort.org"]
    rows = [(i, f"http://{h}/a/{i}", "<title>bonus winner</title>") for i, h in enumerate(hosts)]
    found = urls.judged(spark.createDataFrame(rows, PAGE), rules=()).collect()
    blocked = {r.host for r in found if r.verdict == "block"}
    assert blocked == {*block, "bonuswinner.com", "river-escort.org"}
    assert len(found) == len(hosts)


def test_tables_without_a_seed_block_nothing(spark):
    _, allow = spam_pages()
    rows = [(i, f"http://{h}/", None) for i, h in enumerate(allow)] + [(None, None, None)]
    found = urls.judged(spark.createDataFrame(rows, PAGE), rules=()).collect()
    assert {r.verdict for r in found} == {"allow"} and len(found) == len(rows)
