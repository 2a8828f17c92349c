"""Periodic runs and the filter audit against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from tidemark.llm import filter_audit, periodic_runs


def plain_runs(words, least=24, exponent=3):
    """Every maximal stretch per period; a stretch that has a shorter period as well is no run of the longer one."""
    found, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - start >= max(least, exponent * q):
                part = words[start:i]
                if not any(part[k:] == part[: len(part) - k] for k in range(1, q)):
                    found.append((start, i - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def draw_words(draw):
    kind = draw.randrange(5)
    letters = [b"a", b"b", b"c", b"d"][: draw.randint(1, 4)]
    words = [draw.choice(letters) for _ in range(draw.randint(0, 160))]
    if kind < 3:
        for _ in range(draw.randint(1, 3)):
            unit = [draw.choice(letters + [b"x", b"y", b"z"]) for _ in range(draw.randint(1, 25))]
            at = draw.randint(0, len(words))
            words[at:at] = (unit * 9)[: draw.randint(len(unit), 9 * len(unit))]
    if kind == 3:  # Fibonacci words have many runs
        a, b = [b"a"], [b"a", b"b"]
        while len(b) < 150:
            a, b = b, b + a
        words = words[:20] + b + words[20:40]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(60):
        words = draw_words(draw)
        assert periodic_runs.runs(words) == plain_runs(words)


def test_automaton_tells_every_primitive_square():
    draw = random.Random(5)
    for _ in range(120):
        words = [draw.randrange(draw.randint(1, 3)) for _ in range(draw.randint(1, 60))]
        automaton = periodic_runs.SuffixAutomaton()
        for i, word in enumerate(words):
            told = sorted(automaton.append(word))
            squares = []
            for d in range(1, (i + 1) // 2 + 1):
                root = words[i - d + 1 : i + 1]
                primitive = not any(d % k == 0 and root == root[:k] * (d // k) for k in range(1, d))
                if root == words[i - 2 * d + 1 : i - d + 1] and primitive:
                    squares.append(d)
            assert told == squares


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    return (
        doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest(),
    )


def key(row):
    return tuple(str(x) for x in row)


def test_query_equals_brute_force_on_short_texts(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 6000")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(r) for r in periodic_runs.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(rows, key=key) == sorted((plain_row(r.doc_id, r.text) for r in docs.collect()), key=key)
    assert sum(r[1] for r in rows) > 3


def test_odd_rows_of_runs(odd_docs):
    rows = periodic_runs.periodic_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    long = next(r for r in rows if r.doc_id == 7)
    assert (long.n_runs, long.start, long.length, long.period, long.exponent_milli) == (1, 0, 40_000, 1, 40_000_000)
    assert long.collapsed_sha256 == hashlib.sha256(b"wort").hexdigest()
    empty = next(r for r in rows if r.doc_id == 5)
    assert empty.runs_sha256 == empty.collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert [empty.start, empty.length, empty.period, empty.exponent_milli] == [None] * 4


def plain_audit(docs, labels):
    """Every order walked filter by filter."""
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    failing, parts = defaultdict(set), defaultdict(list)
    for row, (doc_id, text, source) in enumerate(docs):
        text = text or ""
        words = text.encode().split()
        parts[source or ""].append(row)
        if len(words) < 50:
            failing["A"].add(row)
        if 100 * len(set(words)) < 65 * len(words):
            failing["B"].add(row)
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            failing["C"].add(row)
        if set(text) & set("#$%&*|"):
            failing["D"].add(row)
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs):
            failing["E"].add(row)
    found = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            alive = set(rows)
            for step, name in enumerate(order):
                gone = alive & failing[name]
                alive -= gone
                shapley[name] += len(gone)
                only = [r for r in rows if [f for f in "ABCDE" if r in failing[f]] == [name]]
                found[part, "".join(order), step + 1] = [
                    len(alive), len(gone), len(failing[name] & set(rows)) - len(gone), len(only),
                    sum(docs[r][0] in good for r in gone), sum(docs[r][0] in toxic for r in gone),
                ]
        for order in permutations("ABCDE"):
            for step, name in enumerate(order):
                found[part, "".join(order), step + 1].append(shapley[name])
    return {k: tuple(v) for k, v in found.items()}


def audited(frame):
    return {tuple(r[:3]): tuple(r[3:]) for r in frame.collect()}


def test_audit_of_odd_rows(spark, odd_docs):
    marks = [(1, 1, 0), (1, 0, 0), (1, 1, 0), (2, None, 1), (None, 1, 1), (3, 0, None), (9, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    docs = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    rows = audited(filter_audit.audit(odd_docs, labels))
    assert rows == plain_audit(docs, marks)


def test_audit_of_drawn_rows(spark):
    draw = random.Random(3)
    texts = ["A b c", "word " * 60, " ".join(map(str, range(60))), "x # y", "", None, "ABC " + " ".join(map(str, range(80)))]
    docs = [(draw.choice([None, *range(30)]), draw.choice(texts), draw.choice(["s", "t", "", None])) for _ in range(150)]
    marks = [(draw.randrange(30), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert audited(filter_audit.audit(frame, labels)) == plain_audit(docs, marks)
