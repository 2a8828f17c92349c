"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from tidemark.llm import jaccard_join
from tidemark.llm.jaccard_join import op11_jaccard_join


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    k = min(3, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def plain_classes(rows):
    """Per row (doc_id, n_shingles, component_id), from all pairs of different sets that can be linked."""
    members = {}
    for doc_id, text in rows:
        members.setdefault(shingles(text), []).append(doc_id)
    sets = [s for s in members if s]
    root = {s: s for s in sets}

    def top(s):
        while root[s] != s:
            s = root[s]
        return s

    owners = {}
    for s in sets:
        for gram in s:
            owners.setdefault(gram, []).append(s)
    for s in sets:
        for other in {o for gram in s for o in owners[gram]}:
            if other is not s and 100 * len(s & other) >= 90 * len(s | other):
                root[top(s)] = top(other)
    low = {}
    for s in sets:
        ids = [i for i in members[s] if i is not None]
        low.setdefault(top(s), []).extend(ids)
    return [
        (i, len(s), (min(low[top(s)], default=None) if s else i)) for i, s in ((i, shingles(t)) for i, t in rows)
    ]


def key(row):
    return tuple(str(x) for x in row)


def check(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in op11_jaccard_join(spark, str(tmp_path)).collect()]
    expected = plain_classes(rows)
    assert sorted(found, key=key) == sorted(expected, key=key)
    return expected


def families(draw, most=120):
    """Families of texts around the limit: words changed, cut off or put in front, repeats, shared passages."""
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [draw.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(25):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([1, 2, 3, 8, 11, 12, 13, 30, 90, 250]))]
        if draw.random() < 0.4:
            base += shared
        for _ in range(draw.randint(1, most // 10)):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 6])):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            words = words[draw.choice([0, 0, 0, 1, 2]) :] + [draw.choice(vocabulary) for _ in range(draw.choice([0, 0, 1, 3]))]
            rows.append(" ".join(w.upper() if draw.random() < 0.1 else w for w in words))
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_families_equal_all_pairs(spark, tmp_path, seed):
    rows = families(random.Random(seed))
    expected = check(spark, rows, tmp_path)
    assert sum(i != c for i, _, c in expected) > 20


@pytest.mark.parametrize(("few", "per_member"), [(16, 8), (2, 8), (2, 0)])
def test_blocks_equal_all_pairs(spark, tmp_path, monkeypatch, few, per_member):
    """A hot family whose members are linked in chains: by pairs, by pairs of several small blocks, and in full."""
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", 7)
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "PAIRS_PER_MEMBER", per_member)
    draw = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in draw.sample(range(100), draw.randint(1, 3)):
            words[at] = draw.choice(["x", "y", f"z{i}"])
        rows.append((i, " ".join(words)))
    check(spark, rows, tmp_path)


def test_odd_rows(spark, tmp_path, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(20, "a b"), (21, "A  b"), (22, "b a"), (None, "only null ids " * 9), (None, "only null ids " * 9)]
    check(spark, rows, tmp_path)


def test_query_equals_all_pairs(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = [tuple(r) for r in op11_jaccard_join(spark, sf).collect()]
    assert sorted(found, key=key) == sorted(plain_classes(rows), key=key)


def test_bound_of_differing_elements():
    for n in range(1, 400):
        worst = 0
        for m in range(1, 2 * n):
            for common in range(1, min(n, m) + 1):
                if 100 * common >= 90 * (n + m - common):
                    worst = max(worst, n + m - 2 * common)
                    break
        assert jaccard_join.most_differing(n) >= worst


def test_linked_sets_share_a_cell():
    """Also where all n-grams of a set are in few cells, or in few bands."""
    draw = np.random.default_rng(4)
    for _ in range(400):
        n = int(draw.integers(9, 200))
        base = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        if draw.random() < 0.3:
            base = base[np.argsort(jaccard_join.scramble(base, jaccard_join.MIX[1]))][: max(9, n // 3)]
        lose = int(draw.integers(0, 1 + len(base) // 10))
        other = np.unique(np.concatenate((base[lose:], draw.integers(0, 2**63, int(draw.integers(0, 4))).astype(np.uint64))))
        base = np.sort(base)
        common = len(np.intersect1d(base, other))
        if 100 * common < 90 * (len(base) + len(other) - common):
            continue
        band = draw.integers(0, 3, 1 << jaccard_join.SLOT_BITS).astype(np.uint8)
        assert np.array_equal(base, other) or set(jaccard_join.cells(base, band).tolist()) & set(jaccard_join.cells(other, band).tolist())


def test_sizes_bound_the_difference():
    """Of sets of any sizes, also where the sizes of parts are cut off."""
    draw = np.random.default_rng(7)
    for _ in range(300):
        base = np.unique(draw.integers(0, 2**63, int(draw.integers(1, 3000))).astype(np.uint64))
        other = np.unique(np.concatenate((base[int(draw.integers(0, len(base))) :], draw.integers(0, 2**63, int(draw.integers(0, 500))).astype(np.uint64))))
        if not len(other):
            continue
        x, y = jaccard_join.part_sizes(base), jaccard_join.part_sizes(other)
        parts = min(len(x), len(y))
        bound = np.abs(jaccard_join.folded(x, parts) - jaccard_join.folded(y, parts)).sum()
        assert bound <= len(np.setxor1d(base, other))
