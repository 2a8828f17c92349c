"""Runs: maximal periodic stretches of words, by a suffix automaton with link-cut access.

The automaton grows word by word. Its suffix links form a tree in which every state knows where its
strings ended last; states that agree there form segments of paths, kept in splay trees. A word that is
appended gives its whole path to the root the new end. On the way each segment, holding the suffixes of
``shorter`` < length <= ``longest`` words, tells the distance d between its previous end and the new one:
if shorter < d <= longest, the last d words are also the d words before them, and no shorter stretch
repeats them: a square whose root is primitive. Squares are extended to runs by comparing words at that
distance, each run once.

Every word of a run of at least ``LEAST`` words and ``EXPONENT`` periods lies in nine words that occur
again at the distance of the period. The automaton is built over stretches of such words only; what is
outside can't belong to a run.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, table

#: A run has at least so many words, and so many periods.
LEAST, EXPONENT = 24, 3
#: In a run of 24 words and three periods, so many words together always occur again one period away.
GRAM = 9
#: A share of the ids, one of so many, has texts that are made periodic.
PERIODIC_SHARE = 10

Run = tuple[int, int, int]


class SuffixAutomaton:
    """Grown by ``append``, which returns the primitive periods of the squares that end at the new word."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link, self.last, self.size = [0], [-1], 0, 0
        # The splay trees, without the initial state, so that 0 stands for none: children nearer to the
        # initial state and farther from it, parent (or the state above the segment), last end at each tree's root.
        self.near, self.far, self.up, self.end = [0], [0], [0], [0]

    def state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.near.append(0)
        self.far.append(0)
        self.up.append(link)
        self.end.append(0)
        return len(self.length) - 1

    def append(self, word: int) -> list[int]:
        edges, length, link = self.next, self.length, self.link
        at = self.last
        self.size += 1
        new = self.last = self.state(self.size, 0, {})
        while at >= 0 and word not in edges[at]:
            edges[at][word] = new
            at = link[at]
        if at >= 0:
            target = edges[at][word]
            if length[target] != length[at] + 1:
                target = self.divide(at, word, target)
            link[new] = self.up[new] = target
        return self.access(new)

    def divide(self, at: int, word: int, target: int) -> int:
        """Give the shorter strings of a state a state of their own, next above it on the same segment."""
        clone = self.state(self.length[at] + 1, self.link[target], self.next[target].copy())
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = clone
            at = self.link[at]
        self.link[target] = clone
        self.splay(target)
        above = self.near[clone] = self.near[target]
        if above:
            self.up[above] = clone
        self.near[target], self.up[clone] = clone, target
        return clone

    def access(self, new: int) -> list[int]:
        """Give the path from a new state upwards the new end; the periods that its segments tell."""
        length, far, up, end, now = self.length, self.far, self.up, self.end, self.size
        found, below, x = [], new, up[new]
        while x:
            self.splay(x)
            distance, cut_off, above = now - end[x], far[x], up[x]
            if cut_off:
                end[cut_off] = end[x]
            far[x], up[below] = below, x
            if length[above] < distance <= length[x]:
                found.append(distance)
            below, x = x, above
        end[below] = now
        return found

    def splay(self, x: int) -> None:
        """Make a state the root of its splay tree; the last end moves there."""
        near, far, up, end = self.near, self.far, self.up, self.end
        while (p := up[x]) and (near[p] == x or far[p] == x):
            g = up[p]
            if g and (near[g] == p or far[g] == p):
                end[x] = end[g]
                self.rotate(p if (near[g] == p) == (near[p] == x) else x)
            else:
                end[x] = end[p]
            self.rotate(x)

    def rotate(self, x: int) -> None:
        near, far, up = self.near, self.far, self.up
        p = up[x]
        g = up[p]
        if near[p] == x:
            child = near[p] = far[x]
            far[x] = p
        else:
            child = far[p] = near[x]
            near[x] = p
        if child:
            up[child] = p
        up[p], up[x] = x, g
        if g:
            if near[g] == p:
                near[g] = x
            elif far[g] == p:
                far[g] = x


def stretches(words: list[bytes], least: int, exponent: int) -> list[tuple[int, int]]:
    """Where each word lies in a gram that occurs again near enough; every run is inside one of these."""
    n = len(words)
    if n < least:
        return []
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=n).view(np.uint64)
    grams = np.zeros(n - GRAM + 1, dtype=np.uint64)
    for k in range(GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - GRAM + 1 + k]
    order = np.argsort(grams, kind="stable")
    gaps = np.diff(order)
    again = (grams[order[1:]] == grams[order[:-1]]) & (gaps <= n // exponent)
    if not again.any():
        return []
    covered = np.zeros(n + 1, dtype=np.int64)
    starts = np.unique(np.concatenate((order[1:][again], order[:-1][again])))
    covered[starts] += 1
    covered[starts + GRAM] -= 1
    inside = np.diff(np.concatenate(([0], (np.cumsum(covered[:n]) > 0).astype(np.int8), [0])))
    bounds = zip(np.flatnonzero(inside == 1).tolist(), np.flatnonzero(inside == -1).tolist())
    return [(a, b) for a, b in bounds if b - a >= least]


def runs(words: list[bytes], least: int = LEAST, exponent: int = EXPONENT) -> list[Run]:
    """(start, length, period) of every run, by start, then period. ``least`` is 24 and ``exponent`` 3 at least."""
    found = []
    for first, end in stretches(words, least, exponent):
        numbers: dict[bytes, int] = {}
        part = [numbers.setdefault(w, len(numbers)) for w in words[first:end]]
        automaton, known = SuffixAutomaton(), {}
        for i, word in enumerate(part):
            for period in automaton.append(word):
                if known.get(period, -1) >= i:
                    continue  # within a run that is known
                start, last = i - 2 * period + 1, i
                while start > 0 and part[start - 1] == part[start - 1 + period]:
                    start -= 1
                while last + 1 < len(part) and part[last + 1] == part[last + 1 - period]:
                    last += 1
                known[period] = last
                length = last + 1 - start
                if length >= max(least, exponent * period):
                    found.append((first + start, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_periodic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words; of one in ``PERIODIC_SHARE`` ids a stretch at the start repeats to the end."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % PERIODIC_SHARE:
        return words
    g = h // PERIODIC_SHARE
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without repetitions: of each run the first period stays, unless another run drops it."""
    if not found:
        return words
    dropped = np.zeros(len(words), dtype=bool)
    for start, length, period in found:
        dropped[start + period : start + length] = True
    return [words[i] for i in np.flatnonzero(~dropped).tolist()]


def strongest(found: list[Run]) -> Run | None:
    """The run of the greatest length / period; of equal ones the first, then the one of the shortest period."""
    best = None
    for run in found:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def describe(text: bytes, doc_id: int | None, edit: bool) -> tuple:
    words = text.split()  # of bytes: ASCII white space only
    if edit:
        words = made_periodic(words, doc_id)
    found = runs(words)
    start, length, period = strongest(found) or (None, None, None)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found).encode()
    return (
        len(found), start, length, period, None if period is None else 1000 * length // period,
        hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest(),
    )


def periodic_runs(docs: DataFrame, edit: bool = False) -> DataFrame:
    """Runs of every row of ``docs`` (doc_id, text): how many, the strongest, and digests of all of them and of
    the text without repetitions.

    A null text has no words; texts of fewer than 24 words have no runs, and four nulls. With ``edit`` the
    words of a tenth of the ids are made periodic first; rows without an id stay as they are. Texts are
    read whole; memory follows the longest one's periodic stretch (some 700 bytes a word). Repeated rows
    are repeated in the result, an empty table gives no rows, further columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> dict:
        ids = batch.column("doc_id")
        texts = batch.column("text").cast(pa.binary())
        rows = [describe(t.as_py() or b"", i.as_py(), edit) for t, i in zip(texts, ids)]
        names = [field.split()[0] for field in RESULT.split(", ")][1:]
        return {"doc_id": ids, **{name: [r[k] for r in rows] for k, name in enumerate(names)}}

    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, RESULT)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), edit=True)
