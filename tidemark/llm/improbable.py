"""Fingerprints of improbable features: rare byte windows in chained Bloom filters.

The entropy of a window is measured by its equal pairs of bytes (collision entropy), and its rarity by how
often the corpus has that entropy. Where a window is the rarest of most of its neighbours it is a
feature. Features go into a chain of small Bloom filters; fingerprints are compared by the bits that
filters have in common beyond chance.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, by_batch, cut, slices, small, table, text_of, to_batch

#: Bytes of a window; neighbours it is compared with; how often of these it must be the rarest.
WINDOW, NEIGHBOURS, POPULAR = 32, 64, 16
#: Fewer windows have neighbours and popularity in proportion: this share of them, and a quarter of that.
SHARE = 6
#: Windows, and from and to how many bytes a text has features of them. All texts of 16 bytes and more share one kind,
#: so a short text is found in a text of any length.
KINDS = ((WINDOW, 256, None), (8, 16, None), (4, 4, 64))
#: Bits of a filter, hashes of a feature, features of a filter.
BITS, HASHES, FULL = 2048, 4, 128
#: Bytes of a range of documents, at least, and its square by the bytes of all: 100 TB have 1.6 million ranges of 63 MB.
RANGE_BYTES, RANGE_SQUARE = 1 << 20, 40
#: Keys that one task sorts to find the ranges, and tasks for that at most; bytes of texts of one task.
KEY_ROWS, KEY_TASKS, TASK_BYTES = 10_000, 20_000, 32 << 20
#: What a row counts beside its text.
ROW_BYTES = 64
#: Bytes measured at once.
AT_ONCE = 1 << 20
#: What documents are in the order of: those without an id come last, by the hash of their text.
KEY = ("unknown", "ord", "h")
OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
COUNTED = f"{OUT}, times long"


def most_pairs(window: int) -> int:
    return window * (window - 1) // 2 + 1


def equal_pairs(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each window, the number of its pairs of equal bytes."""
    n = len(data) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int16)
    ahead, behind = np.zeros(len(data), dtype=np.uint8), np.zeros(len(data), dtype=np.uint8)
    for lag in range(1, window):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        ahead[:-lag] += same
        behind[lag:] += same
    first = data[:window]
    start = int((first[:, None] == first[None, :]).sum() - window) // 2
    # A step drops the pairs of the byte that leaves and adds those of the byte that enters.
    change = behind[window:].astype(np.int16) - ahead[: n - 1]
    out = np.empty(n, dtype=np.int16)
    out[0] = start
    np.cumsum(change, dtype=np.int16, out=out[1:])
    out[1:] += np.int16(start)
    return out


def measured(texts: list[bytes], measure: Callable[[bytes], np.ndarray], window: int) -> Iterator[np.ndarray]:
    """What ``measure`` gives for each window of each text, measured for many texts at a time."""
    at = 0
    while at < len(texts):
        stop, held = at, 0
        while stop < len(texts) and (stop == at or held < AT_ONCE):
            held += len(texts[stop])
            stop += 1
        values = measure(b"".join(texts[at:stop]))
        start = 0
        for text in texts[at:stop]:
            yield values[start : max(start, start + len(text) - window + 1)]
            start += len(text)
        at = stop


def in_kind(text: bytes, least: int, most: int | None) -> bool:
    return least <= len(text) and (most is None or len(text) <= most)


def rarity(docs: DataFrame) -> dict[int, np.ndarray]:
    """By window, the rank of each number of equal pairs: 0 for the one that the corpus has least often.

    Numbers that no text has come first, in order. All windows of WINDOW bytes of all documents count; shorter windows
    count in the texts that have features of them.
    """
    starts = np.cumsum([0, *(most_pairs(w) for w, _, _ in KINDS)])

    def run(batch: pa.RecordBatch) -> dict:
        found = np.zeros(starts[-1], dtype=np.int64)
        texts = [t.encode() for t in batch.column(0).to_pylist()]
        for (window, least, most), start in zip(KINDS, starts):
            size = most_pairs(window)
            some = texts if window == WINDOW else [t for t in texts if in_kind(t, least, most)]
            for pairs in measured(some, lambda data: equal_pairs(np.frombuffer(data, dtype=np.uint8), window), window):
                found[start : start + size] += np.bincount(pairs, minlength=size)
        has = np.flatnonzero(found)
        return {"pairs": has, "n": found[has]}

    rows = by_batch(docs.select(text_of("text").alias("text")), run, "pairs long, n long").groupBy("pairs").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(starts[-1], dtype=object)  # so many rows at most
    for row in rows:
        counts[row["pairs"]] = row["n"]
    out = {}
    for (window, _, _), start in zip(KINDS, starts):
        ranks = np.empty(most_pairs(window), dtype=np.int64)
        ranks[sorted(range(len(ranks)), key=lambda p: (counts[start + p], p))] = np.arange(len(ranks))
        out[window] = ranks
    return out


def features(ranks: np.ndarray) -> np.ndarray:
    """Positions of the windows that are the rarest, first from the left, of at least POPULAR runs of neighbours.

    Few windows have fewer neighbours and need fewer runs. Where no window is popular enough the most popular is it.
    """
    n = len(ranks)
    if not n:
        return np.zeros(0, dtype=np.int64)
    keys = ranks.astype(np.int64) << 40 | np.arange(n)
    near = min(NEIGHBOURS, max(1, n // SHARE))
    width = 1
    while width * 2 <= near:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    rest = near - width
    if rest:
        keys = np.minimum(keys[:-rest], keys[rest:])
    rarest = keys & (1 << 40) - 1
    starts = np.flatnonzero(np.diff(rarest, prepend=-1))
    runs = np.diff(starts, append=len(rarest))
    chosen = rarest[starts[runs >= max(1, near * POPULAR // NEIGHBOURS)]]
    return chosen if len(chosen) else rarest[starts[[int(runs.argmax())]]]


def feature_hashes(data: bytes, at: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A 64-bit hash of each window that starts at a position."""
    windows = np.frombuffer(data, dtype=np.uint8)[at[:, None] + np.arange(window)].copy().view("<u8" if window % 8 == 0 else "<u4").astype(np.uint64)
    out = np.full(len(at), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for k in range(windows.shape[1]):
        out = (out ^ windows[:, k]) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xC4CEB9FE1A85EC53)
        out ^= out >> np.uint64(29)
    return out


class Chain:
    """Bloom filters of a text's features, and how many features each has."""

    def __init__(self, hashes: np.ndarray):
        _, first = np.unique(hashes, return_index=True)
        hashes = hashes[np.sort(first)]  # a feature counts once
        count = -(-len(hashes) // FULL)
        self.sizes = np.minimum(FULL, len(hashes) - np.arange(count) * FULL)
        bits = np.zeros((count, BITS), dtype=np.uint8)
        rows = np.arange(len(hashes)) // FULL
        for k in range(HASHES):
            bits[rows, (hashes >> np.uint64(16 * k)).astype(np.int64) % BITS] = 1
        self.filters = np.packbits(bits, axis=1)
        self.weights = bits.sum(axis=1, dtype=np.int64)

    def __str__(self) -> str:
        """Number of features, then the filters in hexadecimal."""
        return f"{int(self.sizes.sum())}:" + self.filters.tobytes().hex()


def likeness(one: Chain, other: Chain) -> float:
    """0 to 1: for each filter of the shorter chain the best overlap with one of the other, weighed by features.

    An overlap is the share of the bits in common, of the smaller number of bits set, beyond what chance gives.
    Chains of the same filters are alike by 1, as two empty ones are; one empty chain is like no other.
    """
    if one.filters.shape == other.filters.shape and (one.filters == other.filters).all():
        return 1.0
    if not len(one.sizes) or not len(other.sizes):
        return 0.0
    if (len(one.sizes), str(one)) > (len(other.sizes), str(other)):
        one, other = other, one
    best = []
    for bits, weight in zip(one.filters, one.weights):
        common = np.bitwise_count(bits & other.filters).sum(axis=1, dtype=np.int64)
        least = np.minimum(weight, other.weights)
        chance = weight * other.weights / BITS
        best.append(float(np.max(np.clip((common - chance) / np.maximum(least - chance, 1e-9), 0, 1))))
    return float(np.average(best, weights=one.sizes))


class Fingerprinter:
    """Chains of texts, by the ranks of ``rarity``."""

    def __init__(self, ranks: dict[int, np.ndarray]):
        self.ranks = ranks

    def rare(self, data: bytes, window: int) -> np.ndarray:
        """The rank of each window. Short windows are often equally rare: bits of a hash decide between them, as
        places differ in an edited text."""
        if len(data) < window:
            return np.zeros(0, dtype=np.int64)
        ranks = self.ranks[window][equal_pairs(np.frombuffer(data, dtype=np.uint8), window)]
        if window == WINDOW:
            return ranks
        words = np.ndarray(len(data) - window + 1, f"<u{window}", data, strides=(1,)).astype(np.uint64)
        words *= np.uint64(0x9E3779B97F4A7C15)
        words ^= words >> np.uint64(29)
        words *= np.uint64(0xBF58476D1CE4E5B9)
        return ranks << 16 | (words >> np.uint64(48)).astype(np.int64)

    def windows(self, text: bytes) -> list[np.ndarray]:
        """The ranks of a text's windows by kind."""
        return [self.rare(text, window) for window, _, _ in KINDS]

    def of_all(self, texts: list[bytes]) -> list[list[np.ndarray]]:
        return [list(x) for x in zip(*(measured(texts, lambda data, w=w: self.rare(data, w), w) for w, _, _ in KINDS))]

    def chain(self, text: bytes, windows: list[np.ndarray]) -> Chain:
        parts = [
            feature_hashes(text, features(rare), window)
            for (window, least, most), rare in zip(KINDS, windows)
            if in_kind(text, least, most)
        ]
        if not parts and text:  # the shortest are one feature, an empty text has none
            parts = [np.array([int.from_bytes(hashlib.sha256(text).digest()[:8], "little")], dtype=np.uint64)]
        return Chain(np.concatenate(parts) if parts else np.array([], dtype=np.uint64))

    def edited(self, head: bytes, head_windows: list[np.ndarray], tail: bytes, tail_windows: list[np.ndarray]) -> list[np.ndarray]:
        """The windows of head + tail: those within either are known, those across the seam are measured."""
        out = []
        for (window, _, _), one, other in zip(KINDS, head_windows, tail_windows):
            reach = window - 1
            if len(head) < reach or len(tail) < reach:
                out.append(self.rare(head + tail, window))
            else:
                seam = self.rare(head[-reach:] + tail[:reach], window)
                out.append(np.concatenate((one[: len(head) - reach], seam, other[: len(tail) - reach])))
        return out


def prefix_bytes(text: str, data: bytes, chars: int) -> int:
    """Bytes of the first so many code points."""
    return chars if len(text) == len(data) else len(text[:chars].encode())


def compare(rows: list[tuple], maker: Fingerprinter) -> dict:
    """From rows (doc_id, text, times) in order: all but the last with their edited text and likenesses.

    Of rows that are there several times all but the last are followed by themselves.
    """
    texts = [text for _, text, _ in rows]
    data = [text.encode() for text in texts]
    windows = maker.of_all(data)
    chains = [maker.chain(*x) for x in zip(data, windows)]
    out: dict[str, list] = {name: [] for name in arrow_schema(COUNTED).names}
    for i in range(len(rows) - 1):
        doc_id, _, copies = rows[i]
        chars = len(texts[i])
        half = chars // 2
        head = data[i][: prefix_bytes(texts[i], data[i], chars - half)]
        for then, times in ((i + 1, 1), (i, copies - 1)):
            if not times:
                continue
            tail = data[then][: prefix_bytes(texts[then], data[then], half)]
            text = head + tail
            chain = chains[i] if text == data[i] else maker.chain(text, maker.edited(head, windows[i], tail, windows[then]))
            values = doc_id, chars, hashlib.sha256(text).hexdigest(), str(chains[i]), str(chain), likeness(chains[i], chain), likeness(chains[i], chains[then]), times
            for name, value in zip(out, values):
                out[name].append(value)
    return out


def key_bytes(unknown: np.ndarray, ord: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Keys as bytes in the same order."""
    out = np.empty((len(ord), 17), dtype=np.uint8)
    out[:, 0] = unknown
    for at, part in ((1, ord), (9, h)):
        flipped = part.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        out[:, at : at + 8] = flipped.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S17").reshape(-1)


def range_starts(keys: DataFrame) -> np.ndarray:
    """The key that each range begins with, in order. ``keys`` has KEY and bytes, every key once.

    The keys are sorted in parts; a part's first key begins a range, and so does the key after each so many bytes.
    """
    rows, size = keys.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    most = range_bytes(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column("bytes").to_numpy()
            ranges = (np.cumsum(sizes) - sizes + (before[1] if before else 0)) // most
            starts = np.flatnonzero(np.diff(ranges, prepend=before[0] if before else -1))
            yield batch.select(list(KEY)).take(pa.array(starts))
            before = ranges[-1], (before[1] if before else 0) + int(sizes.sum())

    parts = keys.repartitionByRange(max(2, min(KEY_TASKS, rows // KEY_ROWS)), *KEY).sortWithinPartitions(*KEY)
    found = parts.mapInArrow(run, "unknown boolean, ord long, h long").toArrow()
    return np.array(sorted(key_bytes(*(found.column(c).to_numpy() for c in KEY)).tolist()), dtype="S17")


def range_bytes(size: int) -> int:
    """Bytes of a range: they grow with the root of all bytes, as the number of ranges does."""
    return max(RANGE_BYTES, math.isqrt(RANGE_SQUARE * size))


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows (span, at_end, unknown, ord, h, doc_id, text, times): all documents by ranges of their order, and at the end of
    each range the first document of the next. The first of all follows the last.

    Rows that repeat an id follow each other by the hash of their text; rows without an id are the last, in the order of
    that hash. Rows that repeat both are one row, with their number.
    """
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    rows = rows.withColumn("unknown", F.col("doc_id").isNull()).withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("ord", F.coalesce("doc_id", "h"))
    keys = cut(rows.groupBy(*KEY).agg(F.count("*").alias("times"), (F.max(F.octet_length("text")) + ROW_BYTES).cast("long").alias("bytes")))
    repeated = cut(keys.where("times > 1").select(*KEY, "times"))
    if repeated.isEmpty():
        rows = rows.withColumn("times", F.lit(1).cast("long"))
    else:
        rows = rows.join(small(repeated), list(KEY), "left")
        copies = rows.where("times IS NOT NULL").groupBy(*KEY, "doc_id").agg(F.first("text").alias("text"), F.first("times").alias("times"))
        rows = rows.where("times IS NULL").withColumn("times", F.lit(1).cast("long")).unionByName(copies)
    starts = range_starts(keys)

    def place(unknown: pd.Series, ord: pd.Series, h: pd.Series) -> pd.Series:
        keys = key_bytes(unknown.to_numpy(dtype=np.uint8), ord.to_numpy(), h.to_numpy())
        at = np.searchsorted(starts, keys, side="right") - 1
        return pd.Series(at * 2 + (starts[at] == keys), dtype="int64")

    place.__annotations__ = {"unknown": pd.Series, "ord": pd.Series, "h": pd.Series, "return": pd.Series}
    # Twice the range, and one more for the row that begins it: that one is the guest of the range before, too.
    rows = rows.withColumn("place", pandas_udf(place, "long")(*KEY))
    own, first, count = F.expr("place DIV 2"), F.col("place") % 2 == 1, max(1, len(starts))
    guest = F.struct(F.pmod(own - 1, F.lit(count)).alias("span"), F.lit(1).alias("at_end"))
    spans = F.struct(own.alias("span"), F.lit(0).alias("at_end"))
    rows = rows.select(F.inline(F.when(first, F.array(spans, guest)).otherwise(F.array(spans))), *KEY, "doc_id", "text", "times")
    size = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES)
    return rows.repartition(tasks, "span").sortWithinPartitions("span", "at_end", *KEY)


def follow(batches: Iterator[pa.RecordBatch], maker: Fingerprinter) -> Iterator[pa.RecordBatch]:
    """From rows in the order of a span: every row but the last of a span, with the next."""
    schema, held, span = arrow_schema(COUNTED), [], None
    size = 0
    for batch in (part for whole in batches for part in slices(whole)):
        for at, doc_id, text, times in zip(*(batch.column(n).to_pylist() for n in ("span", "doc_id", "text", "times"))):
            if at != span:
                if len(held) > 1:
                    yield to_batch(compare(held, maker), schema)
                held, span, size = [], at, 0
            held.append((doc_id, text, times))
            size += len(text)
            if size >= AT_ONCE and len(held) > 1:
                yield to_batch(compare(held, maker), schema)
                held, size = held[-1:], len(text)
    if len(held) > 1:
        yield to_batch(compare(held, maker), schema)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text) and of its edited text, and their likenesses.

    The second half of the edited text is replaced by the start of the next document. A null text counts
    as empty, and an empty text has no features. A single document is its own next. Rows repeated are
    repeated, and worked on once; rows without an id come last; an empty table gives no rows; further columns are ignored.
    A very long text is a range of its own.
    """
    maker = Fingerprinter(rarity(docs))
    rows = neighbours(docs).select("span", "doc_id", "text", "times")
    found = rows.mapInArrow(lambda batches: follow(batches, maker), COUNTED)
    return found.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times")


def op7_improbable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
