"""Byte-level BPE by a rank queue on a hierarchical bitmap.

The pieces of a batch that are not known yet are laid out as one linked list with barriers between them.
Each merge rank has a bucket of list positions; a bitmap of three levels marks the buckets in use, and
its first set bit is the next rank. A position whose pair has changed meanwhile is skipped. The cost of
a piece grows with its length times the few steps through the bitmap, so very long pieces are no worse
than short ones.
"""

from __future__ import annotations

import base64

from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, table, text_of

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pieces whose ids a task remembers; more clear its memory. Only speed depends on it.
REMEMBERED = 400_000
#: Characters of the texts whose new pieces are merged together.
TOGETHER = 4_000_000
#: Bits of a token's number in a pair's key.
SHIFT = 20


class RankQueue:
    """Positions by rank; the smallest rank in use comes first. Three levels of 64-bit words."""

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // 64 + 1)
        self.mid = [0] * (ranks // 4096 + 1)
        self.top = 0
        self.buckets: defaultdict[int, list[np.ndarray]] = defaultdict(list)

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Put positions into the buckets of their ranks."""
        if len(ranks) > 1:
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            starts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            stops = [0, *starts.tolist(), len(ranks)]
            for start, stop, rank in zip(stops, stops[1:], ranks[stops[:-1]].tolist()):
                self._add(rank, positions[start:stop])
        elif len(ranks):
            self._add(int(ranks[0]), positions)

    def _add(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets[rank]
        if not bucket:
            at = rank >> 6
            self.low[at] |= 1 << (rank & 63)
            self.mid[at >> 6] |= 1 << (at & 63)
            self.top |= 1 << (at >> 6)
        bucket.append(positions)

    def first(self) -> int:
        """The smallest rank in use, or -1."""
        top = self.top
        if not top:
            return -1
        at = (top & -top).bit_length() - 1
        word = self.mid[at]
        at = at << 6 | (word & -word).bit_length() - 1
        word = self.low[at]
        return at << 6 | (word & -word).bit_length() - 1

    def take(self, rank: int) -> np.ndarray:
        """Empty a bucket; its positions in order."""
        at = rank >> 6
        self.low[at] &= ~(1 << (rank & 63))
        if not self.low[at]:
            self.mid[at >> 6] &= ~(1 << (at & 63))
            if not self.mid[at >> 6]:
                self.top &= ~(1 << (at >> 6))
        found = self.buckets.pop(rank)
        return np.unique(np.concatenate(found)) if len(found) > 1 else found[0]


class Vocabulary:
    """Tokens by rank, and the rank of every pair of tokens whose bytes are a token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        pairs = {
            self.ranks[token[:i]] << SHIFT | self.ranks[token[i:]]: rank
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        }
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.key_ranks = np.array([pairs[k] for k in self.keys.tolist()] + [-1], dtype=np.int64)
        #: Tokens that can pair up to a rank below their own.
        self.early = np.zeros(self.size, dtype=bool)
        for key, rank in pairs.items():
            for token in (key >> SHIFT, key & (1 << SHIFT) - 1):
                self.early[token] |= rank < token
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in self.ranks.items()}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens; -1 where they don't merge or one is no token."""
        keys = left.astype(np.int64) << SHIFT | right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.key_ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit numbers."""
        # One list of all bytes, with a barrier (id -1) after each piece. Merged positions get the id -2.
        data = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ends = np.cumsum(sizes + 1) - 1
        ids = self.single[data]
        ids[ends] = -1
        after, before = np.arange(1, len(ids) + 1, dtype=np.int32), np.arange(-1, len(ids) - 1, dtype=np.int32)
        # The rank of the pair that starts at a position; where it isn't a bucket's, the entry is stale.
        rank_at = np.full(len(ids), -1, dtype=np.int32)
        rank_at[:-1] = self.pair_ranks(ids[:-1], ids[1:])
        queue = RankQueue(self.size)
        found = np.flatnonzero(rank_at >= 0)
        queue.push(rank_at[found], found)
        while (rank := queue.first()) >= 0:
            at = queue.take(rank)
            at = at[rank_at[at] == rank]
            if len(at) > 1:
                at, later = self._apart(rank, at, ids, after, before, ends)
                if len(later):
                    queue.push(np.full(len(later), rank), later)
            if not len(at):
                continue
            right = after[at]
            following = after[right]
            ids[at], ids[right] = rank, -2
            rank_at[right] = -1
            after[at], before[following] = following, at
            # The first position has none before it; the last position is a barrier and stands in for it.
            previous = before[at]
            starts = np.concatenate((previous, at))
            new = self.pair_ranks(ids[starts], ids[np.concatenate((at, following))])
            rank_at[starts] = new
            rank_at[-1] = -1
            live = np.flatnonzero(new >= 0)
            if len(live):
                queue.push(new[live], starts[live])
        alive = ids >= 0
        packed = ids[alive].astype("<u4").tobytes()
        stops = np.cumsum(alive)[ends] * 4
        return [packed[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())]

    def _apart(self, rank: int, at: np.ndarray, ids: np.ndarray, after: np.ndarray, before: np.ndarray, ends: np.ndarray):
        """Positions whose pairs can merge at once, and those to look at again.

        Of pairs that overlap, every second from the left merges. In each piece, those behind the first
        that makes a pair of a smaller rank have to wait for it.
        """
        chained = after[at[:-1]] == at[1:]
        if chained.any():
            index = np.arange(len(at))
            start = np.maximum.accumulate(np.where(np.concatenate(([False], chained)), 0, index))
            at = at[(index - start) % 2 == 0]
        if not self.early[rank]:
            return at, at[:0]
        token = np.full(len(at), rank)
        following = after[after[at]]
        made = self.pair_ranks(np.concatenate((ids[before[at]], token, token)), np.concatenate((token, ids[following], token)))
        made = made.reshape(3, -1)
        touches = np.concatenate((following[:-1] == at[1:], [False]))
        lower = ((made >= 0) & (made < rank))
        lower = lower[0] | lower[1] | lower[2] & touches
        if not lower.any():
            return at, at[:0]
        earlier = np.cumsum(lower) - lower
        piece = np.searchsorted(ends, at)
        first = np.maximum.accumulate(np.where(np.diff(piece, prepend=-1) != 0, np.arange(len(at)), 0))
        now = earlier == earlier[first]
        return at[now], at[~now]


class Encoder:
    """Texts to ids and back."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = public_tokenizers.PATTERN):
        self.vocabulary, self.split = vocabulary, regex.compile(pattern).findall
        self.number: dict[str, int] = {}
        self.ids: list[bytes] = []

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        out, at = [], 0
        while at < len(texts):
            stop, chars = at, 0
            while stop < len(texts) and (stop == at or chars < TOGETHER):
                chars += len(texts[stop])
                stop += 1
            out += self._encode(texts[at:stop])
            at = stop
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.ids) > REMEMBERED:
            self.number.clear()
            self.ids.clear()
        number, ids, whole = self.number, self.ids, self.vocabulary.packed
        numbered, new = [], []
        for text in texts:
            pieces = self.split(text)
            for piece in set(pieces).difference(number):
                token = piece.encode()
                number[piece] = len(ids)
                ids.append(whole.get(token))
                if ids[-1] is None:
                    new.append((number[piece], token))
            numbered.append(np.fromiter(map(number.__getitem__, pieces), dtype=np.int32, count=len(pieces)))
        if new:
            for at, found in zip((at for at, _ in new), self.vocabulary.merge([token for _, token in new])):
                ids[at] = found
        return [b"".join([ids[n] for n in numbers.tolist()]) for numbers in numbered]

    def decode(self, ids: bytes) -> bytes:
        tokens = self.vocabulary.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The worker's vocabulary of a file."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit numbers) and decoded bytes of every row of ``docs``.

    A null text counts as empty and has no ids. Rows repeated are repeated; an empty table gives no
    rows; further columns are ignored. ``path`` is the rank file, at the same place on every machine.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    coders: list[Encoder] = []

    def run(batch: pa.RecordBatch) -> dict:
        if not coders:  # once per task
            coders.append(Encoder(vocabulary(path)))
        ids = coders[0].encode(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "ids": ids, "decoded": [coders[0].decode(i) for i in ids]}

    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")), run, "doc_id long, ids binary, decoded binary", rows=2000)


def digests(docs: DataFrame) -> DataFrame:
    return encoded(docs).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
