"""Document quality: random-indexing word vectors, pooled, and a two-layer network with calibrated scores.

Every word has a sparse random index vector. A word's vector is the sum of the index vectors around its
occurrences in the whole corpus, so words of like surroundings have like vectors. Words share a table of
fixed size by their hash, which bounds what is summed, shuffled and broadcast.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, by_batch, cut, fresh, held_out, on_workers, slices, table, text_of, to_batch

#: Rows of the word table, length of a vector, entries other than zero of an index vector, words on either side.
ROWS, DIM, NONZERO, REACH = 1 << 15, 32, 4, 2
SEED = 7
#: The table is summed in so many parts.
PARTS = 64
#: The classifier is fitted on about so many labelled rows at most.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
HIDDEN, EPOCHS, RATE, DECAY = 24, 60, 3e-3, 1e-4
#: Words that a task remembers the row of, and words handled at once. Results don't depend on them.
REMEMBERED, SUMMED_AT_ONCE, POOLED_AT_ONCE = 300_000, 1_000_000, 100_000
FEATURES = 3 * DIM + 5
SUMS = "part long, sums binary"


class Rows(dict):
    """A word's row of the table; row ROWS is a gap."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        row = self[word] = zlib.crc32(word.encode()) % ROWS
        return row


    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        return np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the entries of each row's index vector; a gap has none."""
    draw = np.random.default_rng(SEED)
    places = draw.random((ROWS + 1, DIM)).argsort(axis=1)[:, :NONZERO].astype(np.int64)
    signs = draw.choice(np.array([-1.0, 1.0]), (ROWS + 1, NONZERO))
    signs[ROWS] = 0
    return places, signs


# -- word vectors


def sum_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The context sums of a task's texts, by part of the table."""
    places, signs = index_vectors()
    total = np.zeros((ROWS + 1) * DIM)
    gap = np.full(REACH, ROWS, dtype=np.int32)
    seen, known = False, Rows()
    for batch in (part for whole in batches for part in slices(whole, 2000)):
        for texts in in_runs(batch.column(0).to_pylist(), known, SUMMED_AT_ONCE):
            pieces = [gap]
            for rows in texts:
                pieces += (rows, gap)
            words = np.concatenate(pieces).astype(np.int64)
            seen = True
            for step in range(1, REACH + 1):
                for of, near in ((words[step:], words[:-step]), (words[:-step], words[step:])):
                    for k in range(NONZERO):
                        total += np.bincount(of * DIM + places[near, k], signs[near, k], minlength=len(total))
    if seen:
        # Sums of ones are whole numbers: exact, and the same however the rows are dealt out.
        parts = np.split(total[: ROWS * DIM].astype("<i8"), PARTS)
        pack = zstandard.ZstdCompressor(level=1).compress
        yield to_batch({"part": range(PARTS), "sums": [pack(p.tobytes()) for p in parts]}, arrow_schema(SUMS))


def in_runs(texts: list[str | None], rows: Rows, words: int) -> Iterator[list[np.ndarray]]:
    """Texts as rows of the table, a few at a time."""
    run, held = [], 0
    for text in texts:
        run.append(rows.of(text))
        held += len(run[-1])
        if held >= words:
            yield run
            run, held = [], 0
    if run:
        yield run


def add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = np.frombuffer(unpack(packed), dtype="<i8")
            sums[part] = sums[part] + found if part in sums else found
    if sums:
        yield to_batch({"part": list(sums), "sums": [s.tobytes() for s in sums.values()]}, arrow_schema(SUMS))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of unit vectors, ROWS + 1 by DIM; words that don't occur, and the gap, are zero."""
    on_workers(docs.sparkSession)
    sums = docs.select(text_of("text").alias("text")).mapInArrow(sum_contexts, SUMS).repartition("part").mapInArrow(add_sums, SUMS)
    out = np.zeros((PARTS, ROWS // PARTS * DIM))
    for row in sums.collect():  # PARTS rows, together the table
        out[row["part"]] = np.frombuffer(row["sums"], dtype="<i8")
    vectors = out.reshape(ROWS, DIM)
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1.0)
    return np.vstack([vectors, np.zeros((1, DIM))]).astype(np.float32)


# -- pooling


class Pooler:
    """A text's features: mean and spread of its word vectors, mean of its index vectors, likeness of neighbours, length."""

    def __init__(self, vectors: np.ndarray):
        places, signs = index_vectors()
        self.vectors, self.known = vectors, Rows()
        self.index = np.zeros((ROWS + 1, DIM), dtype=np.float32)
        np.put_along_axis(self.index, places, signs.astype(np.float32), axis=1)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        runs = [self._pool(run) for run in in_runs(texts, self.known, POOLED_AT_ONCE)]
        return np.vstack(runs) if runs else np.zeros((0, FEATURES), dtype=np.float32)

    def _pool(self, run: list[np.ndarray]) -> np.ndarray:
        gap = np.array([ROWS], dtype=np.int32)  # after each text, so that none is empty
        words = np.concatenate([x for rows in run for x in (rows, gap)])
        sizes = np.array([len(rows) for rows in run])
        starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        count = np.maximum(sizes, 1).astype(np.float32)[:, None]
        found, index = self.vectors[words], self.index[words]
        mean = np.add.reduceat(found, starts, axis=0) / count
        spread = np.sqrt(np.maximum(np.add.reduceat(found * found, starts, axis=0) / count - mean * mean, 0))
        bag = np.add.reduceat(index, starts, axis=0) / count
        like = np.zeros(len(words), dtype=np.float32)
        like[:-1] = np.einsum("ij,ij->i", found[:-1], found[1:])
        same = np.zeros(len(words), dtype=np.float32)
        same[:-1] = np.einsum("ij,ij->i", index[:-1], index[1:]) / NONZERO
        return np.hstack(
            [
                mean,
                spread,
                bag,
                np.linalg.norm(mean, axis=1, keepdims=True),
                np.linalg.norm(bag, axis=1, keepdims=True),
                np.add.reduceat(like, starts)[:, None] / count,
                np.add.reduceat(same, starts)[:, None] / count,
                np.log1p(sizes)[:, None],
            ]
        ).astype(np.float32)


# -- network


@dataclass
class Network:
    """Two layers on standardised features; the temperature divides the logit."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.shift) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Train on four fifths of the rows and choose the temperature on the rest.

    With labels of one kind only, or none, every score is the smoothed share of label 1.
    """
    x, y = x.astype(np.float64).reshape(-1, FEATURES), y.astype(np.float64)
    draw = np.random.default_rng(SEED)
    share = (y.sum() + 1) / (len(y) + 2)
    shift = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
    scale = (x.std(axis=0) if len(x) else np.zeros(FEATURES)) + 1e-3
    net = Network(
        shift, scale, draw.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), np.zeros(HIDDEN),
        np.zeros(HIDDEN), float(np.log(share / (1 - share))),
    )
    if len(np.unique(y)) < 2:
        return net
    net.w2 = draw.normal(0, HIDDEN**-0.5, HIDDEN)
    order = draw.permutation(len(x))
    rest, used = order[: len(x) // 5], order[len(x) // 5 :]
    z = np.clip((x - shift) / scale, -8, 8)
    weights = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        for rows in np.array_split(draw.permutation(used), max(1, len(used) // 128)):
            step += 1
            a = np.tanh(z[rows] @ weights[0] + weights[1])
            error = (1 / (1 + np.exp(-np.clip(a @ weights[2] + weights[3], -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - a * a)
            slopes = [z[rows].T @ back + DECAY * weights[0], back.sum(axis=0), a.T @ error + DECAY * weights[2], error.sum(keepdims=True)]
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(weights[3][0])
    if len(rest):
        logits = net.logits(x[rest])
        tried = np.geomspace(0.25, 8, 61)
        loss = [np.mean(np.logaddexp(0, logits / t) - y[rest] * logits / t) for t in tried]
        net.temperature = float(tried[int(np.argmin(loss))])
    return net


# -- operators


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and quality of a bounded sample of the labelled rows that may be learned from."""
    marks = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    marks = cut(marks.groupBy("doc_id").agg(F.max("quality").alias("quality")))
    share = min(1.0, SAMPLE_ROWS / max(1, marks.count()))
    drawn = marks.where(F.xxhash64("doc_id").cast("double") / 2.0**64 + 0.5 < share)
    texts = docs.select("doc_id", "text")
    return texts.join(F.broadcast(drawn), "doc_id")  # about SAMPLE_ROWS narrow rows at most


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Word vectors of all documents, and a network fitted on a bounded sample of the labelled ones."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    poolers: list[Pooler] = []

    def run(batch: pa.RecordBatch) -> dict:
        if not poolers:
            poolers.append(Pooler(shared.value))
        pooled = poolers[0](batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "quality": batch.column("quality"), "x": [r.tobytes() for r in pooled]}

    rows = labelled(docs, labels).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("quality").cast("int").alias("quality"))
    # A row that is repeated teaches once: a single id may have any number of them.
    pooled = by_batch(rows, run, "doc_id long, quality int, x binary").distinct()
    found = sorted(pooled.collect(), key=lambda r: (r["doc_id"], r["x"]))
    x = np.frombuffer(b"".join(r["x"] for r in found), dtype=np.float32).reshape(-1, FEATURES)
    return Model(vectors, fit(x, np.array([r["quality"] for r in found])))


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score of a text, 0 to 1; a null text counts as empty."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    shared = spark.sparkContext.broadcast(model)
    poolers: list[Pooler] = []

    def run(texts: pd.Series) -> pd.Series:
        if not poolers:
            poolers.append(Pooler(shared.value.vectors))
        return pd.Series(shared.value.network.scores(poolers[0](texts.tolist())), dtype="float64")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return pandas_udf(run, "double")(text_of(text))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text).

    ``labels`` has doc_id and quality; a label that is null, or without an id, teaches nothing, of
    repeated labels the largest counts. Without labels every score is one half. Rows repeated are
    repeated and teach once; an empty table gives no rows; further columns are ignored.
    """
    found = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(docs.sparkSession, train(docs, labels), F.col("text")).alias("score")
    )
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least ``THRESHOLD``, with all their columns."""
    score = fresh(docs, "score")[0]
    marked = docs.withColumn(score, score_column(docs.sparkSession, train(docs, labels), F.col("text")))
    return marked.where(F.col(score) >= THRESHOLD).select(*docs.columns)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
