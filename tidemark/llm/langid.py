"""Language identification by compression.

Each language has a raw-content Zstandard dictionary of its own text. A text is compressed with every
dictionary, in blocks so that a long text can't become its own dictionary, and the language whose
dictionary makes it smallest is chosen. Where the runner-up is nearly as small, the choice is narrow.
"""

from __future__ import annotations

import math

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, held_out, table, text_of

#: Texts per language that a dictionary is made of, characters of each at most, and bytes of the dictionary:
#: the bounded sample that is learned from. Each text gets an equal part of the bytes.
SAMPLE_ROWS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 2000, 256 << 10
BLOCK_BYTES = 4096
LEVEL = 3
#: A choice is narrow if the runner-up is larger by less than this share.
MARGIN = 0.01
#: Steepness of the score in the relative difference of sizes.
SHARPNESS = 40.0
UNKNOWN = "und"

#: What ``normal`` keeps, for Spark.
LETTER = r"\p{L}"

_other = regex.compile(r"\P{L}+").sub


def normal(text: str | None) -> str:
    """Lower-case words of letters, separated by blanks; empty if there is no letter."""
    return _other(" ", (text or "").lower()).strip()


def training_text(docs: DataFrame) -> dict[str, bytes]:
    """A dictionary's bytes for each language, from a bounded sample of the rows that may be learned from.

    Texts are drawn by their hash: the same texts whatever the partitioning. Copies of a text count once
    and texts without a letter don't count, both for the share drawn of each language and in what is drawn.
    """
    rows = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select("lang", "text", F.xxhash64(text_of("text")).alias("drawn")).where(F.col("text").rlike(LETTER))
    counts = rows.select("lang", "drawn").distinct().groupBy("lang").count().collect()  # one row per language
    if not counts:
        return {}
    share = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], min(1.0, 2 * SAMPLE_ROWS / r["count"]))))
    low = (F.col("drawn").cast("double") / 2.0**64 + 0.5) <= share[F.col("lang")]
    middle = F.substring(F.col("text"), F.greatest(F.lit(1), F.length("text") / 2 - SAMPLE_CHARS / 2).cast("int"), F.lit(SAMPLE_CHARS))
    first = F.regexp_extract("text", f"(?s){LETTER}.{{0,{SAMPLE_CHARS - 1}}}", 0)  # the middle may have no letter
    passage = F.when(middle.rlike(LETTER), middle).otherwise(first)
    sample = rows.where(low).groupBy("lang", "drawn").agg(F.min(passage).alias("text")).collect()
    texts: dict[str, list[str]] = {r["lang"]: [] for r in counts}
    for lang, _, text in sorted(sample, key=lambda r: (r[0], r[1], r[2] or "")):
        if len(texts[lang]) < SAMPLE_ROWS and (text := normal(text)):
            texts[lang].append(text)
    out = {}
    for lang, parts in texts.items():
        each = DICTIONARY_BYTES // max(1, len(parts))
        data = b" ".join(p.encode()[: max(each, 200)] for p in parts)[-DICTIONARY_BYTES:]
        if data:
            out[lang] = data
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.compressors = []
        for lang in self.langs:
            data = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False).compress)

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes of a normalised text with the dictionary of each language."""
        data = text.encode()
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        return [sum(len(c(b)) for b in blocks) for c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the choice is narrow. Ties go to the first language by name."""
        text = normal(text)
        if not text or not self.langs:
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        weights = [math.exp(-SHARPNESS * (s - sizes[best]) / sizes[best]) for s in sizes]
        runner_up = min((s for i, s in enumerate(sizes) if i != best), default=math.inf)
        return self.langs[best], 1 / sum(weights), runner_up - sizes[best] < MARGIN * sizes[best]


def predictions(docs: DataFrame, dictionaries: dict[str, bytes], reject: bool = True) -> DataFrame:
    """doc_id, lang_pred, score, narrow of every row of ``docs`` (doc_id, text).

    ``und`` stands for texts that are null or have no letter, for all texts if nothing was learned and,
    with ``reject``, for narrow choices. Rows repeated are repeated; an empty table gives no rows;
    further columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    models: list[Classifier] = []

    def run(batch: pa.RecordBatch) -> dict:
        if not models:  # once per task
            models.append(Classifier(shared.value))
        model = models[0]
        found = [model.predict(t) for t in batch.column("text").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "lang_pred": [UNKNOWN if reject and narrow else lang for lang, _, narrow in found],
            "score": [score for _, score, _ in found],
            "narrow": [narrow for _, _, narrow in found],
        }

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return by_batch(rows, run, "doc_id long, lang_pred string, score double, narrow boolean")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predictions(docs, training_text(docs), reject=False).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "narrow"
    )
