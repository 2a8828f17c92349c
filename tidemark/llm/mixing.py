"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is -ln(u) / w: u is uniform and follows from the id, the text and, of rows that agree in
both, the number of the copy; w is the quality weight of the text. Within its source, documents are taken in the order of their keys until the word budget is met.
Whole epochs over a source precede the part that is drawn by key.

The order within a source is never made in one task: keys are cut into buckets of about a thousand
rows, and running sums are built of rows within a bucket, of buckets within a run of buckets, and of
those runs within the source. Buckets are equal steps of the key's logarithm: a weight only shifts that
logarithm, and its density is nowhere above 1/e, so no mix of weights can fill one bucket. Nor can an id
that many rows have, or none, as every row has a key of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, cut, fresh, small, table, text_of

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix has, and how often a document may occur in it.
TOTAL, MOST_EPOCHS = 1.5, 2
ROWS_PER_BUCKET, BUCKETS_PER_RUN = 1000, 1000
#: Highest density of the logarithm of an exponential variable, 1/e.
DENSITY = 0.368
#: Copies of a row that one task numbers at a time.
COPIES_PER_BLOCK = 100_000


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def quality_weight(text: Column) -> Column:
    """Share of letters and white space among the characters, smoothed to stay above zero."""
    chars = F.length(text)
    odd = F.regexp_count(text, F.lit(r"[^\p{L}\x20\x09-\x0D]"))
    return (chars - odd + 1).cast("double") / (chars + 1).cast("double")


def sampling_key(doc_id: Column, digest: Column, copy: Column, weight: Column) -> Column:
    name = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), digest, copy.cast("string"))
    drawn = F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("double")
    return -F.log((drawn + 0.5) / float(2**48)) / weight


def key_bucket(key: Column, n_buckets: Column) -> Column:
    """Buckets in the order of the keys, each with about one of ``n_buckets`` shares of the rows at most."""
    return F.floor(F.log(key) * n_buckets * DENSITY)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size).

    Targets share ``total`` of all words by weight. Filling stops at ``MOST_EPOCHS`` times a source's
    size; in the order of that cap per unit of weight, the sources that the level passes are the full ones.
    """
    name = F.col("source").asc_nulls_last()
    turn = (F.row_number().over(W.orderBy(name)) - 1) % len(weights)
    everything = W.partitionBy()
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), name)
    before, rest = by_cap.rowsBetween(W.unboundedPreceding, -1), by_cap.rowsBetween(0, W.unboundedFollowing)
    levels = (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), turn + 1))
        .withColumn("cap", F.col("source_size").cast("double") * MOST_EPOCHS)
        .withColumn("total", F.sum("source_size").over(everything).cast("double") * total)
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("full", F.col("cap") * F.sum("weight").over(rest) <= F.col("left") * F.col("weight"))
    )
    open_words = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    return levels.withColumn(
        "target", F.when(F.col("full"), F.col("cap")).otherwise(open_words / open_weight * F.col("weight"))
    )


def running_sum(rows: DataFrame) -> DataFrame:
    """Add ``before``: the words of the rows of the same ``part`` that come earlier by (key, doc_id, size)."""
    run = F.floor(F.col("bucket") / BUCKETS_PER_RUN)
    buckets = rows.groupBy("part", "bucket").agg(F.sum("size").alias("words")).withColumn("run", run)
    runs = buckets.groupBy("part", "run").agg(F.sum("words").alias("run_words"))

    def earlier(column: str, partition: list[str], order: list) -> Column:
        window = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    runs = runs.select("part", "run", earlier("run_words", ["part"], ["run"]).alias("run_before"))
    buckets = buckets.join(runs, ["part", "run"]).select(
        "part", "bucket", (F.col("run_before") + earlier("words", ["part", "run"], ["bucket"])).alias("bucket_before")
    )
    within = earlier("size", ["part", "bucket"], ["key", F.col("doc_id").asc_nulls_last(), "size"])
    return rows.join(buckets, ["part", "bucket"]).withColumn("before", F.col("bucket_before") + within)


def numbered_copies(entities: DataFrame) -> DataFrame:
    """A row per copy of each entity, numbered from 0. Very many copies are dealt to several tasks by blocks."""
    last = F.floor((F.col("rows") - 1) / COPIES_PER_BLOCK).cast("long")
    blocks = entities.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition("doc_id", "digest", "block")
    start = F.col("block") * COPIES_PER_BLOCK
    return blocks.withColumn("copy", F.explode(F.sequence(start, F.least(start + COPIES_PER_BLOCK, F.col("rows")) - 1))).drop("block")


def mix(entities: DataFrame) -> DataFrame:
    """Target, source_size and ``copies`` of each row of ``entities``, see ``sized``: one row per row of the documents.

    A source's copies come as near to its target as whole documents allow. Sources are few (their names
    are ordered in one task); rows are not.
    """
    words = F.sum(F.col("size") * F.col("rows")).alias("source_size")
    sizes = cut(entities.groupBy("source").agg(words, F.sum("rows").alias("n_rows")))
    per_source = cut(
        source_targets(sizes).select(
            F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).alias("part"),
            F.col("source").alias("mixed"),
            "source_size",
            "target",
            F.ceil(F.col("n_rows") / ROWS_PER_BUCKET).cast("long").alias("n_buckets"),
        )
    )
    keyed = numbered_copies(entities).join(small(per_source), F.col("source").eqNullSafe(F.col("mixed"))).withColumn(
        "key", sampling_key(F.col("doc_id"), F.col("digest"), F.col("copy"), F.col("weight"))
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    drawn = (budget > 0) & (F.col("before") * 2 + F.col("size") <= budget * 2)
    return (
        running_sum(keyed.withColumn("bucket", key_bucket(F.col("key"), F.col("n_buckets"))))
        .withColumn("epochs", epochs)
        .withColumn("copies", F.col("epochs") + drawn.cast("long"))
    )


def text_digest() -> Column:
    return F.sha2(text_of("text"), 256)


def sized(docs: DataFrame) -> DataFrame:
    """Entities: rows that agree in id, source and text count once, with their number ``rows``."""
    text = text_of("text")
    narrow = docs.select("doc_id", "source", text_digest().alias("digest"), size_of(text).alias("size"), quality_weight(text).alias("weight"))
    return narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("rows"))


def mixture(docs: DataFrame) -> DataFrame:
    """How many words of every row of ``docs`` (doc_id, text, source) the mix takes.

    A null text has no words and takes none; rows without a source are a source of their own, the last.
    Repeated rows, and rows that share an id or have none, are drawn each for itself. Texts are read whole,
    of any length. An empty table, or one without words, gives targets of zero. Further columns are ignored.
    """
    return mix(cut(sized(docs))).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def repeat_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in the mix, each as often as it is taken, with all their columns.

    Of rows that agree in id, source and text together as many are given as are drawn for them: each the
    same number, and what is left over by one of them. Nulls, empty texts, repeated rows and empty tables are
    as in ``mixture``.
    """
    digest, each, rest = fresh(docs, "digest", "each", "rest")
    drawn = mix(cut(sized(docs))).groupBy("doc_id", "source", "digest").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    share = F.floor(F.col("copies") / F.col("rows"))
    shares = cut(
        drawn.where("copies > 0").select(
            F.col("doc_id").alias("c_id"), F.col("source").alias("c_source"), F.col("digest").alias("c_digest"),
            share.cast("int").alias("c_each"), (F.col("copies") - share * F.col("rows")).cast("int").alias("c_rest"),
        )
    )
    left, right = docs.withColumn(digest, text_digest()).alias("d"), shares.alias("c")
    same = (
        (F.col(f"d.{digest}") == F.col("c.c_digest"))
        & F.col("d.doc_id").eqNullSafe(F.col("c.c_id"))
        & F.col("d.source").eqNullSafe(F.col("c.c_source"))
    )
    taken = left.join(right, same).select("d.*", F.col("c.c_each").alias(each), F.col("c.c_rest").alias(rest))

    def times(rows: DataFrame, column: str) -> DataFrame:
        return rows.withColumn(column, F.explode(F.array_repeat(F.lit(1), F.col(column)))).select(*docs.columns)

    left_over = taken.where(F.col(rest) > 0)
    return times(taken, each).unionByName(times(left_over.dropDuplicates(["doc_id", "source", digest]), rest))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), e AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size,
         CAST(length(regexp_replace(t, '[^\p{L}\x20\x09-\x0D]', '', 'g')) + 1 AS DOUBLE) / CAST(length(t) + 1 AS DOUBLE) AS w,
         CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || sha256(t) || ':'
              || (row_number() OVER (PARTITION BY doc_id, source, t) - 1)), 1, 12) AS BIGINT) AS DOUBLE) AS x
  FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM e GROUP BY source
), r AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         source_size * 2.0::DOUBLE AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total
  FROM s
), f AS (
  SELECT *, cap * sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         <= (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS filled
  FROM r
), t AS (
  SELECT source, source_size,
         CASE WHEN filled THEN cap
              ELSE (total - coalesce(sum(CASE WHEN filled THEN cap END) OVER (), 0)) / sum(CASE WHEN NOT filled THEN weight END) OVER () * weight
         END AS target
  FROM f
), k AS (
  SELECT e.doc_id, e.size, t.source_size, t.target,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs,
         coalesce(sum(e.size) OVER (PARTITION BY e.source ORDER BY -ln((x + 0.5) / 281474976710656.0::DOUBLE) / w, doc_id NULLS LAST, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (epochs + CASE WHEN target - epochs * source_size > 0 AND before * 2 + size <= (target - epochs * source_size) * 2 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM k
"""
