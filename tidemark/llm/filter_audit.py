"""Filter interaction audit by failing-id relations.

One table per filter holds the ids of the rows that fail it. A left-semi and a left-anti join with each of
them split the rows into classes that fail the same filters; two more with the labelled ids split off the
label losses. What survives a prefix of an order, what a filter removes after it and what it would have
removed again are unions of such classes, so the 120 orders cost five joins on narrow rows, not 600.
"""

from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, cut, table, text_of

#: Orders that have given filters before one and the other filters after it, by the number before it.
ORDERS_BY_EARLIER = (24, 6, 4, 6, 24)

Failing = dict[str, Column]


def text_rules(text: Column) -> Failing:
    """Failure conditions A to D over a text that isn't null."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 50,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 65,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 5,
        "D": text.rlike(r"[#$%&*|]"),
    }


def numbered_rows(docs: DataFrame) -> DataFrame:
    """Narrow rows with a number of their own: rows that agree in everything count once, with their copies.

    Texts are told apart by their SHA-256. Copies are counted before the shuffle, so a row repeated many
    times, or one id on many rows, fills no task.
    """
    text = text_of("text")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        *(rule.alias(name) for name, rule in text_rules(text).items()),
    )
    rows = narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("copies"))
    return cut(rows.withColumn("row_id", F.monotonically_increasing_id()))


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """One stored id table per filter.

    Filter E fails every row but the first of its text: the anti join is on digest and id together, so
    the copies of a text are spread. Rows without an id are neither earlier nor later than others.
    """
    known = rows.where(F.col("doc_id").isNotNull())
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    failing = {name: rows.where(F.col(name)) for name in "ABCD"}
    failing["E"] = known.join(first, ["digest", "doc_id"], "left_anti")
    return {name: cut(found.select("row_id")) for name, found in failing.items()}


def split(rows: DataFrame, ids: DataFrame, key: str, column: str, mark: str) -> DataFrame:
    """Append ``mark`` to a column of the rows whose key is among the ids."""
    among = rows.join(ids, key, "left_semi").withColumn(column, F.concat(column, F.lit(mark)))
    return cut(among.unionByName(rows.join(ids, key, "left_anti")))


def classes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows per part and set of failed filters (``failed``, like ``ACE``), and those labelled good and toxic."""
    numbered = numbered_rows(docs)
    rows = numbered.select("row_id", "doc_id", "part", "copies", F.lit("").alias("failed"))
    for name, ids in failing_ids(numbered).items():
        rows = split(rows, ids, "row_id", "failed", name)
    # Of one id there are few such groups, so an id on very many rows is no hot key of the labels.
    rows = rows.groupBy("doc_id", "part", "failed").agg(F.sum("copies").alias("copies")).withColumn("label", F.lit(""))
    for mark, wanted in (("g", F.col("quality") == 1), ("t", F.col("toxic") == 1)):
        rows = split(rows, labels.where(wanted).select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "label", mark)

    def labelled(mark: str) -> Column:
        return F.sum(F.when(F.contains("label", F.lit(mark)), F.col("copies")).otherwise(0))

    return cut(
        rows.groupBy("part", "failed").agg(
            F.sum("copies").alias("n"), labelled("g").alias("good"), labelled("t").alias("toxic")
        )
    )


def prefixes(found: DataFrame, filters: str) -> DataFrame:
    """Counts per part, set of earlier filters and next filter, summed over the classes."""
    pairs = [
        ("".join(earlier), name)
        for name in filters
        for k in range(len(filters))
        for earlier in combinations([f for f in filters if f != name], k)
    ]
    pair = F.array(*(F.struct(F.lit(e).alias("earlier"), F.lit(f).alias("filter")) for e, f in pairs))
    rows = found.select("*", F.inline(pair))
    fails = F.contains("failed", "filter")
    gone = F.expr("translate(failed, earlier, '') <> failed")

    def total(condition: Column, column: str) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    return rows.groupBy("part", "earlier", "filter").agg(
        total(~gone & ~fails, "n").alias("kept"),
        total(~gone & fails, "n").alias("removed"),
        total(gone & fails, "n").alias("redundant"),
        total(F.col("failed") == F.col("filter"), "n").alias("unique_fails"),
        total(~gone & fails, "good").alias("good_lost"),
        total(~gone & fails, "toxic").alias("toxic_lost"),
    )


def audit(docs: DataFrame, labels: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row per part of ``docs`` (doc_id, text, source), order of the filters and step.

    Null and empty texts are one text, null and empty sources one part. Repeated rows count each; a row
    without an id has no labels and repeats no text. A document is labelled good or toxic if any row of
    ``labels`` (doc_id, quality, toxic) says so. Texts are read whole, of any length. An empty table gives
    no rows, parts without removals rows of zeros; further columns are ignored.
    """
    spark = docs.sparkSession
    by_prefix = prefixes(classes(docs, labels), filters)
    weight = F.element_at(F.array(*map(F.lit, ORDERS_BY_EARLIER)), F.length("earlier") + 1)
    value = F.sum(F.col("removed") * weight).over(W.partitionBy("part", "filter"))  # of 16 rows
    steps = [
        ("".join(order), step + 1, "".join(sorted(order[:step])), order[step])
        for order in permutations(filters)
        for step in range(len(filters))
    ]
    orders = spark.createDataFrame(steps, "filter_order string, step int, earlier string, filter string")
    return (
        by_prefix.withColumn("shapley", value)
        .join(F.broadcast(orders), ["earlier", "filter"])
        .select(
            "part", "filter_order", "step",
            *(F.col(c).cast("long").alias(c) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")),
        )
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), f AS (
  SELECT part,
         CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN EXISTS (SELECT 1 FROM (SELECT t, min(doc_id) AS low FROM d GROUP BY t) m WHERE m.t = w.t AND m.low < w.doc_id) THEN 'E' ELSE '' END AS failed,
         CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS good,
         CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS toxic
  FROM w
), c AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed
), l AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x
), s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS earlier
  FROM o, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step)
), x AS (
  SELECT *, contains(failed, filter) AS fails, translate(failed, earlier, '') <> failed AS gone FROM c, s
), r AS (
  SELECT part, filter_order, step, filter,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = filter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM x GROUP BY part, filter_order, step, filter
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r
"""
