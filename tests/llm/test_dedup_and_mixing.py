"""The cuckoo index, exact duplicates of odd rows, and the mixture."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import cuckoo_dedup, mixing, simhash


def test_cuckoo_index_is_a_dictionary():
    index, plain, draw = cuckoo_dedup.CuckooIndex(2), {}, random.Random(1)
    for step in range(20_000):
        digest = hashlib.sha256(str(draw.randrange(3000)).encode()).hexdigest()
        if draw.random() < 0.6:
            if index.find(digest) is None:
                index.insert(digest, step)
                plain[digest] = step
        else:
            assert index.delete(digest) == (plain.pop(digest, None) is not None)
        assert index.size == len(plain)
    assert dict(index) == plain
    assert index.mask > 2  # it has grown


def test_exact_groups_of_odd_rows(odd_docs):
    rows = cuckoo_dedup.exact_groups(odd_docs).collect()
    copies = [r for r in rows if r.text_sha256 == hashlib.sha256(b"Alphabetagammadelta").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in copies} == {(2, 5)}
    assert [r.doc_id for r in copies if r.kept] == [2]
    empty = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in empty} == {(6, 4)}


def test_drop_copies_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (None, None), (None, ""), (3, "x")]
    kept = cuckoo_dedup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text or "") for r in kept) == Counter([(1, "a b"), (None, ""), (3, "x")])


def test_one_hot_group_leaves_each_task_as_one_entry(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'same text' AS text").repartition(8)
    found = cuckoo_dedup.exact_groups(docs).groupBy("keep_id", "group_size", "kept").count().collect()
    assert {(r.keep_id, r.group_size, r.kept, r["count"]) for r in found} == {(0, 20_000, True, 1), (0, 20_000, False, 19_999)}


def test_an_index_that_starts_anew_loses_no_row(spark, monkeypatch):
    monkeypatch.setattr(cuckoo_dedup, "MOST_ENTRIES", 50)
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('text ', id % 700) AS text").repartition(3)
    found = cuckoo_dedup.exact_groups(docs).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in found} == {(i, i % 700, 6 if i % 700 < 500 else 5) for i in range(4000)}
    assert sum(r.kept for r in found) == 700


def test_no_weights_fill_one_bucket(spark):
    weight = "CASE WHEN id % 3 = 0 THEN 0.001D WHEN id % 3 = 1 THEN 0.5D ELSE 1D END"
    keys = spark.range(300_000).select("id", mixing.F.expr(weight).alias("w"))
    key = mixing.sampling_key(mixing.F.col("id"), mixing.F.lit("d"), mixing.F.lit(0), mixing.F.col("w"))
    largest = keys.groupBy(mixing.key_bucket(key, mixing.F.lit(300))).count().agg({"count": "max"}).first()[0]
    assert largest < 1.3 * mixing.ROWS_PER_BUCKET


def test_targets_equal_filling_step_by_step(spark):
    sizes = {"a": 100, "b": 100, "c": 10, "d": 500, None: 40}
    weights = dict(zip(sizes, (3, 1, 2, 3, 1)))
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest, open_weight = total - sum(2 * sizes[s] for s in full), sum(weights[s] for s in sizes if s not in full)
        share = {s: rest * weights[s] / open_weight for s in sizes if s not in full}
        over = {s for s, target in share.items() if target > 2 * sizes[s]}
        if not over:
            break
        full |= over
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: round(r.target, 6) for r in mixing.source_targets(frame).collect()}
    assert found == {s: round(share.get(s, 2.0 * sizes[s]), 6) for s in sizes}


def test_mixture_meets_its_targets(spark, sf):
    rows = mixing.op4_mixing(spark, sf).collect()
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    taken, target, largest = Counter(), {}, defaultdict(int)
    for r in rows:
        s = sources[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)
    again = mixing.mixture(spark.read.parquet(f"{sf}/documents.parquet").repartition(5)).collect()
    assert sorted(again) == sorted(rows)


def test_running_sum_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKETS_PER_RUN", 3)
    rows = [(p, (k * 7919) % 101 // 10, float((k * 7919) % 101), k, k % 5) for p in (1, 2) for k in range(101)]
    frame = spark.createDataFrame(rows, "part int, bucket long, key double, doc_id long, size long")
    found = {(r.part, r.doc_id): r.before for r in mixing.running_sum(frame).collect()}
    for p in (1, 2):
        total = 0
        for _, _, _, doc_id, size in sorted((r for r in rows if r[0] == p), key=lambda r: (r[2], r[3])):
            assert found[p, doc_id] == total
            total += size


def test_one_id_on_many_rows_spreads_over_the_buckets(spark):
    """Rows that share an id, have none, or are full copies of one row."""
    F = mixing.F
    docs = spark.range(12_000).select(
        F.when(F.col("id") < 4000, 7).when(F.col("id") < 8000, None).otherwise(9).cast("long").alias("doc_id"),
        F.when(F.col("id") < 8000, F.concat(F.lit("text "), F.col("id"))).otherwise("the same text").alias("text"),
        F.lit("s").alias("source"),
    )
    copies = mixing.numbered_copies(mixing.sized(docs))
    assert copies.count() == 12_000
    key = mixing.sampling_key(F.col("doc_id"), F.col("digest"), F.col("copy"), F.col("weight"))
    assert copies.select(key).distinct().count() == 12_000
    buckets = copies.groupBy("doc_id", mixing.key_bucket(key, F.lit(12)).alias("b")).count().groupBy("doc_id").agg({"count": "max"})
    assert max(r[1] for r in buckets.collect()) < 1500


def test_copies_are_numbered_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES_PER_BLOCK", 7)
    rows = [(1, "a", "x", 1, 1.0, 20), (2, "a", "y", 1, 1.0, 1), (None, None, "z", 1, 1.0, 7)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, digest string, size long, weight double, rows long")
    found = [(r.doc_id, r.copy) for r in mixing.numbered_copies(frame).collect()]
    assert sorted(found, key=str) == sorted([(1, i) for i in range(20)] + [(2, 0)] + [(None, i) for i in range(7)], key=str)


def test_stage_takes_what_the_mix_takes(spark):
    """Rows without an id, rows that repeat an id, and repeated rows: the stage gives the words that are drawn."""
    rows = [(None, f"one two three {i % 50}", "a") for i in range(300)] + [(5, "word " * (i % 7), "b") for i in range(200)]
    rows += [(6, "same row", "b")] * 90 + [(None, None, None), (7, "", "a"), (8, "x y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, given = Counter(), Counter()
    for r in mixing.mixture(docs).collect():
        taken[r.doc_id] += r.taken
    for r in mixing.repeat_rows(docs).collect():
        given[r.doc_id] += len((r.text or "").split())
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in given.items() if v}
    assert sum(taken.values()) > 1000


@pytest.mark.parametrize("drop", [cuckoo_dedup.drop_copies, simhash.drop_near_copies])
def test_unclear_ids_are_judged_by_content(spark, drop):
    """Rows that share an id with another text, or have none, beside rows with ids of their own; the same if ids are too many to send."""
    rows = [(i, f"text number {i % 40} of many words here") for i in range(120)]
    rows += [(7, "another text under the same id"), (None, "text number 3 of many words here"), (None, "a text that only a row without id has")]
    rows += [(None, "a text that only a row without id has"), (500, "twice the same row"), (500, "twice the same row")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("strange_id", F.lit("clash"))
    kept = sorted(((r.doc_id, r.text) for r in drop(frame).collect()), key=str)
    expected = [(i, f"text number {i} of many words here") for i in range(40)]
    expected += [(7, "another text under the same id"), (None, "a text that only a row without id has"), (500, "twice the same row")]
    assert kept == sorted(expected, key=str)


def test_texts_are_not_shuffled_to_drop_few(spark):
    frame = spark.range(2000).selectExpr("id AS doc_id", "concat_ws(' ', sha2(string(id), 256), sha2(string(-id), 256)) AS text")
    for drop in (cuckoo_dedup.drop_copies, simhash.drop_near_copies):
        kept = drop(frame)
        assert kept.count() == 2000
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
