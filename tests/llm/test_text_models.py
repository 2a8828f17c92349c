"""Classifiers on rows that nothing was learned from; tokens against the tiktoken library; fingerprints by hand."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from tidemark.llm import bpe, improbable, langid, quality, simhash

LARGER = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark, sf):
    rows = quality.op1_quality(spark, LARGER).toPandas().merge(spark.read.parquet(f"{LARGER}/labels.parquet").toPandas(), on="doc_id")
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    held = rows[rows.held_out]
    assert (held.predicted == held.quality).mean() >= 0.95
    assert held.score.between(0, 1).all()


def test_quality_scores_do_not_depend_on_partitions(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    one = {r.doc_id: r.score for r in quality.scored(docs, labels).collect()}
    other = {r.doc_id: r.score for r in quality.scored(docs.repartition(7), labels.repartition(3)).collect()}
    assert one == other


def test_quality_without_labels(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.scored(odd_docs, labels).collect()} == {0.5}


def test_temperature_and_layers_fit_a_plain_rule():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(2000, quality.FEATURES))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    net = quality.fit(x, y)
    assert ((net.scores(x) > 0.5) == y).mean() > 0.85
    assert net.temperature > 0


def test_language_on_held_out_rows(spark):
    rows = langid.op10_language_id(spark, LARGER).toPandas()
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang").toPandas()
    held = rows.merge(docs, on="doc_id").query("held_out")
    assert (held.lang_pred == held.lang).mean() >= 0.95
    assert held.score.between(0, 1).all()


def test_language_unknown_and_narrow(spark):
    texts = {"en": b"the and of with that this from " * 200, "de": "der die das und nicht für über ".encode() * 200}
    docs = spark.createDataFrame([(1, "of with that this from the and of with that this from"), (2, None), (3, " 12 !?"), (4, "q")], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in langid.predictions(docs, texts).collect()}
    assert found == {1: "en", 2: "und", 3: "und", 4: "und"}
    assert {r.doc_id: r.lang_pred for r in langid.predictions(docs, {}).collect()} == dict.fromkeys(range(1, 5), "und")


def test_language_sample_gathers_a_copied_text_once(spark):
    copies = spark.range(5000).selectExpr("id AS doc_id", "'und die der das nicht' AS text", "'de' AS lang")
    others = spark.range(5000, 5300).selectExpr("id AS doc_id", "concat('the and of ', chr(97 + id % 26), id) AS text", "'en' AS lang")
    found = langid.training_text(copies.unionByName(others))
    assert found.get("de", b"") in (b"", b"und die der das nicht")
    assert len(found["en"]) > 200


def test_language_share_is_of_distinct_texts_with_letters(spark):
    word = "translate(cast({} AS string), '0123456789', 'abcdefghij')"
    copies = spark.range(40_000).selectExpr("id AS doc_id", f"concat('der die das ', {word.format('id % 20')}) AS text", "'de' AS lang")
    blank = spark.range(40_000, 60_000).selectExpr("id AS doc_id", "concat('', id) AS text", "'fr' AS lang")
    few = spark.range(60_000, 60_050).selectExpr("id AS doc_id", f"concat('le la les ', {word.format('id')}) AS text", "'fr' AS lang")
    far = spark.range(70_000, 70_020).selectExpr("id AS doc_id", "concat('el la los', repeat(' ', 9000)) AS text", "'es' AS lang")
    docs = copies.unionByName(blank).unionByName(few).unionByName(far)
    found = langid.training_text(docs)
    assert found["de"].count(b"der die das") == 20
    learned = few.where(~langid.held_out(few.doc_id)).count()
    assert found["fr"].count(b"le la les") == learned
    assert found["es"] == b"el la los"


def test_quality_rows_repeated_teach_once(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.train(docs, labels).network
    vectors = quality.word_vectors(docs)
    original = quality.word_vectors
    quality.word_vectors = lambda _: vectors  # the vectors count every row
    try:
        again = quality.train(docs.unionByName(docs), labels).network
    finally:
        quality.word_vectors = original
    assert np.array_equal(found.w1, again.w1) and found.b2 == again.b2


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(public_tokenizers.path(bpe.VOCABULARY)))


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


def test_bpe_equals_the_library(encoder, library):
    draw = random.Random(3)
    texts = ["", "a", "aaaaaaa", "a" * 1001, "é" * 300, "日本語テキスト😀" * 20, " \n\n  x", "it's 'RE", "<|endoftext|>"]
    texts += ["".join(draw.choice("etaoin srh'1.\n") for _ in range(draw.randint(0, 90))) for _ in range(500)]
    texts += ["".join(chr(draw.choice([draw.randint(32, 0x2FFF), draw.randint(97, 122)])) for _ in range(draw.randint(0, 60))) for _ in range(500)]
    texts += ["".join(draw.choice("abc") for _ in range(20_000))]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_bpe_one_very_long_piece(encoder, library):
    text = "".join(random.Random(5).choice("abcdefgh") for _ in range(200_000))
    ids = encoder.encode([text])[0]
    assert encoder.decode(ids) == text.encode()
    assert len(np.frombuffer(ids, "<u4")) == len(library.encode_ordinary(text))


def test_bpe_query(spark, sf, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in bpe.op9_byte_bpe(spark, sf).collect():
        ids = library.encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()


def test_rank_queue_finds_the_smallest():
    queue, draw = bpe.RankQueue(50_000), random.Random(2)
    ranks = [draw.randrange(50_000) for _ in range(300)]
    queue.push(np.array(ranks), np.arange(300))
    seen = []
    while (rank := queue.first()) >= 0:
        seen += [rank] * len(queue.take(rank))
    assert seen == sorted(ranks)


def plain_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_by_hand():
    for text in ("", " \n", "One", "one TWO", "a b c a b c a b c d", "É é ß \x1c x\xa0y z", "w " * 5000):
        assert simhash.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)


def test_equal_pairs_by_hand():
    data = np.random.default_rng(4).integers(97, 105, 300).astype(np.uint8)
    expected = [(int((w[:, None] == w).sum()) - len(w)) // 2 for w in np.lib.stride_tricks.sliding_window_view(data, improbable.WINDOW)]
    assert improbable.equal_pairs(data).tolist() == expected
    assert len(improbable.equal_pairs(data[:5])) == 0


def test_features_by_hand():
    ranks = np.random.default_rng(5).integers(0, 50, 400).astype(np.int16)
    popular = {}
    for i in range(len(ranks) - improbable.NEIGHBOURS + 1):
        at = i + int(np.argmin(ranks[i : i + improbable.NEIGHBOURS]))
        popular[at] = popular.get(at, 0) + 1
    assert improbable.features(ranks).tolist() == sorted(a for a, n in popular.items() if n >= improbable.POPULAR)


def test_short_texts_have_features_over_their_length(spark):
    draw = np.random.default_rng(6)
    words = ["".join(map(chr, draw.integers(97, 123, int(n)))) for n in draw.integers(2, 9, 400)]
    texts = [" ".join(draw.choice(words, 200))[:size] for size in (32, 40, 62, 80, 100, 200, 300, 400) for _ in range(20)]
    maker = improbable.Fingerprinter(improbable.rarity(spark.createDataFrame([(t,) for t in texts], "text string")))

    def chain(text):
        return maker.chain(text.encode(), maker.windows(text.encode()))

    assert min(int(chain(t).sizes.sum()) for t in texts) >= 3
    for size in (32, 62, 80, 200, 400):
        group = [t for t in texts if len(t) == size]
        near = [improbable.likeness(chain(a), chain(a[: size - size // 2] + b[: size // 2])) for a, b in zip(group, group[1:])]
        other = [improbable.likeness(chain(a), chain(b)) for a, b in zip(group, group[1:])]
        assert 0.2 < np.mean(near) < 0.9
        assert np.mean(near) > np.mean(other) + 0.15


def test_short_passages_are_found_in_texts_of_any_length(spark):
    draw = np.random.default_rng(16)
    words = ["".join(map(chr, draw.integers(97, 123, int(n)))) for n in draw.integers(2, 9, 2000)]
    texts = [" ".join(draw.choice(words, 2000)) for _ in range(20)]
    maker = improbable.Fingerprinter(improbable.rarity(spark.createDataFrame([(t,) for t in texts], "text string")))

    def alike(one, other):
        return improbable.likeness(*(maker.chain(t.encode(), maker.windows(t.encode())) for t in (one, other)))

    for size in (500, 1000, 1023, 1024, 1025, 1100, 2000, 5000):
        found = [alike(t[:255], t[:size]) for t in texts]
        other = [alike(t[:255], u[:size]) for t, u in zip(texts, texts[1:])]
        assert np.mean(found) > 0.3 and np.mean(found) > np.mean(other) + 0.25, size


def test_windows_across_a_seam(spark):
    maker = improbable.Fingerprinter({w: np.arange(improbable.most_pairs(w)) for w, _, _ in improbable.KINDS})
    text = np.random.default_rng(17).integers(97, 105, 500).astype(np.uint8).tobytes()
    for cut in (0, 2, 8, 30, 31, 32, 250, 490, 500):
        head, tail = text[:cut], text[cut:]
        found = maker.edited(head, maker.windows(head), tail, maker.windows(tail))
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(found, maker.windows(text)))
    assert [[w.tolist() for w in x] for x in maker.of_all([text[:7], b"", text])] == [[w.tolist() for w in maker.windows(t)] for t in (text[:7], b"", text)]


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_documents_without_an_id_and_repeated_ones(spark, monkeypatch, size):
    """The order is by id, then by the hash of the text; rows without an id are the last. No range holds them all."""
    monkeypatch.setattr(improbable, "RANGE_BYTES", size)
    monkeypatch.setattr(improbable, "RANGE_SQUARE", 0)
    rows = [(None, f"none {i % 40} {'x' * i}") for i in range(60)] + [(7, f"seven {i}") for i in range(60)]
    rows += [(-3, "copy")] * 5 + [(None, "copy")] * 50 + [(None, None), (1, None), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = {r.text: r.h for r in docs.selectExpr("coalesce(text, '') text", "xxhash64(coalesce(text, '')) h").distinct().collect()}
    plain = sorted((doc_id is None, doc_id if doc_id is not None else hashed[text or ""], hashed[text or ""], text or "") for doc_id, text in rows)
    expected = []
    for (unknown, doc_id, _, text), (_, _, _, following) in zip(plain, plain[1:] + plain[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected.append((-99 if unknown else doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    found = [(-99 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in improbable.fingerprints(docs).collect()]
    assert sorted(found) == sorted(expected)
    spans = {r.span: r["count"] for r in improbable.neighbours(docs).where("at_end = 0").groupBy("span").count().collect()}
    assert size > 1 or max(spans.values()) == 1


def test_improbable_query_against_plain_version(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    maker = improbable.Fingerprinter(improbable.rarity(spark.read.parquet(f"{sf}/documents.parquet")))

    def chain(text):
        return maker.chain(text.encode(), maker.windows(text.encode()))

    rows = {r.doc_id: r for r in improbable.op7_improbable(spark, sf).collect()}
    assert len(rows) == len(docs)
    for (doc_id, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = rows[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (str(chain(text)), str(chain(edited)))
        assert row.near_edited == improbable.likeness(chain(text), chain(edited))
        assert row.near_next == improbable.likeness(chain(text), chain(following))
    long = [r for (_, t), r in ((d, rows[d[0]]) for d in docs) if len(t) > 1000]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.3


def test_numerals_are_no_letters(spark):
    rows = [(i, f"der die das und {i} haus" if i % 2 else f"the and of to {i} house", "de" if i % 2 else "en") for i in range(60)]
    rows += [(100, "²½", "en"), (101, "Ⅻ ①", "de"), (102, "12 34", "en"), (103, "ª", None), (104, "é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in langid.predictions(docs, langid.training_text(docs), reject=False).collect()}
    assert [found[i] for i in (100, 101, 102)] == ["und"] * 3
    assert found[103] != "und" and found[104] != "und"
    assert langid.normal("a²b Ⅻ c1d") == "a b c d"
