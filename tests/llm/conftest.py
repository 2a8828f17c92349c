import os

import pytest
from pyspark.sql import functions as F

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    return SF


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns whose names clash."""
    rows = [
        (1, "Alpha beta gamma delta", "en", "s1", 22),
        (1, "Alpha beta gamma delta", "en", "s1", 22),
        (2, "Alpha  beta\tgamma\ndelta ", "en", "s1", 24),
        (3, "Alphabeta gammadelta", None, "s2", None),
        (4, "", "en", None, 0),
        (5, None, None, None, None),
        (None, "Alpha beta gamma delta", "de", "s2", 22),
        (None, None, None, None, None),
        (6, " \n\t ", "fr", "s2", 4),
        (7, "wort " * 40_000, "de", "s3", 200_000),
        (8, "x" * 100_000, "de", "s3", 100_000),
        (9, "日本語😀 e\u0301 ÀÉ", "ja", "s4", 12),
        (9, "other text of the same id", "en", "s4", 25),
        (-5, "negative", "en", "s4", 8),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    clash = ("n", "h", "fp", "digest", "size", "weight", "before", "key", "score", "root", "span", "ord", "rows", "row", "keep_id", "Component_Id")
    return frame.select("*", *(F.lit("clash").alias(c) for c in clash))


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def folder(tmp_path_factory, spark, odd_docs):
    """A folder with the odd documents, and pages and labels to match."""
    path = tmp_path_factory.mktemp("odd")
    odd_docs.write.parquet(f"{path}/documents.parquet")
    labels = [(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, None), (3, 0, None), (7, 0, 1), (9, 1, 0)]
    spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("clash")).write.parquet(f"{path}/labels.parquet")
    long = "<article><p>" + "word " * 50_000 + "</p></article>"
    pages = [
        (1, "http://A.Example.NET/en/1?q", long),
        (2, "http://a.example.net/en/2", long),
        (2, "http://a.example.net/en/2", long),
        (3, None, None),
        (4, "no scheme", ""),
        (5, "http://casino.example.org", "<p>short</p>"),
        (None, "http://x.com/de/", long),
        (None, None, None),
        (6, "x://example.com/de/x\ny", "<article><nav>no</nav><p>a &amp; b"),
        (7, "http:///p#f", "é" * 600),
    ]
    frame = spark.createDataFrame(pages, PAGES)
    frame.select("*", *(F.lit("clash").alias(c) for c in ("host", "path", "n", "token", "digest", "shared", "template", "last"))).write.parquet(f"{path}/pages.parquet")
    return str(path)


@pytest.fixture(scope="session")
def empty_folder(tmp_path_factory, spark):
    path = tmp_path_factory.mktemp("empty")
    for name, schema in (("documents", DOCS), ("pages", PAGES), ("labels", LABELS)):
        spark.createDataFrame([], schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)
