from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillspark.mapping import Mapping  # noqa: E402
from quillspark.sources.index import Index  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


# The small corpora whose answers the tests know.
STORED = {"stored": True}
ARTICLES = Mapping.build([("title", "text", STORED), ("body", "text", STORED), ("category", "string", STORED)])
ARTICLE_ROWS = [
    (0, "Elixir Programming", "Elixir is a functional language", "tech"),
    (1, "Rust Systems", "Rust is a systems language", "tech"),
    (2, "Cooking Pasta", "How to make great pasta", "food"),
    (3, "Elixir Phoenix", "Phoenix is a web framework for Elixir", "tech"),
]
GUIDES = Mapping.build(
    [("title", "text", STORED), ("body", "text", STORED), ("slug", "string", STORED), ("category", "string", STORED)]
)
GUIDE_ROWS = [
    (0, "Quick Brown Fox", "The quick brown fox jumps", "quick-fox", "animals"),
    (1, "Elixir Programming", "Learn elixir programming today", "elixir-prog", "tech"),
    (2, "Elixir Phoenix Guide", "Build web apps with phoenix", "elixir-phoenix", "tech"),
    (3, "Rust Systems", "Systems programming with rust", "rust-systems", "tech"),
]
PRODUCTS = Mapping.build(
    [
        ("title", "text", STORED),
        ("category", "string", {"stored": True, "fast": True}),
        ("price", "f64", {"stored": True, "fast": True}),
        ("quantity", "u64", {"stored": True, "fast": True}),
    ]
)
PRODUCT_ROWS = [
    (0, "Laptop Pro", "electronics", 999.99, 10),
    (1, "Laptop Basic", "electronics", 499.99, 25),
    (2, "Phone X", "electronics", 799.99, 50),
    (3, "Running Shoes", "sports", 89.99, 100),
    (4, "Tennis Racket", "sports", 149.99, 30),
    (5, "Novel Book", "books", 14.99, 200),
    (6, "Cookbook", "books", 24.99, 150),
]


@pytest.fixture(scope="session")
def articles(spark):
    rows = spark.createDataFrame(ARTICLE_ROWS, "doc_id bigint, title string, body string, category string")
    return Index.in_memory(rows, ARTICLES)


@pytest.fixture(scope="session")
def guides(spark):
    rows = spark.createDataFrame(GUIDE_ROWS, "doc_id bigint, title string, body string, slug string, category string")
    return Index.in_memory(rows, GUIDES)


@pytest.fixture(scope="session")
def products(spark):
    rows = spark.createDataFrame(PRODUCT_ROWS, "doc_id bigint, title string, category string, price double, quantity bigint")
    return Index.in_memory(rows, PRODUCTS)


def ids(frame, key="doc_id"):
    return [r[key] for r in frame.collect()]
