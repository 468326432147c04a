"""Indexes over the given tables, built once per session in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.mapping import Mapping
from quillspark.plans.query import Term
from quillspark.sources.index import Index
from quillspark.sources.versions import IndexDirectory

_built: dict[tuple[str, str, str], IndexDirectory] = {}
_own: dict[str, str] = {}

KEYWORD = {"stored": True, "fast": True}
NUMBER = {"stored": True, "fast": True}

DOCUMENTS = Mapping.build(
    [
        ("text", "text", {"stored": True}),
        ("lang", "string", KEYWORD),
        ("source", "string", KEYWORD),
        ("n_chars", "i64", NUMBER),
        ("path", "facet", {"stored": True, "fast": True}),
    ]
)
#: Texts with postings of pairs of frequent words, tables of pieces of terms, and tiers of postings.
PHRASED = Mapping.build(
    [("text", "text", {"stored": True, "pairs": True, "grams": True, "tiers": True}), ("source", "string", {**KEYWORD, "grams": True})]
)
REVISIONS = Mapping.build([*DOCUMENTS.fields, ("revision", "i64", NUMBER)])
PARTS = Mapping.build(
    [
        ("p_name", "text", {"stored": True}),
        ("p_brand", "string", KEYWORD),
        ("p_type", "string", KEYWORD),
        ("p_size", "u64", NUMBER),
        ("p_retailprice", "f64", NUMBER),
    ],
    key="p_partkey",
)
ORDERS = Mapping.build(
    [
        ("o_orderstatus", "string", KEYWORD),
        ("o_orderpriority", "string", KEYWORD),
        ("o_totalprice", "f64", NUMBER),
        ("o_orderdate", "date", NUMBER),
    ],
    key="o_orderkey",
)
EVENTS = Mapping.build(
    [
        ("event_type", "string", KEYWORD),
        ("ts", "date", NUMBER),
        ("value", "f64", NUMBER),
        ("user_id", "u64", NUMBER),
        ("big", "bool", NUMBER),
        ("ip", "ip_addr", NUMBER),
        ("tag", "bytes", {"stored": True}),
        ("props", "json", {"stored": True}),
    ],
    key="event_id",
)
MEASURES = Mapping.build(
    [(n, kind, {**NUMBER, "summary": True, "ranged": kind != "string"}) for n, kind in (("event_type", "string"), ("ts", "date"), ("value", "f64"), ("user_id", "u64"))],
    key="event_id",
)
CONVERSATIONS = Mapping.build([("text", "text", {"stored": True}), ("role", "string", KEYWORD)], key="turn_id")
PAGES = Mapping.build([("url", "string", KEYWORD), ("html", "text", {"stored": True, "tokenizer": "whitespace"})], key="page_id")
STEMMED = Mapping.build([("text", "text", {"stored": True, "tokenizer": "en_stem"})])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("path", F.concat(F.lit("/"), "lang", F.lit("/"), "source"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an address, a flag and a byte tag derived from their own columns."""
    octet = lambda shift: F.pmod(F.floor(F.col("event_id") / (256**shift)), F.lit(256)).cast("string")
    return table(spark, sf_dir, "events").withColumns(
        {
            "ip": F.concat_ws(".", F.lit("10"), octet(2), octet(1), octet(0)),
            "big": F.col("value") >= 20,
            "tag": F.concat(F.lit("t-"), "event_type"),
        }
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").withColumn("turn_id", F.col("conv_id") * 1000 + F.col("turn"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see; one of our own only where there is one process and the session names none."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or "cluster" in context.master:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="quill-")
    return _own.setdefault(context.applicationId, folder.rstrip("/"))


def _directory(
    spark: SparkSession, sf_dir: str, name: str, mapping: Mapping, fill: Callable[[IndexDirectory], None]
) -> IndexDirectory:
    known = (spark.sparkContext.applicationId, sf_dir, name)
    if known not in _built:
        directory = IndexDirectory(spark, f"{shared_folder(spark)}/indexes-{uuid.uuid4().hex}/{name}")
        directory.create(mapping)
        fill(directory)
        _built[known] = directory
    return _built[known]


def _index(spark, sf_dir, name, mapping, records) -> Index:
    return _directory(spark, sf_dir, name, mapping, lambda d: d.append(records(spark, sf_dir))).open()


def documents_index(spark: SparkSession, sf_dir: str) -> Index:
    return _index(spark, sf_dir, "documents", DOCUMENTS, documents)


def phrased_index(spark: SparkSession, sf_dir: str) -> Index:
    return _index(spark, sf_dir, "phrased", PHRASED, lambda s, d: table(s, d, "documents"))


def parts_index(spark: SparkSession, sf_dir: str) -> Index:
    return _index(spark, sf_dir, "part", PARTS, lambda s, d: table(s, d, "part"))


def orders_index(spark: SparkSession, sf_dir: str) -> Index:
    return _index(spark, sf_dir, "orders", ORDERS, lambda s, d: table(s, d, "orders"))


def events_index(spark: SparkSession, sf_dir: str) -> Index:
    return _index(spark, sf_dir, "events", EVENTS, events)


def measures_index(spark: SparkSession, sf_dir: str) -> Index:
    """Events in two batches, clicks and all others."""

    def fill(directory: IndexDirectory) -> None:
        rows = table(spark, sf_dir, "events")
        directory.append(rows.filter("event_type = 'click'"))
        directory.append(rows.filter("event_type <> 'click' or event_type is null"))

    return _directory(spark, sf_dir, "measures", MEASURES, fill).open()


def conversations_index(spark: SparkSession, sf_dir: str) -> Index:
    return _index(spark, sf_dir, "conversations", CONVERSATIONS, conversations)


def pages_index(spark: SparkSession, sf_dir: str) -> Index:
    return _index(spark, sf_dir, "pages", PAGES, lambda s, d: table(s, d, "pages"))


def stemmed_index(spark: SparkSession, sf_dir: str) -> Index:
    return _index(spark, sf_dir, "stemmed", STEMMED, documents)


def replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New texts for the Spanish documents."""
    docs = documents(spark, sf_dir).filter(F.col("lang") == "es")
    return docs.withColumn("text", F.concat(F.lit("replaced text of "), "source"))


def lifecycle(spark: SparkSession, sf_dir: str) -> IndexDirectory:
    """Versions 1 and 2 add the English and the other documents, 3 deletes the French ones, 4 replaces
    the Spanish ones, and 5 deletes one source while adding back the French documents."""

    def fill(directory: IndexDirectory) -> None:
        docs = documents(spark, sf_dir)
        directory.append(docs.filter(F.col("lang") == "en"))
        directory.append(docs.filter(F.col("lang") != "en"))
        directory.delete("lang", "fr")
        directory.upsert(replacements(spark, sf_dir))
        directory.replace(Term("source", "src1"), docs.filter(F.col("lang") == "fr"))

    return _directory(spark, sf_dir, "lifecycle", DOCUMENTS, fill)
