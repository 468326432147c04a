"""Schema checks, projection, coercion and stored fields: SC1 to SC5."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions.coerce import coerce, coerce_permissive, conform_report, project
from quillspark.mapping import Mapping
from quillspark.operators.profile import field_profile
from quillspark.operators.search import search
from registry import corpora, query, sql

RAW_FIELDS = [
    ("title", "text"),
    ("number", "i64"),
    ("size", "u64"),
    ("ratio", "f64"),
    ("flag", "bool"),
    ("day", "date"),
    ("address", "ip_addr"),
    ("path", "facet"),
    ("missing", "string"),
]
RAW = Mapping.build(RAW_FIELDS)

# Records as text, some of them bad, derived from the documents; once for Spark and once for SQL.
_RAW_SQL = """raw AS (SELECT doc_id, text AS title,
  CASE lang WHEN 'en' THEN substr(source, 4) WHEN 'fr' THEN source END AS number,
  CASE WHEN lang = 'de' THEN '-' || CAST(n_chars AS VARCHAR) ELSE CAST(n_chars AS VARCHAR) END AS size,
  CASE lang WHEN 'es' THEN '1.5x' ELSE substr(source, 4) || '.25' END AS ratio,
  CASE lang WHEN 'en' THEN 'true' WHEN 'de' THEN 'false' WHEN 'fr' THEN 'yes' END AS flag,
  CASE lang WHEN 'en' THEN '2024-03-05T10:20:30.75+02:00' WHEN 'fr' THEN '2024-03-05' ELSE '2024-03-05T08:20:30Z' END AS day,
  CASE lang WHEN 'de' THEN '10.0.0.256' ELSE '10.0.' || substr(source, 4) || '.7' END AS address,
  CASE lang WHEN 'es' THEN lang ELSE '/' || lang || '/' || source END AS path
FROM documents)"""


def _raw(spark, sf_dir):
    docs = corpora.table(spark, sf_dir, "documents")
    lang, digits = F.col("lang"), F.substring("source", 4, 10)
    size = F.col("n_chars").cast("string")
    return docs.select(
        "doc_id",
        F.col("text").alias("title"),
        F.when(lang == "en", digits).when(lang == "fr", F.col("source")).alias("number"),
        F.when(lang == "de", F.concat(F.lit("-"), size)).otherwise(size).alias("size"),
        F.when(lang == "es", F.lit("1.5x")).otherwise(F.concat(digits, F.lit(".25"))).alias("ratio"),
        F.when(lang == "en", "true").when(lang == "de", "false").when(lang == "fr", "yes").alias("flag"),
        F.when(lang == "en", "2024-03-05T10:20:30.75+02:00")
        .when(lang == "fr", "2024-03-05")
        .otherwise("2024-03-05T08:20:30Z")
        .alias("day"),
        F.when(lang == "de", "10.0.0.256").otherwise(F.concat(F.lit("10.0."), digits, F.lit(".7"))).alias("address"),
        F.when(lang == "es", lang).otherwise(F.concat(F.lit("/"), lang, F.lit("/"), "source")).alias("path"),
        F.lit("dropped").alias("not_mapped"),
    )


_BAD = {
    "title": "FALSE",
    "number": "number = source",
    "size": "lang = 'de'",
    "ratio": "lang = 'es'",
    "flag": "flag = 'yes'",
    "day": "lang = 'fr'",
    "address": "lang = 'de'",
    "path": "lang = 'es'",
}
_REPORT = " UNION ALL ".join(
    f"""SELECT '{name}' AS field, '{kind}' AS type, count({name}) AS present, count(*) - count({name}) AS missing,
  count(*) FILTER (WHERE {name} IS NOT NULL AND {_BAD[name]}) AS unparsable FROM joined"""
    for name, kind in RAW_FIELDS
    if name != "missing"
)


@query(
    "sc1_conform_report",
    f"""WITH {_RAW_SQL}, joined AS (SELECT raw.*, lang, source FROM raw JOIN documents USING (doc_id))
{_REPORT} UNION ALL SELECT 'missing', 'string', 0, count(*), 0 FROM joined""",
)
def report(spark, sf_dir):
    return conform_report(_raw(spark, sf_dir), RAW)


@query(
    "sc2_field_profile",
    f"""WITH {sql.index_of()}
SELECT * FROM (
  SELECT 0 AS position, 'text' AS field, 'text' AS type, TRUE AS stored, TRUE AS indexed, FALSE AS fast,
    (SELECT count(*) FROM len) AS docs_with_value, (SELECT count(*) FROM freq) AS terms, (SELECT count(*) FROM tok) AS tokens
  UNION ALL SELECT 1, 'lang', 'string', TRUE, TRUE, TRUE, count(lang), count(DISTINCT lang), count(lang) FROM documents
  UNION ALL SELECT 2, 'source', 'string', TRUE, TRUE, TRUE, count(source), count(DISTINCT source), count(source) FROM documents
  UNION ALL SELECT 3, 'n_chars', 'i64', TRUE, TRUE, TRUE, count(n_chars), 0, 0 FROM documents
  UNION ALL SELECT 4, 'path', 'facet', TRUE, TRUE, TRUE, count(*), 0, 0 FROM documents)""",
)
def profile(spark, sf_dir):
    return field_profile(corpora.documents_index(spark, sf_dir))


@query(
    "sc3_projection",
    "SELECT doc_id, text, lang, CAST(NULL AS VARCHAR) AS author FROM documents",
)
def projection(spark, sf_dir):
    mapping = Mapping.build([("text", "text"), ("lang", "string"), ("author", "string")])
    projected = project(corpora.table(spark, sf_dir, "documents"), mapping)
    return projected.withColumn("author", F.col("author").cast("string"))


@query(
    "sc4_coerced_documents",
    f"""WITH {_RAW_SQL}
SELECT raw.doc_id, title, CAST(number AS BIGINT) AS number, CAST(size AS BIGINT) AS size, CAST(ratio AS DOUBLE) AS ratio,
  CAST(flag AS BOOLEAN) AS flag, CAST(epoch(TIMESTAMP '2024-03-05 08:20:30') AS BIGINT) AS day_seconds,
  10 * 16777216 + CAST(substr(source, 4) AS BIGINT) * 256 + 7 AS address, raw.path
FROM raw JOIN documents USING (doc_id) WHERE lang = 'en'""",
)
def coerced(spark, sf_dir):
    """Rows whose every value parses; the rest are rejects."""
    good, _ = coerce_permissive(_raw(spark, sf_dir), RAW)
    return good.withColumn("day_seconds", F.unix_seconds("day")).drop("day", "missing")


@query(
    "sc4_rejects",
    """SELECT doc_id, CASE lang
  WHEN 'fr' THEN 'cannot parse number as i64; cannot parse flag as bool; cannot parse day as date'
  WHEN 'de' THEN 'cannot parse size as u64; cannot parse address as ip_addr'
  WHEN 'es' THEN 'cannot parse ratio as f64; cannot parse path as facet' END AS errors
FROM documents WHERE lang <> 'en'""",
)
def rejects(spark, sf_dir):
    _, bad = coerce_permissive(_raw(spark, sf_dir), RAW)
    return bad.select("doc_id", F.array_join("_errors", "; ").alias("errors"))


@query(
    "sc4_strict_events",
    """SELECT event_id, event_type, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS ts_seconds, value, user_id,
  value >= 20 AS big, 10 * 16777216 + event_id % 16777216 AS ip, 't-' || event_type AS tag,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events""",
)
def strict_events(spark, sf_dir):
    """Typed source columns and text alike become the mapped types; a bad value would fail the batch."""
    typed = coerce(corpora.events(spark, sf_dir), corpora.EVENTS)
    return typed.select(
        "event_id", "event_type", F.unix_seconds("ts").alias("ts_seconds"), "value", "user_id", "big", "ip",
        F.decode("tag", "UTF-8").alias("tag"), F.try_variant_get("props", "$.k", "bigint").alias("k"),
    )


@query(
    "sc5_stored_fields",
    f"""WITH {sql.index_of()}, {sql.scored()},
top AS ({sql.page("SELECT doc_id, s FROM sc WHERE term = 'inger'", 25)})
SELECT doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars, '/' || lang || '/' || source AS path
FROM documents JOIN top USING (doc_id)""",
)
def stored_fields(spark, sf_dir):
    """Stored fields of a page of hits, rendered as text."""
    index = corpora.documents_index(spark, sf_dir)
    return search(index, "inger", limit=25, fields=("text",), stringify=True).select("doc_id", "doc.*")
