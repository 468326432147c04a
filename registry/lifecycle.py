"""Building, changing and reading indexes: IX1 to IX9."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quillspark.functions.coerce import coerce
from quillspark.operators.search import count_hits, top_k
from quillspark.plans import query as q
from quillspark.sources import tables
from quillspark.sources.index import Index
from quillspark.sources.versions import IndexDirectory
from quillspark.streaming.ingest import index_stream
from registry import corpora, query, sql

_IX = f"WITH {sql.index_of()}, {sql.scored()}"
_TOP = sql.page("SELECT doc_id, sum(s) AS s FROM sc WHERE term IN ('the', 'aivi', 'replaced') GROUP BY doc_id", 25)


def _top(index):
    return top_k(index, "the aivi replaced", limit=25, fields=("text",))


@query(
    "ix1_build_index",
    f"""WITH {sql.index_of()}
SELECT 'text' AS field, term, doc_id, CAST(count(*) AS INTEGER) AS tf, CAST(any_value(dl) AS INTEGER) AS dl,
  string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM tok JOIN len USING (doc_id) GROUP BY term, doc_id
UNION ALL SELECT 'lang', lang, doc_id, 1, 1, '0' FROM documents
UNION ALL SELECT 'source', source, doc_id, 1, 1, '0' FROM documents""",
)
def build_index(spark, sf_dir):
    """The inverted index of the whole table, with positions."""
    typed = tables.spread(coerce(corpora.documents(spark, sf_dir), corpora.DOCUMENTS))
    postings = tables.postings_table(typed, corpora.DOCUMENTS)
    return postings.withColumn("positions", F.array_join("positions", ","))


@query(
    "ix2_term_stats",
    f"""WITH {sql.index_of()}
SELECT 'text' AS field, term, df, cf FROM freq
UNION ALL SELECT 'lang', lang, count(*), count(*) FROM documents GROUP BY lang
UNION ALL SELECT 'source', source, count(*), count(*) FROM documents GROUP BY source""",
)
def term_stats(spark, sf_dir):
    return corpora.documents_index(spark, sf_dir).terms.select("field", "term", "df", "cf")


@query(
    "ix2_field_stats",
    f"""WITH {sql.index_of()}
SELECT 'text' AS field, (SELECT count(*) FROM documents) AS n_docs, count(*) AS sum_dl FROM tok
UNION ALL SELECT 'lang', count(*), count(lang) FROM documents
UNION ALL SELECT 'source', count(*), count(source) FROM documents""",
)
def field_stats(spark, sf_dir):
    return corpora.documents_index(spark, sf_dir).field_stats()


@query("ix3_append_commit", f"{_IX} {_TOP}")
def append_commit(spark, sf_dir):
    """Two appended batches answer like one."""
    return _top(corpora.lifecycle(spark, sf_dir).open(2))


_NO_FRENCH = sql.index_of(where="lang <> 'fr'")
_REPLACED = """changed AS (SELECT doc_id, CASE WHEN lang = 'es' THEN 'replaced text of ' || source ELSE text END AS text,
  lang, source, n_chars FROM documents WHERE lang <> 'fr')"""
_SWAPPED = """swapped AS (SELECT doc_id, CASE WHEN lang = 'es' THEN 'replaced text of ' || source ELSE text END AS text,
  lang, source, n_chars FROM documents WHERE lang = 'fr' OR source <> 'src1')"""


@query("ix4_delete_by_term", f"WITH {_NO_FRENCH}, {sql.scored()} {_TOP}")
def delete_by_term(spark, sf_dir):
    """After a delete, neither hits nor statistics know the deleted documents."""
    return _top(corpora.lifecycle(spark, sf_dir).open(3))


@query(
    "ix4_statistics_after_delete",
    f"WITH {_NO_FRENCH} SELECT term, df, cf FROM freq",
)
def statistics_after_delete(spark, sf_dir):
    terms = corpora.lifecycle(spark, sf_dir).open(3).terms
    return terms.filter(F.col("field") == "text").select("term", "df", "cf")


@query("ix5_upsert", f"WITH {_REPLACED}, {sql.index_of('changed')}, {sql.scored()} {_TOP}")
def upsert(spark, sf_dir):
    """Documents replaced under their keys in one commit."""
    return _top(corpora.lifecycle(spark, sf_dir).open(4))


@query("ix5_delete_and_add", f"WITH {_SWAPPED}, {sql.index_of('swapped')}, {sql.scored()} {_TOP}")
def delete_and_add(spark, sf_dir):
    """A deletion and an addition that show together."""
    return _top(corpora.lifecycle(spark, sf_dir).open(5))


@query(
    "ix6_memory_index",
    f"WITH {sql.index_of('part', 'p_partkey', 'p_name')}, {sql.scored()}"
    + " SELECT doc_id AS p_partkey, score FROM ("
    + sql.page("SELECT doc_id, sum(s) AS s FROM sc WHERE term IN ('red', 'bolt') GROUP BY doc_id", 50)
    + ")",
)
def memory_index(spark, sf_dir):
    index = Index.in_memory(corpora.table(spark, sf_dir, "part"), corpora.PARTS)
    return top_k(index, "red bolt", limit=50, fields=("p_name",))


@query("ix7_reopen", f"{_IX} {_TOP}")
def reopen(spark, sf_dir):
    """Opened again from its path alone, mapping included."""
    corpora.documents_index(spark, sf_dir)
    path = corpora._built[(spark.sparkContext.applicationId, sf_dir, "documents")].path
    return _top(IndexDirectory(spark, path).open())


@query(
    "ix8_snapshots",
    f"""WITH {_SWAPPED}, {sql.index_of(where="lang = 'en'", prefix="a_")}, {sql.index_of(prefix="b_")},
{sql.index_of(where="lang <> 'fr'", prefix="c_")}, {sql.index_of("swapped", prefix="d_")}
SELECT 1 AS version, count(*) AS hits FROM a_post WHERE term = 'de'
UNION ALL SELECT 2, count(*) FROM b_post WHERE term = 'de'
UNION ALL SELECT 3, count(*) FROM c_post WHERE term = 'de'
UNION ALL SELECT 5, count(*) FROM d_post WHERE term = 'de'""",
)
def snapshots(spark, sf_dir):
    """Every version keeps answering as of its commit."""
    directory = corpora.lifecycle(spark, sf_dir)
    counts = [
        count_hits(directory.open(v), q.match("de", "text")).select(F.lit(v).alias("version"), "hits") for v in (1, 2, 3, 5)
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


_CHANGES = """was AS (SELECT doc_id, text, lang, source, n_chars FROM documents),
changed AS (SELECT 'removed' AS change, * FROM was WHERE lang IN ('fr', 'es') OR source = 'src1'
  UNION ALL SELECT 'added', doc_id, CASE WHEN lang = 'es' THEN 'replaced text of ' || source ELSE text END, lang, source, n_chars FROM was
  WHERE lang = 'fr' OR lang = 'es' AND source <> 'src1')"""


@query("ix8_changes", f"WITH {_CHANGES} SELECT change, doc_id, text, lang, source, n_chars FROM changed")
def changes(spark, sf_dir):
    """What three commits took away and brought."""
    found = corpora.lifecycle(spark, sf_dir).changes(2, 5)
    return found.select("change", "doc_id", "text", "lang", "source", "n_chars")


@query("ix8_changes_applied", f"WITH {_SWAPPED} SELECT doc_id, text FROM swapped")
def changes_applied(spark, sf_dir):
    """An earlier version with its changes is the later version."""
    directory = corpora.lifecycle(spark, sf_dir)
    found = directory.changes(2, 5).select("change", "doc_id", "text")
    removed, added = found.filter("change = 'removed'").select("doc_id"), found.filter("change = 'added'").drop("change")
    return directory.open(2).docs.select("doc_id", "text").join(removed, "doc_id", "left_anti").unionByName(added)


_REVISIONS = """revised AS (SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN 'replaced text of ' || source ELSE text END AS text,
  lang, source, n_chars FROM documents)"""


def _revisions(spark, sf_dir):
    """Two files of records: revision 2 of every document with a replayed revision 1, and then revision 3 of the odd ones
    after an older revision of all."""
    docs = corpora.documents(spark, sf_dir)
    old = docs.withColumn("text", F.lit("replaced by what came before"))
    new = docs.filter("doc_id % 2 = 1").withColumn("text", F.concat(F.lit("replaced text of "), "source"))
    revision = lambda rows, n: rows.withColumn("revision", F.lit(n).cast("long"))
    first = revision(docs, 2).unionByName(revision(old, 1))
    return first, revision(old, 0).unionByName(revision(new, 3)).unionByName(revision(old, 1))


@query("ix9_stream_ingest", f"WITH {_REVISIONS}, {sql.index_of('revised')}, {sql.scored()} {_TOP}")
def stream_ingest(spark, sf_dir):
    """A stream of revisions out of order, one commit per micro-batch: the newest of every document is searched."""
    known = (spark.sparkContext.applicationId, sf_dir, "stream")
    if known not in corpora._built:
        base = f"{corpora.shared_folder(spark)}/stream-{uuid.uuid4().hex}"
        directory = IndexDirectory(spark, f"{base}/index").create(corpora.REVISIONS)
        for records in _revisions(spark, sf_dir):
            records.write.mode("append").parquet(f"{base}/records")
            files = spark.readStream.schema(records.schema).parquet(f"{base}/records")
            writer = index_stream(files, directory, f"{base}/checkpoint", order_by="revision")
            writer.trigger(availableNow=True).start().awaitTermination()
        corpora._built[known] = directory
    return _top(corpora._built[known].open())
