"""Analyzers over whole tables: AN1 to AN5."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import analysis
from quillspark.functions.stemming import stem_words_udf
from quillspark.mapping import Mapping
from quillspark.operators.batch import query_words
from quillspark.sources import tables
from registry import corpora, query, sql


def _tokens(docs, key: str, column: str, analyzer: str):
    entries = analysis.token_entries(F.col(column), analyzer)
    return tables.spread(docs.select(key, column)).select(key, F.inline(entries)).select(key, "term", "pos")


@query("an1_default_tokens", f"WITH {sql.index_of()} SELECT doc_id, term, pos FROM tok")
def default_tokens(spark, sf_dir):
    return _tokens(corpora.table(spark, sf_dir, "documents"), "doc_id", "text", "default")


@query("an2_raw_tokens", "SELECT page_id, url AS term, CAST(0 AS INTEGER) AS pos FROM pages WHERE url IS NOT NULL")
def raw_tokens(spark, sf_dir):
    return _tokens(corpora.table(spark, sf_dir, "pages"), "page_id", "url", "raw")


_BLANKS = r"regexp_extract_all(html, '[^ \t\n\f\r]+')"


@query(
    "an3_whitespace_tokens",
    f"""SELECT page_id, unnest({_BLANKS}) AS term, CAST(unnest(range(len({_BLANKS}))) AS INTEGER) AS pos FROM pages""",
)
def whitespace_tokens(spark, sf_dir):
    return _tokens(corpora.table(spark, sf_dir, "pages"), "page_id", "html", "whitespace")


@query(
    "an4_english_stems",
    f"WITH {sql.index_of()}, {sql.english_stems('freq')} SELECT term, stem, df FROM english JOIN freq USING (term)",
)
def english_stems(spark, sf_dir):
    """The English stem of every word of the table."""
    docs = tables.spread(corpora.table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = tables.terms_table(tables.postings_table(docs, Mapping.build([("text", "text")])))
    return words.select("term", F.get(stem_words_udf(F.array("term")), F.lit(0)).alias("stem"), "df")


@query(
    "an4_stemmed_vocabulary",
    f"""WITH {sql.index_of()}, {sql.english_stems('freq')}
SELECT 'text' AS field, stem AS term, count(DISTINCT doc_id) AS df, CAST(sum(tf) AS BIGINT) AS cf
FROM post JOIN english USING (term) GROUP BY stem""",
)
def stemmed_vocabulary(spark, sf_dir):
    """The vocabulary of an index of stemmed texts."""
    return corpora.stemmed_index(spark, sf_dir).terms.select("field", "term", "df", "cf")


@query(
    "an4_stem_map",
    f"""WITH {sql.index_of()}
SELECT doc_id, left(term, 4) AS term, CAST(sum(tf) AS INTEGER) AS tf, CAST(max(dl) AS INTEGER) AS dl
FROM post GROUP BY doc_id, left(term, 4)""",
)
def stem_map(spark, sf_dir):
    """A language without built-in rules: the caller's (term, stem) table, here the first four letters."""
    mapping = Mapping.build([("text", "text", {"tokenizer": "fr_stem"})])
    docs = tables.spread(corpora.table(spark, sf_dir, "documents").select("doc_id", "text"))
    plain = tables.postings_table(docs, Mapping.build([("text", "text")]))
    stems = plain.select("term").distinct().withColumn("stem", F.substring("term", 1, 4))
    return tables.postings_table(docs, mapping, {"fr_stem": stems}).select("doc_id", "term", "tf", "dl")


_BENCH = sql.index_of("benchmark", "item_id", "text", prefix="q_")


@query(
    "an5_query_analysis",
    f"""WITH {sql.index_of()}, {_BENCH}
SELECT q_post.doc_id AS item_id, term, q_post.tf AS times, coalesce(df, 0) AS df
FROM q_post LEFT JOIN freq USING (term)""",
)
def query_analysis(spark, sf_dir):
    """A table of query texts analysed as the documents were, with the frequency of every word."""
    index = corpora.documents_index(spark, sf_dir)
    words = query_words(index, corpora.table(spark, sf_dir, "benchmark"), "item_id", "text", ("text",))
    found = words.join(index.terms, ["field", "term"], "left")
    return found.select("item_id", "term", "times", F.coalesce("df", F.lit(0)).alias("df"))
