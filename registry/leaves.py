"""Leaf queries: Q01 to Q19."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import scoring
from quillspark.operators.aggs import facet_counts
from quillspark.operators.search import top_k
from quillspark.plans import query as q
from quillspark.plans.compile import matches
from registry import corpora, query, sql

_IX = f"WITH {sql.index_of()}, {sql.scored()}"


def _all_hits(index, asked):
    """Every hit, with its score rounded so that engines agree."""
    return matches(asked, index).withColumn("score", scoring.rounded(F.col("score")))


def _sum(words: list[str]) -> str:
    return f"SELECT doc_id, sum(s) AS s FROM sc WHERE term IN ({sql.quoted(words)}) GROUP BY doc_id"


def _ascii(column: str) -> str:
    """DuckDB's distances count bytes. A letter outside ASCII never equals one of an ASCII word, so one
    stand-in byte for each keeps the distance in characters."""
    return f"regexp_replace({column}, '[^\\x00-\\x7F]', '#', 'g')"


def _has(condition: str) -> str:
    return f"SELECT DISTINCT doc_id, 1e0 AS s FROM post WHERE {condition}"


@query(
    "q01_match_words",
    _IX
    + f""", everywhere AS (SELECT * FROM sc UNION ALL SELECT * FROM {sql.keyword("lang")}
  UNION ALL SELECT * FROM {sql.keyword("source")})
{sql.page("SELECT doc_id, sum(s) AS s FROM everywhere WHERE term IN ('aivi', 'the', 'fr', 'src3') GROUP BY doc_id", 50)}""",
)
def match_words(spark, sf_dir):
    """Any word in any text or string field."""
    return top_k(corpora.documents_index(spark, sf_dir), "aivi the fr src3", limit=50)


@query("q02_match_in_field", f"{_IX} {sql.every(_sum(['the', 'est', 'tion']))}")
def match_in_field(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.match("The EST tion", "text"))


@query("q03_term_text", f"{_IX} {sql.every(_sum(['asas']))}")
def term_text(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Term("text", "asas"))


@query("q03_term_string", sql.every(f"SELECT * FROM {sql.keyword('source')} WHERE term = 'src7'"))
def term_string(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Term("source", "src7"))


def _typed(name: str, where: str, table: str, key: str, index, asked: q.Query):
    @query(name, f"SELECT {key}, 1e0 AS score FROM {table} WHERE {where}")
    def run(spark, sf_dir):
        return _all_hits(index(spark, sf_dir), asked)

    return run


_typed("q04_term_u64", "p_size = 7", "part", "p_partkey", corpora.parts_index, q.Term("p_size", 7))
_typed("q04_term_i64", "n_chars IN (416, 715, 4186)", "documents", "doc_id", corpora.documents_index,
       q.Boost(q.any_of(q.Term("n_chars", "416"), q.Term("n_chars", 715), q.Term("n_chars", 4186)), 1.0))
_typed("q04_term_f64", "p_retailprice = 901.0", "part", "p_partkey", corpora.parts_index, q.Term("p_retailprice", "901"))
_typed("q04_term_bool", "value >= 20", "events", "event_id", corpora.events_index, q.Term("big", True))
_typed("q04_term_date", "o_orderdate = TIMESTAMP '1998-10-03'", "orders", "o_orderkey", corpora.orders_index,
       q.Term("o_orderdate", "1998-10-03T02:00:00+02:00"))
_typed("q04_term_bytes", "event_type = 'click'", "events", "event_id", corpora.events_index, q.Term("tag", "t-click"))
_typed("q05_term_ip", "event_id % 16777216 = 517", "events", "event_id", corpora.events_index, q.Term("ip", "10.0.2.5"))
_typed("q06_all", "TRUE", "documents", "doc_id", corpora.documents_index, q.All())


@query("q07_phrase", f"{_IX}, {sql.phrase(['of', 'the'])} {sql.every('SELECT * FROM ph')}")
def phrase(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.phrase("text", "Of", "THE"))


@query("q07_phrase_three", f"{_IX}, {sql.phrase(['in', 'the', 'in'])} {sql.every('SELECT * FROM ph')}")
def phrase_repeated(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.phrase("text", "in", "the", "in"))


def _phrase_prefix_sql(words: list[str], last: str, limit: str) -> str:
    idf = " + ".join(f"(SELECT {sql.IDF} FROM freq, tot WHERE term = '{w}')" for w in words)
    joins = " ".join(
        f"JOIN tok t{i} ON t{i}.doc_id = t0.doc_id AND t{i}.pos = t0.pos + {i} AND t{i}.term = '{w}'"
        for i, w in enumerate(words)
        if i
    )
    n = len(words)
    return f"""{_IX},
expanded AS (SELECT term FROM freq WHERE starts_with(term, '{last}') ORDER BY term {limit}),
found AS (SELECT t0.doc_id, count(*) AS tf FROM tok t0 {joins}
  JOIN tok z ON z.doc_id = t0.doc_id AND z.pos = t0.pos + {n} AND z.term IN (SELECT term FROM expanded)
  WHERE t0.term = '{words[0]}' GROUP BY t0.doc_id)
SELECT doc_id, round(({idf}) * {sql.TF}, 6) AS score FROM found JOIN len USING (doc_id), tot"""


@query("q08_phrase_prefix", _phrase_prefix_sql(["of"], "th", ""))
def phrase_prefix(spark, sf_dir):
    """The last word stands for every term it starts."""
    return _all_hits(corpora.documents_index(spark, sf_dir), q.phrase_prefix("text", "of", "th"))


@query("q08_phrase_prefix_unbounded", _phrase_prefix_sql(["and", "the"], "t", ""))
def phrase_prefix_unbounded(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.phrase_prefix("text", "and", "the", "t"))


@query("q08_phrase_prefix_chosen", _phrase_prefix_sql(["of"], "th", "LIMIT 50"))
def phrase_prefix_chosen(spark, sf_dir):
    """As many expansions, in term order, as the caller asks for."""
    return _all_hits(corpora.documents_index(spark, sf_dir), q.phrase_prefix("text", "of", "th", max_expansions=50))


@query("q07_phrase_by_pairs", f"{_IX}, {sql.phrase(['of', 'the'])} {sql.every('SELECT * FROM ph')}")
def phrase_by_pairs(spark, sf_dir):
    """Two frequent words are one posting list."""
    return _all_hits(corpora.phrased_index(spark, sf_dir), q.phrase("text", "Of", "THE"))


@query("q07_phrase_by_pairs_repeated", f"{_IX}, {sql.phrase(['in', 'the', 'in'])} {sql.every('SELECT * FROM ph')}")
def phrase_by_pairs_repeated(spark, sf_dir):
    return _all_hits(corpora.phrased_index(spark, sf_dir), q.phrase("text", "in", "the", "in"))


@query("q07_phrase_by_pairs_and_words", f"{_IX}, {sql.phrase(['the', 'and', 'attion', 'to'])} {sql.every('SELECT * FROM ph')}")
def phrase_by_pairs_and_words(spark, sf_dir):
    """Longer phrases join the pairs, and words that are in none."""
    return _all_hits(corpora.phrased_index(spark, sf_dir), q.phrase("text", "the", "and", "attion", "to"))


@query("q08_phrase_prefix_by_pairs", _phrase_prefix_sql(["and", "the"], "t", ""))
def phrase_prefix_by_pairs(spark, sf_dir):
    return _all_hits(corpora.phrased_index(spark, sf_dir), q.phrase_prefix("text", "and", "the", "t"))


@query("q09_regex_by_pieces", f"{_IX} {sql.every(_has("regexp_full_match(term, '(as|in)[a-m]{2,3}')"))}")
def regex_by_pieces(spark, sf_dir):
    """The terms come from a table of pieces of terms, not from the vocabulary."""
    return _all_hits(corpora.phrased_index(spark, sf_dir), q.Regex("text", "(as|in)[a-m]{2,3}"))


@query("q11_fuzzy_by_pieces", f"{_IX} {sql.every(_has(f"damerau_levenshtein({_ascii('term')}, 'nation') <= 1"))}")
def fuzzy_by_pieces(spark, sf_dir):
    return _all_hits(corpora.phrased_index(spark, sf_dir), q.Fuzzy("text", "NATION"))


@query("q14_inline_fuzzy_by_pieces", f"{_IX} {sql.every(_has(f"levenshtein({_ascii('term')}, 'thereing') <= 2"))}")
def inline_fuzzy_by_pieces(spark, sf_dir):
    return _all_hits(corpora.phrased_index(spark, sf_dir), q.Fuzzy("text", "thereing", 2, transpose_costs_one=False))


@query("q15_quoted_phrase_by_pairs", f"{_IX}, {sql.phrase(['in', 'of'])} {sql.every('SELECT * FROM ph')}")
def quoted_phrase_by_pairs(spark, sf_dir):
    return _all_hits(corpora.phrased_index(spark, sf_dir), q.QuotedPhrase("In, of!"))


@query("q09_regex", f"{_IX} {sql.every(_has("regexp_full_match(term, '(as|in)[a-m]{2,3}')"))}")
def regex(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Regex("text", "(as|in)[a-m]{2,3}"))


_typed("q09_regex_string", r"regexp_full_match(url, 'https://[a-z.]+example\.(com|org)/en/[0-9]+')", "pages", "page_id",
       corpora.pages_index, q.Regex("url", r"https://[a-z.]+example\.(com|org)/en/[0-9]+"))


@query("q10_exists_text", f"{_IX} {sql.every('SELECT doc_id, 1e0 AS s FROM len')}")
def exists_text(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Exists("text"))


_typed("q10_exists_typed", "value IS NOT NULL", "events", "event_id", corpora.events_index, q.Exists("value"))


@query("q11_fuzzy", f"{_IX} {sql.every(_has(f"damerau_levenshtein({_ascii('term')}, 'nation') <= 1"))}")
def fuzzy(spark, sf_dir):
    """One edit, a swap of neighbours counting one; at this distance both usual definitions agree."""
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Fuzzy("text", "NATION"))


@query("q11_fuzzy_two_plain", f"{_IX} {sql.every(_has(f"levenshtein({_ascii('term')}, 'engint') <= 2"))}")
def fuzzy_plain(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Fuzzy("text", "engint", 2, transpose_costs_one=False))


@query("q11_fuzzy_exact", f"{_IX} {sql.every(_has("term = 'inger'"))}")
def fuzzy_exact(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Fuzzy("text", "inger", 0))


_typed("q12_range_f64", "p_retailprice >= 905 AND p_retailprice <= 950.5", "part", "p_partkey", corpora.parts_index,
       q.Range("p_retailprice", 905, 950.5))
_typed("q12_range_exclusive", "p_size > 10 AND p_size < 20", "part", "p_partkey", corpora.parts_index,
       q.Range("p_size", 10, 20, include_lower=False, include_upper=False))
_typed("q12_range_open_date", "o_orderdate >= TIMESTAMP '1998-06-01'", "orders", "o_orderkey", corpora.orders_index,
       q.Range("o_orderdate", "1998-06-01T00:00:00Z", None))


_typed("q12_range_by_value", "value > 40.5 AND value <= 77", "events", "event_id", corpora.measures_index,
       q.Range("value", 40.5, 77, include_lower=False))
_typed("q12_range_date_by_value", "ts >= TIMESTAMP '2024-01-20'", "events", "event_id", corpora.measures_index,
       q.Range("ts", "2024-01-20T00:00:00Z", None))
_typed("q04_term_by_value", "user_id = 17", "events", "event_id", corpora.measures_index, q.Term("user_id", 17))


@query("q12_range_terms", f"{_IX} {sql.every(_has("term >= 'inge' AND term < 'ingi'"))}")
def range_terms(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Range("text", "inge", "ingi", include_upper=False))


@query("q13_prefix", f"{_IX} {sql.every(_has("starts_with(term, 'asa')"))}")
def prefix(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Prefix("text", "asa"))


@query("q13_prefix_broad", f"{_IX} {sql.every(_has("starts_with(term, 'e')"))}")
def prefix_broad(spark, sf_dir):
    """More terms than are worth listing: the prefix itself goes to the postings."""
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Prefix("text", "e"))


@query("q14_inline_fuzzy", f"{_IX} {sql.every(_has(f"damerau_levenshtein({_ascii('term')}, 'helo') <= 1"))}")
def inline_fuzzy(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Fuzzy("text", "helo", 1))


@query("q15_quoted_phrase", f"{_IX}, {sql.phrase(['in', 'of'])} {sql.every('SELECT * FROM ph')}")
def quoted_phrase(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.QuotedPhrase("In, of!"))


@query(
    "q15_split_word",
    f"""{_IX}, {sql.phrase(["de", "la"])}
{sql.every("SELECT doc_id, sum(s) AS s FROM (SELECT * FROM ph UNION ALL SELECT doc_id, s FROM sc WHERE term = 'aivi') GROUP BY doc_id")}""",
)
def split_word(spark, sf_dir):
    """A word that splits into several tokens is a phrase."""
    return _all_hits(corpora.documents_index(spark, sf_dir), q.match("de-la aivi", "text"))


@query("q16_field_scoped", sql.every(f"SELECT * FROM {sql.keyword('lang')} WHERE term = 'de'"))
def field_scoped(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.match("de", "lang"))


_typed("q17_json_path", "CAST(json_extract(props, '$.k') AS BIGINT) = 42", "events", "event_id", corpora.events_index,
       q.JsonPath("props", "k", 42))
_typed("q18_facet_subtree", "lang = 'de'", "documents", "doc_id", corpora.documents_index, q.Facet("path", "/de"))
_typed("q18_facet_leaf", "lang = 'en' AND source = 'src1'", "documents", "doc_id", corpora.documents_index,
       q.Facet("path", "/en/src1"))


@query(
    "q18_facet_counts",
    """SELECT '/' || lang AS path, count(*) AS doc_count FROM documents GROUP BY 1
UNION ALL SELECT '/' || lang || '/' || source, count(*) FROM documents GROUP BY 1""",
)
def facets(spark, sf_dir):
    return facet_counts(corpora.documents_index(spark, sf_dir), "path")


_typed("q19_ip_range", "event_id % 16777216 BETWEEN 300 AND 1000", "events", "event_id", corpora.events_index,
       q.Range("ip", "10.0.1.44", "10.0.3.232"))
