"""Compound queries: B1 to B7."""

from __future__ import annotations

from quillspark.operators.search import top_k
from quillspark.plans import query as q
from registry import corpora, query, sql
from registry.leaves import _all_hits, _ascii, _sum

_IX = f"WITH {sql.index_of()}, {sql.scored()}"


def _word(name: str, word: str) -> str:
    return f"{name} AS (SELECT doc_id, s FROM sc WHERE term = '{word}')"


@query(
    "b1_boolean",
    f"""{_IX}, {_word("m1", "the")}, {_word("m2", "est")}, {_word("s1", "tion")}, {_word("n1", "inger")}
SELECT m1.doc_id, round(m1.s + m2.s + coalesce(s1.s, 0), 6) AS score
FROM m1 JOIN m2 USING (doc_id) LEFT JOIN s1 USING (doc_id) WHERE m1.doc_id NOT IN (SELECT doc_id FROM n1)""",
)
def boolean(spark, sf_dir):
    w = lambda word: q.match(word, "text")
    asked = q.boolean(("must", w("the")), ("must", w("est")), ("should", w("tion")), ("must_not", w("inger")))
    return _all_hits(corpora.documents_index(spark, sf_dir), asked)


@query(
    "b1_nested",
    f"""{_IX}, {_word("a", "asas")}, {_word("b", "aivi")}, {_word("c", "in")}, {sql.phrase(["of", "the"])},
inner_hits AS (SELECT doc_id, coalesce(a.s, 0) + coalesce(ph.s, 0) AS s FROM a FULL JOIN ph USING (doc_id)
  WHERE doc_id NOT IN (SELECT doc_id FROM b))
SELECT i.doc_id, round(2.0 * i.s + c.s + 1.0, 6) AS score FROM inner_hits i JOIN c USING (doc_id)
JOIN documents d ON d.doc_id = i.doc_id WHERE d.n_chars >= 1000""",
)
def nested(spark, sf_dir):
    """Words, a phrase, a range, a boost and two levels, in one shuffle."""
    inner = q.boolean(
        ("should", q.Term("text", "asas")), ("should", q.phrase("text", "of", "the")), ("must_not", q.Term("text", "aivi"))
    )
    asked = q.all_of(q.Boost(inner, 2.0), q.match("in", "text"), q.Range("n_chars", 1000, None))
    return _all_hits(corpora.documents_index(spark, sf_dir), asked)


@query("b1_only_must_not", "SELECT doc_id, CAST(0.0 AS DOUBLE) AS score FROM documents WHERE FALSE")
def only_must_not(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.none_of(q.match("the", "text")))


@query(
    "b2_and_or_not",
    f"""{_IX}, {_word("a", "de")}, {_word("b", "la")}, {_word("c", "est")}, {_word("d", "aivi")}
SELECT a.doc_id, round(a.s + coalesce(b.s, 0) + coalesce(c.s, 0), 6) AS score
FROM a LEFT JOIN b USING (doc_id) LEFT JOIN c USING (doc_id)
WHERE (b.s IS NOT NULL OR c.s IS NOT NULL) AND a.doc_id NOT IN (SELECT doc_id FROM d)""",
)
def and_or_not(spark, sf_dir):
    """``de AND (la OR est) AND NOT aivi``."""
    w = lambda word: q.match(word, "text")
    asked = q.boolean(("must", w("de")), ("must", q.any_of(w("la"), w("est"))), ("must_not", w("aivi")))
    return _all_hits(corpora.documents_index(spark, sf_dir), asked)


@query(
    "b3_shorthand",
    f"""{_IX}, a AS ({_sum(["the", "of"])}), b AS (SELECT doc_id, s FROM sc WHERE term = 'asbo')
{sql.page(f"SELECT a.doc_id, a.s + k.s AS s FROM a JOIN {sql.keyword('lang')} k ON k.doc_id = a.doc_id AND k.term = 'en' WHERE a.doc_id NOT IN (SELECT doc_id FROM b)", 30)}""",
)
def shorthand(spark, sf_dir):
    """Texts and a built query mixed in a clause list."""
    clauses = [("must", q.match("the of", "text")), ("must", q.Term("lang", "en")), ("must_not", "asbo")]
    return top_k(corpora.documents_index(spark, sf_dir), clauses, limit=30)


@query("b4_boost", f"{_IX} {sql.every("SELECT doc_id, s * 2.5 AS s FROM sc WHERE term = 'edst'")}")
def boost(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.Boost(q.match("edst", "text"), 2.5))


@query(
    "b5_boosted_fields",
    f"""{_IX} {sql.page(f"SELECT doc_id, sum(s) AS s FROM (SELECT doc_id, 3.0 * s AS s FROM {sql.keyword('lang')} WHERE term IN ('de', 'la') UNION ALL SELECT doc_id, s FROM sc WHERE term IN ('de', 'la')) GROUP BY doc_id", 40)}""",
)
def boosted_fields(spark, sf_dir):
    asked = q.boosted_fields("de la", {"lang": 3.0, "text": 1.0})
    return top_k(corpora.documents_index(spark, sf_dir), asked, limit=40)


@query(
    "b6_text_filter_exclusion",
    f"""WITH {sql.index_of("part", "p_partkey", "p_name")}, {sql.scored()}
SELECT p_partkey, round(x.s + k.s, 6) AS score FROM (SELECT doc_id AS p_partkey, sum(s) AS s FROM sc
  WHERE term IN ('red', 'ring') GROUP BY 1) x
JOIN part USING (p_partkey) JOIN {sql.keyword("p_type", "p_partkey", "part")} k ON k.doc_id = p_partkey
WHERE p_type = 'ECONOMY' AND NOT (p_size >= 40)""",
)
def text_filter_exclusion(spark, sf_dir):
    """An exact category, words in the name, and an excluded range."""
    asked = q.boolean(
        ("must", q.Term("p_type", "ECONOMY")), ("must", q.match("red ring", "p_name")), ("must_not", q.Range("p_size", 40, None))
    )
    return _all_hits(corpora.parts_index(spark, sf_dir), asked)


def _near(word: str, column: str) -> str:
    return f"damerau_levenshtein({_ascii(column)}, '{word}') <= {0 if len(word) <= 3 else 1}"


_BOX = " UNION ALL ".join(
    f"""SELECT doc_id, 2e0 AS s FROM documents WHERE {_near(w, "source")}
  UNION ALL SELECT DISTINCT doc_id, 1e0 AS s FROM post WHERE {_near(w, "term")}"""
    for w in ("src12", "aiiv", "of")
)


@query(
    "b7_search_box",
    f"{_IX} {sql.page(f'SELECT doc_id, sum(s) AS s FROM ({_BOX}) GROUP BY doc_id', 20)}",
)
def search_box(spark, sf_dir):
    """Every word within a typo, one field counting double, first twenty."""
    asked = q.search_box(" Src12 aiiv OF ", {"source": 2.0, "text": 1.0})
    return top_k(corpora.documents_index(spark, sf_dir), asked, limit=20)
