"""Ranking, paging, hits, highlighting: R1 to R11 and H1 to H4."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators.batch import batch_hits, batch_search, batch_search_box
from quillspark.operators.search import browse, count_hits, highlight_all, lookup, search, search_indexes, top_k
from quillspark.plans import query as q
from registry import corpora, query, sql
from registry.leaves import _all_hits, _sum

_IX = f"WITH {sql.index_of()}, {sql.scored()}"
_WORDS = ["the", "aivi", "est", "asbo"]


@query("r1_bm25", f"{_IX} {sql.every(_sum(_WORDS))}")
def bm25(spark, sf_dir):
    return _all_hits(corpora.documents_index(spark, sf_dir), q.match(" ".join(_WORDS), "text"))


@query(
    "r2_constant_score",
    f"""{_IX} SELECT doc_id, round(3e0 * sum(s), 6) AS score FROM (
  SELECT DISTINCT doc_id, 1e0 AS s FROM post WHERE starts_with(term, 'asb')
  UNION ALL SELECT doc_id, 1e0 FROM documents WHERE n_chars <= 500) GROUP BY doc_id""",
)
def constant_score(spark, sf_dir):
    asked = q.Boost(q.any_of(q.Prefix("text", "asb"), q.Range("n_chars", None, 500)), 3.0)
    return _all_hits(corpora.documents_index(spark, sf_dir), asked)


@query("r3_top_k", f"{_IX} {sql.page(_sum(_WORDS))}")
def top(spark, sf_dir):
    return top_k(corpora.documents_index(spark, sf_dir), " ".join(_WORDS), fields=("text",))


@query("r3_top_k_by_tiers", f"{_IX} {sql.page(_sum(['the']), 12)}")
def top_by_tiers(spark, sf_dir):
    """Of a very frequent word only the postings that can be among the best are read."""
    return top_k(corpora.phrased_index(spark, sf_dir), "the", limit=12, fields=("text",))


@query("r3_top_phrase_by_tiers", f"{_IX}, {sql.phrase(['of', 'the'])} {sql.page('SELECT * FROM ph', 7)}")
def top_phrase_by_tiers(spark, sf_dir):
    return top_k(corpora.phrased_index(spark, sf_dir), q.phrase("text", "of", "the"), limit=7)


@query("r4_page", f"{_IX} {sql.page(_sum(_WORDS), 20, 40)}")
def page(spark, sf_dir):
    return top_k(corpora.documents_index(spark, sf_dir), " ".join(_WORDS), limit=20, offset=40, fields=("text",))


@query("r5_tie_order", "SELECT doc_id, CAST(1.0 AS DOUBLE) AS score FROM documents WHERE lang = 'es' ORDER BY doc_id LIMIT 12")
def ties(spark, sf_dir):
    """Equal scores come in key order."""
    return top_k(corpora.documents_index(spark, sf_dir), q.Facet("path", "/es"), limit=12)


@query(
    "r6_hits",
    f"""{_IX}, top AS ({sql.page(_sum(_WORDS), 15, 5)})
SELECT CAST(row_number() OVER (ORDER BY score DESC, doc_id) + 5 AS INTEGER) AS rank, doc_id, score, lang, source, n_chars,
  CAST(length(text) AS INTEGER) AS chars,
  0 AS highlighted FROM top JOIN documents USING (doc_id)""",
)
def hits(spark, sf_dir):
    """Rank, score and stored fields of a page; no highlights unless asked for."""
    found = search(corpora.documents_index(spark, sf_dir), " ".join(_WORDS), limit=15, offset=5, fields=("text",))
    return found.select(
        "rank", "doc_id", "score", "doc.lang", "doc.source", "doc.n_chars", F.length("doc.text").alias("chars"),
        F.size("highlights").alias("highlighted"),
    )


_TURNS = "turns AS (SELECT conv_id * 1000 + turn AS turn_id, text FROM conversations)"


@query(
    "r7_several_indexes",
    f"""WITH {_TURNS}, {sql.index_of()}, {sql.scored()}, {sql.index_of("turns", "turn_id", prefix="c_")}, {sql.scored("c_")},
a AS ({sql.page(_sum(["aivi", "de"]), 20)}),
b AS ({sql.page("SELECT doc_id, sum(s) AS s FROM c_sc WHERE term IN ('aivi', 'de') GROUP BY doc_id", 20)}),
m AS (SELECT 'documents' AS source_index, CAST(doc_id AS VARCHAR) AS id, score FROM a
  UNION ALL SELECT 'conversations', CAST(doc_id AS VARCHAR), score FROM b)
SELECT * FROM m ORDER BY score DESC, source_index, id LIMIT 20""",
)
def several(spark, sf_dir):
    indexes = {"documents": corpora.documents_index(spark, sf_dir), "conversations": corpora.conversations_index(spark, sf_dir)}
    return search_indexes(indexes, q.match("aivi de", "text"), limit=20).select("source_index", "id", "score")


_QUERIES = sql.index_of("benchmark", "item_id", "text", prefix="q_")


@query(
    "r8_batch_search",
    f"""WITH {sql.index_of()}, {sql.scored()}, {_QUERIES},
pairs AS (SELECT q_post.doc_id AS item_id, sc.doc_id, round(sum(q_post.tf * s), 6) AS score
  FROM q_post JOIN sc USING (term) GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM pairs)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
)
def batch(spark, sf_dir):
    """Every benchmark item as a query, its ten best documents, in one job."""
    index = corpora.documents_index(spark, sf_dir)
    return batch_search(index, corpora.table(spark, sf_dir, "benchmark"), 10, "item_id", "text", ("text",))


_SPLIT = """ws AS (SELECT item_id, list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}]+'), lambda x: lower(x)) AS w FROM benchmark),
chunks AS (SELECT item_id, w, unnest(range(1, len(w) + 1, 2)) AS i FROM ws),
pairs_of AS (SELECT item_id, i, w[i] AS a, w[i + 1] AS b FROM chunks WHERE i < len(w)),
single AS (SELECT item_id, w[i] AS c FROM chunks WHERE i = len(w))"""


def _split_words(spark, sf_dir):
    """The words of every item in pairs with a hyphen between the two, a last one alone."""
    words = F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    items = corpora.table(spark, sf_dir, "benchmark").select("item_id", words.alias("w")).filter(F.size("w") > 0)
    pairs = F.transform(F.sequence(F.lit(1), F.size("w"), F.lit(2)), lambda i: F.array_join(F.slice("w", i, 2), "-"))
    return items.select("item_id", F.array_join(pairs, " ").alias("text"))


_SPLIT_SQL = f"""WITH {sql.index_of()}, {sql.scored()}, {_SPLIT},
near AS (SELECT s.item_id, s.i, x.doc_id, count(*) AS tf FROM pairs_of s JOIN tok x ON x.term = s.a
  JOIN tok y ON y.doc_id = x.doc_id AND y.pos = x.pos + 1 AND y.term = s.b GROUP BY 1, 2, 3),
gain AS (SELECT item_id, i, sum({sql.IDF}) AS g FROM (SELECT item_id, i, unnest([a, b]) AS term FROM pairs_of) JOIN freq USING (term), tot
  GROUP BY 1, 2),
pairs AS (SELECT item_id, doc_id, g * {sql.TF} AS s FROM near JOIN gain USING (item_id, i) JOIN len USING (doc_id), tot
  UNION ALL SELECT item_id, doc_id, s FROM single JOIN sc ON term = c),
summed AS (SELECT item_id, doc_id, round(sum(s), 6) AS score FROM pairs GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM summed)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


@query("r8_batch_split_words", _SPLIT_SQL)
def batch_split_words(spark, sf_dir):
    """Words with a hyphen are phrases, as in a single search."""
    index = corpora.documents_index(spark, sf_dir)
    return batch_search(index, _split_words(spark, sf_dir), 10, "item_id", "text", ("text",))


@query("r8_batch_in_two_steps", _SPLIT_SQL)
def batch_in_two_steps(spark, sf_dir):
    """The same by the steps that many postings call for."""
    index = corpora.documents_index(spark, sf_dir)
    return batch_search(index, _split_words(spark, sf_dir), 10, "item_id", "text", ("text",), many_postings=0)


@query("r8_batch_split_words_by_pairs", _SPLIT_SQL)
def batch_split_words_by_pairs(spark, sf_dir):
    """The same from the postings of pairs of frequent words, where both are."""
    index = corpora.phrased_index(spark, sf_dir)
    return batch_search(index, _split_words(spark, sf_dir), 10, "item_id", "text", ("text",))


_BOXES = """asked AS (SELECT item_id, w, count(*) AS times FROM (
  SELECT item_id, unnest(regexp_split_to_array(trim(lower(text)), '\\s+')) AS w FROM benchmark) WHERE w <> '' GROUP BY 1, 2),
ws AS (SELECT DISTINCT w FROM asked),
terms AS (SELECT 'text' AS field, term AS t FROM freq UNION ALL SELECT DISTINCT 'source', source FROM documents WHERE source IS NOT NULL),
lost AS (SELECT w, unnest(list_prepend(w, list_transform(range(1, length(w) + 1), lambda i: left(w, i - 1) || substr(w, i + 1)))) AS x
  FROM ws WHERE length(w) > 3),
lost_terms AS (SELECT field, t, unnest(list_prepend(t, list_transform(range(1, length(t) + 1), lambda i: left(t, i - 1) || substr(t, i + 1)))) AS x
  FROM terms),
both_ AS (SELECT DISTINCT w, field, t, length(w) AS n, length(t) AS m, list_filter(range(1, greatest(n, m) + 1), lambda i: substr(w, i, 1) <> substr(t, i, 1)) AS d
  FROM lost JOIN lost_terms USING (x)),
near AS (SELECT w, field, t FROM both_ WHERE w = t OR n = m AND (len(d) = 1 OR len(d) = 2 AND d[2] = d[1] + 1
      AND substr(w, d[1], 1) = substr(t, d[2], 1) AND substr(w, d[2], 1) = substr(t, d[1], 1))
    OR n = m + 1 AND left(w, d[1] - 1) || substr(w, d[1] + 1) = t OR m = n + 1 AND left(t, d[1] - 1) || substr(t, d[1] + 1) = w
  UNION SELECT w, field, t FROM ws JOIN terms ON t = w WHERE length(w) <= 3),
have AS (SELECT DISTINCT w, field, doc_id FROM near JOIN post ON post.term = t AND field = 'text'
  UNION SELECT DISTINCT w, field, doc_id FROM near JOIN documents ON source = t AND field = 'source')"""


@query(
    "b7_batch_search_box",
    f"""WITH {sql.index_of()}, {_BOXES},
summed AS (SELECT item_id, doc_id, sum(times * CASE field WHEN 'source' THEN 2e0 ELSE 1e0 END) AS score
  FROM asked JOIN have USING (w) GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM summed)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20""",
)
def search_boxes(spark, sf_dir):
    """Every benchmark item typed into the search box, its twenty best documents, in one job."""
    index = corpora.documents_index(spark, sf_dir)
    return batch_search_box(index, corpora.table(spark, sf_dir, "benchmark"), {"source": 2.0, "text": 1.0}, 20, "item_id", "text")


@query(
    "r8_batch_words_in_two_steps",
    f"""WITH {sql.index_of()}, {sql.scored()}, {_QUERIES},
pairs AS (SELECT q_post.doc_id AS item_id, sc.doc_id, round(sum(q_post.tf * s), 6) AS score
  FROM q_post JOIN sc USING (term) GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM pairs)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
)
def batch_words_in_two_steps(spark, sf_dir):
    index = corpora.documents_index(spark, sf_dir)
    return batch_search(index, corpora.table(spark, sf_dir, "benchmark"), 10, "item_id", "text", ("text",), many_postings=0)


@query("r9_hit_count", f"{_IX} SELECT count(DISTINCT doc_id) AS hits FROM sc WHERE term IN ('est', 'asas')")
def hit_count(spark, sf_dir):
    return count_hits(corpora.documents_index(spark, sf_dir), q.match("est asas", "text"))


@query("r10_point_lookup", """SELECT doc_id, text, lang, source, n_chars, '/' || lang || '/' || source AS path
FROM documents WHERE source = 'src11' ORDER BY doc_id LIMIT 1""")
def point_lookup(spark, sf_dir):
    return lookup(corpora.documents_index(spark, sf_dir), "source", "src11")


@query("r11_browse", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part WHERE p_type = 'PROMO'")
def browse_category(spark, sf_dir):
    return browse(corpora.parts_index(spark, sf_dir), "p_type", "PROMO")


# -- highlighting ----------------------------------------------------------------------------

_GAP = r"[^\p{L}\p{N}]+"
_PIECES = rf"regexp_extract_all(text, '{sql.WORD}|{_GAP}')"
_ESCAPED = (
    "replace(replace(replace(replace(replace(w, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
)


def _marked(words: list[str]) -> str:
    return f"CASE WHEN lower(w) IN ({sql.quoted(words)}) AND strlen(w) < 40 THEN '<b>' || {_ESCAPED} || '</b>' ELSE {_ESCAPED} END"


def _pieces(source: str) -> str:
    """(doc_id, i, w, b, e): pieces of the text in order with their character offsets."""
    return f"""cut AS (SELECT doc_id, unnest({_PIECES}) AS w, unnest(range(len({_PIECES}))) AS i
  FROM documents JOIN ({source}) USING (doc_id)),
pieces AS (SELECT doc_id, i, w, sum(length(w)) OVER (PARTITION BY doc_id ORDER BY i) AS e,
  regexp_matches(w, '^{sql.WORD}') AND strlen(w) < 40 AS word FROM cut)"""


def _fragments(keys: str) -> str:
    """``shown`` (keys, snippet) from ``hits`` (keys, i, w, e, word, hit, gain): the heaviest fragment of each."""
    own = [k.strip() for k in keys.split(",")]
    listed = lambda p: ", ".join(f"{p}.{k}" for k in own)
    same = lambda p, r: " AND ".join(f"{p}.{k} = {r}.{k}" for k in own)
    return f"""words AS (SELECT {keys}, i, e - length(w) AS b, e, gain FROM hits WHERE word),
frag({keys}, first, b) AS (
  SELECT {keys}, min(i), min(b) FROM words GROUP BY {keys}
  UNION ALL
  SELECT {listed("n")}, n.i, n.b FROM (
    SELECT {listed("f")}, w.i, w.b, row_number() OVER (PARTITION BY {listed("f")} ORDER BY w.i) AS rn
    FROM frag f JOIN words w ON {same("w", "f")} AND w.i > f.first AND w.e - f.b > 150) n WHERE n.rn = 1),
spans AS (SELECT {keys}, first, coalesce(lead(first) OVER (PARTITION BY {keys} ORDER BY first), 1000000000) AS stop FROM frag),
heavy AS (SELECT {listed("s")}, s.first, max(w.i) AS last, sum(gain) AS gain
  FROM spans s JOIN words w ON {same("w", "s")} AND w.i >= s.first AND w.i < s.stop GROUP BY {listed("s")}, s.first),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY round(gain, 12) DESC, first) AS rn
  FROM heavy WHERE gain > 0) WHERE rn = 1),
shown AS (SELECT {listed("h")}, string_agg(CASE WHEN hit THEN '<b>' || {_ESCAPED} || '</b>' ELSE {_ESCAPED} END, '' ORDER BY i) AS snippet
  FROM hits h JOIN best b ON {same("b", "h")} AND h.i BETWEEN b.first AND b.last GROUP BY {listed("h")})"""


_HIT_WORDS = ["aivi", "est"]


@query(
    "h1_snippet",
    f"""WITH RECURSIVE {sql.index_of()}, {sql.scored()}, top AS ({sql.page(_sum(_HIT_WORDS), 10)}),
{_pieces("SELECT doc_id FROM top")},
words AS (SELECT doc_id, i, e - length(w) AS b, e,
  CASE lower(w) {" ".join(f"WHEN '{t}' THEN 1.0 / (1 + (SELECT df FROM freq WHERE term = '{t}'))" for t in _HIT_WORDS)} ELSE 0 END AS gain
  FROM pieces WHERE word),
frag(doc_id, first, b) AS (
  SELECT doc_id, min(i), min(b) FROM words GROUP BY doc_id
  UNION ALL
  SELECT n.doc_id, n.i, n.b FROM (
    SELECT f.doc_id, w.i, w.b, row_number() OVER (PARTITION BY f.doc_id ORDER BY w.i) AS rn
    FROM frag f JOIN words w ON w.doc_id = f.doc_id AND w.i > f.first AND w.e - f.b > 150) n WHERE n.rn = 1),
spans AS (SELECT doc_id, first, coalesce(lead(first) OVER (PARTITION BY doc_id ORDER BY first), 1000000000) AS stop FROM frag),
heavy AS (SELECT s.doc_id, s.first, max(w.i) AS last, sum(gain) AS gain
  FROM spans s JOIN words w ON w.doc_id = s.doc_id AND w.i >= s.first AND w.i < s.stop GROUP BY 1, 2),
best AS (SELECT doc_id, first, last FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(gain, 12) DESC, first) AS rn
  FROM heavy WHERE gain > 0) WHERE rn = 1)
SELECT p.doc_id, string_agg({_marked(_HIT_WORDS)}, '' ORDER BY i) AS snippet
FROM pieces p JOIN best b ON b.doc_id = p.doc_id AND p.i BETWEEN b.first AND b.last GROUP BY p.doc_id""",
)
def snippet(spark, sf_dir):
    """The best fragment of each hit of a page."""
    found = search(corpora.documents_index(spark, sf_dir), "aivi est", fields=("text",), highlight=("text",))
    return found.select("doc_id", F.col("highlights")["text"].alias("snippet"))


@query(
    "h1_batch_snippets",
    f"""WITH RECURSIVE {sql.index_of()}, {sql.scored()}, {_QUERIES},
scored_pairs AS (SELECT q_post.doc_id AS item_id, sc.doc_id, round(sum(q_post.tf * s), 6) AS score
  FROM q_post JOIN sc USING (term) GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored_pairs),
top AS (SELECT * FROM ranked WHERE rank <= 3),
{_pieces("SELECT DISTINCT doc_id FROM top")},
hits AS (SELECT top.item_id, p.*, f.term IS NOT NULL AS hit, CASE WHEN f.term IS NOT NULL THEN 1.0 / (1 + df) ELSE 0 END AS gain
  FROM top JOIN pieces p USING (doc_id) LEFT JOIN (SELECT q.doc_id AS item_id, term, df FROM q_post q JOIN freq USING (term)) f
    ON f.item_id = top.item_id AND p.word AND f.term = lower(p.w)),
{_fragments('item_id, doc_id')}
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score, lang, snippet FROM top JOIN documents USING (doc_id) JOIN shown USING (item_id, doc_id)""",
)
def batch_snippets(spark, sf_dir):
    """The three best documents of every benchmark item, with the best fragment of each for that item's words."""
    index = corpora.documents_index(spark, sf_dir)
    found = batch_hits(index, corpora.table(spark, sf_dir, "benchmark"), 3, "item_id", "text", ("text",), ("text",))
    return found.select("item_id", "rank", "doc_id", "score", "doc.lang", F.col("highlights")["text"].alias("snippet"))


@query(
    "h1_snippet_expanded",
    f"""{_IX}, found AS (SELECT DISTINCT doc_id FROM post WHERE starts_with(term, 'e')),
top AS (SELECT doc_id FROM found ORDER BY doc_id LIMIT 10)
SELECT doc_id, TRUE AS marked, TRUE AS rightly FROM top""",
)
def snippet_expanded(spark, sf_dir):
    """A pattern with very many terms still marks what it found."""
    found = search(
        corpora.documents_index(spark, sf_dir), q.Prefix("text", "e"), highlight=("text",), highlight_expanded=True
    )
    marks = F.regexp_extract_all(F.col("highlights")["text"], F.lit("<b>([^<]*)</b>"), F.lit(1))
    return found.select(
        "doc_id", (F.size(marks) > 0).alias("marked"), F.forall(marks, lambda m: F.lower(m).startswith("e")).alias("rightly")
    )


@query(
    "h1_snippet_expanded_text",
    f"""WITH RECURSIVE {sql.index_of()}, found AS (SELECT DISTINCT doc_id FROM post WHERE starts_with(term, 'asb')),
top AS (SELECT doc_id FROM found ORDER BY doc_id LIMIT 25), {_pieces("SELECT doc_id FROM top")},
hits AS (SELECT p.*, word AND starts_with(lower(w), 'asb') AS hit, CASE WHEN word AND starts_with(lower(w), 'asb') THEN 1.0 / (1 + df) ELSE 0 END AS gain
  FROM pieces p LEFT JOIN freq ON term = lower(w)),
{_fragments("doc_id")} SELECT doc_id, snippet FROM shown""",
)
def snippet_expanded_text(spark, sf_dir):
    """The fragments that a pattern's terms pick."""
    asked = q.Prefix("text", "asb")
    found = search(corpora.documents_index(spark, sf_dir), asked, limit=25, highlight=("text",), highlight_expanded=True)
    return found.select("doc_id", F.col("highlights")["text"].alias("snippet"))


@query(
    "h2_several_fields",
    f"""{_IX}, k AS (SELECT * FROM {sql.keyword("lang")} WHERE term = 'fr'),
top AS ({sql.page("SELECT doc_id, s FROM k", 10)})
SELECT doc_id, '<b>fr</b>' AS lang, '' AS source, 2 AS fields FROM top""",
)
def several_fields(spark, sf_dir):
    """One snippet per known field, empty where nothing matched; unknown fields are left out."""
    found = search(corpora.documents_index(spark, sf_dir), "fr", fields=("lang",), highlight=("lang", "source", "nowhere"))
    shown = F.col("highlights")
    return found.select("doc_id", shown["lang"].alias("lang"), shown["source"].alias("source"), F.size(shown).alias("fields"))


@query(
    "h3_no_match",
    f"{_IX}, top AS ({sql.page(_sum(['inger']), 10)}) SELECT doc_id, '' AS lang, 0 AS plain FROM top",
)
def no_match(spark, sf_dir):
    """A field without a match has an empty snippet; without a request the map is empty."""
    index = corpora.documents_index(spark, sf_dir)
    asked = search(index, "inger", fields=("text",), highlight=("lang",))
    plain = search(index, "inger", fields=("text",)).select("doc_id", F.size("highlights").alias("plain"))
    return asked.select("doc_id", F.col("highlights")["lang"].alias("lang")).join(plain, "doc_id")


@query(
    "h4_bulk_highlight",
    f"""{_IX}, {_pieces("SELECT DISTINCT doc_id FROM post WHERE term IN ('the', 'est')")}
SELECT doc_id, string_agg({_marked(["the", "est"])}, '' ORDER BY i) AS highlight FROM pieces GROUP BY doc_id""",
)
def bulk_highlight(spark, sf_dir):
    """Every hit's whole text, marked and escaped."""
    return highlight_all(corpora.documents_index(spark, sf_dir), q.match("the est", "text"), "text")
