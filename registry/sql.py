"""Pieces of SQL shared by the counterparts: an inverted index spelled out as common table expressions."""

WORD = r"[\p{L}\p{N}]+"

# Tokens, postings with positions, lengths, frequencies and totals of one text column.
def index_of(table: str = "documents", key: str = "doc_id", text: str = "text", prefix: str = "", where: str = "TRUE") -> str:
    words = f"regexp_extract_all({text}, '{WORD}')"
    p = prefix
    return f"""
{p}src AS (SELECT * FROM {table} WHERE {where}),
{p}raw AS (SELECT {key} AS doc_id, unnest({words}) AS w, unnest(range(len({words}))) AS pos FROM {p}src),
{p}tok AS (SELECT doc_id, lower(w) AS term, CAST(pos AS INTEGER) AS pos FROM {p}raw WHERE strlen(w) < 40),
{p}len AS (SELECT doc_id, count(*) AS dl FROM {p}tok GROUP BY doc_id),
{p}post AS (SELECT t.doc_id, t.term, count(*) AS tf, any_value(l.dl) AS dl FROM {p}tok t JOIN {p}len l USING (doc_id)
            GROUP BY t.doc_id, t.term),
{p}freq AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {p}post GROUP BY term),
{p}tot AS (SELECT (SELECT count(*) FROM {p}src) AS n,
                  (SELECT count(*) FROM {p}tok) * 1.0 / (SELECT count(*) FROM {p}src) AS avgdl)"""


IDF = "ln(1 + (n - df + 0.5) / (df + 0.5))"
TF = "2.2 * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))"


def scored(prefix: str = "") -> str:
    """(doc_id, term, s): the BM25 part of every posting."""
    p = prefix
    return f"""
{p}sc AS (SELECT p.doc_id, p.term, {IDF} * {TF} AS s FROM {p}post p JOIN {p}freq f USING (term), {p}tot)"""


def keyword(column: str, key: str = "doc_id", table: str = "documents") -> str:
    """(doc_id, term, s) of an untokenised column; one token per value, so only the idf is left."""
    return f"""(SELECT d.{key} AS doc_id, d.{column} AS term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS s
  FROM {table} d JOIN (SELECT {column}, count(*) AS df FROM {table} GROUP BY 1) f USING ({column}),
  (SELECT count(*) AS n FROM {table}))"""


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def phrase(words: list[str], prefix: str = "", name: str = "ph") -> str:
    """(doc_id, s): BM25 of adjacent words in order."""
    p = prefix
    cases = " + ".join(f"(SELECT {IDF} FROM {p}freq, {p}tot WHERE term = '{w}')" for w in words)
    joins = " ".join(
        f"JOIN {p}tok t{i} ON t{i}.doc_id = t0.doc_id AND t{i}.pos = t0.pos + {i} AND t{i}.term = '{w}'"
        for i, w in enumerate(words)
        if i
    )
    return f"""
{name}tf AS (SELECT t0.doc_id, count(*) AS tf FROM {p}tok t0 {joins} WHERE t0.term = '{words[0]}' GROUP BY t0.doc_id),
{name} AS (SELECT x.doc_id, ({cases}) * {TF} AS s FROM {name}tf x JOIN {p}len USING (doc_id), {p}tot)"""


def page(source: str, limit: int = 10, offset: int = 0) -> str:
    """One page of (doc_id, score) from a (doc_id, s) source."""
    return f"""SELECT doc_id, round(s, 6) AS score FROM ({source})
ORDER BY round(s, 6) DESC, doc_id LIMIT {limit} OFFSET {offset}"""


def every(source: str) -> str:
    return f"SELECT doc_id, round(s, 6) AS score FROM ({source})"


# Suffixes of the published English rules and what stands for them.
_LONGER = """tional tion enci ence anci ance abli able entli ent izer ize ization ize ational ate ation ate ator ate alism al aliti al
alli al fulness ful ousli ous ousness ous iveness ive iviti ive biliti ble bli ble ogi og fulli ful lessli less li -""".split()
_MIDDLE = "tional tion ational ate alize al icate ic iciti ic ical ic ful - ness - ative -".split()
_LAST = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()
_WHOLE = """skis ski skies sky dying die lying lie tying tie idly idl gently gentl ugly ugli early earli only onli singly singl
sky sky news news howe howe atlas atlas cosmos cosmos bias bias andes andes""".split()
_KEPT = "inning outing canning herring earring proceed exceed succeed".split()
_SHORT = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"


def _instead(suffix: str, pairs: list[str]) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b.strip('-')}'" for a, b in zip(pairs[::2], pairs[1::2]))
    return f"CASE {suffix} {cases} END"


def _ending(suffixes: list[str]) -> str:
    """The word ``w`` parted: ``s``, the longest of the suffixes that it ends in, and ``b``, what is before it."""
    s = f"regexp_extract(w, '({'|'.join(suffixes)})$')"
    return f"{s} AS s, left(w, length(w) - length({s})) AS b"


def english_stems(terms: str) -> str:
    """``english (term, stem)`` of all terms of a relation, by the published English rules, one step in each relation."""
    first = "^.*?[aeiouy][^aeiouy]"
    return f"""
en_y AS (SELECT term, regexp_replace(regexp_replace(term, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') AS w FROM {terms}),
en_r1 AS (SELECT term, w, CASE WHEN regexp_matches(w, '^(gener|commun|arsen)') THEN length(regexp_extract(w, '^(gener|commun|arsen)'))
  WHEN regexp_matches(w, '{first}') THEN length(regexp_extract(w, '{first}')) ELSE length(w) END AS r1 FROM en_y),
en_r2 AS (SELECT term, w, r1, CASE WHEN regexp_matches(substr(w, r1 + 1), '{first}')
  THEN r1 + length(regexp_extract(substr(w, r1 + 1), '{first}')) ELSE length(w) END AS r2 FROM en_r1),
en_1a AS (SELECT term, r1, r2, CASE WHEN w LIKE '%sses' THEN left(w, length(w) - 2)
  WHEN regexp_matches(w, '(ied|ies)$') THEN left(w, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END)
  WHEN regexp_matches(w, '(us|ss)$') THEN w
  WHEN regexp_matches(w, '[aeiouy].+s$') THEN left(w, length(w) - 1) ELSE w END AS w FROM en_r2),
en_1b_parts AS (SELECT *, {_ending("eedly ingly edly eed ing ed".split())} FROM en_1a),
en_1b AS (SELECT term, r1, r2, w AS plural, CASE WHEN s = '' THEN w
  WHEN s LIKE 'eed%' THEN CASE WHEN length(b) >= r1 THEN b || 'ee' ELSE w END
  WHEN NOT regexp_matches(b, '[aeiouy]') THEN w
  WHEN regexp_matches(b, '(at|bl|iz)$') THEN b || 'e'
  WHEN regexp_matches(b, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(b, length(b) - 1)
  WHEN length(b) <= r1 AND regexp_matches(b, '{_SHORT}') THEN b || 'e' ELSE b END AS w FROM en_1b_parts),
en_1c AS (SELECT term, r1, r2, plural, CASE WHEN regexp_matches(w, '.[^aeiouy][yY]$') THEN left(w, length(w) - 1) || 'i' ELSE w END AS w
  FROM en_1b),
en_2_parts AS (SELECT *, {_ending(_LONGER[::2])} FROM en_1c),
en_2 AS (SELECT term, r1, r2, plural, CASE WHEN s = '' OR length(b) < r1 OR (s = 'ogi' AND b NOT LIKE '%l')
  OR (s = 'li' AND NOT regexp_matches(b, '[cdeghkmnrt]$')) THEN w ELSE b || {_instead("s", _LONGER)} END AS w FROM en_2_parts),
en_3_parts AS (SELECT *, {_ending(_MIDDLE[::2])} FROM en_2),
en_3 AS (SELECT term, r1, r2, plural, CASE WHEN s = '' OR length(b) < CASE WHEN s = 'ative' THEN r2 ELSE r1 END THEN w
  ELSE b || {_instead("s", _MIDDLE)} END AS w FROM en_3_parts),
en_4_parts AS (SELECT *, {_ending(_LAST)} FROM en_3),
en_4 AS (SELECT term, r1, r2, plural, CASE WHEN s = '' OR length(b) < r2 OR (s = 'ion' AND NOT regexp_matches(b, '[st]$')) THEN w
  ELSE b END AS w FROM en_4_parts),
en_5 AS (SELECT term, plural, CASE WHEN w LIKE '%e' AND (length(w) > r2 OR (length(w) > r1
    AND NOT regexp_matches(left(w, length(w) - 1), '{_SHORT}'))) THEN left(w, length(w) - 1)
  WHEN w LIKE '%ll' AND length(w) > r2 THEN left(w, length(w) - 1) ELSE w END AS w FROM en_4),
english AS (SELECT term, CASE WHEN length(term) <= 2 THEN term
  WHEN term IN ({", ".join(f"'{w}'" for w in _WHOLE[::2])}) THEN {_instead("term", _WHOLE)}
  WHEN plural IN ({", ".join(f"'{w}'" for w in _KEPT)}) THEN plural ELSE replace(w, 'Y', 'y') END AS stem FROM en_5)"""
