"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from quillspark.llm import quality, secrets

WORD = r"[^\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{WORD}')"


def quality_sql() -> str:
    """The same counts, the same tests with the tail of the binomial distribution added up term by term."""
    each = quality.RISK / len(quality.RULES)
    window = quality.WINDOW
    rules = " UNION ALL ".join(
        f"SELECT doc_id, stratum, '{rule}' AS rule, {a} AS a, {b} AS b FROM counted WHERE NOT base_failed"
        for rule, (a, b) in quality.RULES.items()
    )
    cutoffs = ", ".join(map(str, quality.CUTOFFS))
    return f"""WITH src AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS t, {_words("text")} AS w FROM documents),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM src),
win AS (SELECT doc_id, unnest(range(1, len(w) - {window - 2})) AS i,
    unnest(list_transform(range(1, len(w) - {window - 2}), lambda i: array_to_string(list_slice(w, i, i + {window - 1}), ' '))) AS x
  FROM src WHERE len(w) >= {window}),
twice AS (SELECT doc_id, x FROM win GROUP BY doc_id, x HAVING count(*) > 1),
again AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM win JOIN twice USING (doc_id, x), range({window}) r(k) GROUP BY doc_id),
plain AS (SELECT doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(t) - length(regexp_replace(t, '[^\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM src JOIN lines USING (doc_id) LEFT JOIN again USING (doc_id)),
counted AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM plain),
ratios AS ({rules}),
grid AS (SELECT unnest([{cutoffs}]) AS c),
cells AS (SELECT stratum, rule, c, count(*) FILTER (quality = 1) AS n, count(*) FILTER (quality <> 1) AS bad,
    count(*) FILTER (quality = 1 AND 1000 * a > c * b) AS k, count(*) FILTER (quality <> 1 AND 1000 * a > c * b) AS caught
  FROM ratios JOIN labels USING (doc_id), grid WHERE quality IS NOT NULL GROUP BY stratum, rule, c),
tested AS (SELECT *, count(*) OVER () AS tests, CASE WHEN k < n * {each} THEN list_sum(list_transform(range(0, k + 1),
    lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({each}) + (n - j) * ln(1 - {each})))) ELSE 1 END AS p FROM cells),
gains AS (SELECT *, caught * n - {quality.REGRET} * k * bad AS gain FROM tested WHERE p <= {quality.CHANCE} / tests),
best AS (SELECT stratum, rule, c FROM gains WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, c DESC) = 1),
broken AS (SELECT DISTINCT doc_id FROM ratios r JOIN best b ON r.rule = b.rule AND r.stratum IS NOT DISTINCT FROM b.stratum
  WHERE 1000 * r.a > b.c * r.b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM broken) AS kept FROM counted"""


def passages_sql(window: int) -> str:
    return f"""WITH src AS (SELECT doc_id, {_words("text")} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - {window - 2})) AS i,
    md5(unnest(list_transform(range(1, len(w) - {window - 2}), lambda i: array_to_string(list_slice(w, i, i + {window - 1}), ' ')))) AS x
  FROM src WHERE len(w) >= {window}),
twice AS (SELECT x FROM win GROUP BY x HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN twice USING (x), range({window}) r(k)),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM src),
left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256 FROM src LEFT JOIN removed USING (doc_id) LEFT JOIN left_over USING (doc_id)"""


def near_duplicates_sql(n: int, percent: int) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH RECURSIVE src AS (SELECT doc_id, regexp_extract_all({lower}, '{WORD}') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(list_slice(w, i, i + {n - 1}), ' ')) END) AS s FROM src),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a AS doc_id, a AS other FROM links UNION SELECT doc_id, b FROM reach JOIN links ON other = a),
least AS (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM src LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""


def secrets_sql() -> str:
    quote = lambda p: p.replace("'", "''")
    opaque = secrets.OPAQUE[secrets.OPAQUE.index(")") + 1 :]  # matches are whole runs with or without the look behind
    patterns = [(0, secrets.ASSIGN), (1, secrets.ACCESS), (2, secrets.HEX), (3, opaque)]
    found = " UNION ALL ".join(
        f"SELECT rid, {k} AS kind, regexp_extract_all(t, '{quote(p)}') AS ms, string_split_regex(t, '{quote(p)}') AS bs FROM src"
        for k, p in patterns
    )
    total = lambda x: f"coalesce(list_sum(list_transform({x}, lambda x: length(x))), 0)"
    order = "ORDER BY a, kind"
    written = "kinds[kind + 1] || ':' || a || ':' || e"
    return f"""WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, source AS owner,
    coalesce(source, '') || '/' || coalesce(lang, '') AS repository, ['assign', 'access', 'hex', 'opaque'] AS kinds FROM documents),
found AS ({found}),
places AS (SELECT rid, kind, ms, bs, unnest(range(1, len(ms) + 1)) AS i FROM found),
spans AS (SELECT rid, kind, ms[i] AS m, CAST({total("list_slice(bs, 1, i)")} + {total("list_slice(ms, 1, i - 1)")} AS BIGINT) AS a FROM places),
ends AS (SELECT *, CAST(a + length(m) AS BIGINT) AS e,
  CASE WHEN kind = 0 THEN regexp_extract(m, '{quote(secrets.ASSIGN)}', 2) ELSE m END AS v FROM spans),
kept AS (SELECT * FROM ends WHERE kind IN (1, 2) OR kind = 0 AND length(v) >= {secrets.LEAST_ASSIGNED}
  OR kind = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')),
candidates AS (SELECT * FROM kept o WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM kept b
  WHERE b.rid = o.rid AND b.kind < 3 AND b.a < o.e AND o.a < b.e)),
owners AS (SELECT v, count(DISTINCT coalesce('=' || owner, 'null')) >= {secrets.SHARED_OWNERS}
    AND count(DISTINCT repository) >= {secrets.SHARED_REPOSITORIES} AS shared
  FROM candidates JOIN src USING (rid) GROUP BY v),
judged AS (SELECT * FROM candidates JOIN owners USING (v)),
summed AS (SELECT rid, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
    string_agg({written}, ',' {order}) FILTER (kind < 3) AS base, string_agg({written}, ',' {order}) FILTER (kind < 3 OR NOT shared) AS chosen,
    count(*) FILTER (kind < 3 OR NOT shared) AS n_chosen, count(*) FILTER (NOT shared) AS live, count(*) FILTER (shared) AS common
  FROM judged JOIN src USING (rid) GROUP BY rid)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(chosen, '') AS spans, coalesce(n_chosen, 0) AS n_spans, coalesce(live, 0) AS n_live, coalesce(common, 0) AS n_shared
FROM src LEFT JOIN summed USING (rid)"""


def merkle_sql(arity: int = 16) -> str:
    """Both trees level by level; a proof is the other nodes of each run on the way up."""
    field = lambda v: f"coalesce(strlen({v}) || ':' || {v}, '-')"
    leaf = lambda text: " || ".join(field(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars", text))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def grown(name: str, leaves: str) -> str:
        return f"""{name} AS (SELECT g, 0 AS level, pos, total, d FROM {leaves}
  UNION ALL SELECT g, level + 1, pos // {arity}, (any_value(total) + {arity - 1}) // {arity}, sha256(string_agg(d, '' ORDER BY pos))
  FROM {name} WHERE total > 1 GROUP BY g, level, pos // {arity})"""

    def steps(name: str, tree: str, leaves: str) -> str:
        """The siblings of each leaf's ancestors, level by level."""
        return f"""{name} AS (SELECT l.g, l.pos, s.level,
    coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos < l.pos // CAST(pow({arity}, s.level) AS BIGINT)), '') AS lefts,
    coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos > l.pos // CAST(pow({arity}, s.level) AS BIGINT)), '') AS rights
  FROM {leaves} l JOIN {tree} s ON s.g = l.g AND s.total > 1 AND s.pos // {arity} = l.pos // CAST(pow({arity}, s.level + 1) AS BIGINT)
  GROUP BY l.g, l.pos, s.level)"""

    return f"""WITH RECURSIVE crc_table AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || range(8), lambda a, b:
    CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS c FROM range(256) r(i))),
hashed AS (SELECT doc_id, coalesce('=' || source, '') AS g, sha256({leaf("text")}) AS d, sha256({leaf(lower)}) AS lowered,
    xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda h, b: xor(h // 256, t[CAST(xor(h % 256, b) AS INT) + 1]))) AS crc FROM documents, crc_table),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS pos, count(*) OVER (PARTITION BY g) AS total,
    CASE WHEN crc % 5 = 0 THEN lowered ELSE d END AS seen FROM hashed),
{grown("nodes", "leaves")},
subroots AS (SELECT g AS source, '' AS g, d, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS total FROM nodes WHERE total = 1),
{grown("tops", "subroots")},
{steps("low", "nodes", "leaves")},
{steps("high", "tops", "subroots")},
low_lists AS (SELECT g, pos, list(lefts || '|' || rights ORDER BY level) AS p FROM low GROUP BY g, pos),
high_lists AS (SELECT pos, list(lefts || '|' || rights ORDER BY level) AS p FROM high GROUP BY pos),
proofs AS (SELECT l.doc_id, l.d AS leaf, l.seen, s.d AS subroot, (SELECT d FROM tops WHERE total = 1) AS root,
    coalesce(a.p, []) || coalesce(b.p, []) AS proof
  FROM leaves l JOIN subroots s ON s.source = l.g LEFT JOIN low_lists a ON a.g = l.g AND a.pos = l.pos LEFT JOIN high_lists b ON b.pos = s.pos),
done AS (SELECT *, list_reduce([seen] || proof, lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(proof, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM done"""


def collocations_sql(least: int, most: int, longest: int = 4) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    grams = " UNION ALL ".join(
        f"SELECT lang, {n} AS k, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(list_slice(w, i, i + {n - 1}), ' '))) AS p FROM pieces WHERE len(w) >= {n}"
        for n in range(1, longest + 1)
    )
    return f"""WITH src AS (SELECT coalesce(lang, 'und') AS lang, {lower} AS t FROM documents),
cut AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM src),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM cut),
counted AS (SELECT lang, k, p, count(*) AS f FROM ({grams}) GROUP BY lang, k, p),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
often AS (SELECT *, string_split(p, ' ') AS w FROM counted WHERE f >= {least}),
cuts AS (SELECT lang, p, w, f, unnest(range(1, k)) AS i FROM often WHERE k > 1),
parts AS (SELECT c.lang, c.p, c.f, c.i, x.f AS l, y.f AS r, CAST(2000000 * c.f::HUGEINT // (x.f + y.f) AS BIGINT) AS score FROM cuts c
  JOIN often x ON x.lang = c.lang AND x.p = array_to_string(list_slice(c.w, 1, i), ' ')
  JOIN often y ON y.lang = c.lang AND y.p = array_to_string(list_slice(c.w, i + 1, len(c.w)), ' ')),
best AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, i) = 1),
inner_ AS (SELECT lang, k, f, w, unnest(range(2, k)) AS size FROM often WHERE k > 2),
places AS (SELECT lang, k, f, w, size, unnest(range(1, k - size + 2)) AS i FROM inner_),
covered AS (SELECT lang, array_to_string(list_slice(w, i, i + size - 1), ' ') AS p, max(f) AS longest FROM places GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN covered USING (lang, p) WHERE longest IS NULL OR 100 * longest::HUGEINT < 80 * b.f::HUGEINT)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, encode(p)) AS rank, p AS phrase, f AS a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= {most}"""
