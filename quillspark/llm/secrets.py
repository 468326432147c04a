"""Secret scan with corpus-wide ownership frequency.

Patterns find candidates in each text. A candidate's hash is then counted over the corpus by the distinct repositories
and owners that hold it: a value that several owners share is an example that everybody copies, a value that only one
owner has looks live. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import bind, text_of, written

# The kinds in order, with the least length of a match, or of the group that counts.
ASSIGN = (
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Long mixed runs that no base pattern covers; the method adds those that only one owner has.
OPAQUE = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{24,}"
LEAST_ASSIGNED = 6
#: A shared value: found with at least so many owners, and in at least so many repositories. What one repository has is not
#: copied, though several owners hold it.
SHARED_OWNERS, SHARED_REPOSITORIES = 2, 2

SPAN = "struct<start:bigint,kind:int,end:bigint,hash:string>"
NAMES = ("assign", "access", "hex", "opaque")


def _no_spans() -> Column:
    return F.expr(f"cast(array() as array<{SPAN}>)")


def _matches(text: Column, pattern: str, kind: int, secret, keep) -> Column:
    """Spans of all matches, leftmost first and not overlapping: what lies between them gives their places."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.expr(f"struct(0L as at, cast(array() as array<{SPAN}>) as found)")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["0"]).cast("long")
        end = start + F.length(pair["1"]).cast("long")
        span = F.struct(
            start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.sha2(secret(pair["1"]), 256).alias("hash")
        )
        found = F.when(keep(pair["1"]), F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    pairs = F.zip_with(between, matches, lambda b, m: F.struct(b.alias("0"), m.alias("1")))
    pairs = F.filter(pairs, lambda p: p["1"].isNotNull())
    found = F.aggregate(pairs, none, add, lambda s: s["found"])
    return F.when(text.rlike(pattern), found).otherwise(_no_spans())


def candidate_spans(text: Column) -> Column:
    """Array of candidates (start, kind, end, hash of the value) by start, then kind; offsets count code points."""
    assigned = lambda m: F.regexp_extract(m, ASSIGN, 2)
    whole, always = (lambda m: m), (lambda m: F.lit(True))
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")
    base = F.concat(
        _matches(text, ASSIGN, 0, assigned, lambda m: F.length(assigned(m)) >= LEAST_ASSIGNED),
        _matches(text, ACCESS, 1, whole, always),
        _matches(text, HEX, 2, whole, always),
    )
    more = _matches(text, OPAQUE, 3, whole, mixed)

    def clear_of(found: Column) -> Column:
        return F.filter(more, lambda o: ~F.exists(found, lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"])))

    found = bind(base, lambda found: F.array_sort(F.concat(found, clear_of(found))))
    return F.when(text.rlike("|".join((ASSIGN, ACCESS, HEX, OPAQUE))), found).otherwise(_no_spans())


def scan(docs: DataFrame, text_col: str, owner: Column, repository: Column, keep: list[str]) -> DataFrame:
    """Rows of ``docs`` with their candidates: ``row`` (a number of the row), ``doc`` (a struct of the columns ``keep``)
    and ``spans``, an array of (start, kind, end, hash, n_owners, n_repositories, shared), by start and kind.

    A null text is empty and has no spans. A null owner or repository is one of its own. Repeated rows stay apart, and
    count once for the owner that holds them. Other columns have no effect, an empty table gives an empty table. Texts
    are scanned once and not shuffled; hashes are counted with partial sums, so a hash in a third of all rows is one row
    per task. The counts are written before they are joined back, so that both sides of that join come from plain shuffles
    and AQE can split a hash that very many rows have."""
    found = docs.select(
        F.struct(*keep).alias("doc"),
        owner.cast("string").alias("owner"),
        repository.cast("string").alias("repository"),
        candidate_spans(text_of(text_col)).alias("found"),
    )
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    each = found.filter(F.size("found") > 0).select("row", "owner", "repository", F.explode("found").alias("s"))
    one = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    holders = each.select(F.col("s.hash").alias("hash"), one(F.col("owner")).alias("o"), one(F.col("repository")).alias("r"))
    ownership = holders.groupBy("hash").agg(F.count_distinct("o").alias("n_owners"), F.count_distinct("r").alias("n_repositories"))
    ownership = written(ownership, "secret-ownership")
    judged = each.select("row", "s", F.col("s.hash").alias("hash")).join(ownership, "hash")
    judged = judged.select(
        "row",
        F.struct(
            "s.start", "s.kind", "s.end", "hash", "n_owners", "n_repositories",
            ((F.col("n_owners") >= SHARED_OWNERS) & (F.col("n_repositories") >= SHARED_REPOSITORIES)).alias("shared"),
        ).alias("span"),
    )
    spans = judged.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return found.select("row", "doc").join(spans, "row", "left").withColumn("spans", F.coalesce("spans", empty))


def written_spans(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, NAMES))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts by kind and the places of all spans; of the added kind only those that one owner has."""
    base = F.filter("spans", lambda s: s["kind"] < 3)
    chosen = F.filter("spans", lambda s: (s["kind"] < 3) | ~s["shared"])
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda k: lambda s: s["kind"] == k
    return scanned.select(
        "doc.*",
        *(count(of_kind(k)).alias(f"n_{NAMES[k]}") for k in range(3)),
        F.sha2(written_spans(base), 256).alias("base_sha256"),
        written_spans(chosen).alias("spans"),
        F.size(chosen).cast("long").alias("n_spans"),
        count(lambda s: ~s["shared"]).alias("n_live"),
        count(lambda s: s["shared"]).alias("n_shared"),
    )


def redact(docs: DataFrame, text_col: str, owner: Column, repository: Column, placeholder: str = "[secret]") -> DataFrame:
    """``docs`` with every span that only one owner has replaced by ``placeholder``; shared examples stay. All columns
    and rows are kept; a text without such spans is unchanged, null texts stay null."""
    live = scan(docs, text_col, owner, repository, docs.columns).select(
        "doc", F.col(f"doc.`{text_col}`").alias("text"), F.filter("spans", lambda s: ~s["shared"]).alias("live")
    )

    def cut(state: Column, span: Column) -> Column:
        before = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        out = F.concat(state["out"], before, F.lit(placeholder))
        out = F.when(span["start"] < state["at"], state["out"]).otherwise(out)
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    rest = lambda s: F.concat(s["out"], F.expr("text").substr((s["at"] + 1).cast("int"), F.length("text")))
    changed = F.aggregate("live", F.expr("struct(0L as at, '' as out)"), cut, rest)
    text = F.when(F.size("live") > 0, changed).otherwise(F.col("text"))
    return live.select("doc", text.alias("text")).select(
        *(F.col("text").alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in docs.columns)
    )
