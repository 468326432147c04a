"""Quality rules with risk-controlled thresholds.

Each rule rejects a text if a ratio of two of its counts is above a cutoff. The cutoff of a rule in a stratum is chosen
on labelled documents: an exact binomial test must show that the rule rejects at most a given share of the stratum's
good documents, with all tests corrected together. Where no cutoff can be shown to be safe, the rule rejects nothing.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import SPACE, bind, n_words, text_of, words_of, written

WINDOW = 8
LEAST_WORDS = 20
SYMBOLS = "[#*$%&|<>]"

#: Rules: a name, and the two counts whose ratio a cutoff limits.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
}
#: Cutoffs in thousandths, the same for every rule.
CUTOFFS = (10, 20, 40, 60, 80, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900)
#: At most this share of a stratum's good documents is rejected by all rules together, ...
RISK = 0.02
#: ... but for this chance over all tests together.
CHANCE = 0.05
#: A share of good documents rejected weighs as much as so many times the share of bad ones.
REGRET = 20


def _repeat_words(words: Column) -> Column:
    """Words in windows that occur twice or more in the text. Windows are compared by 64-bit hashes."""

    def covered(hashes: Column) -> Column:
        numbered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of_sorted(s: Column) -> Column:
            same = lambda x, j, d: F.coalesce(F.get(s, j + d)["h"] == x["h"], F.lit(False))
            twice = F.filter(s, lambda x, j: same(x, j, -1) | same(x, j, 1))
            starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
            step = lambda a, i: F.struct(
                (i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n")
            )
            return F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step, lambda a: a["n"])

        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), bind(numbered, of_sorted)).otherwise(0)

    window = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW)))
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)
    return F.when(F.size(words) > WINDOW, bind(hashes, covered)).otherwise(0)


def measured(docs: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` and the counts of each text, one row per row. A null text is empty, and all its counts are 0."""
    text = F.col("_t")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = bind(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    rows = docs.select(*keep, text_of(text_col).alias("_t"))
    counted = rows.select(
        "*",
        n_words(text).alias("n_words"),
        (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        of_lines.alias("_lines"),
        bind(words_of(text), _repeat_words).cast("long").alias("n_repeat_words"),
    ).drop("_t")
    return counted.withColumns(
        {
            "n_lines": F.col("_lines.n").cast("long"),
            "n_dup_lines": (F.col("_lines.n") - F.col("_lines.d")).cast("long"),
            "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        }
    ).drop("_lines")


def _log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series, shifted up so that it holds from x = 0 on."""
    shift = 8
    z = x + 1 + shift
    product = F.lit(0.0)
    for k in range(1, shift + 1):
        product = product + F.ln(x + k)
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5)))
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + series - product


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P(X <= k) for n trials at ``risk``, exactly, for k below the mean; 1 above it.

    From k down the terms fall, each by a known factor; what lies 12 standard deviations below is under 1e-30."""
    top = (
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(risk) + (n - k) * math.log(1 - risk)
    )
    steps = F.least(k, F.ceil(12 * F.sqrt(n * risk)) + 50).cast("int")
    odds = (1 - risk) / risk

    def add(a: Column, i: Column) -> Column:
        return F.struct(
            (a["term"] * (k - i) * odds / (n - k + i + 1)).alias("term"), (a["total"] + a["term"]).alias("total")
        )

    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))
    total = F.aggregate(F.sequence(F.lit(0), steps), start, add, lambda a: a["total"])
    return F.when(k < n * risk, F.exp(top) * total).otherwise(1.0)


def choose_cutoffs(labelled: DataFrame, risk: float = RISK, chance: float = CHANCE) -> DataFrame:
    """One row per stratum: ``stratum`` and a cutoff for each rule (null: none is safe).

    ``labelled`` has ``stratum``, ``good`` and the counts. For each rule and cutoff, a binomial test of "more than
    risk / rules of the stratum's good documents are rejected" must be refused at ``chance`` divided by the number of all
    tests; so all chosen cutoffs hold together. Of the safe cutoffs of a rule, the one with the largest gain in rejected
    bad documents over weighted rejected good ones is taken, if it gains at all; ties go to the higher cutoff. Ratios
    are grouped into the steps between cutoffs first, so what is shuffled is a row per stratum, rule and step."""
    each = risk / len(RULES)
    grid = F.array(*(F.lit(c) for c in CUTOFFS))

    def step(rule: str, a: str, b: str) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), F.size(F.filter(grid, lambda c: 1000 * F.col(a) > c * F.col(b))).alias("passed")
        )

    steps = [step(rule, a, b) for rule, (a, b) in RULES.items()]
    tally = labelled.select("stratum", F.col("good").cast("boolean").alias("good"), F.explode(F.array(*steps)).alias("s"))
    tally = tally.groupBy("stratum", "s.rule", "s.passed").agg(
        F.sum(F.when(F.col("good"), 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("good"), 0).otherwise(1)).alias("bad")
    )
    totals = tally.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"),
        F.sum("bad").alias("n_bad"),
        F.collect_list(F.struct("passed", "good", "bad")).alias("steps"),
    )
    cells = totals.select("stratum", "rule", "n_good", "n_bad", "steps", F.posexplode(grid).alias("at", "cutoff"))
    beyond = lambda what: F.aggregate(
        F.filter("steps", lambda s: s["passed"] > F.col("at")), F.lit(0).cast("long"), lambda a, s: a + s[what]
    )
    cells = cells.select("stratum", "rule", "cutoff", "n_good", "n_bad", beyond("good").alias("k"), beyond("bad").alias("caught"))
    tests = F.count("*").over(W.partitionBy())
    cells = cells.withColumn("p", binomial_tail(F.col("k"), F.col("n_good"), each)).withColumn("tests", tests)
    gain = F.col("caught") * F.col("n_good") - REGRET * F.col("k") * F.col("n_bad")
    safe = cells.filter(F.col("p") <= chance / F.col("tests")).withColumn("gain", gain).filter("gain > 0")
    best = safe.groupBy("stratum", "rule").agg(F.max(F.struct("gain", "cutoff")).alias("best"))
    return best.groupBy("stratum").agg(
        *(F.max(F.when(F.col("rule") == name, F.col("best.cutoff"))).alias(f"max_{name}") for name in RULES)
    )


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, stratum: Column, keep: list[str], label: str = "quality"
) -> DataFrame:
    """Rows of ``docs`` as ``doc`` (a struct of the columns ``keep``) with ``stratum``, the counts, ``base_failed``, the
    cutoffs of the stratum and ``kept``.

    Labels are rows of (id, ``label`` 0 or 1); ids without a label, labels without a document and null labels take no
    part, an id with several labels counts once for each. Thresholds are chosen among documents that pass the base
    rules. Null strata are one stratum. Empty tables: empty, or no cutoffs. Texts are read once and not shuffled."""
    rows = written(_measured_rows(docs, id_col, text_col, stratum, keep), "quality-counts")
    return _judged(rows, _cutoffs(rows, labels, id_col, label))


def _measured_rows(docs: DataFrame, id_col: str, text_col: str, stratum: Column, keep: list[str]) -> DataFrame:
    name = F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit("null")).alias("stratum")
    return measured(docs, text_col, [F.struct(*keep).alias("doc"), F.col(id_col).alias("id"), name])


def _cutoffs(rows: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    marked = labels.select(F.col(id_col).alias("id"), (F.col(label) == 1).alias("good")).filter("good is not null")
    return written(choose_cutoffs(rows.drop("doc").filter("not base_failed").join(marked, "id")), "quality-cutoffs")


def _judged(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    judged = rows.join(cutoffs, "stratum", "left")
    rejected = F.lit(False)
    for rule, (a, b) in RULES.items():
        rejected = rejected | F.coalesce(1000 * F.col(a) > F.col(f"max_{rule}") * F.col(b), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~rejected)


def kept_documents(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, stratum: Column, label: str = "quality"
) -> DataFrame:
    """The rows of ``docs`` that all rules keep; the columns stay. Texts are read twice, for the cutoffs and to apply them,
    so that no copy of them is written."""
    rows = written(_measured_rows(docs, id_col, text_col, stratum, [id_col]), "quality-counts")
    cutoffs = _cutoffs(rows, labels, id_col, label)
    whole = _measured_rows(docs, id_col, text_col, stratum, docs.columns)
    return _judged(whole, cutoffs).filter("kept").select("doc.*")
