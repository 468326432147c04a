"""Toxicity by a weighted lexicon.

Texts are folded first: case, look-alike letters of other alphabets, full-width forms, digits that stand for letters.
The lexicon, whole words and word beginnings with weights, is learned from labels; one Aho-Corasick automaton finds all
its entries in one pass. Matches inside an exception phrase do not count. The weights found, normalised by length, give
the score through a logistic curve that is fitted on labelled texts the lexicon has not seen.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: About so many labelled rows, chosen by a hash of the id, teach lexicon and curve; their words are all that the lexicon
#: can hold.
LABELLED_SAMPLE = 20_000
#: Beginnings of words that can be entries.
BEGINNINGS = (3, 4, 5, 6)
#: An entry is in at least so many toxic texts of the sample, ...
LEAST_TEXTS = 3
#: ... and so much more often than by chance, as a likelihood ratio: a limit that a million candidates rarely reach.
LEAST_EVIDENCE = 25.0
#: The least log-odds of an entry.
LEAST_WEIGHT = 3.0
BATCH_ROWS = 1_000

# Letters that look like Latin ones, and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ո": "n", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ℓ": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
INVISIBLE = ("­", "​", "‌", "‍", "⁠", "﻿")
#: Phrases in which words of abuse mean no harm.
EXCEPTIONS = (
    "clown fish", "class clown", "circus clown", "trash can", "trash bin", "trash bag", "take out the trash", "pond scum",
    "stupid mistake", "sore loser",
)


class _Folding(dict):
    """Code point to folded text, learned as characters turn up: letters stay, everything else separates words."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if c in INVISIBLE:
            out = ""
        elif c in HOMOGLYPHS or c in SUBSTITUTES:
            out = HOMOGLYPHS.get(c) or SUBSTITUTES[c]
        else:
            plain = unicodedata.normalize("NFKC", c).lower()
            out = "".join(HOMOGLYPHS.get(p, p) for p in plain if p.isalpha()) or " "
        self[code] = out
        return out


FOLDING = _Folding()


def folded(text: str | None) -> str:
    """Words of letters, one space before and after each."""
    return f" {' '.join((text or '').lower().translate(FOLDING).split())} "


@dataclass
class Lexicon:
    """Entries are " word " or " beginning", with weights."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(folded(phrase), (len(folded(phrase)), None))
        for entry, weight in self.weights.items():
            if not found.exists(entry):
                found.add_word(entry, (len(entry), weight))
        if len(found):
            found.make_automaton()
        return found


def measure(text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, float]:
    """What the curve sees: the weight found by length, and the weight found, both on a log scale."""
    plain = folded(text)
    if not len(automaton):
        return 0.0, 0.0
    found = list(automaton.iter(plain))
    if not found:
        return 0.0, 0.0
    # Exceptions by where they start, each with the furthest end of those so far: one step along it per match.
    spared = sorted((end - n + 1, end) for end, (n, weight) in found if weight is None)
    total, at, furthest = 0.0, 0, -1
    for start, end, weight in sorted((end - n + 1, end, weight) for end, (n, weight) in found if weight is not None):
        while at < len(spared) and spared[at][0] <= start:
            furthest = max(furthest, spared[at][1])
            at += 1
        if furthest < end - 1:
            total += weight
    return math.log1p(100 * total / (10 + plain.count(" "))), math.log1p(total)


def _entries(text: str | None) -> set[str]:
    """Candidates of one text, each once."""
    out: set[str] = set()
    for word in set(folded(text).split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in BEGINNINGS if len(word) >= n)
    return out


def choose_entries(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries and weights from (candidate, toxic texts, clean texts). A longer entry is left out where a beginning of
    it is as sharp, and a beginning where a single word is all there is to it."""
    odds: dict[str, float] = {}
    support: dict[str, int] = {}
    base = n_toxic / max(1, n_toxic + n_clean)
    for entry, toxic, clean in counts:
        weight = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
        if toxic < LEAST_TEXTS or weight < LEAST_WEIGHT or not 0 < base < 1:
            continue
        both = toxic + clean
        evidence = 2 * (toxic * math.log(toxic / (both * base)) + (clean and clean * math.log(clean / (both * (1 - base)))))
        if evidence >= LEAST_EVIDENCE:
            odds[entry], support[entry] = weight, toxic
    chosen: dict[str, float] = {}
    for entry in sorted(odds, key=lambda e: (len(e.rstrip()), e)):
        word = entry.strip()
        if not entry.endswith(" ") and support.get(f"{entry} ") == support[entry]:
            continue
        covered = [chosen[f" {word[:n]}"] for n in BEGINNINGS if n < len(word) + entry.endswith(" ") and f" {word[:n]}" in chosen]
        if not covered or odds[entry] > max(covered) + 1.0:
            chosen[entry] = odds[entry]
    return {e: chosen[e] for e in sorted(chosen, key=lambda e: (-support[e] * chosen[e], e))}


def fit_curve(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression with a little shrinkage, by Newton's method."""
    x = np.column_stack([np.ones(len(features)), features])
    beta = np.zeros(x.shape[1])
    if not len(features) or toxic.min() == toxic.max():
        return np.array([-3.0, 2.0, 1.0])
    shrink = np.diag([1e-6] + [0.05] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - toxic) + shrink @ beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink + 1e-9 * np.eye(len(beta)), gradient)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass
class Model:
    lexicon: Lexicon
    beta: np.ndarray


def fold_of(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 4


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str = "toxic", sample: int = LABELLED_SAMPLE
) -> Model:
    """Lexicon and curve from labelled texts whose fold is not 2: folds 0 and 1 teach the lexicon, fold 3 the curve.

    About ``sample`` labelled rows, chosen by a hash of their id, are read; only they are broadcast, as ids and labels.
    Counts of candidates are summed in each task before they are shuffled; the driver sees the chosen candidates and
    two numbers for each text of the sample. Null ids and labels take no part. Without labels the lexicon is empty."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("toxic"), fold_of(id_col).alias("fold"))
    known = known.filter("id is not null and toxic is not null and fold != 2")
    share = min(1.0, sample / max(1, known.count()))
    known = known.filter((F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)) | F.lit(share >= 1))
    known = known.dropDuplicates(["id"])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean, texts = Counter(), Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (toxic if label else clean).update(_entries(text))
                texts[bool(label)] += 1
        toxic[""], clean[""] = texts[True], texts[False]
        keys = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())],
            names=["entry", "toxic", "clean"],
        )

    teaching = texts.filter("fold < 2").select("text", "toxic").dropDuplicates()
    counted = teaching.mapInArrow(count, "entry string, toxic long, clean long").groupBy("entry")
    counted = counted.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = counted.filter((F.col("toxic") >= LEAST_TEXTS) & (F.col("toxic") > F.col("clean")) | (F.col("entry") == ""))
    rows = [tuple(r) for r in counted.collect()]
    n_toxic, n_clean = next(((t, c) for e, t, c in rows if not e), (0, 0))
    lexicon = Lexicon(choose_entries([r for r in rows if r[0]], n_toxic, n_clean))
    seen = texts.filter("fold = 3").select("text", "toxic")
    measured = _measured(seen, "text", ["toxic"], lexicon).collect()
    features = np.array([(r["by_length"], r["weight"]) for r in measured]).reshape(-1, 2)
    return Model(lexicon, fit_curve(features, np.array([float(r["toxic"]) for r in measured])))


def _measured(docs: DataFrame, text_col: str, keep: list[str], lexicon: Lexicon) -> DataFrame:
    """``keep`` and the two numbers of each text."""
    shipped = docs.sparkSession.sparkContext.broadcast(lexicon)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shipped.value.automaton()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                pairs = [measure(text.as_py(), automaton) for text in batch.column(len(keep))]
                numbers = [pa.array([p[i] for p in pairs], pa.float64()) for i in (0, 1)]
                kept = [batch.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *numbers], names=[*keep, "by_length", "weight"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(each, f"{schema}, by_length double, weight double")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``score`` between 0 and 1, ``weight`` and ``by_length``.

    Null and empty texts have no matches and get the curve's lowest score. Whole texts are read, in one pass, without a
    shuffle. Null ids, repeated rows and other columns have no effect."""
    b0, b1, b2 = (float(b) for b in model.beta)
    z = b0 + b1 * F.col("by_length") + b2 * F.col("weight")
    rows = _measured(docs, text_col, [id_col], model.lexicon)
    return rows.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0)))))
