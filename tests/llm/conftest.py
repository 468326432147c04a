from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, spans string, length bigint, "
    "key string, size bigint, id bigint, score double, piece int, hub bigint, stratum string, rank int, kept boolean"
)
EXTRA = (7, "x", 3, "k", 5, -1, 0.5, 9, 4, "s", 2, False)


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Ordinary texts, copies, near copies, nulls, blanks, a very long text and repeated rows."""
    rng = random.Random(3)
    texts = [sentence(rng, rng.randrange(3, 160)) for _ in range(40)]
    base = sentence(rng, 120)
    near = base.split()
    near[60] = "changed"
    shared = sentence(rng, 60)
    texts += [base, base, " ".join(near), base.upper(), base.replace(" ", "\n\t")]
    texts += [f"{sentence(rng, 30)} {shared} {sentence(rng, 30)}" for _ in range(3)]
    texts += [None, None, "", "", " \n\t ", "one", "one two", "ab " * 200, sentence(rng, 9000), "é ü 漢字   x y  z\r\n\x0b\x0c\x1c end"]
    rows = [(i, t, ("en", "de", None)[i % 3], ("a", "b", None, "c")[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[1], None, None, 1), (None, None, None, None, None)]
    return [(*r, *EXTRA) for r in rows]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
