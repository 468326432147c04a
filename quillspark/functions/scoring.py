"""BM25, as published (Robertson and Zaragoza), in the form with a non-negative idf."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two free parameters, and the digits kept so that sums do not depend on order.
K1 = 1.2
B = 0.75
SCORE_DIGITS = 6


def idf(df: int, n_docs: int) -> float:
    return math.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))


def idf_column(df: Column, n_docs: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


def tf_norm(tf: Column, dl: Column, avgdl: Column) -> Column:
    """The saturating term-frequency part; always below ``K1 + 1``."""
    length = F.lit(1.0 - B) + F.lit(B) * dl / avgdl
    return F.lit(K1 + 1.0) * tf / (tf + F.lit(K1) * length)


#: Postings of a term are in so many tiers by what they can add to a score; four tiers on, their ratio of frequency to
#: length has doubled. The lowest tier is open below, the highest above.
TIERS, _STEPS, _LOWEST = 64, 4, -4


def tier_of(tf: Column, dl: Column, length: Column) -> Column:
    """The tier of a posting, at a fixed average length."""
    ratio = tf / (F.lit(1.0 - B) + F.lit(B) * dl / length)
    step = F.floor((F.log2(ratio) - _LOWEST) * _STEPS)
    return F.least(F.greatest(step, F.lit(0)), F.lit(TIERS - 1)).cast("int")


def tier_bound(tier: int, length: float, avgdl: float, lower: bool) -> float:
    """What ``tf_norm`` is at least in this tier, or at most below it, when the average length is ``avgdl`` by now and not
    the ``length`` that tiers were made with."""
    if tier <= 0:
        return 0.0
    if tier >= TIERS:
        return K1 + 1.0
    ratio = 2.0 ** (tier / _STEPS + _LOWEST) * (min if lower else max)(1.0, avgdl / length)
    return (K1 + 1.0) * ratio / (ratio + K1)


def rounded(score: Column) -> Column:
    return F.round(score, SCORE_DIGITS)
