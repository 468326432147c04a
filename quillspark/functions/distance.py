"""Edit distance with adjacent swaps, as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def swap_distance(term: Column, value: str) -> Column:
    """Edits to turn ``term`` into ``value`` when an adjacent swap counts one (restricted form).

    Spark's ``levenshtein`` has no swaps, so this keeps the last two rows of the usual table in an
    ``aggregate``. It is meant for the few terms a cheaper bound lets through.
    """
    m = len(value)
    target = F.array(*[F.lit(c) for c in value]) if m else F.array().cast("array<string>")

    def next_row(state: Column, i: Column) -> Column:
        here, before = F.substring(term, i, F.lit(1)), F.substring(term, i - 1, F.lit(1))

        def extend(row: Column, j: Column) -> Column:
            same = F.get(target, j - 1) == here
            best = F.least(
                F.get(state["last"], j) + 1,
                F.get(row, j - 1) + 1,
                F.get(state["last"], j - 1) + F.when(same, 0).otherwise(1),
            )
            swapped = (i > 1) & (j > 1) & (F.get(target, j - 2) == here) & (F.get(target, j - 1) == before)
            return F.concat(row, F.array(F.least(best, F.when(swapped, F.get(state["older"], j - 2) + 1))))

        row = F.array(i)
        if m:
            row = F.aggregate(F.sequence(F.lit(1), F.lit(m)), F.array(i), extend)
        return F.struct(row.alias("last"), state["last"].alias("older"))

    first = F.sequence(F.lit(0), F.lit(m))
    length = F.length(term)
    rows = F.when(length > 0, F.sequence(F.lit(1), length)).otherwise(F.array().cast("array<int>"))
    start = F.struct(first.alias("last"), first.alias("older"))
    return F.aggregate(rows, start, next_row, lambda s: F.get(s["last"], F.lit(m)))


def within_distance(term: Column, value: str, distance: int, swaps: bool) -> Column:
    """Whether ``term`` is at most ``distance`` edits from ``value``, cheapest test first."""
    if distance == 0:
        return term == value
    near_length = F.length(term).between(len(value) - distance, len(value) + distance)
    if not swaps:
        return near_length & (F.levenshtein(term, F.lit(value), distance) >= 0)
    plain = F.levenshtein(term, F.lit(value), 2 * distance)
    exact = F.when(plain < 0, False).when(plain <= distance, True).otherwise(swap_distance(term, value) <= distance)
    return near_length & exact
