"""Postings of many documents at once: words of texts in, sorted groups out.

A step between two Spark steps: words are told apart by column expressions, and Spark sorts and writes what leaves.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from quillspark.functions.analysis import TOO_LONG_BYTES
from quillspark.functions.scoring import _LOWEST, _STEPS, TIERS, B
from quillspark.functions.stemming import stem_words
from quillspark.mapping import PAIRED

# Executors need not have this package: what runs there travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: About so many bytes of texts are grouped together, and about so many postings leave at a time; no document is cut.
TEXT_BYTES, POSTINGS = 12 << 20, 1 << 18


@dataclass(frozen=True)
class Words:
    """A field: its analyzer, the words whose pairs are kept, and the length that tiers of its postings are made with."""

    name: str
    analyzer: str
    paired: tuple[str, ...] = ()
    length: float | None = None


def grouped(fields: list[Words], key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``, from rows in order of ``key`` with, for the i-th field, ``words_i`` (its words, a blank between
    two of them, or the whole value if it is ``raw``) and ``as_is_i`` (the same before lowercasing, null where that
    changes no length). A row per field, term and tier, with the postings of some documents in order of their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, len(fields)):
                for i, f in enumerate(fields):
                    yield from _field(f, part.column(f"words_{i}"), part.column(f"as_is_{i}"), part.column(key), key)

    return run


def _parts(batch: pa.RecordBatch, n: int) -> Iterator[pa.RecordBatch]:
    sizes = sum(_numbers(pc.fill_null(pc.binary_length(batch.column(f"words_{i}")), 0)).astype(np.int64) for i in range(n))
    number = (np.cumsum(sizes) - sizes) // TEXT_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _field(f: Words, texts: pa.Array, as_is: pa.Array, keys: pa.Array, key: str) -> Iterator[pa.RecordBatch]:
    if f.analyzer == "raw":
        words, row = texts.drop_null(), np.flatnonzero(_numbers(texts.is_valid()))
        at = np.zeros(len(row), np.int64)
    else:
        words, row, at = _split(f, texts, as_is)
    if not len(words):
        return
    coded = words.dictionary_encode()
    code, terms = _numbers(coded.indices), coded.dictionary
    if f.analyzer.endswith("_stem"):
        coded = pa.array(stem_words(terms.to_pylist()), pa.string()).dictionary_encode()
        code, terms = _numbers(coded.indices)[code], coded.dictionary
    lengths = np.bincount(row, minlength=len(texts))
    yield from _groups(f.name, f.length, terms, code, row, at, lengths, keys, key)
    if f.paired:
        found = _pairs(f.paired, terms, code, row, at)
        if found is not None:
            yield from _groups(f.name + PAIRED, f.length, *found, lengths, keys, key)


def _split(f: Words, texts: pa.Array, as_is: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, the row each is in, and its place there; words that are too long are left out but have a place."""
    lists = pc.split_pattern(texts, " ")
    words, row = lists.flatten(), _numbers(pc.list_parent_indices(lists)).astype(np.int64)
    some = pc.greater(pc.binary_length(words), 0)
    words, row = words.filter(some), row[_numbers(some)]
    at = np.arange(len(row)) - np.searchsorted(row, row)
    if f.analyzer != "whitespace":
        sizes = pc.binary_length(words)
        if as_is.null_count < len(as_is):
            original = pc.split_pattern(pc.coalesce(as_is, texts), " ").flatten()
            sizes = pc.binary_length(original)
            sizes = sizes.filter(pc.greater(sizes, 0))
        kept = pc.less(sizes, TOO_LONG_BYTES)
        if not pc.all(kept).as_py():
            words, row, at = words.filter(kept), row[_numbers(kept)], at[_numbers(kept)]
    return words, row, at


def _pairs(paired: tuple[str, ...], terms: pa.Array, code: np.ndarray, row: np.ndarray, at: np.ndarray):
    """The same of adjacent words that are both among some."""
    chosen = _numbers(pc.is_in(terms, value_set=pa.array(paired, pa.string())))[code]
    near = chosen[:-1] & chosen[1:] & (row[1:] == row[:-1]) & (at[1:] == at[:-1] + 1)
    first = np.flatnonzero(near)
    if not len(first):
        return None
    pair, number = np.unique(code[first].astype(np.int64) * len(terms) + code[first + 1], return_inverse=True)
    left, right = (terms.take(pa.array(side)) for side in np.divmod(pair, len(terms)))
    return pc.binary_join_element_wise(left, right, " "), number, row[first], at[first]


def _groups(
    label: str, length: float | None, terms: pa.Array, code: np.ndarray, row: np.ndarray, at: np.ndarray,
    lengths: np.ndarray, keys: pa.Array, key: str,
) -> Iterator[pa.RecordBatch]:
    by_term = _numbers(pc.sort_indices(terms))
    rank = np.empty(len(terms), np.int64)
    rank[by_term] = np.arange(len(terms))
    group, at = _in_order(rank[code] * len(keys) + row, at, len(terms) * len(keys))
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[first, len(group)]
    term, row = np.divmod(group[first], len(keys))
    tf, dl, tier = np.diff(ends), lengths[row], np.zeros(len(first), np.int64)
    positions = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(at.astype(np.int32)))
    if length is not None:
        tier = _tiers(tf, dl, length)
        order = np.lexsort((row, -tier, term))
        term, row, tf, dl, tier, positions = term[order], row[order], tf[order], dl[order], tier[order], positions.take(pa.array(order))
    block = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tier[1:] != tier[:-1])])
    of = keys.take(pa.array(row))
    columns = [of, pa.array(tf.astype(np.int32)), pa.array(dl.astype(np.int32)), positions]
    rows = pa.StructArray.from_arrays(columns, [key, "tf", "dl", "positions"])
    found = pa.RecordBatch.from_pydict(
        {
            "field": pa.repeat(pa.scalar(label, pa.string()), len(block)),
            "term": terms.take(pa.array(by_term[term[block]])),
            "run": pa.array(-tier[block].astype(np.int32)),
            "first": of.take(pa.array(block)),
            "rows": pa.ListArray.from_arrays(pa.array(np.r_[block, len(term)].astype(np.int32)), rows),
        }
    )
    cuts = [0, *(np.flatnonzero(np.diff(block // POSTINGS)) + 1).tolist(), len(block)]
    for a, b in zip(cuts, cuts[1:]):
        yield found.slice(a, b - a)


def _tiers(tf: np.ndarray, dl: np.ndarray, length: float) -> np.ndarray:
    """``scoring.tier_of`` but for rounding: it only brings postings near the order that Spark's own tiers give them."""
    step = np.floor((np.log2(tf / (1.0 - B + B * dl / length)) - _LOWEST) * _STEPS)
    return np.clip(step, 0, TIERS - 1).astype(np.int64)


def _in_order(group: np.ndarray, at: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Both sorted by group and position, as one number where they fit into it."""
    bits = int(at.max()).bit_length()
    if groups.bit_length() + bits < 64:
        both = np.sort(group << bits | at)
        return both >> bits, both & ((1 << bits) - 1)
    order = np.lexsort((at, group))
    return group[order], at[order]
