"""Token counts by a linear longest-match automaton over a word-piece vocabulary.

The vocabulary is two tries, one for pieces that begin a word and one for pieces that continue it. Every node has
a failure link: where the longest match so far has been cut into pieces, the node of what is left over; and the
number of pieces that this cutting pops. Both are computed once. Counting then walks each byte of a word once and
adds up numbers; no piece is ever built. Counts of recent words are remembered in a bounded table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import shipped_file

#: Words whose counts a worker remembers before it starts anew.
REMEMBERED_WORDS = 400_000
#: Rows in one batch: bounds the memory of a worker.
BATCH_ROWS = 1_000

BEGINS, CONTINUES = 0, 1


class LongestMatch:
    """Greedy longest-match piece counts of words, in time linear in their bytes."""

    def __init__(self, begins: Iterable[bytes], continues: Iterable[bytes]):
        step: dict[int, int] = {}
        parent, last, ends = [-1, -1], [0, 0], [False, False]
        depth = [0, 0]
        for root, pieces in ((BEGINS, begins), (CONTINUES, continues)):
            for piece in pieces:
                node = root
                for c in piece:
                    to = step.get(node << 8 | c)
                    if to is None:
                        to = step[node << 8 | c] = len(parent)
                        parent.append(node)
                        last.append(c)
                        ends.append(False)
                        depth.append(depth[node] + 1)
                    node = to
                if node != root:
                    ends[node] = True
        link, pops = [-1] * len(parent), [0] * len(parent)
        for node in sorted(range(2, len(parent)), key=depth.__getitem__):
            if ends[node]:
                link[node], pops[node] = CONTINUES, 1
                continue
            back, popped = link[parent[node]], pops[parent[node]]
            while back >= 0 and (back << 8 | last[node]) not in step:
                popped += pops[back]
                back = link[back]
            if back >= 0:
                link[node], pops[node] = step[back << 8 | last[node]], popped
        self.step, self.link, self.pops = step, link, pops

    def count(self, word: bytes) -> int:
        """The number of pieces; -1 where the vocabulary cannot spell the word."""
        step, link, pops = self.step.get, self.link, self.pops
        node, total = BEGINS, 0
        for c in word:
            to = step(node << 8 | c)
            while to is None:
                total += pops[node]
                node = link[node]
                if node < 0:
                    return -1
                to = step(node << 8 | c)
            node = to
        while node > CONTINUES:
            total += pops[node]
            node = link[node]
            if node < 0:
                return -1
        return total


class Remembered(dict):
    """Counts by word, at most ``REMEMBERED_WORDS`` of them."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        n = self[word] = self.automaton.count(word)
        return n


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabulary files write bytes: printable ones as they are, the rest in order
    from code point 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def pieces_of(tokenizer_json: bytes) -> tuple[list[bytes], list[bytes]]:
    """Word pieces from a byte-level vocabulary file: entries that start with a space begin words, entries without
    one continue them. Every byte can do both, so every word can be spelled."""
    alphabet = byte_alphabet()
    entries = []
    for token in json.loads(tokenizer_json)["model"]["vocab"]:
        if all(c in alphabet for c in token):
            entries.append(bytes(alphabet[c] for c in token))
    singles = [bytes([b]) for b in range(256)]
    begins = [e[1:] for e in entries if e.startswith(b" ") and len(e) > 1] + singles
    return begins, [e for e in entries if b" " not in e] + singles


_built: dict[bytes, Remembered] = {}


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_tokens`` (an unspellable word is one token) and
    ``n_unknown`` (such words).

    Words are split at ASCII white space. A null or empty text has no words and no tokens. Null ids, repeated rows and
    other columns pass without effect; an empty table gives an empty table. No shuffle; a worker holds one batch of
    texts, one automaton and a bounded table of words."""
    shipped = shipped_file(docs.sparkSession, vocabulary_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = hashlib.sha256(shipped.value).digest()
        known = _built.get(digest)
        if known is None:
            _built.clear()
            known = _built[digest] = Remembered(LongestMatch(*pieces_of(shipped.value)))
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                words, tokens, unknown = [], [], []
                for text in batch.column(1):
                    counts = list(map(known.__getitem__, (text.as_py() or b"").split()))
                    missing = counts.count(-1)
                    words.append(len(counts))
                    tokens.append(sum(counts) + 2 * missing)
                    unknown.append(missing)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                    names=[id_col, "n_words", "n_tokens", "n_unknown"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(
        count, f"`{id_col}` {kind}, n_words long, n_tokens long, n_unknown long"
    )
