"""Token ids of texts by a byte-level tokenizer file, remembered by word.

A text may be cut before a space that does not stand between two other white space characters: byte-level splitting
never joins across such a place, so ids of the parts, in a row, are the ids of the whole. Parts recur; their ids are
remembered in a bounded table, and only new ones reach the tokenizer. A part of plain letters, digits and signs is split
as any byte-level splitting does, and only the merges of each piece are asked for."""

from __future__ import annotations

import os
import re
import struct

from tokenizers import Tokenizer

from quillspark.llm.wordpiece import byte_alphabet

#: Parts a worker remembers: at most two generations of so many.
REMEMBERED_PARTS = 450_000

#: White space after a space: such texts are not cut. More are kept whole than must be.
_TWO_SPACES = [" " + chr(c) for c in range(0x3001) if chr(c).isspace()]
#: Pieces that any byte-level splitting makes: letters, digits, signs but the apostrophe, a lone new line.
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ſ]+| ?[0-9]+| ?[!-&(-/:-@\[-`{-~]+|\n(?=\S)")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Parts(dict):
    """Ids by part; what is not there is looked up among older parts or made."""

    def __init__(self, owner: Ids):
        super().__init__()
        self.owner = owner

    def __missing__(self, part: str) -> bytes:
        ids = self.owner.old.get(part)
        if ids is None:
            ids = self.owner.made(part)
        self[part] = ids
        return ids


class Ids:
    """``of(text)`` gives a text's ids as little-endian unsigned 32-bit numbers in bytes."""

    def __init__(self, tokenizer_json: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer_json.decode())
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.letters = {b: c for c, b in byte_alphabet().items()}
        self.young, self.old = _Parts(self), {}

    def made(self, part: str) -> bytes:
        pieces = _PLAIN.findall(part) if "<|" not in part else []
        if sum(map(len, pieces)) != len(part):
            return self.whole(part)
        if len(pieces) != 1:
            return b"".join([self.young[p] for p in pieces])
        spelled = part.encode().decode("latin-1").translate(self.letters)
        return _packed([t.id for t in self.model.tokenize(spelled)])

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def of(self, text: str) -> bytes:
        if len(self.young) > REMEMBERED_PARTS:
            self.old, self.young = self.young, _Parts(self)
        if "\0" in text or any(two in text for two in _TWO_SPACES):
            return self.whole(text)
        return b"".join(map(self.young.__getitem__, text.replace(" ", "\0 ").split("\0")))


_built: dict[int, Ids] = {}


def ids_of(shipped) -> Ids:
    """The worker's own table for a broadcast tokenizer file."""
    key = shipped.id if hasattr(shipped, "id") else hash(shipped.value)
    if key not in _built:
        _built.clear()
        _built[key] = Ids(shipped.value)
    return _built[key]
