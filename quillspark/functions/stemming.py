"""English stemming by the published Snowball "english" rules, as a small memoised helper.

Spark has no stemmer, so this is the one place where words pass through Python: whole token
arrays cross in Arrow batches and every worker stems each distinct word once.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Workers need no copy of this package: the functions below travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Word lists and suffix tables of the published English rules.
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
REGION_PREFIXES = ("gener", "commun", "arsen")
LONGER_SUFFIXES = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al",
    "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble",
    "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
MIDDLE_SUFFIXES = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "", "ative": "",
}
LAST_SUFFIXES = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize",
    "ion",
)
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
VOWELS = "aeiouy"

MEMO_WORDS = 1 << 18

_REGION = re.compile(r"[aeiouy][^aeiouy]")
_SHORT_END = re.compile(r"(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")


def _longest(word: str, suffixes) -> str | None:
    matching = [s for s in suffixes if word.endswith(s)]
    return max(matching, key=len) if matching else None


def _regions(word: str) -> tuple[int, int]:
    """Where the two regions start that suffixes must lie in to be removed."""
    first = next((len(p) for p in REGION_PREFIXES if word.startswith(p)), None)
    if first is None:
        hit = _REGION.search(word)
        first = hit.end() if hit else len(word)
    hit = _REGION.search(word, first)
    return first, hit.end() if hit else len(word)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith(("us", "ss")):
        return word
    if word.endswith("s") and any(c in VOWELS for c in word[:-2]):
        return word[:-1]
    return word


def _past_and_gerund(word: str, r1: int) -> str:
    suffix = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if suffix in ("eed", "eedly"):
        return stem + "ee" if len(stem) >= r1 else word
    if not any(c in VOWELS for c in stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if stem.endswith(DOUBLES):
        return stem[:-1]
    if len(stem) <= r1 and _SHORT_END.search(stem):
        return stem + "e"
    return stem


def _derivational(word: str, r1: int, r2: int) -> str:
    suffix = _longest(word, LONGER_SUFFIXES)
    if suffix and len(word) - len(suffix) >= r1:
        stem = word[: -len(suffix)]
        allowed = True
        if suffix == "ogi":
            allowed = stem.endswith("l")
        elif suffix == "li":
            allowed = bool(stem) and stem[-1] in "cdeghkmnrt"
        if allowed:
            word = stem + LONGER_SUFFIXES[suffix]
    suffix = _longest(word, MIDDLE_SUFFIXES)
    if suffix and len(word) - len(suffix) >= (r2 if suffix == "ative" else r1):
        word = word[: -len(suffix)] + MIDDLE_SUFFIXES[suffix]
    suffix = _longest(word, LAST_SUFFIXES)
    if suffix and len(word) - len(suffix) >= r2:
        stem = word[: -len(suffix)]
        if suffix != "ion" or stem.endswith(("s", "t")):
            word = stem
    return word


def _final_letter(word: str, r1: int, r2: int) -> str:
    at = len(word) - 1
    if word.endswith("e"):
        if at >= r2 or (at >= r1 and not _SHORT_END.search(word[:-1])):
            return word[:-1]
    elif word.endswith("ll") and at >= r2:
        return word[:-1]
    return word


def stem_english(word: str) -> str:
    """The English stem of one lowercased word."""
    if len(word) <= 2:
        return word
    if word in WHOLE_WORDS:
        return WHOLE_WORDS[word]
    # A y that acts as a consonant is held as Y until the end; the y after a Y is a vowel.
    word = re.sub(r"([aeiouy])y", r"\1Y", re.sub(r"^y", "Y", word))
    r1, r2 = _regions(word)
    word = _plural(word)
    if word in KEPT_AFTER_PLURAL:
        return word
    word = _past_and_gerund(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    word = _derivational(word, r1, r2)
    word = _final_letter(word, r1, r2)
    return word.replace("Y", "y")


def stem_words(words) -> list[str]:
    return [stem_english(w) for w in words]


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_words_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    seen: dict[str, str] = {}
    for batch in batches:
        stemmed = []
        for words in batch:
            if words is None:
                stemmed.append(None)
                continue
            if len(seen) > MEMO_WORDS:
                seen.clear()
            out = []
            for word in words:
                stem = seen.get(word)
                if stem is None:
                    stem = seen[word] = stem_english(word)
                out.append(stem)
            stemmed.append(out)
        yield pd.Series(stemmed, index=batch.index, dtype=object)
