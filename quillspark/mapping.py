"""Field mappings: the declared, never inferred, shape of an index."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import types as T

from quillspark.errors import MappingError

# The closed list of field types, and the analyzer names.
SPARK_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "string": T.StringType(),
    "u64": T.LongType(),
    "i64": T.LongType(),
    "f64": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.TimestampType(),
    "bytes": T.BinaryType(),
    "json": T.VariantType(),
    "ip_addr": T.LongType(),
    "facet": T.StringType(),
}
#: The name of a field with this ending stands for its pairs of words.
PAIRED = "+pairs"
ANALYZERS = (
    "default", "raw", "whitespace", "en_stem", "fr_stem", "de_stem", "es_stem", "pt_stem", "it_stem", "nl_stem", "sv_stem",
    "no_stem", "da_stem", "fi_stem", "hu_stem", "ro_stem", "ru_stem", "tr_stem", "ar_stem", "ta_stem", "el_stem",
)


@dataclass(frozen=True)
class Field:
    """One mapped field; the options mean what they mean in a search schema."""

    name: str
    type: str
    stored: bool = False
    indexed: bool = True
    fast: bool = False
    tokenizer: str = "default"
    # A u64 field whose values may exceed a bigint.
    wide: bool = False
    # Whether an index in a directory keeps postings of adjacent frequent words, and a table of letters to terms.
    pairs: bool = False
    grams: bool = False
    # Whether postings are laid out by how much they can add to a score, so that the best hits are read first.
    tiers: bool = False
    # Whether a batch keeps a summary of the field: count, extremes, quantiles and distinct values.
    summary: bool = False
    # Whether values and keys are kept a second time, in folders by ranges of the value.
    ranged: bool = False

    @property
    def spark_type(self) -> T.DataType:
        return T.DecimalType(20, 0) if self.type == "u64" and self.wide else SPARK_TYPES[self.type]

    @property
    def analyzer(self) -> str:
        """The analyzer that turns this field's values into terms."""
        return self.tokenizer if self.type == "text" else "raw"

    @property
    def numeric(self) -> bool:
        return self.type in ("u64", "i64", "f64", "bool", "date")

    @property
    def in_postings(self) -> bool:
        return self.type == "text" or (self.type == "string" and self.indexed)

    @property
    def in_docs(self) -> bool:
        """Text is kept to be returned or aggregated on; every other type is also filtered on."""
        if self.type == "text":
            return self.stored or self.fast
        return self.stored or self.fast or (self.indexed and self.type != "string")


def _as_field(definition) -> Field:
    if isinstance(definition, Field):
        found = definition
    elif isinstance(definition, (tuple, list)) and len(definition) in (2, 3):
        options = dict(definition[2]) if len(definition) == 3 else {}
        # Unknown option names are accepted and ignored.
        known = {k: v for k, v in options.items() if k in Field.__dataclass_fields__}
        found = Field(str(definition[0]), str(definition[1]), **known)
    else:
        raise MappingError(f"invalid field definition: {definition!r}")
    if found.type not in SPARK_TYPES:
        raise MappingError(f"invalid field type: {found.type}")
    if found.tokenizer not in ANALYZERS:
        raise MappingError(f"unknown tokenizer: {found.tokenizer}. Expected one of {', '.join(ANALYZERS)}")
    if found.pairs and (found.type != "text" or found.tokenizer not in ("default", "whitespace")):
        raise MappingError(f"pairs of words are kept for text that is not stemmed: {found.name}")
    if found.summary and not (found.numeric or found.type == "string"):
        raise MappingError(f"no summary is kept of a field of type {found.type}: {found.name}")
    if found.summary and not found.in_docs:
        raise MappingError(f"a summary needs a field that is kept with the documents: {found.name}")
    if found.ranged and not (found.in_docs and found.type in ("u64", "i64", "f64", "date", "ip_addr")):
        raise MappingError(f"values of a field of type {found.type} are not kept by range: {found.name}")
    if found.name.endswith(PAIRED):
        raise MappingError(f"no field name may end in {PAIRED}: {found.name}")
    if found.type == "string" and not (found.indexed or found.stored):
        raise MappingError(f"string field {found.name!r} must be indexed or stored")
    return found


@dataclass(frozen=True)
class Mapping:
    """An ordered, immutable list of fields plus the name of the key column."""

    fields: tuple[Field, ...]
    key: str = "doc_id"

    @classmethod
    def build(cls, definitions: Iterable, key: str = "doc_id") -> Mapping:
        """Check the definitions and build a mapping; raises ``MappingError``."""
        fields = tuple(_as_field(d) for d in definitions)
        names = [f.name for f in fields]
        clash = {n for n in names if names.count(n) > 1} | ({key} & set(names))
        if clash:
            raise MappingError(f"duplicate field: {sorted(clash)[0]}")
        return cls(fields, key)

    @classmethod
    def problems(cls, definitions: Iterable) -> list[str]:
        """The messages ``build`` would raise, one per bad definition; empty when all are good."""
        found = []
        for definition in definitions:
            try:
                _as_field(definition)
            except MappingError as error:
                found.append(str(error))
        return found

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def has(self, name: str) -> bool:
        return name in self.names

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise MappingError(f"unknown field: {name}")

    def type_of(self, name: str) -> str:
        return self.field(name).type

    @property
    def default_fields(self) -> list[str]:
        """Fields searched when a query names none: every text and string field."""
        return [f.name for f in self.fields if f.in_postings]

    @property
    def paired(self) -> list[str]:
        return [f.name for f in self.fields if f.pairs]

    @property
    def summarized(self) -> list[str]:
        return [f.name for f in self.fields if f.summary]

    @property
    def ranged(self) -> list[str]:
        return [f.name for f in self.fields if f.ranged]

    @property
    def tiered(self) -> list[str]:
        return [f.name for f in self.fields if f.tiers and f.in_postings]

    @property
    def grammed(self) -> list[str]:
        return [f.name for f in self.fields if f.grams and f.in_postings]

    @property
    def stored(self) -> list[str]:
        return [f.name for f in self.fields if f.stored]

    @property
    def doc_fields(self) -> list[Field]:
        return [f for f in self.fields if f.in_docs]

    def to_json(self) -> str:
        return json.dumps({"key": self.key, "fields": [asdict(f) for f in self.fields]})

    @classmethod
    def from_json(cls, text: str) -> Mapping:
        raw = json.loads(text)
        return cls(tuple(Field(**f) for f in raw["fields"]), raw["key"])
