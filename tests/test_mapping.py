import pytest

from quillspark.errors import MappingError
from quillspark.mapping import ANALYZERS, SPARK_TYPES, Mapping


def test_every_type_builds():
    mapping = Mapping.build([(f"f_{t}", t, {"stored": True}) for t in SPARK_TYPES])
    assert mapping.names == [f"f_{t}" for t in SPARK_TYPES]


@pytest.mark.parametrize(
    "definition, message",
    [
        (("bad", "nonexistent"), "invalid field type"),
        ("not_a_tuple", "invalid field definition"),
        (("t", "text", {"tokenizer": "nope"}), "unknown tokenizer"),
        (("s", "string", {"indexed": False}), "must be indexed or stored"),
    ],
)
def test_bad_definitions(definition, message):
    with pytest.raises(MappingError, match=message):
        Mapping.build([("ok", "text"), definition])
    assert len(Mapping.problems([("ok", "text"), definition])) == 1


def test_names_types_and_unknown_fields():
    mapping = Mapping.build([("title", "text"), ("body", "text"), ("slug", "string"), ("view_count", "u64", {"fast": True})])
    assert mapping.names == ["title", "body", "slug", "view_count"]
    assert [mapping.type_of(n) for n in ("title", "slug", "view_count")] == ["text", "string", "u64"]
    assert mapping.has("title") and not mapping.has("nope")
    with pytest.raises(MappingError, match="unknown field"):
        mapping.type_of("nope")


def test_unknown_options_are_ignored_and_duplicates_refused():
    assert Mapping.build([("t", "text", {"colour": "red"})]).names == ["t"]
    with pytest.raises(MappingError, match="duplicate"):
        Mapping.build([("t", "text"), ("t", "string")])


def test_round_trip_through_json():
    mapping = Mapping.build([("t", "text", {"tokenizer": "en_stem", "stored": True}), ("n", "i64", {"fast": True})], key="k")
    assert Mapping.from_json(mapping.to_json()) == mapping


def test_analyzers_are_the_documented_ones():
    assert len(ANALYZERS) == 21 and "en_stem" in ANALYZERS and "whitespace" in ANALYZERS
