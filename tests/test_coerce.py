import pytest
from pyspark.sql import Row

from quillspark.functions.coerce import coerce, coerce_permissive, conform_report, project
from quillspark.mapping import Mapping

POSTS = Mapping.build([("title", "text"), ("body", "text"), ("slug", "string")])


def test_projection_keeps_mapped_fields_only(spark):
    rows = spark.createDataFrame([(1, "Hello", "hello", "2024")], "doc_id int, title string, slug string, inserted_at string")
    assert project(rows, POSTS).collect() == [Row(doc_id=1, title="Hello", body=None, slug="hello")]
    with pytest.raises(ValueError, match="key column"):
        project(rows.drop("doc_id"), POSTS)


@pytest.mark.parametrize(
    "kind, good, bad",
    [
        ("u64", ["0", "+5", "9223372036854775807"], ["-1", " 1", "1.0", "x", "9223372036854775808"]),
        ("i64", ["-5", "+5"], ["5.0", "1e3", " 5", "t"]),
        ("f64", ["1", "-1.5", "1e3", ".5", "inf", "NaN"], ["1.0d", "x", " 1", "0x1"]),
        ("bool", ["true", "false"], ["t", "1", "yes", "TRUE"]),
        ("date", ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00.5+02:00"], ["2024-01-01", "2024-01-01T00:00:00", "2024-13-01T00:00:00Z"]),
        ("ip_addr", ["10.0.0.1", "255.255.255.255"], ["256.0.0.1", "1.2.3", "01.2.3.4"]),
        ("facet", ["/a/b"], ["a/b"]),
        ("json", ['{"a": [1, null]}', "3"], ["{a", "{"]),
    ],
)
def test_parsing_rules(spark, kind, good, bad):
    mapping = Mapping.build([("v", kind)])
    values = [(i, v) for i, v in enumerate(good + bad + [None])]
    rows = spark.createDataFrame(values, "doc_id int, v string")
    typed, rejects = coerce_permissive(rows, mapping)
    assert {r["doc_id"] for r in rejects.collect()} == set(range(len(good), len(good) + len(bad)))
    assert typed.count() == len(good) + 1
    report = conform_report(rows, mapping).first()
    assert (report["present"], report["missing"], report["unparsable"]) == (len(good) + len(bad), 1, len(bad))
    with pytest.raises(Exception, match="cannot parse"):
        coerce(rows, mapping).collect()
    assert coerce(rows.filter(rows.doc_id < len(good)), mapping).count() == len(good)


def test_dates_lose_fractions_and_bytes_are_utf8(spark):
    mapping = Mapping.build([("d", "date"), ("b", "bytes")])
    rows = spark.createDataFrame([(0, "2024-03-05T10:20:30.75+02:00", "é")], "doc_id int, d string, b string")
    row = coerce(rows, mapping).selectExpr("unix_millis(d) AS d", "b").first()
    assert row["d"] == 1709626830000 and bytes(row["b"]) == "é".encode()
