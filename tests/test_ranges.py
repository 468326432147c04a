"""Values kept by range against the documents."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillspark.errors import MappingError
from quillspark.mapping import Mapping
from quillspark.operators.search import top_k
from quillspark.plans import query as q
from quillspark.plans.compile import matches
from quillspark.sources import tables
from quillspark.sources.versions import IndexDirectory

FIELDS = (("n", "i64"), ("v", "f64"), ("d", "date"), ("s", "string"), ("ip", "ip_addr"), ("w", "u64"))
PLAIN = Mapping.build([(n, kind, {"fast": True, "wide": n == "w"}) for n, kind in FIELDS])
RANGED = Mapping.build([(n, kind, {"fast": True, "wide": n == "w", "ranged": kind != "string"}) for n, kind in FIELDS])


@pytest.fixture(scope="module", autouse=True)
def fewer_ranges():
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "RANGES", 20)
        yield


def rows(spark, first, n):
    i = F.col("id")
    return spark.range(first, first + n).select(
        i.alias("doc_id"), F.when(i % 11 > 0, (i * 7919) % 1000).alias("n"), F.when(i % 3 > 0, ((i * 31) % 640) / 7).alias("v"),
        F.timestamp_seconds((i * 37 % 500) * 3600).alias("d"), F.concat(F.lit("k"), i % 9).alias("s"),
        F.format_string("10.0.%d.7", i % 200).alias("ip"), F.format_string("18446744073709551%03d", i % 500).alias("w"),
    )


def filled(spark, path, mapping):
    directory = IndexDirectory(spark, path).create(mapping)
    directory.append(rows(spark, 0, 3000))
    directory.append(rows(spark, 50_000, 500))
    return directory


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("ranges")
    return filled(spark, f"{top}/plain", PLAIN), filled(spark, f"{top}/ranged", RANGED)


ASKED = [
    q.Range("n", 10, 20), q.Range("n", None, 5), q.Range("n", 990, None, include_lower=False), q.Term("n", 500), q.Term("n", -3),
    q.Range("n"), q.Range("v", 1.5, 2.25), q.Range("v", None, 0.0, include_upper=False), q.Boost(q.Range("v", 80, None), 2.0),
    q.Range("d", "1970-01-02T00:00:00Z", "1970-01-03T00:00:00Z"), q.Term("d", "1970-01-01T05:00:00Z"), q.Range("ip", "10.0.3.0", "10.0.5.255"),
    q.Term("ip", "10.0.9.7"), q.Range("w", "18446744073709551490", None), q.Term("w", "18446744073709551007"),
    q.all_of(q.Range("n", 10, 200), q.Range("v", 3, 50)), q.boolean(("must", q.Range("n", 10, 200)), ("must_not", q.Term("n", 15))),
]


@pytest.mark.parametrize("asked", ASKED, ids=str)
def test_conditions_find_the_same_documents(both, asked):
    plain, ranged = (sorted(map(tuple, matches(asked, d.open()).collect())) for d in both)
    assert plain == ranged


def files_read(frame) -> int:
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves()
    return sum(scans.apply(i).metrics().get("numFiles").get().value() for i in range(scans.size()))


def test_files_read_fall_with_selectivity(both):
    plain, ranged = (d.open() for d in both)
    key = lambda index, *ends: files_read(matches(q.Range("n", *ends), index))
    everything = key(ranged, None, None)
    assert everything >= 20 and key(plain, 10, 20) == key(plain, None, None)
    for low, high in ((0, 500), (100, 300), (400, 410)):
        share = (high - low) / 1000
        assert share * everything * 0.7 <= key(ranged, low, high) <= share * everything * 1.3 + 4
    assert files_read(top_k(ranged, q.Term("n", 500))) <= 4


def test_ranges_after_changes(spark, tmp_path):
    made = [filled(spark, f"{tmp_path}/{n}", m) for n, m in (("p", PLAIN), ("r", RANGED))]
    for step in (lambda d: d.delete("n", 500), lambda d: d.upsert(rows(spark, 100, 50).withColumn("n", F.lit(3))), lambda d: d.rewrite()):
        for d in made:
            step(d)
        for asked in (q.Range("n", 0, 30), q.Range("n", 450, 550)):
            plain, ranged = (sorted(r["doc_id"] for r in matches(asked, d.open()).collect()) for d in made)
            assert plain == ranged
    gone = made[1].expire(1)
    assert any(g.startswith("ranges/field=n/") for g in gone) and matches(q.Range("n", 0, 30), made[1].open()).count()


def test_nothing_to_range(spark, tmp_path):
    made = IndexDirectory(spark, f"{tmp_path}/ix").create(RANGED)
    assert matches(q.Range("n", 1, 2), made.open()).collect() == []
    made.append(rows(spark, 0, 5).withColumns({n: F.lit(None) for n, _ in FIELDS}))
    assert matches(q.Range("n", 1, 2), made.open()).collect() == []
    made.append(rows(spark, 10, 20))
    assert matches(q.Range("v", None, None), made.open()).count() == rows(spark, 10, 20).filter("v is not null").count()
    with pytest.raises(MappingError):
        Mapping.build([("s", "string", {"ranged": True, "stored": True})])
