import pytest
from pyspark.sql import functions as F

from conftest import ids
from quillspark.errors import CommitConflict, MappingError
from quillspark.mapping import Mapping
from quillspark.operators.search import search, top_k
from quillspark.plans import query as q
from quillspark.sources import tables, versions
from quillspark.sources.index import Index
from quillspark.sources.versions import IndexDirectory, build_index
from quillspark.streaming.changes import change_stream
from quillspark.streaming.ingest import index_stream, without_replays

NOTES = Mapping.build(
    [("title", "text", {"stored": True}), ("body", "text"), ("slug", "string", {"stored": True}), ("n", "i64", {"fast": True})]
)
SCHEMA = "doc_id bigint, title string, body string, slug string, n bigint"


def notes(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


KEEP = (0, "Keep This", "Stays in index", "keep", 1)
REMOVE = (1, "Remove This", "Gets deleted", "remove", 2)


def postings(index):
    return sorted(map(tuple, index.postings.select("field", "term", "doc_id", "tf", "dl", F.array_join("positions", ",")).collect()))


def vocabulary(index):
    return sorted(map(tuple, index.terms.select("field", "term", "df", "cf").collect()))


def test_append_twice_is_build_once(spark, tmp_path):
    whole = build_index(notes(spark, KEEP, REMOVE), NOTES, f"{tmp_path}/whole")
    parts = IndexDirectory(spark, f"{tmp_path}/parts").create(NOTES)
    assert parts.append(notes(spark, KEEP)) == 1 and parts.append(notes(spark, REMOVE)) == 2
    assert postings(whole) == postings(parts.open()) and vocabulary(whole) == vocabulary(parts.open())
    assert whole.counts == parts.open().counts
    memory = Index.in_memory(notes(spark, KEEP), NOTES).added(notes(spark, REMOVE))
    assert postings(memory) == postings(whole) and vocabulary(memory) == vocabulary(whole) and memory.counts == whole.counts


def test_delete_is_seen_after_its_commit_only(spark, tmp_path):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    directory.append(notes(spark, KEEP, REMOVE))
    before = directory.open()
    assert set(ids(top_k(before, "index deleted"))) == {0, 1}
    directory.delete("slug", "remove")
    after = directory.open()
    rows = search(after, "index deleted").collect()
    assert [r["doc"]["slug"] for r in rows] == ["keep"]
    assert set(ids(top_k(before, "index deleted"))) == {0, 1}
    assert vocabulary(after) == vocabulary(Index.in_memory(notes(spark, KEEP), NOTES))
    assert after.counts[0] == 1 and directory.open(1).counts[0] == 2
    assert vocabulary(before.without(spark.createDataFrame([(1,)], "doc_id bigint"))) == vocabulary(after)


def test_typed_and_matching_deletes(spark, tmp_path):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    directory.append(notes(spark, KEEP, REMOVE, (2, "Third", "one", "third", 3)))
    directory.delete("n", 2)
    assert ids(top_k(directory.open(), q.All())) == [0, 2]
    directory.delete("title", "third")
    assert ids(top_k(directory.open(), q.All())) == [0]
    directory.delete("slug", "nobody")
    assert ids(top_k(directory.open(), q.All())) == [0]


def test_upsert_replace_and_rewrite(spark, tmp_path):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    directory.append(notes(spark, KEEP, REMOVE))
    directory.upsert(notes(spark, (1, "Fresh", "New words", "fresh", 5), (2, "Third", "More words", "third", 6)))
    index = directory.open()
    assert ids(top_k(index, "deleted")) == [] and set(ids(top_k(index, "words"))) == {1, 2}
    directory.replace(q.Term("slug", "keep"), notes(spark, (0, "Kept again", "words", "again", 7)))
    expected = Index.in_memory(
        notes(spark, (0, "Kept again", "words", "again", 7), (1, "Fresh", "New words", "fresh", 5), (2, "Third", "More words", "third", 6)),
        NOTES,
    )
    for version in (directory.current_version(), directory.rewrite()):
        index = directory.open(version)
        assert postings(index) == postings(expected) and vocabulary(index) == vocabulary(expected)
        assert index.counts == expected.counts
        assert top_k(index, "words").collect() == top_k(expected, "words").collect()
    directory.upsert(notes(spark, (2, "Fourth", "x", "fourth", 8)))
    assert directory.open().n_docs == 3 and ids(top_k(directory.open(), "fourth")) == [2]


def test_a_bad_value_leaves_the_version_as_it_was(spark, tmp_path):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    directory.append(notes(spark, KEEP))
    bad = notes(spark, REMOVE).withColumn("n", F.lit("many"))
    with pytest.raises(Exception, match="cannot parse"):
        directory.append(bad)
    assert directory.current_version() == 1 and directory.open().n_docs == 1
    directory.append(notes(spark, REMOVE))
    assert directory.open().n_docs == 2


def test_of_two_writers_one_commits(spark, tmp_path):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    other = IndexDirectory(spark, directory.path)
    commit = directory._commit

    def late(v, since):
        other.append(notes(spark, REMOVE))
        return commit(v, since)

    directory._commit = late
    with pytest.raises(CommitConflict):
        directory.append(notes(spark, KEEP))
    directory._commit = commit
    assert ids(top_k(directory.open(), q.All())) == [1]
    assert directory.append(notes(spark, KEEP)) == 2 and directory.open().n_docs == 2
    assert [r["version"] for r in directory.versions().orderBy("version").collect()] == [0, 1, 2]


def test_keys_are_unique(spark, tmp_path):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    with pytest.raises(MappingError, match="repeats"):
        directory.append(notes(spark, KEEP, KEEP))
    with pytest.raises(MappingError, match="null key"):
        directory.append(notes(spark, (None, *KEEP[1:])))
    directory.append(notes(spark, KEEP))
    with pytest.raises(MappingError, match="already"):
        directory.append(notes(spark, REMOVE, KEEP))
    directory.delete("slug", "keep")
    directory.append(notes(spark, KEEP, REMOVE))
    assert directory.open().n_docs == 2 and ids(top_k(directory.open(), q.All())) == [0, 1]


def test_older_records_change_nothing(spark, tmp_path):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    directory.upsert(notes(spark, (0, "b", "b", "b", 5), (0, "a", "a", "a", 4), (1, "x", "x", "x", None)), order_by="n")
    directory.upsert(notes(spark, (0, "old", "old", "old", 3), (1, "y", "y", "y", 1), (2, "z", "z", "z", 1)), order_by="n")
    found = {r["key"]: r["doc"]["slug"] for r in search(directory.open(), q.All()).withColumnRenamed("doc_id", "key").collect()}
    assert found == {0: "b", 1: "y", 2: "z"}
    with pytest.raises(MappingError, match="ordered"):
        directory.upsert(notes(spark, KEEP), order_by="body")
    with pytest.raises(ValueError, match="order_by"):
        index_stream(notes(spark, KEEP), directory, f"{tmp_path}/c")


def test_a_delete_reads_the_deleted_documents_only(spark, tmp_path, monkeypatch):
    stored = Mapping.build([("t", "text", {"stored": True}), ("s", "string", {"stored": True})])
    rows = spark.range(400).selectExpr("id as doc_id", "concat('word ', id % 7, ' w', id) as t", "cast(id as string) as s")
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(stored)
    directory.append(rows)
    counted = []
    whole = tables.terms_table
    monkeypatch.setattr(tables, "terms_table", lambda p: counted.append(p.select("doc_id").distinct().count()) or whole(p))
    directory.delete("s", "3")
    assert counted == [1]
    rest = Index.in_memory(rows.filter("doc_id != 3"), stored)
    assert vocabulary(directory.open()) == vocabulary(rest) and directory.open().counts == rest.counts


def test_compaction_of_chosen_batches_and_expiry(spark, tmp_path):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    for i in range(4):
        directory.append(notes(spark, *[(10 * i + j, f"word t{j}", f"body {i}", f"s{j}", j) for j in range(4 - i)]))
    directory.delete("slug", "s1")
    directory.upsert(notes(spark, (0, "word new", "b", "s9", 9)))
    before = directory.open()
    small = directory.small_batches(2)
    old = directory._require()
    assert len(small) == 3 and set(small) < set(old.batches)
    version = directory.compact(small)
    new, after = directory._require(), directory.open()
    assert [b for b in new.batches if b in old.batches] == [b for b in old.batches if b not in small]
    assert postings(after) == postings(before) and vocabulary(after) == vocabulary(before) and after.counts == before.counts
    assert top_k(after, "word").collect() == top_k(before, "word").collect()
    directory.compact(new.batches)
    assert directory._require().deletes == [] and postings(directory.open()) == postings(before)
    gone = directory.expire(1)
    assert {f"docs/batch={b}" for b in old.batches} <= set(gone)
    assert postings(directory.open()) and directory.open().counts[0] == 7
    with pytest.raises(FileNotFoundError):
        directory.open(version)
    directory.append(notes(spark, (99, "word", "b", "s", 1)))
    assert directory.open().n_docs == 8


def test_the_log_is_read_from_the_last_whole_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "SNAPSHOT_EVERY", 3)
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    for i in range(5):
        directory.append(notes(spark, (i, f"t{i}", "b", "s", i)))
    log = directory.versions().orderBy("version").collect()
    assert [len(r["batches"]) for r in log] == [0, 1, 1, 3, 1, 1]
    assert [directory.open(v).docs.count() for v in range(6)] == [0, 1, 2, 3, 4, 5]


def test_reopening_restores_mapping_and_missing_paths_fail(spark, tmp_path):
    build_index(notes(spark, KEEP), NOTES, f"{tmp_path}/ix")
    again = IndexDirectory(spark, f"{tmp_path}/ix")
    assert again.open().mapping == NOTES
    again.create(Mapping.build([("other", "text")]))
    assert again.open().mapping == NOTES
    again.append(notes(spark, REMOVE))
    assert again.open().n_docs == 2
    with pytest.raises(FileNotFoundError):
        IndexDirectory(spark, f"{tmp_path}/nowhere").open()


def test_an_empty_index_answers(spark, tmp_path):
    index = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES).open()
    assert ids(top_k(index, "anything")) == [] and index.n_docs == 0


def test_stem_map_is_kept_with_the_index(spark, tmp_path):
    mapping = Mapping.build([("t", "text", {"tokenizer": "fr_stem", "stored": True})])
    words = spark.createDataFrame([("chevaux", "cheval"), ("cheval", "cheval")], "term string, stem string")
    rows = spark.createDataFrame([(0, "les chevaux et le cheval"), (1, "un chat")], "doc_id bigint, t string")
    index = build_index(rows, mapping, f"{tmp_path}/ix", stem_maps={"fr_stem": words})
    row = index.postings.filter("term = 'cheval'").first()
    assert (row["tf"], row["positions"]) == (2, [1, 4])
    assert ids(top_k(IndexDirectory(spark, f"{tmp_path}/ix").open(), "Chevaux")) == [0]
    with pytest.raises(ValueError, match="stem map"):
        Index.in_memory(rows, mapping)


def test_streamed_batches_and_their_replay(spark, tmp_path):
    source = f"{tmp_path}/in"
    notes(spark, KEEP, REMOVE).write.parquet(f"{source}/a")
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)

    def run(checkpoint):
        files = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(source)
        writer = index_stream(files, directory, f"{tmp_path}/{checkpoint}", order_by="n")
        writer.trigger(availableNow=True).start().awaitTermination()

    run("c1")
    assert directory.open().n_docs == 2 and directory.current_version() == 1
    run("c2")  # a lost checkpoint replays batch 0, which the commit log knows
    assert directory.current_version() == 1
    notes(spark, (1, "Newer", "words", "newer", 8), (1, "Newest", "words", "newest", 9)).write.parquet(f"{source}/b")
    run("c1")
    assert directory.open().n_docs == 2
    assert [r["doc"]["slug"] for r in search(directory.open(), "words").collect()] == ["newest"]


def test_an_index_without_words(spark, tmp_path):
    mapping = Mapping.build([("n", "i64", {"fast": True})])
    index = build_index(spark.createDataFrame([(0, 5), (1, 6)], "doc_id bigint, n bigint"), mapping, f"{tmp_path}/ix")
    assert index.n_docs == 2 and ids(top_k(index, q.Range("n", 6))) == [1] and ids(top_k(index, "word")) == []


def test_replayed_records_are_dropped_within_the_delay(spark, tmp_path):
    source = f"{tmp_path}/in"
    at = F.timestamp_seconds(F.lit(1_700_000_000))
    notes(spark, KEEP, KEEP, REMOVE).withColumn("at", at).write.parquet(source)
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    files = spark.readStream.schema(SCHEMA + ", at timestamp").parquet(source)
    writer = index_stream(without_replays(files, "doc_id", "at", "1 hour"), directory, f"{tmp_path}/c", upsert=False)
    writer.trigger(availableNow=True).start().awaitTermination()
    assert directory.open().n_docs == 2 and sorted(ids(top_k(directory.open(), q.All()))) == [0, 1]


def test_one_word_has_no_shuffle_after_deletes(spark, tmp_path, monkeypatch):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    directory.append(notes(spark, KEEP, REMOVE, (2, "Index this", "index index", "more", 3)))
    directory.delete("slug", "remove")
    directory.upsert(notes(spark, (2, "Index", "again", "more", 4)))

    def shuffles():
        frame = top_k(directory.open(), "index")
        return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"), sorted(ids(frame))

    assert directory._require().deleted == 2
    one_word = top_k(directory.open(), "index", fields=("title",))
    assert "Exchange hashpartitioning" not in one_word._jdf.queryExecution().executedPlan().toString() and ids(one_word) == [2]
    few = shuffles()
    monkeypatch.setattr(versions, "BROADCAST_KEYS", 1)
    many = shuffles()
    assert few[1] == many[1] == [0, 2] and few[0] < many[0]
    directory.rewrite()
    assert directory._require().deleted == 0 and sorted(ids(top_k(directory.open(), "index"))) == [0, 2]


def changed(directory, since, until=None):
    return sorted((r["change"], r["doc_id"], r["title"]) for r in directory.changes(since, until).collect())


def test_changes_between_versions(spark, tmp_path):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    directory.append(notes(spark, KEEP, REMOVE))
    directory.delete("slug", "remove")
    directory.upsert(notes(spark, (0, "Kept", "b", "keep", 1), (5, "New", "b", "new", 1)))
    directory.delete("slug", "new")
    assert changed(directory, 0, 1) == [("added", 0, "Keep This"), ("added", 1, "Remove This")]
    assert changed(directory, 1, 2) == [("removed", 1, "Remove This")]
    assert changed(directory, 2, 3) == [("added", 0, "Kept"), ("added", 5, "New"), ("removed", 0, "Keep This")]
    assert changed(directory, 1) == [("added", 0, "Kept"), ("removed", 0, "Keep This"), ("removed", 1, "Remove This")]
    assert changed(directory, 4, 4) == []
    directory.rewrite()
    for since, until in ((4, 5), (3, 2)):
        with pytest.raises(ValueError):
            directory.changes(since, until)


def test_a_stream_of_changes_keeps_a_copy(spark, tmp_path):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(NOTES)
    copy, seen = {}, []

    def apply(changes, version):
        rows = sorted(changes.collect(), key=lambda r: r["change"], reverse=True)  # removed before added
        for r in rows:
            copy.pop(r["doc_id"], None) if r["change"] == "removed" else copy.update({r["doc_id"]: r["title"]})
        seen.append(version)

    def run():
        change_stream(directory, apply, f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()

    run()
    directory.append(notes(spark, KEEP, REMOVE))
    run()
    assert copy == {0: "Keep This", 1: "Remove This"}
    directory.upsert(notes(spark, (0, "Kept", "b", "keep", 1)))
    directory.delete("slug", "remove")
    run()
    run()
    assert copy == {0: "Kept"} and seen == [1, 3]
    assert copy == {r["doc_id"]: r["title"] for r in directory.open().docs.collect()}
