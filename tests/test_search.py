import pytest

from conftest import ids
from quillspark.errors import QueryError
from quillspark.mapping import Mapping
from quillspark.operators.batch import batch_search
from quillspark.operators.search import browse, count_hits, highlight_all, lookup, search, search_indexes, top_k
from quillspark.plans import query as q
from quillspark.sources.index import Index


def test_words_match_any_field(articles):
    assert set(ids(top_k(articles, "elixir"))) == {0, 3}
    assert ids(top_k(articles, "zzzznonexistent")) == []
    assert len(ids(top_k(articles, "language", limit=1))) == 1
    assert ids(top_k(articles, "tech")) == [0, 1, 3]


def test_scores_are_positive_floats(articles):
    row = top_k(articles, "rust", limit=1).first()
    assert isinstance(row["score"], float) and row["score"] > 0


def test_fields_offset_and_limit(articles):
    assert ids(top_k(articles, "elixir", fields=("title",)))
    every = ids(top_k(articles, "elixir"))
    assert ids(top_k(articles, "elixir", offset=1)) == every[1:]
    assert ids(top_k(articles, "elixir", limit=0)) == []
    with pytest.raises(QueryError, match="invalid field"):
        top_k(articles, "elixir", fields=("nope",))


@pytest.mark.parametrize(
    "asked, inside, outside",
    [
        ([("must", "elixir"), ("must", "phoenix")], {3}, {0}),
        ([("must", "language"), ("must_not", "rust")], {0}, {1}),
        ([("should", "elixir"), ("should", "pasta")], {0, 2, 3}, {1}),
        ([("must", "elixir"), ("must", q.match("phoenix"))], {3}, {0}),
        (q.none_of(q.match("elixir")), set(), {0, 1, 2, 3}),
        (q.all_of(q.All(), q.none_of(q.match("elixir"))), set(), {0, 1, 2, 3}),
        (q.boolean(("must", q.All()), ("must_not", q.match("elixir"))), {1, 2}, {0, 3}),
    ],
)
def test_boolean_clauses(articles, asked, inside, outside):
    found = set(ids(top_k(articles, asked)))
    assert inside <= found and not outside & found


def test_boost_and_all(articles):
    plain = top_k(articles, "elixir").first()["score"]
    assert top_k(articles, q.Boost(q.match("elixir"), 10.0)).first()["score"] == pytest.approx(10 * plain, abs=1e-4)
    assert len(ids(top_k(articles, q.All()))) == 4
    with pytest.raises(QueryError, match="float"):
        q.Boost(q.All(), 2)
    with pytest.raises(QueryError, match="no kind of clause"):
        q.boolean(("may", q.All()))


def test_hits_carry_stored_fields_and_snippets(articles):
    rows = search(articles, "elixir", highlight=("title", "body", "nowhere")).collect()
    assert [r["rank"] for r in rows] == [1, 2]
    assert rows[0]["doc"]["title"] == "Elixir Programming"
    assert all("<b>Elixir</b>" in r["highlights"]["body"] for r in rows)
    assert "nowhere" not in rows[0]["highlights"]
    assert search(articles, "elixir").first()["highlights"] == {}
    assert search(articles, "rust", highlight=("category",)).first()["highlights"] == {"category": ""}


def test_phrases(guides):
    assert ids(top_k(guides, q.phrase("body", "quick", "brown"))) == [0]
    assert ids(top_k(guides, q.phrase("body", "quick", "fox"))) == []
    assert ids(top_k(guides, q.phrase("body", "Quick"))) == [0]
    assert ids(top_k(guides, q.phrase_prefix("body", "quick", "bro"))) == [0]
    assert ids(top_k(guides, q.phrase_prefix("body", "quick", "bro", max_expansions=None))) == [0]
    assert ids(top_k(guides, q.phrase_prefix("body", "bro"))) == [0]
    assert ids(top_k(guides, q.QuotedPhrase("Elixir, Programming!"))) == [1]


def test_patterns(guides):
    assert ids(top_k(guides, q.Regex("slug", "elixir-.*"))) == [1, 2]
    with pytest.raises(QueryError, match="invalid regex"):
        top_k(guides, q.Regex("slug", "[invalid"))
    with pytest.raises(QueryError, match="look-around"):
        top_k(guides, q.Regex("slug", "(?=a)b"))
    assert ids(top_k(guides, q.Exists("category"))) == [0, 1, 2, 3]
    assert ids(top_k(guides, q.Fuzzy("body", "elixri"))) == [1]
    assert ids(top_k(guides, q.Fuzzy("body", "elixri", transpose_costs_one=False))) == []
    assert ids(top_k(guides, q.Prefix("title", "eli"))) == [1, 2]
    assert ids(top_k(guides, q.Range("slug", "elixir-q", "r"))) == [0]
    with pytest.raises(QueryError, match="distance"):
        q.Fuzzy("body", "x", 3)


def test_search_box(guides):
    box = q.search_box("Elixri pheonix", {"title": 2.0, "body": 1.0})
    assert ids(top_k(guides, box, limit=20))[0] == 2
    assert q.search_box("   ", {"title": 1.0}) is None


def test_patterns_beyond_the_listed_terms_give_the_same_rows(guides, monkeypatch):
    import quillspark.sources.index as module

    asked = q.boolean(("must", q.Prefix("body", "p")), ("should", q.Fuzzy("title", "elixr")), ("must_not", q.Regex("slug", "ru.*")))
    listed = top_k(guides, asked).collect()
    monkeypatch.setattr(module, "RESOLVED_TERMS", 0)
    assert top_k(guides, asked).collect() == listed


def test_typed_terms_and_ranges(spark):
    mapping = Mapping.build(
        [
            ("n", "i64"), ("u", "u64"), ("x", "f64"), ("ok", "bool"), ("day", "date"), ("raw", "bytes"),
            ("ip", "ip_addr"), ("path", "facet"), ("meta", "json"),
        ]
    )
    rows = spark.createDataFrame(
        [
            (0, "-5", "7", "1.5", "true", "2024-01-01T10:00:00Z", "ab", "10.0.0.1", "/a/b", '{"k": {"n": 1}, "t": "Big Red Dog"}'),
            (1, "8", "9", "2.5", "false", "2024-02-01T10:00:00+02:00", "cd", "10.0.1.0", "/a", '{"k": {"n": 2}, "t": "redder"}'),
            (2, None, None, None, None, None, None, None, "/ab", None),
        ],
        "doc_id bigint, n string, u string, x string, ok string, day string, raw string, ip string, path string, meta string",
    )
    index = Index.in_memory(rows, mapping)
    find = lambda asked: ids(top_k(index, asked))
    assert find(q.Term("n", -5)) == [0] and find(q.Term("u", "9")) == [1]
    assert find(q.Term("x", "2.5")) == [1] and find(q.Term("ok", True)) == [0]
    assert find(q.Term("day", "2024-02-01T08:00:00Z")) == [1] and find(q.Term("raw", "cd")) == [1]
    assert find(q.Term("ip", "10.0.1.0")) == [1] and find(q.Range("ip", "10.0.0.0", "10.0.0.255")) == [0]
    assert find(q.Range("day", "2024-01-15T00:00:00Z")) == [1] and find(q.Range("n", None, 0)) == [0]
    assert find(q.Facet("path", "/a")) == [0, 1] and find(q.Exists("n")) == [0, 1]
    assert find(q.JsonPath("meta", "k.n", 2)) == [1] and find(q.JsonPath("meta", "t", "RED dog")) == [0]
    for bad in (q.Term("n", "x"), q.Term("u", "-1"), q.Term("ok", "yes"), q.Term("day", "2024-01-01"), q.Term("ip", "1.2.3")):
        with pytest.raises(QueryError, match="cannot parse"):
            find(bad)
    for refused in (q.Term("meta", "x"), q.Term("path", "/a")):
        with pytest.raises(QueryError, match="not supported"):
            find(refused)
    with pytest.raises(QueryError, match="unknown field"):
        find(q.Term("nope", 1))


def test_english_stems(spark):
    mapping = Mapping.build([(f, "text", {"stored": True, "tokenizer": "en_stem"}) for f in ("title", "body")])
    rows = spark.createDataFrame(
        [(0, "Running Fast", "The runners are running quickly"), (1, "Swimming Pools", "Swimmers swim in the pool")],
        "doc_id bigint, title string, body string",
    )
    index = Index.in_memory(rows, mapping)
    assert ids(top_k(index, "run", fields=("body",))) == [0]
    assert ids(top_k(index, "pools", fields=("body",))) == [1]
    assert ids(top_k(index, q.phrase("body", "running"))) == []  # phrase words are not stemmed
    assert search(index, "swim", highlight=("title",)).first()["highlights"]["title"] == "<b>Swimming</b> Pools"


def test_whitespace_and_byte_length(spark):
    mapping = Mapping.build([("a", "text", {"tokenizer": "whitespace"}), ("b", "text")])
    long = "é" * 20  # 40 bytes, 20 letters
    rows = spark.createDataFrame([(0, "Foo-Bar baz", f"one {long} two {'e' * 39}")], "doc_id bigint, a string, b string")
    index = Index.in_memory(rows, mapping)
    terms = {(r["field"], r["term"], tuple(r["positions"])) for r in index.postings.collect()}
    assert terms == {("a", "Foo-Bar", (0,)), ("a", "baz", (1,)), ("b", "one", (0,)), ("b", "two", (2,)), ("b", "e" * 39, (3,))}
    assert ids(top_k(index, q.phrase("b", "one", "two"))) == []  # the dropped token leaves its place


def test_counts_lookup_browse_and_merge(articles, guides):
    assert count_hits(articles, "elixir").first()["hits"] == 2
    assert lookup(articles, "category", "tech").first()["doc_id"] == 0
    assert browse(articles).count() == 4 and browse(articles, "category", "food").count() == 1
    merged = search_indexes({"a": articles, "g": guides}, "elixir", limit=3).collect()
    assert [r["score"] for r in merged] == sorted((r["score"] for r in merged), reverse=True)
    assert {r["source_index"] for r in merged} == {"a", "g"}


def test_highlight_escapes_and_whole_fields(spark):
    mapping = Mapping.build([("t", "text", {"stored": True})])
    rows = spark.createDataFrame([(0, "a <lt> & 'LT' lt; salt")], "doc_id bigint, t string")
    index = Index.in_memory(rows, mapping)
    expected = "a &lt;<b>lt</b>&gt; &amp; &#x27;<b>LT</b>&#x27; <b>lt</b>; salt"
    assert highlight_all(index, "lt", "t").first()["highlight"] == expected
    assert search(index, "lt", highlight=("t",)).first()["highlights"]["t"] == expected.removeprefix("a &lt;").join(["a &lt;", ""])


def test_snippet_picks_the_heaviest_fragment(spark):
    mapping = Mapping.build([("t", "text", {"stored": True})])
    filler = " ".join(["word"] * 40)
    rows = spark.createDataFrame([(0, f"needle {filler} needle haystack needle {filler}")], "doc_id bigint, t string")
    index = Index.in_memory(rows, mapping)
    found = search(index, "needle haystack", highlight=("t",)).first()["highlights"]["t"]
    assert found.count("<b>needle</b>") == 2 and "<b>haystack</b>" in found
    fuzzy = search(index, q.Fuzzy("t", "needl"), highlight=("t",)).first()["highlights"]["t"]
    assert fuzzy == ""
    expanded = search(index, q.Fuzzy("t", "needl"), highlight=("t",), highlight_expanded=True).first()["highlights"]["t"]
    assert "<b>needle</b>" in expanded


def test_wide_unsigned_numbers(spark):
    mapping = Mapping.build([("u", "u64", {"wide": True, "fast": True})])
    rows = spark.createDataFrame([(0, "18446744073709551615"), (1, "7")], "doc_id bigint, u string")
    index = Index.in_memory(rows, mapping)
    assert ids(top_k(index, q.Term("u", 18446744073709551615))) == [0]
    assert ids(top_k(index, q.Range("u", 0, 10))) == [1]
    over = spark.createDataFrame([(0, "18446744073709551616")], "doc_id bigint, u string")
    with pytest.raises(Exception, match="cannot parse"):
        Index.in_memory(over, mapping).docs.collect()


def test_batch_search_is_search_in_bulk(spark):
    mapping = Mapping.build([("t", "text", {"stored": True}), ("f", "text", {"tokenizer": "fr_stem"})])
    texts = ["usb c cable", "c then usb", "usb", "a usb-c and usb c", "cable usb usb c", "", None, "don't c usb"]
    rows = [(i, t, "chevaux" if i % 2 else "cheval gris") for i, t in enumerate(texts)]
    stems = spark.createDataFrame([("chevaux", "cheval"), ("cheval", "cheval")], "term string, stem string")
    index = Index.in_memory(spark.createDataFrame(rows, "doc_id bigint, t string, f string"), mapping, {"fr_stem": stems})
    asked = ["usb-c", "usb-c cable", "Chevaux", "cable  usb\tc", "don't", "nobody-there usb", "usb-c usb-c", " ", "gris-cheval"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id bigint, text string")
    for many in (0, 10**9):
        found = batch_search(index, queries, 3, many_postings=many).orderBy("query_id", "rank").collect()
        for i, text in enumerate(asked):
            mine = [(r["doc_id"], r["score"]) for r in found if r["query_id"] == i]
            assert mine == [tuple(r) for r in top_k(index, text, limit=3).collect()], (many, text)


def test_fields_stemmed_by_a_map_are_highlighted(spark):
    mapping = Mapping.build([("t", "text", {"stored": True, "tokenizer": "fr_stem"})])
    rows = spark.createDataFrame([(0, "les chevaux"), (1, "un cheval & un chat"), (2, "chats")], "doc_id bigint, t string")
    words = [("chevaux", "cheval"), ("cheval", "cheval"), ("chats", "chat")]
    index = Index.in_memory(rows, mapping, {"fr_stem": spark.createDataFrame(words, "term string, stem string")})
    marked = {r["doc_id"]: r["highlight"] for r in highlight_all(index, "chevaux", "t").collect()}
    assert marked == {0: "les <b>chevaux</b>", 1: "un <b>cheval</b> &amp; un chat"}
    found = {r["doc_id"]: r["highlights"]["t"] for r in search(index, "chat", highlight=("t",)).collect()}
    assert found[1].endswith("un <b>chat</b>") and found[2] == "<b>chats</b>"
