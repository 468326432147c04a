"""Pairs of frequent words, pieces of terms, and commits: other layouts, the same rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.errors import MappingError
from quillspark.functions import analysis, grouping, scoring
from quillspark.mapping import PAIRED, Mapping
from quillspark.operators.search import top_k
from quillspark.plans import compile, grams
from quillspark.plans import query as q
from quillspark.plans.compile import matches
from quillspark.sources import tables
from quillspark.sources.versions import IndexDirectory, build_index

TEXT, EXTRA = {"stored": True}, {"stored": True, "pairs": True, "grams": True, "tiers": True}
PLAIN = Mapping.build([("body", "text", TEXT), ("kind", "string", TEXT)])
WIDE = Mapping.build([("body", "text", EXTRA), ("kind", "string", {**TEXT, "grams": True})])
WORDS = ["the", "of", "in", "a", "engine", "engines", "ngine", "gear", "geer", "grae", "x", "überlang", "z9"]


def rows(spark, seed: int, first: int, n: int):
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        words = [rng.choice(WORDS[:4]) if rng.random() < 0.75 else rng.choice(WORDS) for _ in range(rng.randrange(0, 25))]
        if i % 5 == 0:
            words.insert(len(words) // 2, "l" * 45)
        texts.append((first + i, rng.choice([" ", "-", ", "]).join(words) or None, f"k{rng.randrange(4)}"))
    return spark.createDataFrame(texts, "doc_id bigint, body string, kind string")


def filled(spark, path, mapping):
    """Two batches, a delete, an upsert."""
    directory = IndexDirectory(spark, path).create(mapping)
    directory.append(rows(spark, 1, 0, 60))
    directory.append(rows(spark, 2, 100, 40))
    directory.delete("kind", "k3")
    directory.upsert(rows(spark, 3, 90, 20))
    return directory


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("layouts")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "PAIRED_SHARE", 2)
        return filled(spark, f"{top}/plain", PLAIN), filled(spark, f"{top}/wide", WIDE)


@pytest.fixture(scope="module")
def opened(both):
    return tuple(d.open() for d in both)


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    """Without deletes."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "PAIRED_SHARE", 2)
        return build_index(rows(spark, 1, 0, 80), WIDE, str(tmp_path_factory.mktemp("clean")) + "/ix")


def found(index, asked):
    return sorted((r["doc_id"], round(r["score"], 6)) for r in matches(asked, index).collect())


word = st.sampled_from(WORDS)
phrases = st.lists(st.sampled_from(WORDS[:5]), min_size=2, max_size=5)
leaf = st.one_of(
    phrases.map(lambda w: q.phrase("body", *w)),
    phrases.map(lambda w: q.phrase_prefix("body", *w[:-1], w[-1][:1])),
    phrases.map(lambda w: q.QuotedPhrase(" ".join(w), ("body",))),
    phrases.map(lambda w: q.match("-".join(w) + " gear", "body")),
    st.tuples(word, st.integers(0, 2), st.booleans()).map(lambda x: q.Fuzzy("body", *x)),
    st.sampled_from(["eng.*", "(the|gear)", "[a-f]?ngine(s)?", "g[re]{1,2}[a-z]+", "engine|of", ".*", "en(gi)+ne"]).map(lambda p: q.Regex("body", p)),
    st.sampled_from(["k[12]", "k\\d"]).map(lambda p: q.Regex("kind", p)),
)
asked = st.one_of(leaf, st.lists(st.tuples(st.sampled_from(q.OCCURS), leaf), min_size=1, max_size=3).map(lambda c: q.Bool(tuple(c))))


@settings(max_examples=14, deadline=None)
@given(asked)
def test_both_layouts_give_the_same_rows(opened, asked):
    plain, wide = opened
    assert found(plain, asked) == found(wide, asked)


def test_pairs_are_kept_apart_from_words(opened):
    plain, wide = opened
    columns = ["field", "term", "doc_id", "tf", "dl"]
    assert sorted(plain.postings.select(*columns).collect()) == sorted(wide.postings.select(*columns).collect())
    assert sorted(plain.terms.select("field", "term", "df", "cf").collect()) == sorted(wide.terms.select("field", "term", "df", "cf").collect())
    assert {"the", "of", "in", "a"} <= wide.paired["body"] and "z9" not in wide.paired["body"]
    pairs = wide.everything.filter(F.col("field") == "body" + PAIRED)
    assert pairs.count() and {len(r["term"].split(" ")) for r in pairs.collect()} == {2}


def test_rewriting_chooses_the_pairs_anew(spark, both, tmp_path):
    directory = filled(spark, f"{tmp_path}/ix", WIDE)
    before = directory.open()
    directory.rewrite()
    after = directory.open()
    for asked in (q.phrase("body", "of", "the"), q.phrase("body", "in", "the", "in"), q.Fuzzy("body", "engin", 1)):
        assert found(before, asked) == found(after, asked)
    directory.append(rows(spark, 9, 1000, 30))
    directory.compact([b for b in directory._require().batches])
    plain = filled(spark, f"{tmp_path}/plain", PLAIN)
    plain.append(rows(spark, 9, 1000, 30))
    assert found(directory.open(), q.phrase("body", "of", "the")) == found(plain.open(), q.phrase("body", "of", "the"))


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_phrase_of_frequent_words_reads_no_word(clean):
    wide = clean
    text = plan(matches(q.phrase("body", "of", "the"), wide))
    assert "EqualTo(term,of the)" in text and "positions" not in text and "Exchange" not in text
    text = plan(matches(q.phrase("body", "in", "the", "of", "in"), wide))
    asked = re.search(r"In\(term, \[([^]]*)\]", text).group(1)
    assert sorted(asked.split(",")) == ["in the", "of in"] and "body+pairs" in text


def test_patterns_read_the_rows_of_their_pieces(clean, monkeypatch):
    wide = clean
    monkeypatch.setattr(wide, "terms", None)  # the vocabulary
    for field, pattern, pieces in (
        ("body", F.col("term").rlike("^eng.*$"), grams.for_regex("eng.*")),
        ("body", F.levenshtein("term", F.lit("engine")) <= 1, grams.for_fuzzy("engine", 1, True)),
    ):
        frame = wide.terms_matching(field, pattern, pieces)
        text = plan(frame)
        assert "grams" in text and re.search(r"gram_bucket#\d+ (IN|=)", text) and "In(gram, [" in text
        assert {"engine", "engines"} <= {r["term"] for r in frame.collect()}
    assert {t for t in wide.resolve([("body", F.col("term").rlike("^eng.*$"), grams.for_regex("eng.*"))])[0]} == {"engine", "engines"}


@pytest.mark.parametrize(
    "pattern, alternatives",
    [
        ("abcd", [{"\x02ab", "abc", "bcd", "cd\x03"}]),
        ("ab.*", [{"\x02ab"}]),
        ("(as|in)[a-m]{2,3}", [{"\x02as"}, {"\x02in"}]),
        ("x(ab)+y?zz", [{"\x02xa", "xab", "zz\x03"}]),
        ("[ab]cd", [{"\x02ac", "acd", "cd\x03"}, {"\x02bc", "bcd", "cd\x03"}]),
        ("a{3}", [{"\x02aa", "aaa", "aa\x03"}]),
        ("^the$", [{"\x02th", "the", "he\x03"}]),
    ],
)
def test_pieces_of_a_regex(pattern, alternatives):
    assert [set(pieces) for pieces, n in grams.for_regex(pattern).alternatives] == alternatives


@pytest.mark.parametrize("pattern", [".*", "a|.*b", "(?i)abc", "[[ab]c]de", "\\Qabc\\E", "[a&&b]cd", "\\0101bc", "(?<n>abc)", "\\b{g}abc", "\\p{L}abc", "("])
def test_patterns_that_say_nothing_for_sure(pattern):
    assert grams.for_regex(pattern) is None


letters = st.text("abc", max_size=7)
part = st.sampled_from(["a", "b", "c", "ab", ".", "[ab]", "[^a]", "(a|bc)", "(ab)*", "(ba)+", "c{2}", "a?", "(?:b|ca){1,2}", "c{2,}", "^", "$"])


@settings(max_examples=600, deadline=None)
@given(st.lists(part, min_size=1, max_size=6), st.one_of(letters, st.just(None)), st.integers(0, 5))
def test_no_matching_term_is_filtered_out(parts, term, seed):
    pattern = "".join(parts)
    rng = random.Random(seed)
    for term in [term or "", *("".join(rng.choice("abc") for _ in range(rng.randrange(8))) for _ in range(40))]:
        wanted = grams.for_regex(pattern)
        if wanted is not None and re.fullmatch(pattern, term):
            have = grams._pieces(grams.BEGIN + term + grams.END) or {grams.BEGIN + grams.END}
            assert any(len(have & pieces) >= n for pieces, n in wanted.alternatives)


def edited(rng, word, swaps):
    i = rng.randrange(len(word) + 1)
    kind = rng.choice(["add", "drop", "change"] + ["swap"] * swaps)
    if kind == "add":
        return word[:i] + rng.choice("abc") + word[i:]
    if kind == "drop":
        return word[:i] + word[i + 1 :]
    if kind == "change" and i < len(word):
        return word[:i] + rng.choice("abc") + word[i + 1 :]
    return word[:i] + word[i : i + 2][::-1] + word[i + 2 :]


@settings(max_examples=400, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.integers(0, 10_000), st.integers(0, 2), st.booleans())
def test_edited_words_keep_enough_pieces(value, seed, distance, swaps):
    rng, term = random.Random(seed), value
    for _ in range(distance):
        term = edited(rng, term, swaps)
    wanted = grams.for_fuzzy(value, distance, swaps)
    if wanted is not None:
        have = grams._pieces(grams.BEGIN + term + grams.END) or {grams.BEGIN + grams.END}
        assert all(len(have & pieces) >= n for pieces, n in wanted.alternatives)


def test_pieces_in_the_engine_and_here_agree(spark):
    words = ["", "a", "ab", "abc", "überß", "漢字漢字漢", "aaaa"]
    frame = spark.createDataFrame([(w,) for w in words], "term string")
    for r in frame.select("term", grams.pieces_of(F.col("term")).alias("p")).collect():
        text = grams.BEGIN + r["term"] + grams.END
        assert set(r["p"]) == (grams._pieces(text) or {text}) and len(set(r["p"])) == len(r["p"])


def test_pairs_need_plain_text():
    for bad in (("t", "text", {"pairs": True, "tokenizer": "en_stem"}), ("s", "string", {"pairs": True}), ("t" + PAIRED, "text", {})):
        with pytest.raises(MappingError):
            Mapping.build([bad])


def test_a_torn_commit_is_not_seen(spark, tmp_path, monkeypatch):
    directory = IndexDirectory(spark, f"{tmp_path}/ix").create(PLAIN)
    directory.append(rows(spark, 1, 0, 5))
    names = lambda: sorted(p.name for p in (tmp_path / "ix" / "versions").iterdir() if p.suffix == ".json")
    whole = names()
    (tmp_path / "ix" / "versions" / ".000000000002.json.half.tmp").write_text('{"version": 2')
    (tmp_path / "ix" / "versions" / "000000000002.json").write_text("")
    assert directory.open().n_docs == directory.open(1).n_docs and directory.current_version() == 1
    directory.append(rows(spark, 2, 100, 5))
    assert names() == [*whole, "000000000002.json"]


@pytest.fixture(scope="module")
def tiered(spark, tmp_path_factory):
    """Two batches of other lengths, so that tiers were made with another average; without and with the layout."""
    top = tmp_path_factory.mktemp("tiers")
    made = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "TIERED_POSTINGS", 8)
        for name, mapping in (("plain", PLAIN), ("wide", WIDE)):
            directory = IndexDirectory(spark, f"{top}/{name}").create(mapping)
            directory.append(rows(spark, 5, 0, 150))
            longer = rows(spark, 6, 1000, 60).withColumn("body", F.concat_ws(" ", "body", F.repeat(F.lit("filler "), 30)))
            directory.append(longer)
            made.append(directory.open())
    return tuple(made)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from([*WORDS, "filler"]), min_size=1, max_size=4), st.integers(1, 12))
def test_the_best_are_the_same_with_tiers(tiered, words, k):
    plain, wide = tiered
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(compile, "SPARED_ROWS", 0)
        for asked in (q.match(" ".join(words), "body"), q.phrase("body", "of", words[0]), q.boosted_fields(" ".join(words), {"body": 2.5})):
            assert [tuple(r) for r in top_k(plain, asked, k).collect()] == [tuple(r) for r in top_k(wide, asked, k).collect()]


def test_only_upper_tiers_of_a_frequent_word_are_read(tiered):
    _, wide = tiered
    frame = top_k(wide, "the", 3, fields=("body",))
    text = plan(frame)
    least = int(re.search(r"GreaterThanOrEqual\(tier,(\d+)\)", text).group(1))
    counts = wide.tier_counts([("body", "the")])["body", "the"]
    assert 3 <= sum(n for t, n in counts.items() if t >= least) < sum(counts.values()) / 2 and "Exchange hash" not in text
    assert wide.tier_counts([("body", "nowhere")]) == {}


def test_tiers_bound_what_postings_add(tiered):
    _, wide = tiered
    for r in wide.everything.filter("tier is not null").select("field", "tf", "dl", "tier").distinct().collect():
        field = r["field"].removesuffix(PAIRED)
        for avgdl in (3.0, wide.lengths[field], 80.0):
            norm = 2.2 * r["tf"] / (r["tf"] + 1.2 * (0.25 + 0.75 * r["dl"] / avgdl))
            low, high = (scoring.tier_bound(r["tier"] + i, wide.lengths[field], avgdl, not i) for i in (0, 1))
            assert low - 1e-9 <= norm <= high + 1e-9


def test_tiers_are_not_trusted_after_a_delete(opened):
    _, wide = opened
    assert wide.tiers is None


@pytest.mark.parametrize("mapping", [PLAIN, WIDE])
def test_a_large_batch_writes_its_postings_where_they_are_made(spark, tmp_path, monkeypatch, mapping):
    """No shuffle of the postings, each share sorted in files of its own, and the rows of a small batch."""
    dealt, write = [], IndexDirectory._write_postings

    def noted(self, postings, v, n, **more):
        dealt.append((more.get("dealt", False), postings.rdd.getNumPartitions()))
        write(self, postings, v, n, **more)

    monkeypatch.setattr(IndexDirectory, "_write_postings", noted)
    records = rows(spark, 3, 0, 300)
    small = build_index(records, mapping, f"{tmp_path}/small")
    monkeypatch.setattr(tables, "LARGE_VALUES", 500)
    monkeypatch.setattr(tables, "SHARE_VALUES", 100)
    large = build_index(records, mapping, f"{tmp_path}/large")
    assert not dealt[0][0] and dealt[1] == (True, 6)
    for name in ("docs", "everything", "statistics"):
        a, b = getattr(small, name), getattr(large, name)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    rounded = lambda frame: frame.withColumn("score", scoring.rounded(F.col("score")))
    for asked in (q.phrase("body", "of", "the"), q.match("engine the x", "body"), q.Prefix("body", "e")):
        a, b = rounded(matches(asked, small)), rounded(matches(asked, large))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert top_k(small, "the engine", limit=7).collect() == top_k(large, "the engine", limit=7).collect()
    per_file: dict[str, list] = {}
    lines = large.postings.withColumn("file", F.input_file_name()).withColumn("i", F.monotonically_increasing_id())
    for r in lines.orderBy("i").collect():
        per_file.setdefault(r["file"], []).append((r["term"], -(r["tier"] or 0) if "tier" in r else 0, r["doc_id"]))
    assert all(found == sorted(found) for found in per_file.values())


STEMS = Mapping.build([("body", "text", {**TEXT, "tokenizer": "en_stem"}), ("kind", "string", TEXT)])
BLANKS = Mapping.build([("body", "text", {**EXTRA, "tokenizer": "whitespace"}), ("kind", "string", TEXT)])


@pytest.mark.parametrize("mapping", [PLAIN, WIDE, STEMS, BLANKS])
@pytest.mark.parametrize("most", [400, 1 << 20])
def test_postings_of_many_documents_come_in_the_order_they_are_written_in(spark, monkeypatch, mapping, most):
    """The rows that documents give one by one, whatever is grouped together; letters whose lower case is longer or shorter
    are measured as they are in the text, and only blanks, words that are too long and nulls give nothing."""
    monkeypatch.setattr(grouping, "TEXT_BYTES", most)
    odd = ["\u212a" * 13 + "k", "\u212a" * 14, "\u0130" * 19 + " the of", "\u023a" * 19, "\u03a3\u0391\u03a3 a\u0301\u0301", " ", "", ".,", None, "the, of the", "x\u00a0y\tz\x0bw\n\fv"]
    odd = spark.createDataFrame([(1000 + i, t, [None, "", "a b", "K\u212a"][i % 4]) for i, t in enumerate(odd)], "doc_id bigint, body string, kind string")
    records = rows(spark, 4, 0, 120).unionByName(odd).coalesce(1).cache()
    slots = {"body": analysis.word_slots(spark, WORDS[:4])} if mapping.paired else None
    lengths = {"body": 9.5} if mapping.tiered else {}
    alone = tables.postings_table(records, mapping, slots=slots).withColumn("term_bucket", tables.bucket_of(F.col("term"), 8))
    found = tables.sorted_postings(records, mapping, 8, slots, lengths)
    assert found.columns == alone.columns and found.exceptAll(alone).isEmpty() and alone.exceptAll(found).isEmpty()
    tiered = tables.with_tiers(found, lengths).collect()
    order = [(r["field"], r["term_bucket"], r["term"].encode(), -(r["tier"] or 0), r["doc_id"]) for r in tiered]
    assert order == sorted(order)


@pytest.mark.parametrize("groups", [1 << 20, 1 << 62])
def test_order_of_groups_with_and_without_room_for_positions(groups):
    """Where group and position do not fit into one number, both are compared."""
    rng = random.Random(1)
    pairs = [(rng.randrange(50), rng.randrange(300)) for _ in range(500)]
    group, at = (np.array(c, np.int64) for c in zip(*pairs))
    found = grouping._in_order(group, at, groups)
    assert list(zip(*(c.tolist() for c in found))) == sorted(pairs)


def test_shares_are_bounded_and_leave_each_bucket_enough():
    shares = lambda size, values=0, cores=8, buckets=8: tables.shares_of(size, values, cores, buckets)
    assert shares(tables.LARGE_BATCH - 1) is None and shares(tables.LARGE_BATCH, buckets=2048) is None
    assert shares(tables.LARGE_BATCH) == 8 and shares(tables.LARGE_BATCH, cores=1000) == 16
    for times in (2, 60, 6000):
        assert shares(times * tables.LARGEST_SHARE, cores=1) == times
        assert shares(1, 4 * times * tables.SHARE_VALUES) == 4 * times


def test_values_alone_make_a_batch_large():
    """Short rows that compress well still have postings to sort."""
    assert tables.shares_of(1 << 20, 18_000_000, 8, 8) == 9
