"""Dataset manifest, phrase mining and line labelling against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import collocations, merkle, quality_lines
from tests.llm.conftest import EXTRA, SCHEMA, odd_rows

# Manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(fields):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def plain_tree(leaves):
    """The root, and for each leaf the siblings (left, right) of every level."""
    proofs, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for proof, i in zip(proofs, at):
            run = i // 16 * 16
            proof.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 16])))
        nodes, at = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)], [i // 16 for i in at]
    return nodes[0], proofs


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified) of rows (doc_id, text, lang, source, n_chars)."""
    sources = defaultdict(list)
    for r in rows:
        lowered = None if r[1] is None else re.sub("[A-Z]", lambda m: m[0].lower(), r[1])
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        leaf = plain_leaf((r[0], r[3], r[2], r[4], r[1]))
        sources[r[3]].append((r[0] is not None, r[0] or 0, leaf, plain_leaf((r[0], r[3], r[2], r[4], lowered)) if hit else leaf))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf for *_, leaf, _ in sorted(sources[s])]) for s in names}
    root, tops = plain_tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for (some, doc_id, leaf, seen), own in zip(sorted(sources[s]), trees[s][1]):
            node, proof = seen, own + top
            for left, right in proof:
                node = sha(left + node + right)
            digest = sha("".join(left + right for left, right in proof))
            out.append((doc_id if some else None, leaf, trees[s][0], root, digest, node, node == root))
    return Counter(out)


def manifest_of(docs):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.verified(docs, tampered, lowered)


def test_manifest_of_odd_rows(odd_docs, no_docs):
    assert Counter(map(tuple, manifest_of(odd_docs).collect())) == plain_manifest(odd_rows())
    assert manifest_of(no_docs).collect() == []


def test_manifest_of_trees_of_many_heights(spark):
    sizes = {"one": 1, "two": 2, "run": 16, "more": 17, "square": 256, "above": 257, "large": 4500, None: 33}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, f"Text {i}", None, source, i % 7, *EXTRA))
            i += 1
    rows += [(10_000 + k, "One", "en", f"s{k}", 3, *EXTRA) for k in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = manifest_of(docs)
    assert Counter(map(tuple, got.collect())) == plain_manifest(rows)


def test_single_document_is_its_own_root(spark):
    docs = spark.createDataFrame([(1, "x", "en", "a", 1, *EXTRA)], SCHEMA)
    (row,) = manifest_of(docs).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")


def test_only_every_second_level_is_stored(spark):
    rows = [(i, "x", "en", "a", 1, *EXTRA) for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    built = merkle.Manifest.build(docs, F.col("source"), F.col("doc_id"), merkle.document_leaf(F.col("text")), {})
    assert [level.count() for level in built.sources.levels] == [600, 3, 1]


# Phrases


def plain_phrases(rows, least, most):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    counts, words = defaultdict(Counter), Counter()
    for r in rows:
        lang = r[2] if r[2] is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, 5):
                counts[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, own in counts.items():
        best = []
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longest[p[i : i + n]] = max(longest[p[i : i + n]], a)
        for p, a in candidates.items():
            if 100 * longest[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return Counter(out)


def phrase_rows():
    rng = random.Random(11)
    tokens = ["The", "the", "cat", "SAT", "mat", "é", "x\x01", "漢", "a", "b"]
    texts = ["".join(rng.choice(tokens) + rng.choice([" ", " ", " ", "\t", ", ", "\n", "  "]) for _ in range(rng.randrange(0, 60))) for _ in range(120)]
    rows = [(i, t, ("en", "de", None, "und")[i % 4], "s", 1, *EXTRA) for i, t in enumerate(texts)]
    return rows + [(1, "of the cat of the cat, " * 300, "en", None, None, *EXTRA)] + odd_rows()


@pytest.fixture(scope="module")
def phrase_docs(spark):
    return spark.createDataFrame(phrase_rows(), SCHEMA).repartition(4).cache()


@pytest.mark.parametrize("least, most, shard, fan", [(5, 40, 1_000_000, 8), (2, 7, 300, 1)])
def test_phrases_by_counting_everything(phrase_docs, monkeypatch, least, most, shard, fan):
    monkeypatch.setattr(collocations, "SHARD_WORDS", shard)
    monkeypatch.setattr(collocations, "FAN_BITS", fan)
    got = collocations.mine(phrase_docs, "text", F.coalesce("lang", F.lit("und")), least, most).collect()
    assert Counter(map(tuple, got)) == plain_phrases(phrase_rows(), least, most)


def test_phrases_with_marks_that_are_shared(phrase_docs, monkeypatch):
    monkeypatch.setattr(collocations, "MARK_BITS", 15)
    monkeypatch.setattr(collocations, "_mark", lambda a, b: np.zeros(len(a), np.uint64))
    got = collocations.mine(phrase_docs, "text", F.coalesce("lang", F.lit("und")), 4, 50).collect()
    assert Counter(map(tuple, got)) == plain_phrases(phrase_rows(), 4, 50)


def test_no_phrases_of_no_texts(no_docs):
    assert collocations.mine(no_docs, "text", F.col("lang"), 1, 5).collect() == []


@pytest.mark.parametrize("n, bits", [(2, 16), (3, 17), (4, 16), (2, 32), (3, 32), (4, 21), (4, 32)])
def test_filters_lose_nothing(n, bits):
    rng = np.random.default_rng(n * bits)
    ids = rng.integers(0, 1 << min(bits, 5), 4000).astype(np.uint32)
    ids[::5] = (1 << bits) - 1
    left, right = collocations._halves(n, bits)
    turn = collocations.Permutation(left, right)
    a, b = collocations.packed(ids, n, bits)
    back = collocations.unpacked(*turn.back(*turn.of(a, b)), n, bits)
    assert all((back[k] == ids[k : len(a) + k]).all() for k in range(n))
    parts = []
    for half in (slice(0, 1500), slice(1500, None)):
        x, y = turn.of(a[half], b[half])
        one = collocations.summed(x, y, None, right)
        one[2][::3] += 300
        for range_, blob in collocations._cut(*one, left, right, 8):
            again = collocations.Filter.unpack(blob, left, right, 8, range_)
            mine = (one[0] >> np.uint64(left - 8)) == range_
            assert all((p == q[mine]).all() for p, q in zip(again, one))
            parts.append(again)
    merged = collocations.summed(*(np.concatenate(p) for p in zip(*parts)), right)
    expected = Counter()
    for x, y, c in parts:
        for entry in zip(x.tolist(), y.tolist(), c.tolist()):
            expected[entry[:2]] += entry[2]
    assert dict(zip(zip(merged[0].tolist(), merged[1].tolist()), merged[2].tolist())) == dict(expected)


# Lines


def test_marginals_by_listing_all_labellings():
    rng = np.random.default_rng(4)
    for size in (1, 2, 5):
        odds, pairs = rng.normal(size=size) * 2, rng.normal(size=(2, 2))
        total, good = 0.0, np.zeros(size)
        for labels in itertools.product((0, 1), repeat=size):
            weight = np.exp(np.dot(odds, labels) + sum(pairs[i, j] for i, j in itertools.pairwise(labels)))
            total += weight
            good += weight * np.array(labels)
        assert np.allclose(quality_lines.marginals(odds, pairs), good / total)
        _, forward, backward = quality_lines.messages([odds, odds[:1]], pairs)
        assert np.allclose(1 / (1 + np.exp(-(forward + backward)[:, 0])), good / total)


def test_measures_of_lines():
    rows = quality_lines.measures("The cat, the cat.\n\n| a | 12 |\nThe cat, the cat.\nBB!! BB!!")
    at = quality_lines.MEASURES.index
    assert rows[:, at("words")].tolist() == [4, 0, 5, 4, 2]
    assert rows[:, at("copies in the text")].tolist() == [1, 0, 0, 1, 0]
    assert rows[:, at("lines of the text")].tolist() == [5] * 5
    assert rows[4, at("repeats of the word before")] == 0.5 and rows[2, at("words without letters")] == 0.8
    assert rows[0, at("ends in a stop")] == 1 and rows[2, at("ends in a stop")] == 0
    for empty in (None, "", " "):
        assert quality_lines.measures(empty).shape == (1, len(quality_lines.MEASURES))


def test_blocks_of_a_long_text_measure_alike(monkeypatch):
    rng = random.Random(1)
    text = "\n".join(" ".join(rng.choice(["one", "Two", "3", "|", "x!!"]) for _ in range(rng.randrange(0, 9))) for _ in range(300))
    whole = quality_lines.measures(text)
    monkeypatch.setattr(quality_lines, "BLOCK_BYTES", 50)
    assert np.array_equal(whole, quality_lines.measures(text))


def line_text(rng, good):
    clean = [f"{' '.join(rng.choice(['on', 'the', 'river', 'bank', 'stone', 'walks']) for _ in range(8)).capitalize()}." for _ in range(rng.randrange(1, 9))]
    junk = ["CLICK!! NOW!! " * 4, "a | b | c | d", "### %%% x *** y"]
    return "\n".join(clean if good else clean[: len(clean) // 3] + [rng.choice(junk) for _ in range(5)])


def test_lines_are_learned_from_documents(spark, no_docs):
    rng = random.Random(2)
    truth = [(i, line_text(rng, i % 4 > 0), int(i % 4 > 0)) for i in range(400)]
    rows = [(i, t, None, None, None, *EXTRA) for i, t, _ in truth] + [(None, None, None, None, None, *EXTRA), (3, "", None, None, 1, *EXTRA)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, y, 9) for i, _, y in truth] + [(None, 1, 1), (5, None, 1)], "doc_id long, quality int, text int")
    field = quality_lines.learn(docs, labels, "doc_id", "text")
    scored = quality_lines.score(docs, field).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    by_id = {r["doc_id"]: r for r in scored if r["n_lines"] > 1 or r["doc_id"] not in (3,)}
    wrong = [i for i, _, y in truth if zlib.crc32(str(i).encode()) % 5 == 0 and i != 3 and (by_id[i]["score"] >= 0.3) != y]
    assert not wrong
    mixed = [by_id[i]["n_bad_lines"] < by_id[i]["n_lines"] for i, t, y in truth if not y and len(t.split("\n")) > 6]
    assert np.mean(mixed) > 0.9  # clean lines of bad documents are told apart
    assert quality_lines.score(no_docs, field).collect() == []
    blank = quality_lines.learn(docs, labels.limit(0), "doc_id", "text")
    assert len({r["score"] for r in quality_lines.score(docs, blank).collect()}) == 1


def test_contradicting_and_held_out_labels_teach_nothing(spark):
    rng = random.Random(6)
    truth = [(i, line_text(rng, i % 3 > 0), int(i % 3 > 0)) for i in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in truth], "doc_id long, text string")
    labels = [(i, y) for i, _, y in truth]
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, *_ in truth}
    flipped = [(i, y if fold[i] else 1 - y) for i, y in labels] + [(1000, 0), (1000, 1)]
    fields = [quality_lines.learn(docs, spark.createDataFrame(x, "doc_id long, quality int"), "doc_id", "text") for x in (labels, flipped)]
    assert np.array_equal(fields[0].weights, fields[1].weights) and fields[0].curve == fields[1].curve
