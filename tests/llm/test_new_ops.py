"""Operators 11 to 13 against the library, brute force and small cases."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from jobstar.llm.centroids import choose_pivots, cluster_vectors, nearest, to_pivots
from jobstar.llm.merge_automaton import FINAL, MergeAutomaton, WordCoder, decode_words, encode_words, roundtrip_digests
from jobstar.llm.phrases import Words, _word_hash, collocations, group_bounds, suffixes
from tests.llm import brute

PATH = public_tokenizers.path("word_bpe_49k.json")


# ---- operator 11

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts() -> list[str]:
    r = random.Random(4)
    out = ["", " \n ", "aaaa aaa aa a aaaaaaaaaaaaaaa", "x" * 700, "<|endoftext|>A<|startoftext|>b <|endo",
           "It's we'll I'D \"'s ÉCOLE é İstanbul ǅ 中文字符测试 １２ ½ ٣ 　x\x85y\x1cz Σας", "\x01 \x7f", "🙂🙂👩‍👩‍👧 ﬁ"]
    out += ["".join(r.choice("abcdefghijklmnopqrstuvwxyzetaoinsétñ'.-!09    ") for _ in range(300)) for _ in range(60)]
    out += ["".join(chr(r.choice([r.randrange(1, 0x250), r.randrange(0x250, 0xd7ff), r.randrange(0x10000, 0x1f9ff)]))
                    for _ in range(100)) for _ in range(60)]
    return out


def test_ids_equal_the_library(library):
    coder = WordCoder.of(PATH)
    for text, ids in zip(texts(), coder.ids([t.encode() for t in texts()])):
        ids = np.frombuffer(ids, "<u4")
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected
        assert coder.automaton.decode(ids) == library.decode(expected, skip_special_tokens=False)


def by_merging(word: str, merges: list[tuple[str, str]]) -> list[str]:
    parts = [*word[:-1], word[-1] + "$"]
    for a, b in merges:
        i = 0
        while i < len(parts) - 1:
            if (parts[i], parts[i + 1]) == (a, b):
                parts[i:i + 2] = [a + b]
            i += 1
    return parts


@pytest.mark.parametrize("seed", range(30))
def test_automaton_of_random_merges(seed):
    """Any merges, dead ones and of a token with itself too: one path per word, that of merging in turn."""
    r = random.Random(seed)
    symbols = [*"abc", *(c + "$" for c in "abc")]
    tokens, merges = list(symbols), []
    for _ in range(r.randrange(1, 25)):
        a, b = r.choice(tokens), r.choice(tokens)
        if not a.endswith("$") and a + b not in tokens:
            merges.append((a, b))
            tokens.append(a + b)
    vocab = {t: i for i, t in enumerate(tokens)}
    automaton = MergeAutomaton(vocab, merges, "$")
    words = ["".join(r.choice("aabc") for _ in range(r.randrange(1, 14))) for _ in range(60)]
    for word, ids in zip(words, automaton.encode([w.encode() for w in words])):
        ids = np.frombuffer(ids, "<u4")
        assert [automaton.labels[i] for i in ids] == by_merging(word, merges)
        state = 0  # a path of the automaton, from its start to its end
        for i in ids:
            assert automaton.arcs(state)[i]
            state = automaton.target[i]
        assert state == FINAL


def test_vocabulary_that_is_none():
    with pytest.raises(ValueError):
        MergeAutomaton({"a": 0, "b": 1, "abc": 2}, [], "$")
    with pytest.raises(ValueError):  # a merge before those that make its parts
        MergeAutomaton({"a": 0, "b": 1, "c": 2, "abc": 3, "bc": 4}, [("a", "bc"), ("b", "c")], "$")


def test_encode_and_decode_frames(spark, library):
    rows = [(1, "Hello, WORLD  it's", 7), (1, "Hello, WORLD  it's", 7), (None, None, None), (3, "", 0), (4, "é " * 3000, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    out = decode_words(encode_words(docs, PATH), PATH).collect()
    assert len(out) == 5
    for r in out:
        expected = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == expected and r.decoded == library.decode(expected, skip_special_tokens=False)
    assert encode_words(docs.limit(0), PATH).collect() == []


def test_digests_and_clashing_names(spark, library):
    rows = [(1, "some Words. of", "mine", 5), (2, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _part string, n_tokens int")
    out = {r.doc_id: r for r in roundtrip_digests(docs, PATH).collect()}
    for d, t in ((1, "some Words. of"), (2, "")):
        ids = library.encode(t, add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        assert (out[d].n_tokens, out[d].ids_sha256) == (len(ids), brute.sha(raw))
        assert out[d].decoded_sha256 == brute.sha(library.decode(ids, skip_special_tokens=False))
    assert out[1]._part == "mine" and roundtrip_digests(docs.limit(0), PATH).collect() == []


# ---- operator 12

def brute_clusters(vectors: dict, k: int, rounds: int) -> dict:
    q = {i: [int(Fraction(x) * 64 // 1) for x in v] for i, v in vectors.items()}
    order = sorted(q, key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())
    centroids = [q[i] for i in order[:k]]

    def assign():
        return {i: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for i, v in q.items()}

    for _ in range(rounds):
        at = assign()
        for n in range(len(centroids)):
            mine = [q[i] for i, (_, c) in at.items() if c == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assign()
    sha = [brute.sha(",".join(map(str, c))) for c in centroids]
    return {i: (c, d, sum(e for e, o in at.values() if o == c), sum(e for e, _ in at.values()), sha[c]) for i, (d, c) in at.items()}


def vectors(n: int, dims: int, seed: int) -> dict:
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return {i: [float(np.float32(x + r.gauss(0, .2))) for x in r.choice(centres)] for i in range(n)}


def test_clusters_equal_brute_force(spark):
    given = vectors(300, 8, 1)
    given |= {300 + i: given[i % 3] for i in range(120)}  # many equal vectors: ties and empty clusters
    rows = [(i, v) for i, v in given.items()]
    rows += [(1000, None), (1001, [1.0] * 7), (1002, [1.0] * 7 + [float("nan")]), (1003, [1.0] * 7 + [None]),
             (1004, [float("inf")] * 8), (1005, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    got = {r.vec_id: tuple(r)[1:] for r in
           cluster_vectors(df, dims=8).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()}
    assert got == brute_clusters(given, 16, 3)


def test_pruning_changes_nothing_and_saves_distances():
    r = np.random.default_rng(2)
    centroids = r.integers(-400, 400, (16, 12))
    rows = centroids[r.integers(0, 16, 3000)] + r.integers(-30, 30, (3000, 12))
    pivots = choose_pivots(centroids, 4)
    cluster, distance, worked = nearest(rows, to_pivots(rows, pivots), centroids, pivots)
    exact = ((rows[:, None, :] - centroids[None]) ** 2).sum(2)
    assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    assert worked < 0.5 * exact.size


def test_cluster_edges(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0], "a"), (5, [1.0, 2.0], "b"), (5, [-1.5, 0.0], None)],
                               "vec_id bigint, embedding array<double>, cluster string").selectExpr("*", "3 AS _q")
    out = cluster_vectors(df, dims=2).collect()
    assert len(out) == 3 and all(r.distance == 0 and r.inertia == 0 and r._q == 3 for r in out)
    assert cluster_vectors(df.limit(0), dims=2).collect() == []
    assert set(cluster_vectors(df.limit(0), dims=2).columns) == set(cluster_vectors(df, dims=2).columns)
    large = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        cluster_vectors(large, dims=2).collect()


# ---- operator 13

def brute_phrases(rows: list[tuple], least: int = 10, percent: int = 50, top: int = 2000) -> list[tuple]:
    count: dict[str, Counter] = {}
    for lang, text in rows:
        c = count.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            c.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, c in count.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        longer: dict[tuple, int] = {}
        for p, a in candidates.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer.get(q, 0), a)
        found = []
        for p, a in candidates.items():
            if len(p) == 2 and 100 * longer.get(p, 0) >= percent * a:
                continue
            score, _, left, right = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def passages(seed: int) -> list[tuple]:
    r = random.Random(seed)
    pool = [f"w{int(r.paretovariate(.7)) % 90}" for _ in range(400)] + ["é", "Ünï", "A", "a"]
    rows = [(r.choice(["en", "de", None, "und"]), " ".join(r.choice(pool) + r.choice(["", "", "", ",", ".\n", "\t"])
                                                           for _ in range(r.randrange(80)))) for _ in range(150)]
    return rows + [("en", "the very common line is here " * 300), ("en", None), (None, ""), ("de", " ,. \n"), ("en", "hot pair hot pair x hot pair y")]


@pytest.mark.parametrize("budget", [1 << 20, 100, 30])
def test_phrases_equal_brute_force(spark, budget):
    """With a small budget words and pairs are extended and subtrees spread over many groups."""
    rows = passages(3)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = sorted(tuple(r) for r in collocations(docs, budget=budget).collect())
    assert got == brute_phrases(rows) and len(got) > 50


@pytest.mark.parametrize("budget", [5, 1 << 20])
def test_phrases_of_odd_languages_and_words(spark, budget):
    """A language may hold blanks or nothing, a word a zero byte; leaves carry both words and the language as one (F1)."""
    r = random.Random(6)
    rows = [(lang, " ".join(r.choice(["a", "b\0", "\0", "é", "c"]) for _ in range(40))) for lang in ("", "x y", " ", "x", None) for _ in range(4)]
    docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    got = sorted(tuple(x) for x in collocations(docs, budget=budget).collect())
    assert got == brute_phrases(rows) and len({x[0] for x in got}) == 5
    named = docs.selectExpr("coalesce(lang, 'und') AS _lang", "text AS _text")
    leaves = suffixes(named, b"\xff" * (1 << 23), [], set(), {})
    assert leaves.columns == ["_group", "head", "w3", "f"] and leaves.agg({"f": "sum"}).first()[0] == 20 * 39


def test_phrases_top_and_least(spark):
    rows = passages(5)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in collocations(docs, least=3, inside_percent=80, top=7, budget=64).collect())
    assert got == brute_phrases(rows, 3, 80, 7)


def test_phrase_edges(spark):
    docs = spark.createDataFrame([("x y " * 20, None, 1)] * 2, "text string, lang string, f int")
    got = sorted(tuple(r) for r in collocations(docs).collect())
    assert got == brute_phrases([(None, "x y " * 20)] * 2) and got
    assert collocations(docs.limit(0)).collect() == []
    assert collocations(spark.createDataFrame([(None, None)], "text string, lang string")).collect() == []


def test_groups_keep_to_the_budget(spark):
    r = random.Random(1)
    rows = sorted((r.randrange(-2**63, 2**63), r.randrange(1, 50)) for _ in range(500))
    bounds = group_bounds(spark.createDataFrame(rows, "h bigint, f bigint"), 100)
    assert bounds[0] == rows[0][0]
    sums: Counter = Counter()
    for h, f in rows:
        sums[max(i for i, b in enumerate(bounds) if b <= h)] += f
    assert max(sums.values()) <= 100 and len(bounds) < 2 * sum(x[1] for x in rows) / 100 + 10


def test_words_hash_as_spark_does(spark):
    w = Words(pa.array(["en", "dé"]), ["Ab é, ab".encode(), b"x"])
    df = spark.createDataFrame([(bytearray(g), bytearray(x), i) for i, (g, x) in enumerate(zip(w.lang.to_pylist(), w.word.to_pylist()))],
                               "lang binary, w1 binary, i int")
    got = {r.i: r.h & (2**64 - 1) for r in df.select("i", _word_hash().alias("h")).collect()}
    assert [got[i] for i in range(3)] == w.hash.tolist()
