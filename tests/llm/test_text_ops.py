"""Operators 2, 3, 5, 6, 8 and 9 against brute force, exact round trips or held-out rows."""

import base64
import hashlib
import io
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from tokenizers import Tokenizer

from jobstar.llm import bpe, packing, warc
from jobstar.llm.langid import LanguageModel, features, fit_svm, identify_languages
from jobstar.llm.packing import pack_documents, plan_packing
from jobstar.llm.quality import ngram_table, quality_rules
from jobstar.llm.toxicity import Network, score_toxicity
from jobstar.session import scratch_path
from tests.llm import brute

SF = "/root/testdata/sf0.001"
RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.rows(), "doc_id bigint, text string").repartition(3)


# --- 2: WARC

PAGES = [(5, "http://a/", "<p>é</p>"), (2, "http://b/ c", "<p>é</p>"), (9, None, None), (8, "u", ""), (1, "u", "y" * 5000),
         (None, "u", "<p>é</p>"), (3, "u", "\r\n\r\nWARC/1.1\r\n")]


def test_warc_roundtrip(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in warc.warc_roundtrip(pages).collect()}
    assert len(got) == len(PAGES) and all(r.error is None for r in got.values())
    for page, url, html in PAGES:
        data = (html or "").encode()
        same = sorted((p for p, _, h in PAGES if (h or "").encode() == data), key=lambda p: (p is None, p))
        r = got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if page == same[0] else ("revisit", same[0]))
        assert r.payload == (data if page == same[0] else None)
    assert warc.warc_roundtrip(pages.limit(0)).collect() == []


def test_warc_least_bytes(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    got = {r.page_id: r.record_type for r in warc.warc_roundtrip(pages, min_bytes=1).collect()}
    assert got[8] == got[9] == "response" and got[5] == "revisit"


def test_warc_many_archives(spark):
    pages = spark.createDataFrame([(i, "u", f"<p>{i}</p>" * 50) for i in range(60)], "page_id bigint, url string, html string")
    root = scratch_path(spark, "warc-test")
    listed = warc.write_archives(pages.coalesce(1), root, archive_bytes=5000)
    assert listed.count() > 1 and sum(r.records for r in listed.collect()) == 60
    assert sorted(r.page_id for r in warc.read_archives(listed, root).collect()) == list(range(60))


def _archive(records) -> bytes:
    out = io.BytesIO()
    warc.write_archive(out, iter(records))
    return out.getvalue()


def test_warc_reader_reports_what_is_wrong():
    good = [warc.build_record(i, "u", f"<html>{'x' * 300}{i}".encode()) for i in range(30)]
    raw = _archive(good)
    size = struct.unpack("<I", raw[4:8])[0]
    assert struct.unpack("<I", raw[:4])[0] == warc.SKIPPABLE_MAGIC and size
    assert zstandard.ZstdDecompressor().decompress(raw[8:8 + size])  # the dictionary leads
    found = list(warc.read_archive(io.BytesIO(raw).read))
    assert [f["page_id"] for _, f in found] == list(range(30))
    # every frame is a record of its own
    frame = raw[found[3][0]:found[4][0]]
    decoder = zstandard.ZstdDecompressor(dict_data=warc._dictionary(zstandard.ZstdDecompressor().decompress(raw[8:8 + size])))
    assert decoder.decompress(frame) == good[3]

    bad = {
        b"WARC/0.9" + good[0][8:]: "version", good[0].replace(b"Content-Length: 307", b"Content-Length: 306"): "content-length",
        good[0].replace(b"WARC-Date", b"X-Date"): "warc-date", good[0][:-2]: "content-length", b"no header": "header",
        good[0].replace(b"x" * 300, b"y" * 300): "digest", good[0].replace(b": response", b": other"): "record type",
        good[0].replace(b"WARC-Type", b"WARC-Date"): "twice",
    }
    found = list(warc.read_archive(io.BytesIO(_archive([*bad, good[1]])).read))
    for (_, error), text in zip(found, bad.values()):
        assert isinstance(error, warc.WarcError) and text in str(error).lower()
    assert found[-1][1]["page_id"] == 1
    for cut, text in ((raw[:-3], "cut short"), (raw[:4], "dictionary"), (b"", "dictionary"), (raw[:20], "cut short")):
        assert text in str(list(warc.read_archive(io.BytesIO(cut).read))[-1][1])


# --- 3: quality

def test_base_rules(spark, docs):
    labels = spark.createDataFrame([(d, 1, 0) for d, _ in brute.rows()[::2]] + [(None, 1, 0), (999, 1, 0), (1, None, 0)],
                                   "doc_id bigint, quality int, toxic int")
    out = quality_rules(docs, labels).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out}
    assert got == {d: brute.base_rules(t) for d, t in brute.rows()}
    assert not any(r.kept for r in out if r.base_failed)


def test_base_rules_of_odd_texts(spark):
    texts = ["a b c d e a b c d e", "a a a a a a a a a a a", "x\n\n \nx\nx y\rx y\n", "a\x0bb\x1cc \xa0d #*$%&|<>é", "p q r s t " * 9]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id int, text string, score string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in quality_rules(docs, labels).collect()}
    assert got == {i: brute.base_rules(t) for i, t in enumerate(texts)}
    assert quality_rules(docs.limit(0), labels).collect() == []


def test_ratio_tells_target_from_raw(spark):
    r = random.Random(1)
    good = [" ".join(r.choice(["alpha", "beta", "gamma", "delta"]) + str(r.randrange(9)) for _ in range(60)) for _ in range(60)]
    junk = [" ".join(r.choice(["zz", "qq", "xx", "jj"]) + str(r.randrange(9)) for _ in range(60)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(good + junk)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)], "doc_id bigint, quality int, toxic int")
    kept = {x.doc_id for x in quality_rules(docs, labels).where("kept").collect()}
    assert kept == set(range(60))


def test_target_counts_all_trusted_documents(spark):
    """With every document trusted the ratio is flat, however many there are and whatever else the labels name."""
    docs = spark.range(9000).selectExpr("id AS doc_id", "concat('w', id % 977, ' v', id % 89, ' u', id % 53) AS text")
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    beyond = spark.range(9000, 30000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    for table in (labels, labels.unionByName(beyond).unionByName(labels)):
        assert max(map(abs, ngram_table(docs, table, "doc_id", "text", buckets=16, smoothing=1e-9))) < 1e-6
    half = ngram_table(docs, labels.where("doc_id % 2 = 0").unionByName(beyond), "doc_id", "text", buckets=16)
    assert half == ngram_table(docs, labels.where("doc_id % 2 = 0"), "doc_id", "text", buckets=16)


# --- 5: packing

def _checked(docs, rows):
    tokenizer = Tokenizer.from_file(WORDS)
    seen = {}
    for r in rows:
        seen.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for d, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert sorted(seen[d]) == [(k, a, len(ids[a:a + 4096]), zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes()))
                                   for k, a in enumerate(range(0, len(ids), 4096))]
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(bins), -(-sum(r.length for r in rows) // 4096)


def test_packing(spark):
    r = random.Random(8)
    docs = brute.rows() + [(1000 + i, brute.sentence(r, r.randrange(1, 900))) for i in range(60)] + [
        (2000, "long " * 9000), (2001, "İstanbul ΣΑΣ\x1cx\xa0y é á <|endoftext|> 'll"), (2002, "　\x85")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    used, least = _checked(docs, pack_documents(df.repartition(4), WORDS).collect())
    assert used <= least + 1
    assert pack_documents(df.limit(0), WORDS).collect() == []


def test_packing_keeps_other_columns(spark):
    df = spark.createDataFrame([(None, "a b", "x"), (1, "a b", "y"), (1, "a b", "y")], "doc_id bigint, text string, offset string")
    rows = pack_documents(df, WORDS).collect()
    assert len(rows) == 3 and {r.sequence_id for r in rows} == {0} and sorted(r.offset for r in rows) == [0, 3, 6]


def test_packing_keeps_columns_named_like_helpers(spark):
    names = ["_part", "_rank", "_before", "_n", "c0", "odd name"]
    df = spark.createDataFrame([("x", *range(6), 1), ("x y", *range(6), 2)],
                               "text string, " + ", ".join(f"`{n}` int" for n in names) + ", doc_id bigint")
    out = pack_documents(df, WORDS)
    assert out.columns == [*names, "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = out.collect()
    assert {r.doc_id for r in rows} == {1, 2} and all([r[n] for n in names] == list(range(6)) for r in rows)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    r = random.Random(seed)
    counts = {r.randrange(1, 101): r.randrange(1, 10 ** r.randrange(1, 6)) for _ in range(r.randrange(1, 60))}
    used: dict[int, int] = {}
    bins = 0
    for lengths, n in (plan := plan_packing(counts, 100)):
        assert 0 < sum(lengths) <= 100 and n > 0
        bins += n
        for x in lengths:
            used[x] = used.get(x, 0) + n
    assert used == counts and len(plan) < 2000
    assert bins >= -(-sum(k * n for k, n in counts.items()) // 100)


def test_plan_fills_gaps_by_one_two_and_three():
    assert sorted(plan_packing({100: 2, 70: 1, 30: 1, 60: 1, 25: 1, 15: 1, 50: 1, 20: 1, 18: 1, 12: 1}, 100)) == [
        ((50, 20, 18, 12), 1), ((60, 25, 15), 1), ((70, 30), 1), ((100,), 2)]


# --- 6: byte-level BPE

@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.BytePairCoder.of(RANKS).ranks,
                             special_tokens={})


def test_bpe_equals_library(reference):
    r = random.Random(6)
    letters = " \n\t'srtmdvleabS1٣,.!é数 　ñ'' \x1c\U0001F600"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(4000)]
    texts += ["a" * 3000, "ab" * 2000, "#-" * 1500, " " * 999, "'s" * 300, "", "\n", "don't we'll 'Tis I'VE", "<|endoftext|>"]
    coder = bpe.BytePairCoder.of(RANKS)
    got = coder.encode(texts)
    assert got == [reference.encode_ordinary(t) for t in texts]
    assert [coder.decode(ids).decode() for ids in got] == texts
    for ids, text in zip(got, texts):
        at = coder.offsets(ids)
        for i, a, b in zip(ids, at, [*at[1:], len(text.encode())]):
            assert coder.tokens[i] == text.encode()[a:b]


def test_bpe_classes_of_all_code_points(reference):
    texts = [f"a{chr(i)}1{chr(i)}{chr(i)}." for i in range(0, 0x110000, 7) if not 0xD800 <= i < 0xE000]
    assert bpe.BytePairCoder.of(RANKS).encode(texts) == [reference.encode_ordinary(t) for t in texts]


def test_bpe_frames(spark, docs, reference):
    coded = bpe.encode(docs.withColumnRenamed("text", "body"), RANKS, "body")
    out = {r.doc_id: r for r in bpe.decode(coded, RANKS).collect()}
    digest = {r.doc_id: r for r in bpe.roundtrip_digests(docs, RANKS).collect()}
    for d, text in brute.rows():
        ids = reference.encode_ordinary(text or "")
        assert out[d].ids == ids and bytes(out[d].decoded).decode() == (text or "")
        assert (digest[d].n_tokens, digest[d].ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))))
        assert digest[d].decoded_sha256 == brute.sha(text or "")
    assert bpe.encode(docs.limit(0), RANKS).collect() == []


# --- 8: toxicity

def test_gradients_of_the_network():
    r = np.random.default_rng(0)
    net = Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = r.standard_normal((64, 3, 4))
    there = np.arange(64)[:, None] < np.array([64, 5, 1])[None, :]
    x *= there[:, :, None]
    target, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        y = net.forward(x, there)
        return -(weight * (target * np.log(y) + (1 - target) * np.log(1 - y))).sum() / weight.sum()

    keep = {}
    net.forward(x, there, keep)
    grads = net.gradients(keep, target, weight)
    for name, p in net.p.items():
        i = tuple(r.integers(0, s) for s in p.shape)
        p[i] += 1e-4
        up = loss()
        p[i] -= 2e-4
        down = loss()
        p[i] += 1e-4
        assert abs((up - down) / 2e-4 - grads[name][i]) < 1e-3


def _labelled(r, n):
    rude = ["idiot", "moron", "scum", "pathetic"]
    rows, labels = [], []
    for i in range(n):
        words = [f"w{r.randrange(300)}" for _ in range(r.randrange(20, 200))]
        toxic = i % 3 == 0
        for _ in range(4 if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(rude))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    r = random.Random(9)
    rows, labels = _labelled(r, 240)
    rows += [(1000, "the " * 3000 + "idiot moron scum"), (1001, None), (1002, ""), (1003, " "), (None, "idiot moron pathetic scum")]
    docs = spark.createDataFrame([(*x, "s") for x in rows], "doc_id bigint, text string, predicted string")
    table = spark.createDataFrame(labels + [(None, 1, 1), (5000, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    out = {x.doc_id: x for x in score_toxicity(docs, table).collect()}
    assert len(out) == len(rows) and all(0 <= x.score <= 1 for x in out.values())
    for i in range(240):
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [x for i, x in out.items() if i is not None and i < 240 and x.held_out]
    assert sum(x.predicted == int(x.doc_id % 3 == 0) for x in held) > 0.9 * len(held)
    assert out[1000].predicted == 1 and out[None].predicted == 1  # far behind the first window
    assert [out[i].score for i in (1001, 1002, 1003)] == [0, 0, 0]
    none = score_toxicity(docs, table.limit(0))
    assert {x.score for x in none.collect()} == {0.0}
    assert score_toxicity(docs.limit(0), table).collect() == []


# --- 9: languages

def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = identify_languages(docs).select("doc_id", "held_out", "lang", "lang_pred").collect()
    held = [r for r in rows if r.held_out]
    assert {r.held_out for r in rows} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_languages_of_a_family_by_pairs():
    """Four languages of one family, each a mixture; predictions equal votes over all pairs, ties by summed margins."""
    r = random.Random(4)
    langs = ["da", "de", "en", "nl"]

    def text(share):
        return "   ".join("abcd"[r.choices(range(4), share)[0]] * 3 for _ in range(40))

    shares = {"da": (6, 1, 1, 2), "de": (3, 3, 2, 2), "en": (2, 3, 3, 2), "nl": (1, 1, 5, 3)}
    rows = [(text(shares[v]), v) for v in langs for _ in range(60)] + [("кот дом " * 9, "ru")] * 5
    model = LanguageModel([t for t, _ in rows], [v for _, v in rows])
    probes = [text([r.random() for _ in range(4)]) for _ in range(300)]
    x, y = features([t for t, _ in rows]), np.array([v for _, v in rows])
    scale = (np.sqrt((x * x).mean(axis=0)) + 1e-4) * np.sqrt(len(x[0])) / 8
    votes, sums = np.zeros((300, 4)), np.zeros((300, 4))
    for a in range(4):
        for b in range(a + 1, 4):
            own = (y == langs[a]) | (y == langs[b])
            w, bias = fit_svm(x[own] / scale, np.where(y[own] == langs[a], 1.0, -1.0).astype(np.float32))
            margin = features(probes) / scale @ w + bias
            votes[:, a], votes[:, b] = votes[:, a] + (margin > 0), votes[:, b] + (margin < 0)
            sums[:, a], sums[:, b] = sums[:, a] + margin, sums[:, b] - margin
    expected = [langs[max(range(4), key=lambda j: (votes[i, j], sums[i, j]))] for i in range(300)]
    got = model.predict(probes)
    assert sum(g == e for (g, _), e in zip(got, expected)) >= 298  # but for rounding
    assert set(expected) == set(langs) and all(0 <= s <= 1 for _, s in got)
    assert model.predict(["дом кот", "12"])[0][0] == "ru" and model.predict(["12"]) == [("und", 0.0)]


def test_language_edges(spark):
    r = random.Random(2)
    pools = {"en": ["the", "thing", "with"], "de": ["und", "schön", "nicht"], "fr": ["être", "les", "ceux"], "xx": ["кот", "дом"]}
    rows = [(i, " ".join(r.choice(pools[v]) for _ in range(30)), v) for i, v in enumerate(list(pools) * 30)]
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 !!", "de"), (1003, "nicht und schön", None), (None, "les ceux être", "en")]
    docs = spark.createDataFrame([(*x, "s") for x in rows + odd], "doc_id bigint, text string, lang string, score string")
    out = {x.doc_id: x for x in identify_languages(docs).collect()}
    assert [out[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "de"]
    assert out[None].lang_pred == "fr" and not out[None].held_out
    assert all(out[i].lang_pred == v for i, _, v in rows) and all(0 <= x.score <= 1 for x in out.values())
    assert {x.lang_pred for x in identify_languages(docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang is null")).collect()} <= {"und"}
    assert identify_languages(docs.limit(0)).collect() == []


def test_languages_with_long_texts_only(spark):
    """Of texts longer than the sample takes a part is learned from."""
    pools = {"en": "the thing with ", "ru": "кот дом сад "}
    docs = spark.createDataFrame([(i, pools[v] * 2000, v) for i, v in enumerate(list(pools) * 6)], "doc_id bigint, text string, lang string")
    assert all(r.lang == r.lang_pred for r in identify_languages(docs).collect())


def test_quality_keeps_columns_named_like_helpers(spark):
    names = ["_hashed", "_lines", "_windows", "_sorted", "_twice", "_total", "_text", "_doc", "_place", "_bits", "c0", "odd name"]
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)), *range(len(names))), (2, None, *range(len(names)))],
                               "doc_id bigint, text string, " + ", ".join(f"`{n}` int" for n in names))
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    out = quality_rules(df, labels).collect()
    assert len(out) == 2 and all([r[n] for n in names] == list(range(len(names))) for r in out)


def test_idle_tokenizer_drops_its_words(monkeypatch):
    """An idle Python worker holds no words beside the stages that follow; one that gets a task in time keeps them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    coder = packing.WordTokenizer.of(path)
    ids = coder.ids([b"some words, some more"])
    monkeypatch.setattr(packing, "IDLE_S", 60)
    coder.rest()
    assert packing.WordTokenizer.of(path) is coder and b"more" in coder.known
    monkeypatch.setattr(packing, "IDLE_S", 0.01)
    coder.rest()
    coder.timer.join()
    assert coder.known == {b"": b""} and coder.old == {}
    assert packing.WordTokenizer.of(path).ids([b"some words, some more"]) == ids


def test_idle_tokenizer_is_dropped(monkeypatch):
    """An idle Python worker holds no tokenizer either (F2); the next task loads it again."""
    monkeypatch.setattr(packing, "IDLE_S", 0.01)
    coder = packing.WordTokenizer.of(WORDS)
    ids = coder.ids([b"some words"])
    coder.rest()
    coder.timer.join()
    assert WORDS not in packing.WordTokenizer._loaded and coder.tokenizer is None
    assert packing.WordTokenizer.of(WORDS).ids([b"some words"]) == ids


def test_odd_words_are_encoded_in_few_calls(monkeypatch):
    """Words with accents, digits and signs are cut into pre-tokens and not encoded one by one (F2)."""
    r = random.Random(4)
    letters, signs = "abcxyzABCéÉßÿø0179", [".", ",###", "-", "(", "\"%%%", "<", "|>", "_"]
    words = ["".join(r.choice(letters) for _ in range(r.randrange(1, 8))) + r.choice(signs) +
             "".join(r.choice(letters) for _ in range(r.randrange(4))) for _ in range(3000)]
    whole = ["don't", "<|endoftext|>", "İx", "e\u0301a", "x\u0331H\u0331", "中文.", "×÷", "a\x1cb", "ªµº", "x\xa0y"]
    coder, given = packing.WordTokenizer(WORDS), []
    encoded = coder._encoded
    monkeypatch.setattr(coder, "_encoded", lambda texts: given.extend(texts) or encoded(texts))
    texts = [" ".join(words), "", " ".join(whole), "\n".join(w + "\t" + x for w, x in zip(whole, words))]
    tokenizer = Tokenizer.from_file(WORDS)
    assert coder.ids([t.encode() for t in texts]) == [
        np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert len(given) < 20
