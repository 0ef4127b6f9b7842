"""Operators 1, 4, 7 and 10 against brute force."""

import random

import numpy as np
import pytest

from jobstar.llm.exact import exact_dedup
from jobstar.llm.fm_index import FMIndex, fm_dedup
from jobstar.llm.graph import components
from jobstar.llm.minhash import _alike, near_duplicates
from jobstar.llm.suffix_array import COVER, PERIOD, BlockwiseSuffixes, cleaned, difference_cover, suffix_dedup
from tests.llm import brute

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.rows(), SCHEMA).repartition(3)


def test_exact(docs):
    expected = brute.exact(brute.rows())
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(docs).collect()}
    assert got == expected


def test_exact_edges(spark):
    rows = [(1, "a", "x"), (1, "A", "x"), (None, "a", "y"), (2, "b", "z"), (None, None, None), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    out = exact_dedup(docs).collect()
    assert len(out) == 6
    a = [r for r in out if r.text in ("a", "A")]
    assert {(r.keep_id, r.group_size) for r in a} == {(1, 3)} and sum(r.kept for r in a) == 1
    empty = [r for r in out if not r.text]
    assert {(r.keep_id, r.group_size) for r in empty} == {(None, 2)} and sum(r.kept for r in empty) == 1
    assert exact_dedup(docs.limit(0)).collect() == []


def test_exact_keeps_columns_named_like_helpers(spark):
    names = ["_norm", "_digest", "_id", "_best", "_n", "_keep", "_size", "_order", "_key", "_locator", "c0", "odd name"]
    rows = [(1, "a", *range(len(names))), (2, "A", *range(len(names))), (3, "b", *range(len(names)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{n}` int" for n in names))
    out = exact_dedup(docs)
    assert out.columns == [*docs.columns, "keep_id", "group_size", "kept", "text_sha256"]
    assert all([r[n] for n in names] == list(range(len(names))) for r in out.collect())
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out.collect()) == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)]


@pytest.mark.parametrize("bits", [8])
def test_exact_texts_that_share_a_digest(docs, bits):
    """Digests of a few bits collide all over; the bytes tell the texts apart."""
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(docs, digest_bits=bits).collect()}
    assert got == brute.exact(brute.rows())


def _shuffled(node) -> int:
    """Bytes that the exchanges of an executed plan wrote."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _shuffled(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return _shuffled(node.plan())
    own = node.metrics().apply("shuffleBytesWritten").value() if name == "ShuffleExchangeExec" else 0
    return own + sum(_shuffled(node.children().apply(i)) for i in range(node.children().size()))


def test_exact_moves_no_text_without_a_copy(spark):
    """Without broadcasts, as over large tables, only texts that have copies are shuffled."""
    rng = random.Random(7)
    rows = [(i, rng.randbytes(4000).hex()) for i in range(100)] + [(200, "a copy"), (201, "A copy")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = exact_dedup(docs)
        got = {r.doc_id: (r.text, r.keep_id, r.group_size, r.kept) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {i: (t, 201 if i > 100 else i, 2 if i > 100 else 1, i != 200) for i, t in rows}
    assert _shuffled(out._jdf.queryExecution().executedPlan()) < 100_000


def test_exact_over_a_scan_and_over_rows_that_are_no_rows_of_files(spark, docs, tmp_root):
    docs.write.parquet(f"{tmp_root}/docs")
    stored = spark.read.parquet(f"{tmp_root}/docs")
    result = lambda df: {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(df).collect()}
    assert result(stored) == result(stored.where("doc_id >= 0").select("text", "doc_id")) == brute.exact(brute.rows())
    twice = stored.where("doc_id < 20").selectExpr("doc_id", "text", "explode(array(1, 2)) AS copy")
    out = exact_dedup(twice).collect()
    kept = [r for r in out if r.kept]
    assert len(out) == 2 * len({r.doc_id for r in out}) and len(kept) == len({r.text_sha256 for r in out})


def test_exact_arrivals_meet_in_the_state(spark, tmp_root):
    rows = [(i, t) for i, t in enumerate(["a", "A", "b", None, "c", "a", "B", "", "d", "a"])]
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (rows[:5], rows[5:]))
    for _ in range(2):  # an arrival that comes again counts once
        out = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(first, store=f"{tmp_root}/s", arrival="one").collect()}
        assert out == {0: (1, 2, False), 1: (1, 2, True), 2: (2, 1, True), 3: (3, 1, True), 4: (4, 1, True)}
    for _ in range(2):
        out = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(second, store=f"{tmp_root}/s", arrival="two").collect()}
        assert out == {5: (9, 4, False), 6: (6, 2, True), 7: (7, 2, True), 8: (8, 1, True), 9: (9, 4, True)}
    late = spark.createDataFrame([(-1, "a"), (-2, "e")], SCHEMA)  # the row to keep came before
    out = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(late, store=f"{tmp_root}/s", arrival="three").collect()}
    assert out == {-1: (9, 5, False), -2: (-2, 1, True)}


def test_fm_dedup(docs):
    expected = brute.earlier_words(brute.rows())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in fm_dedup(docs).collect()}
    assert got == expected
    assert sum(n for _, n, _ in got.values()) > 500


@pytest.mark.parametrize("limits", [{}, {"limit": 2, "parts": 7}, {"chunk": 3}])
def test_suffix_dedup(docs, limits):
    listed = brute.rows()
    expected = {listed[k][0]: v for k, v in brute.repeated_bytes(listed).items()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup(docs, **limits).collect()}
    assert got == expected
    assert sum(v[1] for v in got.values()) > 5000


def test_fm_dedup_split_buckets(docs):
    expected = brute.earlier_words(brute.rows(), 20)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in fm_dedup(docs, window=20, gram=4, limit=2, parts=4).collect()}
    assert got == expected


def test_substring_edges(spark):
    text = brute.sentence(random.Random(3), 90)
    rows = [(1, text, 0), (1, text, 0), (None, text, 1), (None, None, 2), (7, "", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_removed int")
    out = suffix_dedup(docs).collect()
    assert sorted(r.n_removed for r in out) == [0, 0] + 3 * [len(text.encode())]
    out = {(r.doc_id, r.n_removed) for r in fm_dedup(docs).collect()}
    assert out == {(1, 90), (None, 0), (7, 0)}  # the null identifier is the smallest
    for empty in (suffix_dedup(docs.limit(0)), fm_dedup(docs.limit(0))):
        assert empty.collect() == []


def test_cleaned_text_is_valid(spark):
    text = "é" * 150
    docs = spark.createDataFrame([(1, text), (2, "a" + text + "b"), (3, None)], SCHEMA)
    assert sorted((r.doc_id, r.text) for r in cleaned(docs).collect()) == [(1, ""), (2, "ab"), (3, None)]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near(docs, k, percent):
    expected = brute.near(brute.rows(), k, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, k=k, percent=percent).collect()}
    assert got == expected


def test_near_link_that_no_first_centre_sees(spark):
    """A base and variants that are like the base but not like each other; the base is never the smallest."""
    r = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    rows = [(500, " ".join(base))]
    for i in range(40):
        words = list(base)
        for p in r.sample(range(5, 115, 5), 3):
            words[p] = f"v{i}x{p}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, SCHEMA)
    expected = brute.near(rows, 3, 85)
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_duplicates(docs, k=3, percent=85).collect()}
    assert got == expected


def test_near_links_far_from_all_centres(spark):
    """Pairs around one passage: alike in themselves, unlike all others of their bucket, far more than centres."""
    r = random.Random(12)
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for i in range(24):
        own = [f"o{i}x{j}" for j in range(30)]
        rows += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + own[:-1] + ["other"]))]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    for k, percent in ((3, 85), (2, 90)):
        expected = brute.near(rows, k, percent)
        assert len({c for _, c, _ in expected.values()}) == 24
        got = near_duplicates(docs, k=k, percent=percent, bands=2, rows=1)
        assert {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in got.collect()} == expected


def test_near_rest_leaves_out_no_link(spark):
    """The exact step alone, over random sets of unlike sizes with common and rare items, against all pairs."""
    r = random.Random(13)
    sets = []
    for i in range(160):
        s = set(sets[r.randrange(i)]) if i and r.random() < 0.6 else set(range(r.randrange(40)))
        s = {x for x in s if r.random() < 0.93} | {r.randrange(30, 400) for _ in range(r.randrange(1, 8))}
        sets.append(s)
    frame = spark.createDataFrame(list(enumerate(map(list, sets))), "_id bigint, _set array<bigint>")
    docs = spark.createDataFrame([(i, len(s), i % 90) for i, s in enumerate(sets)], "_id bigint, _n bigint, _comp bigint")
    for percent in (60, 80, 100):
        alike = {(x, y) for y in range(160) for x in range(y) if x % 90 != y % 90
                 and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])}
        got = {(p.x, p.y) for p in _alike(docs, frame, percent).collect()}
        assert alike <= got and all(x % 90 != y % 90 and x < y for x, y in got)
        assert percent == 100 or alike


def test_near_edges(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "e f g h"), (4, "E f g h"), (5, None), (6, " ")],
                                 SCHEMA)
    out = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, k=3, percent=85).collect()),
                 key=str)
    assert out == sorted([(None, 2, None, True), (3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False), (5, 0, 5, True),
                          (6, 0, 6, True)], key=str)
    assert near_duplicates(docs.limit(0)).collect() == []


def test_components_of_a_chain(spark):
    nodes = spark.createDataFrame([(i,) for i in range(40)], "_id bigint")
    links = spark.createDataFrame([(i, i + 1) for i in range(30) if i != 14], "x bigint, y bigint")
    got = {r._id: r._comp for r in components(nodes, links).collect()}
    assert got == {i: 0 if i <= 14 else 15 if i <= 30 else i for i in range(40)}


def test_difference_cover():
    for period in (7, 13, 32, 64):
        cover = difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert len(COVER) < PERIOD // 2


def test_blockwise_suffixes():
    r = np.random.default_rng(4)
    text = r.integers(97, 99, (40, 64)).astype(np.uint8)
    text[5:20] = text[5]
    text[20, :60] = text[5, :60]
    bucket = np.arange(40) // 25
    suffixes = BlockwiseSuffixes(text, bucket)
    for column in range(64):
        keys = [(bucket[i], text[i, column:].tobytes()) for i in suffixes.block(column)]
        assert keys == sorted(keys)


def test_fm_index_counts():
    r = random.Random(2)
    documents = [[r.randrange(1, 4) for _ in range(r.randrange(1, 30))] for _ in range(30)]
    text = np.array([x for d in documents for x in (*d, 0)])
    owner = np.array([i for i, d in enumerate(documents) for _ in range(len(d) + 1)])
    index = FMIndex(text, owner, 8)
    for n in range(1, 9):
        for _ in range(40):
            pattern = [r.randrange(1, 4) for _ in range(n)]
            low, high = np.zeros(1, np.int64), np.full(1, text.size)
            for x in reversed(pattern):
                low, high = index.extend(np.array([x]), low, high)
                if low[0] >= high[0]:
                    break
            expected = sum(d[i:i + n] == pattern for d in documents for i in range(len(d) - n + 1))
            assert max(0, int(high[0] - low[0])) == expected


def thue_morse(n: int, a: str, b: str) -> str:
    """A polynomial hash modulo a power of two cannot tell this word from the one with a and b exchanged."""
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


def test_words_that_collide_under_a_polynomial(spark):
    one, other = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    around = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join([*around, x, *around])) for i, x in enumerate((one, other))]
    out = {r.doc_id: r.n_removed for r in fm_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {0: 0, 1: 0}
    rows = [(0, one + " x"), (1, other + " x")]
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA), k=3, percent=85).collect()
    assert all(r.kept for r in out)


@pytest.mark.parametrize("members", [40, 160])
def test_near_group_of_unlike_members(spark, members):
    """A group whose members are often unlike each other and the centre, in a fixed number of stored steps."""
    import jobstar.session as session
    r = random.Random(members)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(members):
        words = list(base)
        for at in r.sample(range(100), r.randrange(12)):
            words[at] = f"e{r.randrange(300)}"
        rows.append((i, " ".join(words)))
    before = len(session._scratch)
    out = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in
           near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), k=3, percent=85).collect()}
    assert out == brute.near(rows, 3, 85)
    assert len(set(c for _, c, _ in out.values())) > 2
    assert len(session._scratch) - before < 45


def test_cleaned_leaves_other_characters_alone(spark):
    """A replacement character of the text itself stays; characters cut apart at either end of a removed run go."""
    rows = [(1, "\ufffdx" + "é" * 150 + "\ufffdy"), (2, "z" + "é" * 150 + "u")]
    assert sorted((r.doc_id, r.text) for r in cleaned(spark.createDataFrame(rows, SCHEMA)).collect()) == [(1, "\ufffdx\ufffdy"), (2, "zu")]


@pytest.mark.parametrize("operator", [fm_dedup, suffix_dedup])
def test_columns_named_like_helpers(spark, operator):
    names = ["_id", "_k", "_g", "_c", "_at", "_list", "_text", "c0", "c1", "odd name"]
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(i, text, *range(len(names))) for i in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{n}` int" for n in names))
    out = operator(docs).collect()
    assert len(out) == 2 and all([r[n] for n in names] == list(range(len(names))) for r in out)
    assert max(r.n_removed for r in out) > 0


def test_repeated_and_null_identifiers_by_text(spark):
    """Rows of one identifier are told apart by their texts: only those that repeat lose something."""
    r = random.Random(9)
    same = brute.sentence(r, 60)
    rows = [(None, brute.sentence(r, 60)) for _ in range(50)] + [(None, same), (3, same)] + [(3, brute.sentence(r, 60)) for _ in range(50)]
    out = suffix_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(x.n_removed for x in out if x.n_removed) == [len(same.encode())] * 2
