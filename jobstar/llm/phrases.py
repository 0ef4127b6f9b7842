"""Collocations by vertically partitioned suffix subtrees (operator 13).

A phrase is a run of words within a piece of a text, so its occurrences are
the beginnings of the suffixes that start with it. After the scheme of ERA
the suffix tree, cut at three words, is never built as a whole:

* *Vertical partitioning.* Words are counted; a word is a prefix. A prefix that
  occurs too often for the memory budget is extended by a word, those that still
  do by one more. Prefixes below the least count cannot begin a phrase that counts and are left out:
  a suffix is cut where a word or a pair of words is not frequent.
* *Groups.* Prefixes in order of their hashes are put together as long as a group keeps to the budget.
* *Subtrees.* Suffixes go to the group of their prefix, equal ones added up
  before. Each group's are sorted by Spark (spilling where needed) and one pass over the
  sorted leaves builds its subtree, the open path only being held: where
  a path ends its node's count is the total of the leaves below it.

Hashes only route suffixes and leave out what cannot be frequent; a collision costs
some work and changes no count. What goes through the driver has a fixed greatest
size: a budget is at least a fixed share of all words, so few prefixes exceed it and few groups are made,
and frequent words and pairs are told by tables of a fixed number of bits.
When these fill up, on a corpus with far more frequent pairs than bits, more suffixes are sorted; the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobstar.llm.text import batches_of_texts, joined, lower_ascii, mix
from jobstar.session import materialize

BUDGET = 1 << 20  # most suffixes of a group
GROUPS_PER_TASK = 4  # a group has at most this part of a task's even share, so that few groups in one task weigh little
SHARE = 4096  # a budget is at least all words over this, so no more prefixes than this exceed it
FILTER_BITS = 1 << 26  # size of a table of frequent words or pairs: 8 MB
CHUNK = 1 << 20  # bytes of text whose suffixes are added up together
SALTS = 64
SEED = 42  # of Spark's xxhash64
#: ends of pieces and separators of words, fixed by the patterns [.,;:!?\x0A-\x0D] and [^\x20\x09]+
BREAKS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, np.int8)
_KIND[list(SPACES)], _KIND[list(BREAKS)] = 1, 2


class Words:
    """The words of some texts: distinct ones (``lang``, ``word``, ``hash``) and, for each place, which (``at``) and in which piece."""

    def __init__(self, langs: pa.Array, texts: list[bytes]):
        data, starts, _ = joined(texts)  # a line feed after each text: pieces end there
        data = lower_ascii(data)
        kind = _KIND[data]
        inside = kind == 0
        begin = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        end = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[begin]
        offsets = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), begin.size, [
            None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))]).dictionary_encode()
        langs = langs.cast(pa.binary()).dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[np.searchsorted(starts, begin, "right") - 1]
        n = max(1, len(words.dictionary))
        distinct, self.at = np.unique(lang * n + words.indices.to_numpy(zero_copy_only=False), return_inverse=True)
        self.lang_of = distinct // n
        self.langs = langs.dictionary
        self.lang = self.langs.take(pa.array(self.lang_of))
        self.word = words.dictionary.take(pa.array(distinct % n))

    @cached_property
    def hash(self) -> np.ndarray:
        """Spark's hash of each distinct word with its language; made where it is used."""
        heads = [g + b"\0" for g in self.langs.to_pylist()]
        bare = self.word.to_numpy(zero_copy_only=False)  # far faster than a list from Arrow
        return np.fromiter((xxhash.xxh64_intdigest(heads[g] + w, SEED) for g, w in
                            zip(self.lang_of.tolist(), bare.tolist())), np.uint64, bare.size)

    def follows(self) -> np.ndarray:
        """Whether the next place has a word of the same piece."""
        same = np.zeros(self.at.size, bool)
        same[:-1] = self.piece[1:] == self.piece[:-1]
        return same

    def pairs(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the words at ``at`` and the next places."""
        return mix(mix(self.hash[self.at[at]]) * np.uint64(3) + self.hash[self.at[at + 1]])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for part, texts in batches_of_texts(batches, "_text", raw=True, chunk=CHUNK):
        yield Words(part.column("_lang"), texts)


def _word_hash() -> Column:
    return F.xxhash64(F.concat("lang", F.lit(bytes(1)), "w1"))


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    at = (hashes & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _batch(schema: dict[str, pa.DataType], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, schema.values())], names=list(schema))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, w1, f) of all words, and a row per language with a null word and the number of all words."""
    schema = {"lang": pa.binary(), "w1": pa.binary(), "f": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _words(batches):
            count = np.bincount(w.at, minlength=len(w.word))
            yield _batch(schema, w.lang, w.word, count)
            total = np.bincount(w.lang_of, count, len(w.langs)).astype(np.int64)
            yield _batch(schema, w.langs, pa.nulls(len(w.langs)), total)

    return docs.mapInArrow(run, "lang binary, w1 binary, f bigint").groupBy("lang", "w1").agg(F.sum("f").alias("f"))


def pair_counts(docs: DataFrame, bits: bytes, hot: set[int]) -> DataFrame:
    """(h, hot, f): hashes of the pairs of frequent words within pieces, and whether the first word is one of ``hot``."""
    firsts = np.array(sorted(hot), np.uint64)
    schema = {"h": pa.int64(), "hot": pa.bool_(), "f": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint8)
        for w in _words(batches):
            often = _has(table, w.hash)[w.at]
            at = np.flatnonzero(w.follows() & often & np.roll(often, -1))
            h, first, count = np.unique(w.pairs(at), return_index=True, return_counts=True)
            yield _batch(schema, h.view(np.int64), np.isin(w.hash[w.at[at[first]]], firsts), count)

    return docs.mapInArrow(run, "h bigint, hot boolean, f bigint").groupBy("h", "hot").agg(F.sum("f").alias("f"))


def hash_bits(hashes: DataFrame) -> bytes:
    """A table of ``FILTER_BITS`` bits, set for each ``h``. It has one size whatever the corpus."""
    bit = F.pmod("h", F.lit(FILTER_BITS)) + 1  # the bitmap functions count from 1
    parts = (hashes.groupBy(F.bitmap_bucket_number(bit).alias("b"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("m")))
    table = bytearray(FILTER_BITS // 8)
    for r in parts.toLocalIterator():  # 4,096 bytes for each 32,768 bits
        table[(r["b"] - 1) * 4096:r["b"] * 4096] = r["m"]
    return bytes(table)


def group_bounds(prefixes: DataFrame, budget: int) -> list[int]:
    """First hash of every group: prefixes (h, f) in order, as many as keep to the budget.

    Each task cuts its own range of the order, so a group never spans two.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = budget + 1
        for b in batches:
            cut = []
            for i, x in enumerate(b.column("f").to_pylist()):
                if held + x > budget:
                    cut.append(i)
                    held = 0
                held += x
            yield pa.RecordBatch.from_arrays([b.column("h").take(pa.array(cut, pa.int64()))], names=["h"])

    spread = prefixes.select("h", "f").repartitionByRange("h").sortWithinPartitions("h")
    return sorted(r["h"] for r in spread.mapInArrow(run, "h bigint").collect())


def suffixes(docs: DataFrame, bits: bytes, bounds: list[int], hot: set[int], hotter: dict[int, int]) -> DataFrame:
    """(_group, head, w3, f): suffixes cut at three words, and where a pair is not frequent.

    ``head`` is two words and the language with a space between; words have none, so it can be taken apart.
    One column for the three moves, sorts and compares faster than three.
    Words in ``hot`` are routed with the next word, pairs in ``hotter`` (with the number of their groups) with the third.
    """
    firsts, limits = np.array(sorted(hot), np.uint64), np.array(bounds, np.int64)
    spread = np.array(sorted(hotter.items()), np.uint64).reshape(-1, 2)
    schema = {"_group": pa.int64(), "head": pa.binary(), "w3": pa.binary(), "f": pa.int64()}
    space = pa.scalar(b" ", pa.large_binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint8)
        for w in _words(batches):
            at = np.flatnonzero(w.follows())
            hashes = w.pairs(at)
            frequent = _has(table, hashes)
            at, hashes = at[frequent], hashes[frequent]
            if not at.size:
                continue
            begins = np.zeros(w.at.size + 1, bool)
            begins[at] = True
            n = w.hash.size  # stands for no third word
            third = np.where(begins[at + 1], np.concatenate((w.at, [0, 0]))[at + 2], n)
            pair, place = np.unique(w.at[at] * n + w.at[at + 1], return_inverse=True)
            leaf, first, count = np.unique(place * (n + 1) + third, return_index=True, return_counts=True)
            one, three, h = pair[place[first]] // n, third[first], hashes[first]
            route = np.where(np.isin(w.hash[one], firsts), h, w.hash[one]).view(np.int64)
            group = np.searchsorted(limits, route, "right").astype(np.int64)
            if spread.size:
                i = np.minimum(np.searchsorted(spread[:, 0], h), len(spread) - 1)
                last = np.concatenate((w.hash, np.zeros(1, np.uint64)))[three]
                group = np.where(spread[i, 0] == h, -1 - (mix(h + last) % spread[i, 1]).astype(np.int64), group)
            begin, after = pa.array(pair // n), pa.array(pair % n)
            head = pc.binary_join_element_wise(w.word.take(begin), w.word.take(after),
                                               w.lang.take(begin).cast(pa.large_binary()), space)
            yield _batch(schema, group, head.take(pa.array(place[first])),
                         w.word.take(pa.array(np.where(three < n, three, 0), mask=three == n)), count)

    return docs.mapInArrow(run, "_group bigint, head binary, w3 binary, f bigint")


def subtrees(leaves: DataFrame, least: int) -> DataFrame:
    """(spread, lang, w1, w2, w3, f): nodes of two and three words of each group's subtree, with at least ``least`` occurrences.

    A node of two words whose children lie in several groups has a part of its count in each; ``spread`` marks these.
    """
    schema = {"spread": pa.bool_(), **dict.fromkeys(("lang", "w1", "w2", "w3"), pa.binary()), "f": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, total, child, below = None, 0, None, 0  # open node of two words, its open child, and their counts

        def one(spread: bool, word: bytes | None, count: int) -> pa.RecordBatch:
            w1, w2, lang = node[1].split(b" ", 2)
            return _batch(schema, *(pa.array([x], t) for x, t in zip((spread, lang, w1, w2, word, count), schema.values())))

        def apart(head: pa.Array) -> list[pa.Array]:
            parts = pc.split_pattern(head, " ", max_splits=2).flatten()
            w1, w2, lang = (parts.take(pa.array(np.arange(i, len(parts), 3))) for i in range(3))
            return [lang, w1, w2]

        def close_child() -> Iterator[pa.RecordBatch]:
            if child and below >= least:
                yield one(False, child, below)

        def close() -> Iterator[pa.RecordBatch]:
            if node is not None:
                yield from close_child()
                if total >= least or node[0] < 0:
                    yield one(node[0] < 0, None, total)

        for b in batches:
            if not b.num_rows:
                continue
            third = pc.fill_null(b.column("w3"), b"")  # no word is empty
            group, f = b.column("_group").to_numpy(), b.column("f").to_numpy()
            differs = lambda c: pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
            new_node = np.ones(b.num_rows, bool)
            new_node[1:] = group[1:] != group[:-1]
            new_node[1:] |= differs(b.column("head"))
            new_child = new_node.copy()
            new_child[1:] |= differs(third)
            nodes, children = np.flatnonzero(new_node), np.flatnonzero(new_child)
            totals, belows = np.add.reduceat(f, nodes), np.add.reduceat(f, children)
            first = (int(group[0]), b.column("head")[0].as_py())
            if first == node:
                totals[0] += total
                if third[0].as_py() == child:
                    belows[0] += below
                else:
                    yield from close_child()
            else:
                yield from close()
            # the last ones stay open
            last = int(nodes[-1])
            node, total = (int(group[last]), b.column("head")[last].as_py()), int(totals[-1])
            child, below = third[int(children[-1])].as_py(), int(belows[-1])
            nodes, totals, children, belows = nodes[:-1], totals[:-1], children[:-1], belows[:-1]
            often = (totals >= least) | (group[nodes] < 0)
            two = b.take(pa.array(nodes[often]))
            yield _batch(schema, group[nodes[often]] < 0, *apart(two.column("head")), pa.nulls(len(two)), totals[often])
            words = pc.binary_length(third).to_numpy() > 0
            often = (belows >= least) & words[children]
            three = b.take(pa.array(children[often]))
            yield _batch(schema, np.zeros(len(three), bool), *apart(three.column("head")), three.column("w3"), belows[often])
        yield from close()

    # group, then 44 bits of the pair's hash: Spark compares this number first and seldom has to look at the words
    order = F.shiftleft("_group", 44) + F.shiftrightunsigned(F.xxhash64("head"), 20)
    dealt = leaves.repartition("_group").sortWithinPartitions(order, "head", "w3")
    return dealt.mapInArrow(run, "spread boolean, lang binary, w1 binary, w2 binary, w3 binary, f bigint")


def counted_phrases(docs: DataFrame, text_col: str, lang_col: str, least: int, budget: int
                    ) -> tuple[DataFrame, DataFrame]:
    """Stored (lang, w1, f) and (lang, w1, w2, w3, f) of words and phrases with ``least`` occurrences.

    Words have in addition a row per language with a null word and the number of all words.
    """
    docs = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("_lang"),
                       F.col(f"`{text_col}`").cast("string").alias("_text"))
    words = materialize(word_counts(docs).where(f"w1 IS NULL OR f >= {int(least)}"), "phrases-words")
    total = words.where("w1 IS NULL").agg(F.sum("f")).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    budget = max(min(budget, total // (GROUPS_PER_TASK * tasks)), -(-total // SHARE), 1)
    over, fits = F.col("f") > budget, F.col("f") <= budget
    frequent = words.where("w1 IS NOT NULL").select(_word_hash().alias("h"), "f")
    unsigned = lambda h: h & ((1 << 64) - 1)
    # at most SHARE words exceed the budget, and at most as many pairs
    hot = {unsigned(r["h"]) for r in frequent.where(over).collect()}
    pairs = materialize(pair_counts(docs, hash_bits(frequent), hot).where(F.col("f") >= least), "phrases-pairs")
    hotter = {unsigned(r["h"]): -(-r["f"] // budget) for r in pairs.where(over).collect()}
    prefixes = frequent.where(fits).unionByName(pairs.where("hot").where(fits).select("h", "f"))
    leaves = suffixes(docs, hash_bits(pairs), group_bounds(prefixes, budget), hot, hotter)
    nodes = subtrees(leaves, least)
    if hotter:
        nodes = materialize(nodes, "phrases-subtrees")
        whole = nodes.where("spread").groupBy("lang", "w1", "w2", "w3").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
        nodes = nodes.where("NOT spread").drop("spread").unionByName(whole)
    return words, materialize(nodes.select("lang", "w1", "w2", "w3", "f"), "phrases-nodes")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, inside_percent: int = 50,
                 top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two or three words.

    A phrase of ``a`` >= ``least`` occurrences scores floor(1000000 a² / (l r)) at its weakest cut. One of two words is
    dropped when a candidate of three that holds it has 100 f >= ``inside_percent`` a. A null
    language is ``und``, a null or empty text has no words; repeated rows count each; an empty table or
    one without a phrase that often gives an empty result. Ties go by count, then by the phrase's bytes. Other columns do not matter.
    """
    words, nodes = counted_phrases(docs, text_col, lang_col, least, budget)
    counts = words.where("w1 IS NOT NULL").select("lang", F.col("w1").alias("_w"), F.col("f").alias("_f"))
    two = nodes.where("w3 IS NULL").select("lang", "w1", "w2", F.col("f").alias("a"))
    three = nodes.where("w3 IS NOT NULL").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))

    def with_count(rows: DataFrame, word: str, name: str) -> DataFrame:
        return rows.join(counts.select("lang", F.col("_w").alias(word), F.col("_f").alias(name)), ["lang", word])

    def with_pair(rows: DataFrame, first: str, second: str, name: str) -> DataFrame:
        return rows.join(two.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name)),
                         ["lang", first, second])

    whole = lambda c: F.col(c).cast("decimal(19,0)")

    def score(left: str, right: str) -> F.Column:
        return F.expr(f"1000000BD * a * a div (CAST({left} AS decimal(19,0)) * {right})")

    longer = three.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))
                                            ).alias("_p"), "a")
    longer = longer.groupBy("lang", "_p.w1", "_p.w2").agg(F.max("a").alias("_longer"))
    pairs = (with_count(with_count(two, "w1", "l"), "w2", "r").join(longer, ["lang", "w1", "w2"], "left")
             .where(f"_longer IS NULL OR 100 * _longer < {int(inside_percent)} * a")
             .withColumn("a", whole("a")).withColumn("score", score("l", "r"))
             .select("lang", F.concat("w1", F.lit(b" "), "w2").alias("phrase"), "a", "l", "r", "score"))
    triples = with_pair(with_pair(with_count(with_count(three, "w1", "_l1"), "w3", "_r2"), "w2", "w3", "_r1"), "w1", "w2", "_l2")
    triples = (triples.withColumn("a", whole("a")).withColumn("_s1", score("_l1", "_r1")).withColumn("_s2", score("_l2", "_r2"))
               .withColumn("_one", F.col("_s1") <= F.col("_s2"))
               .select("lang", F.concat("w1", F.lit(b" "), "w2", F.lit(b" "), "w3").alias("phrase"), "a",
                       F.when(F.col("_one"), F.col("_l1")).otherwise(F.col("_l2")).alias("l"),
                       F.when(F.col("_one"), F.col("_r1")).otherwise(F.col("_r2")).alias("r"),
                       F.least("_s1", "_s2").alias("score")))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    found = pairs.unionByName(triples).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    # first of each share of a language, then of what these leave
    some = (found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best)))
            .where(F.col("rank") <= top).drop("rank", "_salt"))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    all_words = words.where("w1 IS NULL").select("lang", F.col("f").alias("n"))
    return ranked.join(all_words, "lang").select(
        F.col("lang").cast("string"), F.col("rank").cast("long"), F.col("phrase").cast("string"), F.col("a").cast("long"), "l", "r", "n", F.col("score").cast("long"))
