"""Near-duplicate detection by one-permutation hashing (operator 7).

A document's shingles are hashed once; the hash picks a bin and each bin
keeps its smallest hash. Empty bins borrow from filled ones by a fixed random
order per bin (optimal densification). Bands of bins are bucket keys. In a
bucket every member is linked to one centre only (a star), and every such
candidate is confirmed on the full shingle sets.

A star alone could miss a link between two members that are both unlike the
centre. So where a bucket has members in different components after that, a
second star is drawn around the one with most links, and what is still
mixed is settled exactly: all members of such buckets are joined by the rarest
of their shingles (prefix, size and position filter), which leaves out no pair
that is similar enough. The number of rounds is fixed, whatever the groups are like.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar.llm.graph import components
from jobstar.llm.text import Rolling, batches_of_texts, joined, lower_ascii, mix, word_hashes, word_spans
from jobstar.session import materialize

BANDS, ROWS = 40, 6
_ADDED = ("n_shingles", "component_id", "kept")


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text, A-Z lower-cased.

    A text of fewer words is one shingle of all of them; without words it has none.
    """
    data, starts, ends = joined(texts)
    data = lower_ascii(data)
    begin, end = word_spans(data)
    words = Rolling(word_hashes(data, begin, end))
    first = np.searchsorted(begin, starts)
    last = np.searchsorted(begin, ends)
    grams = words.grams(k)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        else:
            out.append(words.of(np.array([a]), np.array([b])) if b > a else grams[:0])
    return out


def _borrow_order(bins: int) -> np.ndarray:
    """For each bin, all bins in a fixed random order."""
    i = np.arange(bins * bins, dtype=np.uint64)
    return np.argsort(mix(i + np.uint64(1)).reshape(bins, bins), axis=1)


def signatures(sets: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Densified one-permutation signatures, a row per set (all sets non-empty)."""
    bins = len(order)
    out = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros(out.shape, bool)
    for i, s in enumerate(sets):
        at = ((s >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)  # grows with s: the first of a bin is its least
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        out[i, at[first]] = s[first]
        filled[i, at[first]] = True
    row, column = np.nonzero(~filled)
    for step in range(bins):
        if not row.size:
            break
        donor = order[column, step]
        hit = filled[row, donor]
        out[row[hit], column[hit]] = out[row[hit], donor[hit]]
        row, column = row[~hit], column[~hit]
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for every band of every signature."""
    part = signature.reshape(-1, bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for r in range(rows):
        key = mix(key + part[:, :, r])
    return key


def _sketch(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """(_id, _n, _a, _b, _keys) of every row: set size, 128-bit digest of the set, band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = _borrow_order(bands * rows)
        for part, texts in batches_of_texts(batches, "_text", raw=True):
            sets = shingle_sets(texts, k)
            full = [s for s in sets if s.size]
            keys = iter(band_keys(signatures(full, order), bands, rows).view(np.int64)) if full else iter(())
            yield pa.RecordBatch.from_arrays([
                part.column("_id"), pa.array([s.size for s in sets], pa.int64()),
                pa.array(np.array([s.sum() for s in sets], np.uint64).view(np.int64)),
                pa.array(np.array([mix(s).sum() for s in sets], np.uint64).view(np.int64)),
                pa.array([next(keys) if s.size else None for s in sets], pa.list_(pa.int64()))],
                names=["_id", "_n", "_a", "_b", "_keys"])

    return (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
            .mapInArrow(run, "_id bigint, _n bigint, _a bigint, _b bigint, _keys array<bigint>"))


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(_id, _set) of the documents in ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in batches_of_texts(batches, "_text", raw=True):
            sets = [s.view(np.int64) for s in shingle_sets(texts, k)]
            yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["_id", "_set"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.join(ids, "_id", "left_semi").mapInArrow(run, "_id bigint, _set array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (x, y) whose sets overlap enough."""
    both = (pairs.join(sets.select(F.col("_id").alias("y"), F.col("_set").alias("_t")), "y")
            .join(sets.select(F.col("_id").alias("x"), F.col("_set").alias("_s")), "x")
            .withColumn("_both", F.size(F.array_intersect("_s", "_t"))))
    return both.where(100 * F.col("_both") >= percent * (F.size("_s") + F.size("_t") - F.col("_both"))).select("x", "y")


def _pairs(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Distinct (x, y), x < y, of centres and members of a bucket that are of unlike components and alike sizes."""
    c = centres.select("_key", F.col("_id").alias("_c"), F.col("_n").alias("_m"), F.col("_comp").alias("_other"))
    rows = (members.join(c, "_key").where("_comp <> _other")
            .where(100 * F.least("_n", "_m") >= percent * F.greatest("_n", "_m")))
    return rows.select(F.least("_id", "_c").alias("x"), F.greatest("_id", "_c").alias("y")).distinct()


def _alike(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct (x, y), x < y, of ``docs`` (_id, _n, _comp) of unlike components; every link between them is among these.

    Shingles of a document are ordered by rarity. Of two sets that overlap enough the first common shingle stands
    so early in both that those from there on suffice for the overlap, so only these places are joined. A shingle
    of one document alone takes a place and is not joined.
    """
    grams = docs.join(sets, "_id").select("_id", "_n", "_comp", F.explode("_set").alias("_g"))
    common = grams.groupBy("_g").agg(F.count(F.lit(1)).alias("_f")).where("_f > 1")
    ordered = grams.join(common, "_g").groupBy("_id", "_n", "_comp").agg(
        F.sort_array(F.collect_list(F.struct("_f", "_g"))).alias("_s"))
    # _rest: shingles of the document from this place on
    placed = (ordered.select("_id", "_n", "_comp", F.size("_s").alias("_k"), F.posexplode("_s").alias("_at", "_s"))
              .select("_id", "_n", "_comp", (F.col("_k") - F.col("_at")).cast("long").alias("_rest"), F.col("_s._g").alias("_g")))
    places = materialize(placed.where(100 * F.col("_rest") >= percent * F.col("_n")), "minhash-prefixes")
    # a shingle joins what lies outside its largest component with all of it, so a large component costs its size once
    per = places.groupBy("_g", "_comp").agg(F.count(F.lit(1)).alias("_f"))
    mixed = (per.groupBy("_g").agg(F.max(F.struct("_f", "_comp"))["_comp"].alias("_main"), F.count(F.lit(1)).alias("_comps"))
             .where("_comps > 1").select("_g", "_main"))
    places = materialize(places.join(mixed, "_g"), "minhash-mixed-prefixes")
    outside = places.where("_comp <> _main").select("_g", F.col("_id").alias("_c"), F.col("_n").alias("_m"),
                                                    F.col("_comp").alias("_other"), F.col("_rest").alias("_left"))
    rows = (places.join(outside, "_g").where("_comp <> _other AND (_comp = _main OR _c < _id)")
            .where(100 * F.least("_n", "_m") >= percent * F.greatest("_n", "_m"))
            .where((100 + percent) * F.least("_rest", "_left") >= percent * (F.col("_n") + F.col("_m"))))
    return rows.select(F.least("_id", "_c").alias("x"), F.greatest("_id", "_c").alias("y")).distinct()


def _mixed(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members (with ``_comp``) of the buckets whose members are of several components."""
    now = members.join(comps, "_id")
    several = (now.groupBy("_key").agg(F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi"))
               .where("_lo <> _hi").select("_key"))
    return now.join(several, "_key", "left_semi")


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links (x, y): those of the components they connect."""
    of = lambda c: comps.select(F.col("_id").alias(c), F.col("_comp").alias(f"_{c}"))
    between = (links.join(of("x"), "x").join(of("y"), "y").where("_x <> _y")
               .select(F.col("_x").alias("x"), F.col("_y").alias("y")).distinct())
    between = materialize(between, "minhash-between")
    labels = components(between.select(F.explode(F.array("x", "y")).alias("_id")).distinct(), between)
    joined = comps.join(labels.select(F.col("_id").alias("_comp"), F.col("_comp").alias("_new")), "_comp", "left")
    return materialize(joined.select("_id", F.coalesce("_new", "_comp").alias("_comp")), "minhash-components")


def near_links(nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """Components (_id, _comp) of the documents in ``nodes`` (_id, _n, _keys) that share a bucket with another."""
    keyed = nodes.select("_id", "_n", F.explode("_keys").alias("_key"))
    shared = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    members = materialize(keyed.join(shared, "_key").dropDuplicates(["_key", "_id"]), "minhash-buckets")
    ids = materialize(members.select("_id").distinct(), "minhash-nodes")
    sets = materialize(_sets(docs, ids, id_col, text_col, k).dropDuplicates(["_id"]), "minhash-sets")

    # the smallest identifier of each bucket is its centre
    least = members.groupBy("_key").agg(F.min(F.struct("_id", "_n")).alias("_least"))
    centres = least.select("_key", F.col("_least._id").alias("_id"), F.col("_least._n").alias("_n"),
                           F.col("_least._id").alias("_comp"))
    links = materialize(_confirmed(_pairs(members.withColumn("_comp", F.col("_id")), centres, percent), sets, percent),
                        "minhash-links")
    comps = _merged(ids.select("_id", F.col("_id").alias("_comp")), links)

    # then the member with most links, of buckets that are mixed
    now = materialize(_mixed(members, comps), "minhash-mixed")
    degree = links.select(F.explode(F.array("x", "y")).alias("_id")).groupBy("_id").agg(F.count(F.lit(1)).alias("_degree"))
    linked = now.join(degree, "_id", "left").select("_key", F.struct(
        F.coalesce("_degree", F.lit(0)).alias("d"), (-F.col("_id")).alias("i"), "_id", "_n", "_comp").alias("_m"))
    best = linked.groupBy("_key").agg(F.max("_m").alias("_m")).select("_key", "_m._id", "_m._n", "_m._comp")
    more = materialize(_confirmed(_pairs(now, best, percent), sets, percent), "minhash-links")
    comps = _merged(comps, more)

    # the rest exactly
    rest = materialize(_mixed(now.drop("_comp"), comps).select("_id", "_n", "_comp").distinct(), "minhash-rest")
    more = materialize(_confirmed(_alike(rest, sets, percent), sets, percent), "minhash-links")
    return _merged(comps, more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Two documents are linked when 100 * |A & B| >= ``percent`` * |A | B| for
    their sets of k-word shingles; ``component_id`` is the smallest identifier
    reachable over links. Equal sets are one node, so copies need no pairs.
    A null or empty text, or one without words, has no shingle and is linked
    with nothing; nor is a row with a null identifier, whose component is null
    and which is kept. Rows that repeat an identifier are one document: they
    are linked. An empty table gives an empty result.
    """
    rows_of = materialize(_sketch(docs, id_col, text_col, k, bands, rows), "minhash-sketch")
    full = rows_of.where("_n > 0 AND _id IS NOT NULL")
    same = full.groupBy("_a", "_b", "_n").agg(F.min(F.struct("_id", "_keys")).alias("_rep"))
    nodes = same.select(F.col("_rep._id").alias("_id"), "_n", F.col("_rep._keys").alias("_keys"))
    comps = near_links(nodes, docs, id_col, text_col, k, percent)
    label = (same.select("_a", "_b", "_n", F.col("_rep._id").alias("_node"))
             .join(comps.withColumnRenamed("_id", "_node"), "_node", "left")
             .select("_a", "_b", "_n", F.coalesce("_comp", "_node").alias("_comp")))
    out = rows_of.select("_id", "_n", "_a", "_b").join(label, ["_a", "_b", "_n"], "left")
    own = F.when(F.col("_n") > 0, F.coalesce("_comp", "_id")).otherwise(F.col("_id"))
    out = out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"),
                     F.when(F.col("_id").isNotNull(), own).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
