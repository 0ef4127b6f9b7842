"""Common frame of the two substring operators (4 and 10): candidates, buckets, and removal.

A window is a run of ``window`` symbols (bytes, or words). Each window has an
*anchor*, its k-gram of smallest hash, chosen by content alone, so equal windows have
their anchors at equal distances. Only anchors whose gram occurs twice or
more can lie in a repeated window. The *context* of an anchor is all
symbols that a window with this anchor can cover. Equal contexts are counted
once. Where a gram has several different contexts, these form a bucket, and a
solver (suffix array or FM-index) finds which of a context's windows are shared.

A gram may occur in a large part of all rows. Equal contexts are
pre-aggregated; a bucket that still has more than ``limit`` contexts is not given to one task
but split by content: windows are grouped by ranges of offsets, by hash of what all
windows of a range share, and where that does not settle it, by hash of the window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar.llm.text import Rolling, anchors, batches_of_texts, joined, mix, word_hashes, word_spans
from jobstar.session import discard, materialize

NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Kind:
    """What a window is, and when it counts as repeated."""

    words: bool  # symbols are words, else bytes
    window: int
    gram: int
    earlier: bool  # repeated only if it also occurs in a row of smaller identifier
    limit: int = 20_000  # contexts of a bucket that one task takes
    chunk: int = 2_000  # contexts that are worked on at a time, whole buckets
    parts: int = 13  # offsets of a range, where a bucket is split

    @property
    def left(self) -> int:
        """Symbols before the anchor that a window can cover."""
        return self.window - self.gram


class Symbols:
    """The symbols of some texts, one after the other, with the hash of any run of them."""

    def __init__(self, texts: list[bytes], words: bool):
        data, starts, ends = joined(texts)
        self.data, self.words = data, words
        if words:
            self.begin, self.end = word_spans(data)
            self.values = word_hashes(data, self.begin, self.end)
            self.starts, self.ends = np.searchsorted(self.begin, starts), np.searchsorted(self.begin, ends)
        else:
            self.values, self.starts, self.ends = data, starts, ends
        self.rolling = Rolling(self.values)

    def context(self, a: int, b: int) -> bytes:
        """Symbols a..b: the bytes, or the 64-bit hash of each word."""
        return self.values[a:b].tobytes()


def _pack(place, left, right):
    return (place << 32) | (left << 16) | right


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Identifier and hash of the text tell rows apart; a null identifier counts as the smallest."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
                       F.xxhash64(F.col(text_col)).alias("_k"), F.col(text_col).cast("string").alias("_text"))


def _anchor_rows(rows: DataFrame, kind: Kind) -> DataFrame:
    """(_g, _c, _id, _k, _at): gram, context, row, and place with the context's reach, of every anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in batches_of_texts(batches, "_text", raw=True):
            s = Symbols(texts, kind.words)
            at = anchors(s.rolling, s.starts, s.ends, kind.window, kind.gram)
            doc = np.searchsorted(s.starts, at, "right") - 1
            left = np.minimum(at - s.starts[doc], kind.left)
            right = np.minimum(s.ends[doc] - at, kind.window)
            context = mix(s.rolling.of(at - left, at + right) + left.astype(np.uint64))
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.rolling.of(at, at + kind.gram).view(np.int64)), pa.array(context.view(np.int64)),
                 part.column("_id").take(take), part.column("_k").take(take),
                 pa.array(_pack(at - s.starts[doc], left, right))], names=["_g", "_c", "_id", "_k", "_at"])

    return rows.mapInArrow(run, "_g bigint, _c bigint, _id bigint, _k bigint, _at bigint")


_CONTEXT = "_g bigint, _c bigint, _id bigint, _left int, _symbols binary, _cores array<bigint>, _spans array<bigint>, _windows array<bigint>"


def _ranges_of(kind: Kind) -> list[tuple[int, int]]:
    return [(lo, min(lo + kind.parts - 1, kind.left)) for lo in range(0, kind.left + 1, kind.parts)]


def _contexts(rows: DataFrame, wanted: DataFrame, kind: Kind) -> DataFrame:
    """The contexts that ``wanted`` lists for each row: their symbols, or for a split bucket their hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = _ranges_of(kind)
        for part, texts in batches_of_texts(batches, "_text", raw=True):
            s = Symbols(texts, kind.words)
            out: list[list] = [[] for _ in range(8)]
            for i, (ident, lists) in enumerate(zip(part.column("_id").to_pylist(), part.column("_list").to_pylist())):
                base = int(s.starts[i])
                for e in lists:
                    at, left, right = base + (e["_at"] >> 32), (e["_at"] >> 16) & 0xFFFF, e["_at"] & 0xFFFF
                    row = [e["_g"], e["_c"], ident, left, None, None, None, None]
                    if e["_hot"]:
                        of = lambda a, b: int(s.rolling.of(np.array([a]), np.array([b])).view(np.int64)[0])
                        # offsets whose windows lie within the row
                        ok = lambda d: d <= left and kind.window - d <= right
                        row[5], row[6] = [], []
                        for lo, hi in spans:
                            d = [x for x in range(lo, hi + 1) if ok(x)]
                            # what all windows of the whole range share lies within the row if any of them does
                            row[5].append(of(at - lo, at + kind.window - hi) ^ lo if d else None)
                            row[6].append(of(at - d[-1], at + kind.window - d[0]) ^ len(d) ^ (d[0] << 32) if d else None)
                        row[7] = [of(at - d, at - d + kind.window) ^ d if ok(d) else None for d in range(kind.left + 1)]
                    else:
                        row[4] = s.context(at - left, at + right)
                    for column, x in zip(out, row):
                        column.append(x)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), *[pa.list_(pa.int64())] * 3]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)],
                names=["_g", "_c", "_id", "_left", "_symbols", "_cores", "_spans", "_windows"])

    return rows.join(wanted, ["_id", "_k"]).mapInArrow(run, _CONTEXT)


Solver = Callable[[np.ndarray, np.ndarray, np.ndarray, list[bytes], Kind], tuple[np.ndarray, np.ndarray]]


def _solved(contexts: DataFrame, kind: Kind, solve: Solver) -> DataFrame:
    """(_g, _c, _lo, _hi): least and largest offset of a context's repeated windows.

    Buckets arrive one after the other; whole buckets are worked on together
    up to ``kind.chunk`` contexts, so a task holds no more than ``kind.limit`` + ``kind.chunk``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts)
            g, c, ident, left = (t.column(n).to_numpy() for n in ("_g", "_c", "_id", "_left"))
            lo, hi = solve(g, ident, left, t.column("_symbols").to_pylist(), kind)
            hit = hi >= 0
            return pa.RecordBatch.from_arrays(
                [pa.array(g[hit]), pa.array(c[hit]), pa.array(lo[hit].astype(np.int32)), pa.array(hi[hit].astype(np.int32))],
                names=["_g", "_c", "_lo", "_hi"])

        for b in batches:
            while b.num_rows:
                g = b.column("_g").to_numpy()
                count = sum(p.num_rows for p in held)
                if count >= kind.chunk and g[0] != held[-1].column("_g")[-1].as_py():
                    yield work(held)
                    held, count = [], 0
                # up to the end of the bucket in which the chunk is full
                stop = b.num_rows
                if count + b.num_rows > kind.chunk:
                    at = max(0, kind.chunk - count - 1)
                    stop = int(np.searchsorted(g, g[at], "right"))
                held.append(b.slice(0, stop))
                b = b.slice(stop)
        if held:
            yield work(held)

    # sorted, so that a bucket's contexts follow each other; signed order, as searchsorted expects
    return (contexts.select("_g", "_c", "_id", "_left", "_symbols").repartition("_g").sortWithinPartitions("_g")
            .mapInArrow(run, "_g bigint, _c bigint, _lo int, _hi int"))


def _split(contexts: DataFrame, kind: Kind) -> DataFrame:
    """The same for the contexts of large buckets, by grouping hashes; no group meets in one task."""
    rows = contexts.select("_g", "_c", "_id", "_windows",
                           F.posexplode(F.arrays_zip("_cores", "_spans")).alias("_part", "_r"))
    rows = rows.where("_r._cores IS NOT NULL").select(
        "_g", "_c", "_id", "_windows", "_part", F.col("_r._cores").alias("_core"), F.col("_r._spans").alias("_span"))
    core = rows.groupBy("_g", "_part", "_core").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_span").alias("_a"), F.max("_span").alias("_b"),
        F.min("_id").alias("_first")).where("_n > 1")
    rows = rows.join(core, ["_g", "_part", "_core"])
    lo = F.col("_part") * kind.parts
    inside = F.filter(F.transform(F.sequence(lo, F.least(lo + kind.parts - 1, F.lit(kind.left))),
                                  lambda d: F.struct(d.alias("d"), F.get("_windows", d).alias("h"))),
                      lambda x: x["h"].isNotNull())
    rows = rows.select("_g", "_c", "_id", "_first", (F.col("_a") == F.col("_b")).alias("_same"), inside.alias("_in"))
    known = rows.where("_same")
    if kind.earlier:
        known = known.where("_id > _first")
    known = known.select("_g", "_c", F.get("_in", F.lit(0))["d"].alias("_lo"),
                         F.get("_in", F.size("_in") - 1)["d"].alias("_hi"))
    open_ = rows.where("NOT _same").select("_g", "_c", "_id", F.explode("_in").alias("_w")).select(
        "_g", "_c", "_id", F.col("_w.d").alias("_d"), F.col("_w.h").alias("_h"))
    window = open_.groupBy("_g", "_d", "_h").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")).where("_n > 1")
    found = open_.join(window, ["_g", "_d", "_h"])
    if kind.earlier:
        found = found.where("_id > _first")
    return known.unionByName(found.select("_g", "_c", F.col("_d").alias("_lo"), F.col("_d").alias("_hi")))


def repeated_spans(rows: DataFrame, kind: Kind, solve: Solver) -> DataFrame:
    """(_id, _k, _list): for each row of ``keyed`` with repeated windows, the spans of symbols these cover."""
    found = materialize(_anchor_rows(rows, kind), "repeats-anchors")
    first = F.min("_id") if kind.earlier else F.max(F.lit(NO_ID))  # who has a gram first matters to one kind only
    grams = found.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), F.min("_c").alias("_a"), F.max("_c").alias("_b"),
                                    first.alias("_first")).where("_n > 1")
    # stored, so that the join's sides come straight from shuffles, whose hot keys can be split
    grams = materialize(grams, "repeats-grams")
    twice = materialize(found.join(grams.select("_g", "_first", (F.col("_a") != F.col("_b")).alias("_mixed")), "_g"),
                        "repeats-candidates")
    discard(found)
    # one context each of those grams that have several
    mixed = twice.where("_mixed")
    least = mixed.groupBy("_g", "_c").agg(F.count(F.lit(1)).alias("_m"), F.min(F.struct("_id", "_k", "_at")).alias("_rep"))
    size = least.groupBy("_g").agg((F.count(F.lit(1)) > kind.limit).alias("_hot"))
    least = materialize(least.join(size, "_g"), "repeats-contexts")
    wanted = least.groupBy(F.col("_rep._id").alias("_id"), F.col("_rep._k").alias("_k")).agg(
        F.collect_list(F.struct("_g", "_c", F.col("_rep._at").alias("_at"), "_hot")).alias("_list"))
    contexts = _contexts(rows, wanted, kind)
    if least.where("_hot").isEmpty():
        shared = _solved(contexts, kind, solve)
    else:
        contexts = materialize(contexts, "repeats-texts")
        shared = _solved(contexts.where("_symbols IS NOT NULL"), kind, solve).unionByName(
            _split(contexts.where("_windows IS NOT NULL"), kind))
    shared = shared.groupBy("_g", "_c").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    info = least.select("_g", "_c", "_m", F.col("_rep._id").alias("_own")).join(shared, ["_g", "_c"], "left")
    # stored for the same reason: a passage that many rows have makes a hot key of the join below
    info = materialize(info, "repeats-info")
    discard(least)

    place, left, right = (F.shiftright("_at", 32), F.shiftright("_at", 16).bitwiseAND(0xFFFF), F.col("_at").bitwiseAND(0xFFFF))
    whole = F.struct((place - left).alias("a"), (place + right).alias("b"))
    some = F.struct((place - F.col("_hi")).alias("a"), (place - F.col("_lo") + kind.window).alias("b"))
    long = left + right >= kind.window
    copied = F.col("_id") > F.col("_own") if kind.earlier else F.col("_m") > 1
    spans = mixed.join(info, ["_g", "_c"]).select(
        "_id", "_k", F.when(copied & long, whole).when(F.col("_hi").isNotNull(), some).alias("_span"))
    plain = twice.where("NOT _mixed")
    if kind.earlier:
        plain = plain.where("_id > _first")
    spans = spans.unionByName(plain.where(long).select("_id", "_k", whole.alias("_span"))).where("_span IS NOT NULL")
    return spans.groupBy("_id", "_k").agg(F.collect_list("_span").alias("_list"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Spans in order, those that touch joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame, kind: Kind, solve: Solver, id_col: str, text_col: str,
                    names: tuple[str, str, str, str]) -> DataFrame:
    """``docs`` with total and removed symbols, removed spans and what is kept, under ``names``."""
    docs = docs.drop(*names)
    columns = docs.columns
    own = [f"c{i}" for i in range(len(columns))]  # no helper column has such a name
    id_col, text_col = own[columns.index(id_col)], own[columns.index(text_col)]
    docs = docs.toDF(*own)
    spans = repeated_spans(keyed(docs, id_col, text_col), kind, solve)
    key = {"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "_k": F.xxhash64(F.col(text_col))}
    rows = docs.withColumns(key).join(spans, ["_id", "_k"], "left")
    rows = rows.select(*docs.columns, "_list")
    kept_type = "string" if kind.words else "binary"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        f"{names[0]} bigint, {names[1]} bigint, {names[2]} array<struct<a:bigint,b:bigint>>, {names[3]} {kept_type}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in batches_of_texts(batches, text_col, raw=True):
            lists = part.column("_list").to_pylist()
            total, gone, spans_of, kept = [], [], [], []
            s = Symbols(texts, True) if kind.words else None
            for i, (text, found) in enumerate(zip(texts, lists)):
                cuts = merged(found)
                first, last = (int(s.starts[i]), int(s.ends[i])) if s else (0, len(text))
                edges = [0, *(x for cut in cuts for x in cut), last - first]
                stay = [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]
                if s:
                    words = [s.data[x:y].tobytes() for a, b in stay
                             for x, y in zip(s.begin[first + a:first + b].tolist(), s.end[first + a:first + b].tolist())]
                    kept.append(b" ".join(words).decode("utf-8", "replace"))
                else:
                    kept.append(b"".join([text[a:b] for a, b in stay]) if cuts else text)
                total.append(last - first)
                gone.append(sum(b - a for a, b in cuts))
                spans_of.append([{"a": a, "b": b} for a, b in cuts])
            kind_of = pa.string() if kind.words else pa.binary()
            rest = [part.column(f) for f in part.schema.names if f != "_list"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(spans_of, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(kept, kind_of)],
                names=[*(f for f in part.schema.names if f != "_list"), *names])

    return rows.mapInArrow(run, schema).toDF(*columns, *names)
