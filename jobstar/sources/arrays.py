"""JSON array files read by many tasks.

A file with one JSON array cannot be cut at any byte: whether a brace is
structure or text depends on all quotes before it. Spark's text source cuts a
file into blocks at closing braces here. A block alone does not know whether it begins
inside a string, nor how deep, so its summary says what it does in either case: how many quotes it has (odd: it
ends the other way) and by how much the depth changes. Summaries compose associatively, so a
running sum over the few blocks of a file tells each where it begins. A second
scan then cuts every block at the commas between records. What a block has before its first and
after its last cut goes together with its neighbours' ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLANK = b" \t\r\n\xef\xbb\xbf"  # and a byte order mark
_QUOTE, _SLASH, _COMMA, _BRACE = ord('"'), ord("\\"), ord(","), b"}"
_STEP = np.zeros(256, np.int64)
_STEP[[ord("["), ord("{")]], _STEP[[ord("]"), ord("}")]] = 1, -1


def quotes(data: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that begin or end a string: those after an even number of backslashes.

    ``data`` begins where no backslash is pending, as it does after a closing brace.
    """
    slash = data == _SLASH
    place = np.arange(data.size)
    last_other = np.maximum.accumulate(np.where(slash, -1, place))
    run = place - last_other  # backslashes that end here
    escaped = np.zeros(data.size, bool)
    escaped[1:] = run[:-1] % 2 == 1
    return (data == _QUOTE) & ~escaped


def depths(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Whether each byte lies outside strings, and the change of depth at it."""
    marks = quotes(data)
    outside = (np.cumsum(marks) + int(inside)) % 2 == 0
    return outside & ~marks, np.where(outside & ~marks, _STEP[data], 0)


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, size, value): the text up to each closing brace, in order within a block (file, start)."""
    text = spark.read.text(path, lineSep="}")
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The pieces of a batch that are of one block each."""
    file, start = batch.column("file").dictionary_encode(), batch.column("start").to_numpy()
    code = file.indices.to_numpy()
    edges = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield file.dictionary[int(code[a])].as_py(), int(start[a]), batch.slice(a, b - a)


def _bytes(batch: pa.RecordBatch) -> bytes:
    return _BRACE.join(batch.column("value").to_pylist()) + _BRACE


def block_summaries(fragments: DataFrame) -> DataFrame:
    """(file, start, size, odd, out, ins, bytes, first): a block's quotes (odd or even), its change of depth if it begins
    outside and inside a string, its bytes, and the first that is not blank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(at, size, odd, out, ins, n, first) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "file": [at[0]], "start": [at[1]], "size": [size], "odd": pa.array([odd], pa.int32()), "out": [out],
                "ins": [ins], "bytes": [n], "first": pa.array([first], pa.string())})
        at, now = None, None
        for batch in batches:
            for file, start, part in _runs(batch):
                if (file, start) != at:
                    if now:
                        yield row(at, *now)
                    at, now = (file, start), [part.column("size")[0].as_py(), 0, 0, 0, 0, None]
                raw = _bytes(part)
                data = np.frombuffer(raw, np.uint8)
                _, a = depths(data, False)
                _, b = depths(data, True)
                change = (int(a.sum()), int(b.sum()))
                now[2] += change[now[1]]  # began outside: an odd number of quotes since puts this part inside
                now[3] += change[1 - now[1]]
                now[1] = (now[1] + int(quotes(data).sum())) % 2
                now[4] += data.size
                now[5] = now[5] or raw.lstrip(_BLANK)[:1].decode("latin-1") or None
        if now:
            yield row(at, *now)

    return fragments.mapInArrow(run, "file string, start bigint, size bigint, odd int, out bigint, ins bigint, bytes bigint, first string")


def block_starts(summaries: DataFrame) -> DataFrame:
    """(file, start, inside, depth, trim, array): how each block begins; ``trim`` where its last brace is not in the file,
    ``array`` whether the file begins with a bracket."""
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    known = summaries.withColumn("inside", inside == 1)
    change = F.when(F.col("inside"), F.col("ins")).otherwise(F.col("out"))
    last = F.col("start") == F.max("start").over(whole)
    # a brace counted for each text up to one: as many bytes as the file has (the source drops a byte order mark) if it
    # ends with a brace; a compressed file's size says nothing, and an array does not end with one
    ends = (F.sum("bytes").over(whole) - F.col("size")).isin(0, -3)
    first = F.first("first", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return known.withColumn("change", change).select(
        "file", "start", "inside", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
        (last & ~ends).alias("trim"), (F.coalesce(first, F.lit("")) == "[").alias("array"))


_PIECES = "file string, start bigint, kind int, opens string, closes string, text binary"


def _cut(fragments: DataFrame) -> DataFrame:
    """Pieces of the blocks between cuts: ``kind`` 1 a whole element, 0 up to the first cut, 2 from the last, 3 a block without cut."""
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, depth, held, opens, trim = None, False, 0, [], None, False

        def end() -> list[tuple]:
            """The open rest of a block."""
            text = b"".join(held)
            return [(*at, 3 if opens is None else 2, opens, None, text[:-1] if trim else text)] if at else []

        for batch in batches:
            out: list[tuple] = []
            for file, start, part in _runs(batch):
                if (file, start) != at:
                    out += end()
                    first = part.slice(0, 1).to_pylist()[0]
                    at, inside, depth, held, opens = (file, start), first["inside"], first["depth"], [], None
                trim = part.column("trim")[0].as_py()
                raw = _bytes(part)
                data = np.frombuffer(raw, np.uint8)
                outside, step = depths(data, inside)
                after = depth + np.cumsum(step)
                cuts = [] if not part.column("array")[0].as_py() else np.flatnonzero((outside & (data == _COMMA) & (after == 1)) | ((step == 1) & (after == 1) & (data == ord("[")))
                                      | ((step == -1) & (after == 0) & (data == ord("]")))).tolist()
                begin = 0
                for c in cuts:
                    text = b"".join([*held, raw[begin:c]])
                    out.append((*at, 0 if opens is None else 1, opens, chr(raw[c]), text))
                    held, opens, begin = [], chr(raw[c]), c + 1
                held.append(raw[begin:])
                inside = bool((int(inside) + int(quotes(data).sum())) % 2)
                depth = int(after[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.string(),
                                                                         pa.string(), pa.binary()))], names=names)
        if at:
            (r,) = end()
            yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, r)}, schema=pa.schema(
                list(zip(names, (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.binary())))))

    return fragments.mapInArrow(run, _PIECES)


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, value): the text of every element of the JSON arrays in the files of ``path``.

    Files are cut at any size (``spark.sql.files.maxPartitionBytes``), so one file feeds many tasks. The order of the
    elements is not kept. Elements of a damaged file before the damage, and those of a truncated one but the last, come
    whole. What stands before or after the array comes as an element of its own, so that it is seen to be no record; blank parts
    between the brackets and beside them do not. A file without an array is one element.
    """
    fragments = _fragments(spark, path).withColumn("row", F.monotonically_increasing_id())
    starts = block_starts(block_summaries(fragments.drop("row")))
    # as Spark decides by the size of the small side; either way a block stays in one task, in order
    placed = (fragments.join(starts, ["file", "start"])
              .sortWithinPartitions("file", "start", "row").select("file", "start", "inside", "depth", "trim", "array", "value"))
    pieces = _cut(placed)
    whole = pieces.where("kind = 1").select("file", "opens", "closes", "text")
    # ends of neighbouring blocks: each piece from a last cut on begins an element
    ends = pieces.where("kind <> 1").withColumn("side", F.when(F.col("kind") == 2, 1).otherwise(0))
    order = Window.partitionBy("file").orderBy("start", "side")
    ends = ends.withColumn("element", F.sum("side").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = F.sort_array(F.collect_list(F.struct("start", "side", "text")))
    joined = ends.groupBy("file", "element").agg(parts.alias("parts"), F.max("opens").alias("opens"), F.max("closes").alias("closes"))
    text = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["text"]))
    every = whole.unionByName(joined.select("file", "opens", "closes", text.alias("text")))
    value = F.col("text").cast("string")
    blank = F.trim(F.translate(value, "\r\n\t﻿", "   ")) == ""
    edge = F.col("opens").isNull() | F.col("closes").isNull() | F.col("opens").isin("[", "]") | F.col("closes").isin("[", "]")
    return every.where(~(blank & edge)).select(F.col("file").alias("source_file"), value.alias("value"))
