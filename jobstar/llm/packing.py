"""Sequence packing by exact-complement hashing, then best fit (operator 5).

Documents are tokenised and cut into pieces of at most ``capacity`` ids.
Only the number of pieces of each length reaches the driver (at most
``capacity`` counts, whatever the corpus). On these counts the plan is made:
gaps are filled exactly by one, two or three available lengths, as many
sequences at a time as the counts allow; what is left goes by best fit.
The plan says how many sequences have which lengths; Spark then numbers the
pieces of each length and gives each its place.
"""

from __future__ import annotations

import ctypes
import threading
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobstar.llm.text import IS_SPACE, batches_of_texts, joined, ranges, word_spans
from jobstar.session import materialize

CAPACITY, END_ID = 4096, 1
CACHE_WORDS = 600_000  # units a generation of a Python worker's cache holds
IDLE_S = 0.3  # after which a worker without a task drops its cache

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"
RESULT = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _kinds() -> np.ndarray:
    """Kind of every ASCII byte: 1 letters, 2 digits, 3 what joins to one pre-token; 0 all else, apostrophes among them."""
    table = np.zeros(256, np.uint8)
    table[[i for i in range(33, 127) if i != ord("'")]] = 3
    table[[*range(65, 91), *range(97, 123)]] = 1
    table[48:58] = 2
    return table


_KIND = _kinds()
# fixed: second bytes of the letters U+00C0..U+00FF, which NFC and lower-casing leave one letter each
_LATIN = np.zeros(256, bool)
_LATIN[[i for i in range(0x80, 0xC0) if i not in (0x97, 0xB7)]] = True


def units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the units that a text is encoded by, and whether each is a single pre-token.

    A word of ASCII and Latin-1 letters, digits and signs is cut into its pre-tokens: runs of
    letters, runs of signs and single digits. Any other stays whole, as do words with
    an apostrophe (contractions) or ``<|`` (special tokens). ``data`` ends with a separator.
    """
    begin, end = word_spans(data)
    kind = _KIND[data]
    latin = np.flatnonzero(data[:-1] == 0xC3)
    latin = latin[_LATIN[data[latin + 1]]]
    kind[latin] = kind[latin + 1] = 1
    odd = (kind == 0) & ~IS_SPACE[data]
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    whole = np.zeros(begin.size, bool)
    whole[np.searchsorted(begin, np.flatnonzero(odd), "right") - 1] = True
    cut = np.flatnonzero(((kind[1:] != kind[:-1]) | (kind[1:] == 2)) & ~IS_SPACE[data[1:]] & ~IS_SPACE[data[:-1]]) + 1
    word = np.searchsorted(begin, cut, "right") - 1
    cut, word = cut[~whole[word]], word[~whole[word]]
    count = np.bincount(word, minlength=begin.size) + 1
    starts, ends = np.empty(begin.size + cut.size, begin.dtype), np.empty(begin.size + cut.size, begin.dtype)
    first = np.cumsum(count) - count
    inner = np.ones(starts.size, bool)
    inner[first] = False
    starts[first], starts[inner] = begin, cut
    last = np.ones(starts.size, bool)
    last[first + count - 1] = False
    ends[first + count - 1], ends[last] = end, cut
    return starts, ends, np.repeat(~whole, count)


def give_back() -> None:
    """Return freed memory to the system, where the C library can; it keeps some for the process otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class WordTokenizer:
    """Ids of texts by a tokenizer file, unit by unit.

    The tokenizer drops white space and never joins what it separates, nor
    pre-tokens, so a text's ids are those of its ``units`` in order. Each worker keeps the ids of
    the units it meets, in two generations of bounded size, and looks each up
    once for a slice of texts. Many new single pre-tokens are encoded in one
    call and told apart by the tokens that end a word.
    """

    _loaded: dict[str, WordTokenizer] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}
        self.timer: threading.Timer | None = None

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        coder = cls._loaded.get(path)
        if coder is not None and coder.timer is not None:  # ended before words are looked up
            coder.timer.cancel()
            coder.timer.join()
            coder.timer = None
        if coder is None or coder.tokenizer is None:  # dropped
            coder = cls._loaded[path] = cls(path)
        return coder

    def rest(self) -> None:
        """Drop the units learnt and the tokenizer unless another task comes soon, and give the memory
        back to the system: an idle worker would hold it beside later stages."""
        def forget() -> None:
            self.known, self.old = {b"": b""}, {}
            self._loaded.pop(self.path, None)
            self.tokenizer = None
            give_back()

        self.timer = threading.Timer(IDLE_S, forget)
        self.timer.daemon = True
        self.timer.start()

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, words: list[bytes], single: list[bool]) -> None:
        """Learn units that are not known."""
        known, get = self.known, self.old.get
        plain, other = [], []
        for w, one in zip(words, single):
            found = get(w)
            if found is not None:
                known[w] = found
            elif one:
                plain.append(w)
            else:
                other.append(w)
        for at in range(0, len(plain), 2000):
            part = plain[at:at + 2000]
            (ids,) = self._encoded([b" ".join(part).decode()])
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(part):
                raise ValueError(f"{len(part)} words gave {len(ends)} word ends")
            raw = ids.tobytes()
            known.update(zip(part, [raw[a:b] for a, b in zip([0, *ends], ends)]))
        known.update(zip(other, [ids.tobytes() for ids in self._encoded([w.decode("utf-8", "replace") for w in other])]))

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text.

        Words end at ASCII white space. A text of ASCII alone is
        lower-cased first, as the tokenizer does after looking for special tokens.
        """
        data, starts, _ = joined([t.lower() if t.isascii() and b"<|" not in t else t for t in texts])
        begin, end, single = units(data)
        offsets = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), begin.size, [
            None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[~IS_SPACE[data]]))]).dictionary_encode()
        which = words.indices.to_numpy(zero_copy_only=False)
        distinct = words.dictionary.to_numpy(zero_copy_only=False)  # far faster than a list from Arrow
        if len(self.known) > CACHE_WORDS:
            self.known, self.old = {b"": b""}, self.known
        known = self.known
        single_of = np.empty(distinct.size, bool)
        single_of[which] = single
        coded = list(map(known.get, distinct))
        new = [i for i, found in enumerate(coded) if found is None]
        self._add(distinct[new].tolist(), single_of[new].tolist())
        for i in new:
            coded[i] = known[distinct[i]]
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        count = size[which]
        ids = np.frombuffer(b"".join(coded), "<u4")[ranges((np.cumsum(size) - size)[which], count)]
        first = np.append(np.searchsorted(begin, starts), begin.size)  # unit of each text
        cuts = np.concatenate(([0], np.cumsum(count)))[first].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def tokenised_pieces(docs: DataFrame, path: str, text_col: str, capacity: int = CAPACITY,
                     end_id: int = END_ID) -> DataFrame:
    """A row per piece: the columns of ``docs`` but the text, with number, start, length and CRC of the ids."""
    import os
    rest = [c for c in docs.columns if c != text_col]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = WordTokenizer.of(path)
        try:
            for other, texts in batches_of_texts(batches, text_col, raw=True):
                rows, out = [], ([], [], [], [])
                for i, ids in enumerate(coder.ids(texts)):
                    ids = memoryview(ids + end)
                    for k, at in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[4 * at:4 * (at + capacity)]
                        rows.append(i)
                        for values, x in zip(out, (k, at, len(part) // 4, zlib.crc32(part))):
                            values.append(x)
                columns = [other.column(c).take(pa.array(rows, pa.int64())) for c in rest]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(v, t) for v, t in zip(out, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=[*rest, "piece", "start", "length", "ids_crc32"])
        finally:
            coder.rest()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col), PIECES])
    return docs.select(*[f"`{c}`" for c in rest], F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, schema)


def _largest_pair(have: np.ndarray, gap: int) -> tuple[int, int] | None:
    """The available lengths a >= b with a + b = gap and the largest a."""
    if gap < 2:
        return None
    a = np.arange(gap - 1, (gap - 1) // 2, -1)
    fits = (have[a] > 0) & (have[gap - a] > 0) & ((a != gap - a) | (have[a] > 1))
    hit = np.flatnonzero(fits)
    return (int(a[hit[0]]), int(gap - a[hit[0]])) if hit.size else None


def _pair_sums(have: np.ndarray) -> np.ndarray:
    """For each sum, whether two available lengths make it (a length with itself counts)."""
    there = np.fft.rfft((have > 0).astype(float), 2 * have.size)
    return np.fft.irfft(there * there, 2 * have.size)[:have.size] > 0.5


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths in a sequence, number of such sequences).

    Every step uses up at least one length's count, so the plan has at most
    a few entries for each length, whatever the counts.
    """
    have = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        have[length] += n
    plan: list[tuple[tuple[int, ...], int]] = []
    sums = _pair_sums(have)

    def take(lengths: tuple[int, ...]) -> None:
        nonlocal sums
        each = {x: lengths.count(x) for x in lengths}
        n = min(int(have[x]) // k for x, k in each.items())
        for x, k in each.items():
            have[x] -= n * k
        plan.append((lengths, n))
        if any(have[x] == 0 for x in each):
            sums = _pair_sums(have)

    for length in range(capacity, 0, -1):
        while have[length]:
            gap, found = capacity - length, None
            have[length] -= 1  # the one whose gap is to be filled
            if gap == 0:
                found = (length,)
            elif have[gap]:
                found = (length, gap)
            elif sums[gap] and (pair := _largest_pair(have, gap)):
                found = (length, *pair)
            else:
                a = np.flatnonzero(have[:gap])[::-1]
                for x in a[sums[gap - a]]:
                    have[x] -= 1
                    pair = _largest_pair(have, gap - int(x))
                    have[x] += 1
                    if pair:
                        found = (length, int(x), *pair)
                        break
            have[length] += 1
            if found is None:
                break
            take(found)

    open_bins: dict[int, list[list]] = {}  # by gap: [lengths, number]
    gaps = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(have)[::-1].tolist():
        left = int(have[length])
        while left:
            fit = np.flatnonzero(gaps[length:])
            if not fit.size:
                per = capacity // length
                for lengths, n in (((length,) * per, left // per), ((length,) * (left % per), 1 if left % per else 0)):
                    if n:
                        gap = capacity - sum(lengths)
                        open_bins.setdefault(gap, []).append([lengths, n])
                        gaps[gap] = True
                break
            gap = length + int(fit[0])
            lengths, n = open_bins[gap].pop()
            used = min(n, left)
            if used < n:
                open_bins[gap].append([lengths, n - used])
            gaps[gap] = bool(open_bins[gap])
            open_bins.setdefault(gap - length, []).append([(*lengths, length), used])
            gaps[gap - length] = True
            left -= used
    return plan + [(tuple(lengths), n) for bins in open_bins.values() for lengths, n in bins]


def _places(plan: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """Runs of places in order of (length, rank): first rank as one key, first sequence, offset."""
    runs: list[tuple[int, int, int, int]] = []
    taken = [0] * (capacity + 1)
    sequence = 0
    for lengths, n in plan:
        offset = 0
        for x in lengths:
            runs.append((x, taken[x], sequence, offset))
            taken[x] += n
            offset += x
        sequence += n
    runs.sort()
    length, rank, first, offset = (np.array([r[i] for r in runs], np.int64) for i in range(4))
    return (length << 48) + rank, rank, first, offset


def pack_documents(docs: DataFrame, path: str, text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID) -> DataFrame:
    """Pack ``docs`` into sequences; a row per piece with ``sequence_id`` and ``offset``.

    A null or empty text is a document of the end id alone. A document longer
    than ``capacity`` is cut; its last piece may be shorter. Rows that repeat
    are packed each; an empty table gives an empty result. The columns of
    ``docs`` but the text are kept whatever their names, those that carry a result's name replaced.
    """
    docs = docs.drop(*RESULT)
    names = [c for c in docs.columns if c != text_col]
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no helper column has such a name
    docs, text_col = docs.toDF(*own.values()), own[text_col]
    pieces = materialize(tokenised_pieces(docs, path, text_col, capacity, end_id), "packing-pieces")
    counts = {r["length"]: r["n"] for r in  # one row per length at most
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    keys, ranks, firsts, offsets = _places(plan_packing(counts, capacity), capacity)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rank of each piece among those of its length in this task."""
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            order = np.argsort(length, kind="stable")
            inside = np.arange(length.size) - np.searchsorted(length[order], length[order])
            rank = np.empty(length.size, np.int64)
            rank[order] = inside + seen[length[order]]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(length.size, part, np.int32)), pa.array(rank)],
                names=[*b.schema.names, "_part", "_rank"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    # by range, so that a very common length spans tasks and (task, length) has few combinations
    spread = pieces.repartitionByRange(F.col("length"), F.xxhash64(*pieces.columns))
    numbered = materialize(spread.mapInArrow(number, f"{fields}, _part int, _rank bigint"), "packing-ranks")
    per_task = numbered.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = per_task.withColumn("_before", F.sum("_n").over(
        Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    rows = (numbered.join(before.select("length", "_part", F.coalesce("_before", F.lit(0)).alias("_before")),
                          ["length", "_part"])
            .select(*pieces.columns, (F.col("_rank") + F.col("_before")).alias("_rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank = b.column("_rank").to_numpy(zero_copy_only=False)
            length = b.column("length").to_numpy(zero_copy_only=False)
            i = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(firsts[i] + rank - ranks[i]), pa.array(offsets[i])],
                names=[*b.schema.names[:-1], "sequence_id", "offset"])

    return rows.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint").toDF(*names, *RESULT)
