"""Byte-level BPE encoding and decoding (operator 6).

Pre-tokens are located on arrays, without regex: every code point gets a
class, each class is a transition function of a small automaton, and an
associative scan composes these functions over blocks of the text, so that
the state at every character is known at once. Boundaries follow from the
states and the neighbours' classes. The slices between them go through pair
merging, whose results a worker keeps for slices it meets again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from jobstar.llm.text import batches_of_texts

# classes of characters; the letters that end contractions stand apart
SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, SHORT, R, V, L, E, BREAK = range(12)
_N_CLASSES = 12
#: fixed: code points with the Unicode property White_Space
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

# states after a character
S_SPACE, S_BLANK, S_LETTER, S_NUMBER, S_OTHER, S_QUOTE, S_R, S_V, S_L, S_DONE = range(10)
_N_STATES = 10
_BLOCK = 256
CACHE_PIECES = 400_000  # slices a Python worker keeps the ids of


def _next_state(state: int, kind: int) -> int:
    """The automaton. S_QUOTE: an apostrophe that begins a pre-token; S_R, S_V, S_L: it and the
    first letter of a two-letter ending; S_DONE: a contraction is complete."""
    if kind in (SPACE, BLANK, BREAK):
        return S_SPACE if kind == SPACE else S_BLANK
    if kind == NUMBER:
        return S_NUMBER
    if kind == OTHER:
        return S_OTHER
    if kind == QUOTE:
        return S_OTHER if state in (S_SPACE, S_OTHER, S_QUOTE) else S_QUOTE
    if state == S_QUOTE:
        return {SHORT: S_DONE, R: S_R, V: S_V, L: S_L}.get(kind, S_LETTER)
    if (state, kind) in ((S_R, E), (S_V, E), (S_L, L)):
        return S_DONE
    return S_LETTER


def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transition functions that arise by composition: number of each class's function,
    the composition table, and each function's values."""
    of_class = [tuple(_next_state(s, c) for s in range(_N_STATES)) for c in range(_N_CLASSES)]
    known = {tuple(range(_N_STATES)): 0}
    work = list(known)
    while work:
        f = work.pop()
        for g in of_class:
            h = tuple(g[x] for x in f)
            if h not in known:
                known[h] = len(known)
                work.append(h)
    values = np.array(list(known), np.uint8)
    then = np.array([[known[tuple(g[x] for x in f)] for g in known] for f in known], np.uint16)
    return np.array([known[f] for f in of_class], np.uint16), then, values


_OF_CLASS, _THEN, _VALUES = _functions()
_STEP = np.array([[_next_state(s, c) for c in range(_N_CLASSES)] for s in range(_N_STATES)], np.uint8)


def _scan(functions: np.ndarray) -> np.ndarray:
    """Composition of all functions before each one (exclusive), by blocks."""
    n = functions.size
    if n <= _BLOCK:
        out, f = np.zeros(n, np.uint16), 0
        for i, g in enumerate(functions.tolist()):
            out[i] = f
            f = int(_THEN[f, g])
        return out
    rows = -(-n // _BLOCK)
    padded = np.zeros(rows * _BLOCK, np.uint16)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(rows, _BLOCK).T)
    inside = np.empty_like(columns)
    f = np.zeros(rows, np.uint16)
    for i in range(_BLOCK):
        inside[i] = f
        f = _THEN[f, columns[i]]
    before = _scan(f)
    return _THEN[before[None, :], inside].T.ravel()[:n]


def states_of(kinds: np.ndarray) -> np.ndarray:
    """State after every character, starting as after white space.

    Blocks are composed independently and scanned; then all blocks step through their
    characters side by side, each from the state that the scan gives.
    """
    n = kinds.size
    rows = -(-n // _BLOCK)
    padded = np.full(rows * _BLOCK, BLANK, np.uint8)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(rows, _BLOCK).T)
    f = np.zeros(rows, np.uint16)
    for column in columns:
        f = _THEN[f, _OF_CLASS[column]]
    state = _VALUES[_scan(f), S_BLANK]
    out = np.empty_like(columns)
    for i, column in enumerate(columns):
        state = _STEP[state, column]
        out[i] = state
    return out.T.ravel()[:n]


_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point, by general category."""
    if not _classes:
        by = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((by.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
        table[list(WHITE_SPACE)] = BLANK
        for kind, chars in ((SPACE, " "), (QUOTE, "'"), (SHORT, "stmd"), (R, "r"), (V, "v"), (L, "l"), (E, "e")):
            table[[ord(c) for c in chars]] = kind
        _classes.append(table)
    return _classes[0]


# group of each class: 0 white space, 1 letters, 2 numbers, 3 others, 4 break between texts
_GROUP = np.array([0, 0, 1, 2, 3, 3, 1, 1, 1, 1, 1, 4], np.uint8)


def boundaries(kinds: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, in characters that start and end with a break."""
    state, group = states_of(kinds), _GROUP[kinds]
    white = group == 0
    before, after = slice(None, -1), slice(1, None)
    begin = np.ones(kinds.size, bool)
    # other than white space: where the kind changes or a contraction ended; a blank before is joined
    inner = (group[after] != group[before]) | (state[before] == S_DONE)
    begin[after] = inner & (kinds[before] != SPACE)
    # a complete contraction is one with its apostrophe
    done = np.flatnonzero((state == S_DONE) & (group == 1))
    one = kinds[done - 1] == QUOTE
    one &= state[done - 1] == S_QUOTE
    begin[np.where(one, done, done - 1)] = False
    # white space: the run's begin, and its last character if a text goes on after it
    last = np.zeros(kinds.size, bool)
    last[before] = white[before] & ~white[after] & (group[after] != 4)
    first = np.ones(kinds.size, bool)
    first[after] = ~white[before]
    begin[white] = (first | last)[white]
    begin[group == 4] = True
    return begin


def pre_tokens(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Pre-tokens of all texts in order, and how many each text has."""
    whole = "\n" + "\n".join(texts) + "\n"
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = classes()[points]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    breaks = np.concatenate(([0], np.cumsum(size + 1)))
    kinds[breaks] = BREAK
    starts = np.flatnonzero(boundaries(kinds))
    data = whole.encode("utf-8", "surrogatepass")
    if len(data) == points.size:
        at = starts
    else:
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        at = (np.cumsum(width) - width)[starts]
    is_break = kinds[starts] == BREAK
    ends = np.append(at[1:], len(data))
    pieces = [data[a:b] for a, b in zip(at[~is_break].tolist(), ends[~is_break].tolist())]
    place = np.flatnonzero(is_break)
    return pieces, np.diff(place) - 1


class BytePairCoder:
    """Ids of texts by a rank file, and texts of ids."""

    _loaded: dict[str, BytePairCoder] = {}

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.tokens[i] = token
        self.text_of = [str(i) for i in range(len(self.tokens))]
        self.cache: dict[bytes, tuple[int, ...]] = {}

    @classmethod
    def of(cls, path: str) -> BytePairCoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token: join the neighbouring pair of lowest rank, leftmost first, while there is one."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(piece) > 100:
            return self._merge_long(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        none = len(self.tokens)
        pairs = [ranks.get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return tuple([ranks[p] for p in parts])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same by a heap over linked parts, in O(n log n) for a piece of any length."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that begins here; 0 where none does
        prior = list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and end[i] < n:
                stop = end[end[i]]
                rank = ranks.get(piece[i:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, stop))

        for i in range(n):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != stop:
                continue  # one of the two has been joined meanwhile
            end[i], end[mid] = stop, 0
            if stop < n:
                prior[stop] = i
            offer(i)
            offer(prior[i])
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i:end[i]]])
            i = end[i]
        return tuple(ids)

    def encode(self, texts: list[str]) -> list[list[int]]:
        pieces, counts = pre_tokens(texts)
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        known, merge = self.cache, self.merge
        for p in set(pieces):
            if p not in known:
                known[p] = merge(p)
        out, at = [], 0
        for n in counts.tolist():
            out.append([i for p in pieces[at:at + n] for i in known[p]])
            at += n
        return out

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])

    def offsets(self, ids: list[int]) -> np.ndarray:
        """Place in the text's bytes where each id's token begins."""
        size = np.fromiter((len(self.tokens[i]) for i in ids), np.int64, len(ids))
        return np.cumsum(size) - size


def _mapped(docs: DataFrame, text_col: str, make, names: list[str], types: list[pa.DataType], ddl: str) -> DataFrame:
    docs = docs.drop(*names)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), ddl])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in batches_of_texts(batches, text_col):
            columns = list(zip(*make(texts)))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *(pa.array(c, t) for c, t in zip(columns, types))], names=[*rows.schema.names, *names])

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Add ``ids`` and ``offsets`` (of each token in the text's UTF-8 bytes) to every row.

    A null or empty text has no ids. Rows that repeat are encoded each, an
    empty table gives an empty result. Columns of the result's names are replaced.
    """
    def make(texts):
        coder = BytePairCoder.of(path)
        return [(ids, coder.offsets(ids)) for ids in coder.encode(texts)]

    return _mapped(docs, text_col, make, ["ids", "offsets"], [pa.list_(pa.int32()), pa.list_(pa.int64())],
                   "ids array<int>, offsets array<bigint>")


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``, the bytes of each row's ids; null or no ids give no bytes."""
    rows = rows.drop("decoded")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "decoded binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = BytePairCoder.of(path)
        for b in batches:
            out = [coder.decode(ids or []) for ids in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)


def roundtrip_digests(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Encode and decode every row in one pass and add ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    For checks over a whole corpus: ids and bytes stay in the task. Cases as for ``encode``.
    """
    def make(texts):
        coder = BytePairCoder.of(path)
        number = coder.text_of
        return [(len(ids), hashlib.sha256(" ".join([number[i] for i in ids]).encode()).hexdigest(),
                 hashlib.sha256(coder.decode(ids)).hexdigest()) for ids in coder.encode(texts)]

    return _mapped(docs, text_col, make, ["n_tokens", "ids_sha256", "decoded_sha256"],
                   [pa.int64(), pa.string(), pa.string()], "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
