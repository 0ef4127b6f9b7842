"""Substring deduplication by a compressed FM-index per shard (operator 4).

A shard is a chunk of buckets (see ``jobstar.llm.repeats``): contexts of
words around the same anchors. Their words are numbered, the Burrows-Wheeler transform
is taken and kept as a wavelet tree of packed bits. The shard's documents
are then streamed against it: backward search extends every match by one word to the
left, all contexts side by side, and gives the matching statistics. A match that has
reached the window's length is an interval of the index; when the smallest identifier in it is
smaller than the streamed document's own, the window is reported.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from jobstar.llm.repeats import Kind, without_repeats

WINDOW, GRAM = 50, 10
RESULT = ("n_words", "n_removed", "spans", "kept")


class WaveletTree:
    """Rank over a sequence of small integers: one packed bit vector for each bit, highest first (a wavelet matrix)."""

    def __init__(self, values: np.ndarray, top: int):
        self.n, self.levels = values.size, max(1, int(top).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (values >> level) & 1
            packed = np.zeros(-(-(self.n + 1) // 64) * 8, np.uint8)
            raw = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed[:raw.size] = raw
            word = packed.view(np.uint64)
            ones = np.bitwise_count(word).astype(np.int64)
            self.bits.append(word)
            self.before.append((np.cumsum(ones) - ones).astype(np.int32))
            self.zeros.append(int(self.n - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where a place arrives below the last level on the way of each symbol."""
        for i, (word, before, zeros) in enumerate(zip(self.bits, self.before, self.zeros)):
            bit = (symbol >> (self.levels - 1 - i)) & 1
            mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[place >> 6] + np.bitwise_count(word[place >> 6] & mask)
            place = np.where(bit == 1, zeros + ones, place - ones)
        return place


def suffix_ranks(text: np.ndarray, depth: int) -> dict[int, np.ndarray]:
    """Dense ranks of all suffixes by their first 1, 2, 4, ... symbols, up to ``depth`` at least."""
    rank, out, h = np.unique(text, return_inverse=True)[1].astype(np.int64), {}, 1
    out[1] = rank
    while h < depth:
        after = np.zeros(rank.size, np.int64)
        after[:-h] = rank[h:] + 1
        rank = np.unique(rank * (rank.size + 2) + after, return_inverse=True)[1].astype(np.int64)
        h *= 2
        out[h] = rank
    return out


class FMIndex:
    """Backward search over one text, for patterns of up to ``window`` symbols and one more.

    Suffixes are sorted by enough symbols for such patterns: their intervals
    are then those of the full order.
    """

    def __init__(self, text: np.ndarray, owner: np.ndarray, window: int):
        """``text``: symbols from 1 on, 0 after each document; ``owner``: the identifier each place belongs to."""
        n, ranks = text.size, suffix_ranks(text, window + 2)
        last = ranks[max(ranks)]
        order = np.lexsort((np.arange(n), last))
        self.window, self.top = window, int(text.max()) if n else 0
        self.tree = WaveletTree(text[order - 1], self.top)
        self.base = self.tree.descend(np.arange(self.top + 1), np.zeros(self.top + 1, np.int64))
        count = np.bincount(text, minlength=self.top + 1)
        self.first = np.cumsum(count) - count
        # runs of suffixes that share a whole window, and the smallest identifier of each
        half = max(h for h in ranks if h <= window)
        tail = np.full(n, -1, np.int64)
        if n > window - half:
            tail[:n - (window - half)] = ranks[half][window - half:]
        a, b = ranks[half][order], tail[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if n else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        self.run = np.cumsum(new) - 1
        self.run_begin, self.run_end = begin, np.append(begin[1:], n)
        self.run_least = np.minimum.reduceat(owner[order], begin) if n else owner

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with a symbol put before them."""
        base = self.first[symbol] - self.base[symbol]
        return base + self.tree.descend(symbol, low), base + self.tree.descend(symbol, high)

    def matches(self, documents: np.ndarray, size: np.ndarray):
        """Stream documents (rows, filled up with zeros) from their ends.

        Yields (place, rows, least): rows whose match at that place is as long as a window, and the smallest
        identifier that has it. Longer matches are shortened to the window.
        """
        n = self.run.size
        low, high = np.zeros(size.size, np.int64), np.full(size.size, n, np.int64)
        length = np.zeros(size.size, np.int64)
        for place in range(int(size.max()) - 1 if size.size else -1, -1, -1):
            rows = np.flatnonzero(place < size)
            lo, hi = self.extend(documents[rows, place], low[rows], high[rows])
            none = lo >= hi  # not in the index: begin anew
            grown = np.where(none, 0, length[rows] + 1)
            lo, hi = np.where(none, 0, lo), np.where(none, n, hi)
            long = grown >= self.window
            run = self.run[np.minimum(lo, n - 1)]
            lo, hi = np.where(long, self.run_begin[run], lo), np.where(long, self.run_end[run], hi)
            low[rows], high[rows], length[rows] = lo, hi, np.minimum(grown, self.window)
            yield place, rows[long], self.run_least[run[long]]


def earlier_windows(bucket: np.ndarray, ident: np.ndarray, left: np.ndarray, contexts: list[bytes],
                    kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest offset of each context's windows that a row of smaller identifier has; -1 for none."""
    parts = [np.frombuffer(c, np.uint64) for c in contexts]
    size = np.array([p.size for p in parts])
    words, number = np.unique(np.concatenate(parts), return_inverse=True)
    ends = np.cumsum(size + 1)
    text = np.zeros(int(ends[-1]), np.int64)
    inside = np.ones(text.size, bool)
    inside[ends - 1] = False
    text[inside] = number + 1
    index = FMIndex(text, np.repeat(ident, size + 1), kind.window)
    rows = np.zeros((size.size, int(size.max())), np.int64)
    rows[np.arange(rows.shape[1])[None, :] < size[:, None]] = number + 1
    lo, hi = np.full(size.size, -1), np.full(size.size, -1)
    for place, at, least in index.matches(rows, size):
        hit = at[least < ident[at]]
        offset = left[hit] - place  # of the window's begin before the anchor; grows as places fall
        ok = (offset >= 0) & (offset <= kind.left)
        hit, offset = hit[ok], offset[ok]
        lo[hit] = np.where(lo[hit] < 0, offset, np.minimum(lo[hit], offset))
        hi[hit] = np.maximum(hi[hit], offset)
    return lo, hi


def fm_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
             gram: int = GRAM, **limits) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``spans`` (of removed words) and ``kept`` (words joined by a space).

    Every word covered by a run of ``window`` words that also starts in a row
    of smaller identifier is removed, judged on the input. Words are
    ``[^\\x20\\x09-\\x0D]+``, unchanged; a null or empty text has none. Rows that
    repeat an identifier are not earlier than each other; a null identifier is the
    smallest. An empty table gives an empty result. Columns of ``docs`` that carry a
    result's name are replaced.
    """
    kind = Kind(words=True, window=window, gram=min(gram, window), earlier=True, **limits)
    return without_repeats(docs, kind, earlier_windows, id_col, text_col, RESULT)
