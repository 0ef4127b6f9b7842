"""Substring deduplication by suffix array, built blockwise with a difference cover (operator 10).

The contexts of a chunk of buckets (see ``jobstar.llm.repeats``) are laid
out as rows of one text, all anchors in one column. A *suffix bucket* is the set of
suffixes that begin in one column of one bucket; only these can hold the same
window at the same distance from its anchor. First the suffixes in the
columns of a difference cover are ranked, from the last column to the first. Then one suffix
bucket after the other is sorted: by its few bytes up to the next cover
column, and ties by the rank there, however long they are. Only the ranks of the cover
and the order of one block are held. Neighbours in that order with a
common prefix of a whole window are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar.llm.repeats import Kind, without_repeats

WINDOW, GRAM, PERIOD = 200, 32, 32
RESULT = ("n_bytes", "n_removed", "spans", "kept")


def difference_cover(period: int) -> list[int]:
    """Residues whose pairwise differences give every residue; found greedily."""
    cover, missing = [0], set(range(1, period))
    while missing:
        new = {x: {(x - c) % period for c in cover} | {(c - x) % period for c in cover} for x in range(period)}
        best = max((x for x in new if x not in cover), key=lambda x: len(new[x] & missing))
        missing -= new[best]
        cover.append(best)
    return sorted(cover)


COVER = difference_cover(PERIOD)


def _packed(text: np.ndarray, a: int, b: int) -> list[np.ndarray]:
    """Bytes a..b of every row as integers, most significant first."""
    out = []
    for at in range(a, b, 8):
        word = np.zeros(len(text), np.uint64)
        for x in range(at, min(at + 8, b)):
            word = (word << np.uint64(8)) | text[:, x]
        out.append(word)
    return out


def _order(bucket: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket and keys, and the dense rank of each row."""
    keys = [bucket, *keys]
    order = np.lexsort(keys[::-1])
    new = np.zeros(order.size, bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(order.size, np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


class BlockwiseSuffixes:
    """Suffixes of the rows of ``text``, compared within a bucket and column only."""

    def __init__(self, text: np.ndarray, bucket: np.ndarray, period: int = PERIOD, cover: list[int] | None = None):
        self.text, self.bucket = text, bucket
        residues = set(COVER if cover is None else cover)
        width = text.shape[1]
        #: for each column the next one of the cover, or the end
        self.next = np.full(width + 1, width)
        for c in range(width - 1, -1, -1):
            self.next[c] = c if c % period in residues else self.next[c + 1]
        self.rank: dict[int, np.ndarray] = {width: np.zeros(len(text), np.int64)}
        for c in range(width - 1, -1, -1):
            if self.next[c] == c:
                after = int(self.next[c + 1])
                self.rank[c] = _order(bucket, [*_packed(text, c, after), self.rank[after]])[1]

    def block(self, column: int) -> np.ndarray:
        """Rows in order of (bucket, suffix that begins in the column)."""
        after = int(self.next[column])
        return _order(self.bucket, [*_packed(self.text, column, after), self.rank[after]])[0]


def shared_windows(bucket: np.ndarray, ident: np.ndarray, left: np.ndarray, contexts: list[bytes],
                   kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest offset of each context's windows that another context of its bucket has; -1 for none."""
    m, reach = len(contexts), kind.left
    width = -(-(reach + kind.window) // PERIOD) * PERIOD
    text = np.full((m, width), 0xFF, np.uint8)  # 0xFF is no byte of UTF-8
    size = np.array([len(c) for c in contexts])
    for i, c in enumerate(contexts):
        text[i, reach - left[i]:reach - left[i] + len(c)] = np.frombuffer(c, np.uint8)
    _, bucket = np.unique(bucket, return_inverse=True)
    suffixes = BlockwiseSuffixes(text, bucket)
    lo, hi = np.full(m, -1), np.full(m, -1)
    for offset in range(reach + 1):
        column = reach - offset
        order = suffixes.block(column)
        ok = (offset <= left) & (kind.window - offset <= size - left)
        a, b = order[:-1], order[1:]
        same = (bucket[a] == bucket[b]) & ok[a] & ok[b] & (text[a, column] == text[b, column])
        same &= text[a, column + kind.window - 1] == text[b, column + kind.window - 1]
        pair = np.flatnonzero(same)
        equal = (text[a[pair], column:column + kind.window] == text[b[pair], column:column + kind.window]).all(axis=1)
        hit = np.unique(np.concatenate([a[pair[equal]], b[pair[equal]]]))
        lo[hit] = np.where(lo[hit] < 0, offset, lo[hit])
        hi[hit] = offset
    return lo, hi


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 gram: int = GRAM, **limits) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``spans`` (of removed bytes, maximal) and ``kept`` (bytes).

    Every byte covered by a ``window``-byte string that also starts anywhere
    else is removed, judged on the input. Texts are UTF-8 bytes, null counts
    as empty; matches never cross texts. A text shorter than the window stays
    whole. Rows that repeat are copies of each other. A null identifier is
    allowed. An empty table gives an empty result. Columns of ``docs`` that
    carry a result's name are replaced.
    """
    kind = Kind(words=False, window=window, gram=min(gram, window), earlier=False, **limits)
    return without_repeats(docs, kind, shared_windows, id_col, text_col, RESULT)


def cleaned(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text; a character that is cut apart goes whole."""
    columns = docs.columns
    own = [f"c{i}" for i in range(len(columns))]
    text = own[columns.index(text_col)]
    names = {"id_col": own[columns.index(options.pop("id_col", "doc_id"))], "text_col": text}
    out = suffix_dedup(docs.toDF(*own), **names, **options).select(*own, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text).to_pylist()
            for i, spans in enumerate(b.column("spans").to_pylist()):
                if spans:
                    raw = texts[i].encode()
                    edges = [0, *(x for s in spans for x in (s["a"], s["b"])), len(raw)]
                    texts[i] = "".join(raw[x:y].decode("utf-8", "ignore") for x, y in zip(edges[::2], edges[1::2]))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text else b.column(c) for c in own], names=own)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema if f.name != "spans")
    return out.mapInArrow(run, schema).toDF(*columns)
