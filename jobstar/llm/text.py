"""Text helpers of the llm operators: batches of texts, words and rolling hashes as arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # text that is worked on at a time; a longer text is worked on alone
_SPACE = " \t\n\x0b\x0c\r"  # separators of words, fixed by the word pattern [^\x20\x09-\x0D]+
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[ord(c) for c in _SPACE]] = True


def batches_of_texts(batches: Iterator[pa.RecordBatch], column: str, raw: bool = False,
                     chunk: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with their texts (null: empty) as str, or UTF-8 bytes where ``raw``;
    each slice has about ``chunk`` bytes of text, or one longer text. At the end the buffers
    that Arrow's pool has set aside go back to the system: an idle worker would hold them on."""
    empty = b"" if raw else ""
    for b in batches:
        values = b.column(column)
        values = values.cast(pa.binary()) if raw else values
        size = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(size), 0
        while at < len(values):
            base = ends[at] - size[at]
            stop = max(at + 1, int(np.searchsorted(ends, base + chunk, "right")))
            yield (b.slice(at, stop - at),
                   [empty if t is None else t for t in values.slice(at, stop - at).to_pylist()])
            at = stop
        del b, values
    pa.default_memory_pool().release_unused()


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array, a line feed after each; where each begins and ends."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size + 1) - 1
    return data, ends - size, ends


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z lower-cased."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word in bytes that end with a separator."""
    inside = ~IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of BLAKE2 of each word: no text can be written so that its words collide, as with a polynomial.

    Distinct words of the slice are hashed once each.
    """
    offsets = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), begin.size, [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[~IS_SPACE[data]]))]).dictionary_encode()
    digests = b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in words.dictionary.to_pylist())
    return np.frombuffer(digests, "<u8")[words.indices.to_numpy(zero_copy_only=False)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to n."""
    if _powers[0].size <= n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n + 1, 1 << 20), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Rolling:
    """Hashes of any slices of an array of values, by prefix sums of a polynomial modulo 2**64.

    Values are spread over 64 bits first. Equal slices have equal hashes
    wherever they lie.
    """

    def __init__(self, values: np.ndarray):
        spread = _SPREAD[values] if values.dtype == np.uint8 else mix(values.astype(np.uint64))
        power, self.inverse = _power(values.size)
        self.sums = np.zeros(values.size + 1, np.uint64)
        np.cumsum(spread * power[:values.size], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k values from each place on."""
        n = self.sums.size - k
        return mix((self.sums[k:] - self.sums[:n]) * self.inverse[:n]) if n > 0 else np.zeros(0, np.uint64)


_SPREAD = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w values, by running minima forwards and backwards in blocks."""
    n = x.size - w + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-x.size // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:x.size] = x
    blocks = padded.reshape(-1, w)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[w - 1:w - 1 + n])


_PLACE_BITS = np.uint64(30)


def anchors(rolling: Rolling, starts: np.ndarray, ends: np.ndarray, window: int, k: int) -> np.ndarray:
    """Places of the smallest hash of k values in every window that lies within starts..ends.

    The choice depends on a window's content alone (the leftmost of equal
    hashes), so equal windows anywhere choose the same place within them.
    """
    grams = rolling.grams(k)
    if grams.size == 0:
        return np.zeros(0, np.int64)
    place = np.arange(grams.size, dtype=np.uint64)
    least = sliding_minimum(((grams >> _PLACE_BITS) << _PLACE_BITS) | place, window - k + 1)
    whole = np.zeros(least.size + 1, np.int32)
    long = ends - starts >= window
    np.add.at(whole, starts[long], 1)
    np.add.at(whole, ends[long] - window + 1, -1)
    chosen = (least[np.cumsum(whole[:-1]) > 0] & np.uint64((1 << 30) - 1)).astype(np.int64)
    return chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))] if chosen.size else chosen


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count of them) for each start, one after the other."""
    total = int(counts.sum())
    first = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return first + np.arange(total, dtype=first.dtype)
