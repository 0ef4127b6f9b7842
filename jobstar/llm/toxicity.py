"""Toxicity by a bidirectional gated recurrent network (operator 8).

Each word enters as a hashed word feature and as features of its characters
(hashed grams of four bytes). A gated recurrent unit reads a window of words
forwards, another backwards; attention pools their states into one score. The
network is trained in numpy on the driver, on a bounded sample of labelled
rows; every task scores all overlapping windows of its whole texts, and a
text's score is that of its highest window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar.llm.langid import held_out, learned_fold
from jobstar.llm.text import Rolling, batches_of_texts, joined, lower_ascii, ranges, word_spans

WORD_BUCKETS, CHAR_BUCKETS = 1 << 16, 1 << 16
WIDTH, STRIDE, HIDDEN, ATTENTION = 64, 32, 8, 8
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1200, 2400, 8_000  # labelled rows, and their length, that are trained on
THRESHOLD = 0.3
INPUTS = 4
RESULT = ("held_out", "score", "predicted")
_IS_WORD_CHAR = np.zeros(256, bool)
_IS_WORD_CHAR[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


class Words:
    """The words of some texts as arrays: bucket of each word, buckets of its grams, and the words of each text.

    Punctuation at a word's ends is not part of it; a word of punctuation alone stays as it is.
    """

    def __init__(self, texts: list[bytes]):
        data, starts, ends = joined(texts)
        data = lower_ascii(data)
        begin, end = word_spans(data)
        self.first = np.searchsorted(begin, starts)
        self.count = np.searchsorted(begin, ends) - self.first
        if begin.size:
            places = np.arange(data.size, dtype=np.int64)
            letter = _IS_WORD_CHAR[data]
            following = np.minimum.accumulate(np.where(letter, places, data.size)[::-1])[::-1]
            previous = np.maximum.accumulate(np.where(letter, places, -1))
            inner_begin, inner_end = following[begin], previous[end - 1] + 1
            inside = inner_begin < inner_end
            begin, end = np.where(inside, inner_begin, begin), np.where(inside, inner_end, end)
        self.word = (Rolling(data).of(begin, end) >> np.uint64(48)).astype(np.int64)
        # grams of four bytes of the word between blanks: one for each of its bytes, from the one before it
        padded = np.where(_IS_WORD_CHAR[data], data, 32).astype(np.uint32)
        gram = padded << np.uint32(16)
        gram[1:] += padded[:-1] << np.uint32(24)
        gram[:-1] += padded[1:] << np.uint32(8)
        gram[:-2] += padded[2:]
        self.size = end - begin
        self.gram = ((gram * np.uint32(2654435769)) >> np.uint32(16)).astype(np.int32)[ranges(begin, self.size)]
        self.gram_first = np.cumsum(self.size) - self.size

    def inputs(self, word_weight: np.ndarray, char_weight: np.ndarray) -> np.ndarray:
        """Inputs of every word: its own weight, mean and largest weight of its grams, and a constant."""
        out = np.zeros((self.word.size, INPUTS), np.float32)
        if self.word.size:
            c = char_weight[self.gram]
            out[:, 0] = word_weight[self.word]
            out[:, 1] = np.add.reduceat(c, self.gram_first) / self.size
            out[:, 2] = np.maximum.reduceat(c, self.gram_first)
            out[:, 3] = 1
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All overlapping windows: first word, number of words, and the text each belongs to.

        Windows begin every ``STRIDE`` words; the last of a text ends with it. A text without words has none.
        """
        n = np.where(self.count > 0, 1 + -(-np.maximum(self.count - WIDTH, 0) // STRIDE), 0)
        text = np.repeat(np.arange(n.size), n)
        at = ranges(np.zeros(n.size, np.int64), n) * STRIDE
        at = np.minimum(at, np.maximum(self.count[text] - WIDTH, 0))
        return self.first[text] + at, np.minimum(self.count[text], WIDTH), text


def _gathered(inputs: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(step, window, input) and which steps are within the window."""
    step = np.arange(WIDTH)[:, None]
    there = step < count[None, :]
    return inputs[np.where(there, first[None, :] + step, first[None, :])] * there[:, :, None], there


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Bidirectional GRU with attention pooling and a logistic output; forward and backward passes."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        near = lambda *shape: (r.standard_normal(shape) * 0.4).astype(np.float32)
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p[f"x{d}"] = near(INPUTS, 3 * HIDDEN)
            self.p[f"h{d}"] = near(HIDDEN, 3 * HIDDEN)
        self.p["a"] = near(2 * HIDDEN, ATTENTION)
        self.p["v"] = near(ATTENTION)
        self.p["o"] = near(2 * HIDDEN + 1)

    def _run(self, d: str, x: np.ndarray, there: np.ndarray, keep: list | None) -> np.ndarray:
        """States of one direction, (step, window, hidden)."""
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        wx, wh = self.p[f"x{d}"], self.p[f"h{d}"]
        out = np.zeros((*x.shape[:2], HIDDEN), np.float32)
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        k = 2 * HIDDEN
        for t in steps:
            g, u = x[t] @ wx, h @ wh
            zr = _sigmoid(g[:, :k] + u[:, :k])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(g[:, k:] + r * u[:, k:])
            m = there[t][:, None]
            new = np.where(m, h + z * (c - h), h)
            if keep is not None:
                keep.append((t, h, z, r, c, u[:, k:], m))
            h = out[t] = new
        return out

    def forward(self, x: np.ndarray, there: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Probability for each window."""
        tapes = ({"f": [], "b": []} if keep is not None else {"f": None, "b": None})
        h = np.concatenate([self._run(d, x, there, tapes[d]) for d in "fb"], axis=2)
        a = np.tanh(h @ self.p["a"])
        e = np.where(there, a @ self.p["v"], -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = (w[:, :, None] * h).sum(axis=0)
        y = _sigmoid(pooled @ self.p["o"][:-1] + self.p["o"][-1])
        if keep is not None:
            keep.update(tapes=tapes, h=h, a=a, w=w, pooled=pooled, y=y, x=x, there=there)
        return y

    def gradients(self, k: dict, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted logistic loss."""
        p, g = self.p, {n: np.zeros_like(v) for n, v in self.p.items()}
        dy = ((k["y"] - target) * weight / weight.sum()).astype(np.float32)
        g["o"][:-1], g["o"][-1] = k["pooled"].T @ dy, dy.sum()
        dpool = dy[:, None] * p["o"][:-1]
        dh = k["w"][:, :, None] * dpool
        dw = (k["h"] * dpool).sum(axis=2)
        de = k["w"] * (dw - (k["w"] * dw).sum(axis=0))
        da = de[:, :, None] * p["v"] * (1 - k["a"] ** 2)
        g["v"] = np.einsum("tn,tnk->k", de, k["a"])
        g["a"] = np.einsum("tni,tnk->ik", k["h"], da)
        dh = dh + da @ p["a"].T
        for i, d in enumerate("fb"):
            own, carry = dh[:, :, i * HIDDEN:(i + 1) * HIDDEN], 0
            for t, h, z, r, c, uc, m in reversed(k["tapes"][d]):
                total = own[t] + carry
                dn = total * m
                dc = dn * z * (1 - c * c)
                dz = dn * (c - h) * z * (1 - z)
                dr = dc * uc * r * (1 - r)
                du = np.concatenate([dz, dr, dc * r], axis=1)
                g[f"x{d}"] += k["x"][t].T @ np.concatenate([dz, dr, dc], axis=1)
                g[f"h{d}"] += h.T @ du
                carry = total * ~m + dn * (1 - z) + du @ p[f"h{d}"].T
        return g

    def train(self, x: np.ndarray, there: np.ndarray, target: np.ndarray, weight: np.ndarray,
              epochs: int = 12, batch: int = 256, rate: float = 0.02, seed: int = 3) -> None:
        """Adam over shuffled batches; windows are the second axis of ``x``."""
        r, n, step = np.random.default_rng(seed), len(target), 0
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for epoch in range(epochs):
            order = r.permutation(n)
            for at in range(0, n, batch):
                rows = order[at:at + batch]
                keep: dict = {}
                self.forward(x[:, rows], there[:, rows], keep)
                step += 1
                for name, d in self.gradients(keep, target[rows], weight[rows]).items():
                    d = np.clip(d, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * d
                    second[name] = 0.99 * second[name] + 0.01 * d * d
                    self.p[name] = (self.p[name] - rate * (1 - epoch / epochs) * (first[name] / (1 - 0.9 ** step))
                                    / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)


def _log_odds(bucket: np.ndarray, text: np.ndarray, toxic: np.ndarray, buckets: int, prior: float) -> np.ndarray:
    """Log ratio of the share of toxic texts among those with a bucket to their share at large, drawn to 0 by a prior."""
    pairs = np.unique(text * buckets + bucket)
    at, label = pairs % buckets, toxic[pairs // buckets]
    n = np.bincount(at, minlength=buckets)
    bad = np.bincount(at, weights=label, minlength=buckets)
    share = toxic.mean()
    return np.log((bad + prior * share) / (n + prior) / share).astype(np.float32)


class ToxicityModel:
    """Weights of words and grams, and the network over them.

    The network learns from inputs that were weighed without the text at
    hand: each half of the sample is read with the weights of the other half.
    The final weights come from the whole sample.
    """

    def __init__(self, texts: list[bytes], toxic: list[int]):
        label = np.array(toxic, np.float32)
        half = np.arange(len(texts)) % 2 == 0
        self.weigh(texts, label, half)
        parts = [self.telling_windows(texts, label, ~half)]
        self.weigh(texts, label, ~half)
        parts.append(self.telling_windows(texts, label, half))
        self.weigh(texts, label, half | ~half)
        x, there, target = (np.concatenate(p, axis=-1 if p[0].ndim < 3 else 1) for p in zip(*parts))
        share = target.mean() if target.size else 0
        self.net = Network()
        if 0 < share < 1:
            weight = np.where(target > 0, 0.3 / share, 0.7 / (1 - share)).astype(np.float32)
            self.net.train(x, there, target, weight, epochs=max(12, 400 * 256 // target.size))

    def weigh(self, texts: list[bytes], label: np.ndarray, rows: np.ndarray) -> None:
        """Weights of words and grams by the texts in ``rows``."""
        words = Words([t for t, r in zip(texts, rows) if r])
        of_word = np.repeat(np.arange(rows.sum()), words.count)
        self.word = _log_odds(words.word, of_word, label[rows], WORD_BUCKETS, 8.0)
        self.char = _log_odds(words.gram, np.repeat(of_word, words.size), label[rows], CHAR_BUCKETS, 8.0)

    def telling_windows(self, texts: list[bytes], label: np.ndarray, rows: np.ndarray):
        """Inputs, steps and labels: of a toxic text its most telling window, of a clean one that and one more."""
        words = Words([t for t, r in zip(texts, rows) if r])
        inputs = words.inputs(self.word, self.char)
        first, count, text = words.windows()
        sums = np.concatenate(([0], np.cumsum(np.maximum(inputs[:, 0], 0) + np.maximum(inputs[:, 2], 0), dtype=np.float64)))
        best = np.lexsort((-(sums[first + count] - sums[first]), text))
        place = np.arange(text.size) - np.searchsorted(text[best], text[best])
        own = label[rows][text[best]]
        chosen = best[(place == 0) | ((own == 0) & (place == 1))]
        x, there = _gathered(inputs, first[chosen], count[chosen])
        return x, there, label[rows][text[chosen]]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Score of each text: the highest of its windows; 0 without words."""
        words = Words(texts)
        out = np.zeros(len(texts))
        inputs = words.inputs(self.word, self.char)
        first, count, text = words.windows()
        for at in range(0, first.size, 4096):
            part = slice(at, at + 4096)
            y = self.net.forward(*_gathered(inputs, first[part], count[part]))
            np.maximum.at(out, text[part], y)
        return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> ToxicityModel | None:
    """Train on at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` labelled rows, in order of a hash of the identifier."""
    known = (labels.where("toxic IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
             .where(learned_fold("_id")))
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
            .where(F.length("_text").between(1, SAMPLE_CHARS)))
    order = known.withColumn("_hash", F.xxhash64("_id"))
    chosen = None
    for value, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        part = order.where(F.col("_toxic") == value).orderBy("_hash", "_id").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = rows.join(F.broadcast(chosen), "_id").orderBy("_hash", "_id").select("_text", "_toxic").collect()
    if len({r[1] for r in sample}) < 2 or len(sample) < 4:
        return None
    return ToxicityModel([r[0].encode("utf-8", "replace") for r in sample], [r[1] for r in sample])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with ``held_out``, ``score`` and ``predicted``.

    A null or empty text, or one without words, scores 0; so does every text
    when the labels have not both classes. A label that is null or has no
    document does nothing; a document labelled both ways counts as toxic.
    Rows that repeat are scored each; an empty table gives an empty result.
    Columns of ``docs`` that carry a result's name are replaced.
    """
    docs = docs.drop(*RESULT)
    model = fit_toxicity(docs, labels, id_col, text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in batches_of_texts(batches, text_col, raw=True):
            score = model.scores(texts) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.asarray(score, np.float64))],
                                             names=[*rows.schema.names, "score"])

    out = docs.mapInArrow(run, f"{schema}, score double")
    return out.select(*docs.columns, held_out(id_col).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
