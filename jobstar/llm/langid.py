"""Language identification in two steps (operator 9).

Hashed byte n-grams of the lower-cased text feed linear support vector
machines: a first set, one against the rest, tells the language family, then
one machine for each pair of its languages tells the closely related languages
within that family by votes. The machines are fitted on a bounded sample of labelled rows on the driver;
every whole text is scored in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobstar.llm.text import batches_of_texts, joined

#: languages that are closely related; a language not listed is a family of its own
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "lb", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
}
BUCKETS = 1 << 12
SAMPLE_PER_LANG, SAMPLE_CHARS = 500, 20_000  # labelled rows of each language, and their length, that are fitted on
UNKNOWN = "und"
RESULT = ("held_out", "lang_pred", "score")


def held_out(id_col: str) -> Column:
    """Whether a row is in the fold that nothing is learned from; a null identifier is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned_fold(id_col: str) -> Column:
    """Whether a row may be learned from; a null identifier may not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2, F.lit(False))


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), f"={lang}")


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1- to 3-byte grams at every place (three columns), and where each text begins.

    A text is put between blanks, so that it has grams even when it is short.
    """
    data, starts, _ = joined([b" " + t.lower().encode("utf-8", "replace") + b" " for t in texts])
    one = data.astype(np.uint32)
    two = one.copy()
    two[:-1] += one[1:] << np.uint32(8)
    three = two.copy()
    three[:-2] += one[2:] << np.uint32(16)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    return np.stack([((x + np.uint32(i << 24)) * np.uint32(2654435769)) >> shift
                     for i, x in enumerate((one, two, three), 1)]), starts


def features(texts: list[str]) -> np.ndarray:
    """Relative frequencies of the buckets, a row for each text."""
    grams, starts = _grams(texts)
    ends = np.append(starts[1:], grams.shape[1])
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, (a, b) in enumerate(zip(starts, ends)):
        out[i] = np.bincount(grams[:, a:b].ravel(), minlength=BUCKETS)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def fit_svm(x: np.ndarray, y: np.ndarray, steps: int = 150, c: float = 20.0) -> tuple[np.ndarray, float]:
    """A linear support vector machine (squared hinge, both classes weighed alike) by accelerated gradient steps."""
    n, d = x.shape
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())).astype(np.float32) * c
    w, b, vw, vb = np.zeros(d, np.float32), 0.0, np.zeros(d, np.float32), 0.0
    probe, top = np.ones(d, np.float32), 1.0
    for _ in range(8):  # largest curvature, by power iteration
        probe = x.T @ ((x @ probe) * weight)
        top = float(np.linalg.norm(probe)) or 1.0
        probe /= top
    step = 1.0 / (1.0 + 2.5 * (top + weight.sum()))
    for i in range(steps):
        slack = np.maximum(0, 1 - y * (x @ vw + vb)) * weight * y
        nw, nb = vw - step * (vw - 2 * (x.T @ slack)), vb + step * 2 * slack.sum()
        m = i / (i + 3)
        vw, vb, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return w, float(b)


class LanguageModel:
    """Machines for families, and for every pair of languages within a family."""

    def __init__(self, texts: list[str], langs: list[str]):
        x = features(texts)
        scale = np.sqrt((x * x).mean(axis=0)) + 1e-4
        x = x / scale / np.sqrt(BUCKETS) * 8
        self.families = sorted({family_of(v) for v in langs})
        self.langs = sorted(set(langs))
        lang, family = np.array(langs), np.array([family_of(v) for v in langs])
        columns = [fit_svm(x, np.where(family == f, 1.0, -1.0).astype(np.float32)) for f in self.families]
        self.inside = [[v for v in self.langs if family_of(v) == f] for f in self.families]
        self.pairs = [p for inside in self.inside for p in combinations(inside, 2)]
        for a, b in self.pairs:
            own = (lang == a) | (lang == b)
            columns.append(fit_svm(x[own], np.where(lang[own] == a, 1.0, -1.0).astype(np.float32)))
        self.weights = np.stack([w for w, _ in columns], axis=1) / scale[:, None] / np.sqrt(BUCKETS) * 8
        self.bias = np.array([b for _, b in columns])

    def _margins(self, grams: np.ndarray, size: np.ndarray, columns: Iterable[int]) -> np.ndarray:
        """Margins of some machines for texts of so many places each: the mean weight of their grams, and the bias."""
        starts = np.cumsum(size) - size
        out = []
        for j in columns:
            w = self.weights[:, j].astype(np.float32)
            at = w[grams[0]]
            for g in grams[1:]:
                at += w[g]
            out.append(np.add.reduceat(at, starts, dtype=np.float64) / (size * len(grams)) + self.bias[j])
        return np.stack(out, axis=1)

    def _elected(self, inside: list[str], margins: dict[tuple[str, str], float]) -> tuple[str, float]:
        """The language of most votes over all pairs, then of the largest sum of margins, and its least margin."""
        own = {v: [m if v == a else -m for (a, b), m in margins.items() if v in (a, b)] for v in inside}
        best = max(inside, key=lambda v: (sum(m > 0 for m in own[v]), sum(own[v])))
        return best, min(own[best], default=20.0)

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, score) of each text: the family of the largest margin, then the language elected in it."""
        if not texts:
            return []
        grams, starts = _grams(texts)
        size = np.diff(np.append(starts, grams.shape[1]))
        n = len(self.families)
        m = self._margins(grams, size, range(n))
        family = np.argmax(m, axis=1)
        out = [(UNKNOWN, 0.0)] * len(texts)
        for f, inside in enumerate(self.inside):
            rows = np.flatnonzero(family == f)
            pairs = [p for p in self.pairs if p[0] in inside]
            if not rows.size:
                continue
            part = grams if rows.size == len(texts) else grams[:, np.repeat(family == f, size)]
            duels = self._margins(part, size[rows], [n + self.pairs.index(p) for p in pairs]) if pairs else np.zeros((rows.size, 0))
            for i, row in zip(rows.tolist(), duels.tolist()):
                if any(c.isalpha() for c in texts[i]):
                    best, margin = self._elected(inside, dict(zip(pairs, row)))
                    margin = min([*([m[i, f]] if n > 1 else []), margin, 20.0])
                    out[i] = (best, float(1 / (1 + np.exp(-2 * max(margin, -20.0)))))
        return out


def fit_languages(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> LanguageModel | None:
    """Fit on at most ``SAMPLE_PER_LANG`` rows of each language, in order of a hash of the identifier.

    Texts of at most ``SAMPLE_CHARS`` characters come first; of a longer one so many are taken, from a hashed place on.
    """
    rows = docs.where(learned_fold(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).cast("string").alias("_text"))
    over = F.greatest(F.length("_text") - SAMPLE_CHARS, F.lit(0))
    rows = rows.select("_id", "_lang", (over > 0).alias("_long"), F.substring(
        "_text", (F.pmod(F.xxhash64("_id"), over.cast("long") + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("_text"))
    order = Window.partitionBy("_lang").orderBy("_long", F.xxhash64("_id"), "_id")
    sample = (rows
              .withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= SAMPLE_PER_LANG)
              .orderBy("_lang", "_place").select("_text", "_lang").collect())
    return LanguageModel([r[0] for r in sample], [r[1] for r in sample]) if sample else None


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang") -> DataFrame:
    """Every row of ``docs`` with ``held_out``, ``lang_pred`` and ``score``.

    A null or empty text, or one without a letter, is ``und`` with score 0;
    so is every text when no row can be learned from. A null language is not
    learned. Rows that repeat are predicted each; an empty table gives an
    empty result. Columns of ``docs`` that carry a result's name are replaced.
    """
    docs = docs.drop(*RESULT)
    model = fit_languages(docs, id_col, text_col, lang_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in batches_of_texts(batches, text_col):
            found = model.predict(texts) if model else [(UNKNOWN, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*rows.schema.names, "lang_pred", "score"])

    out = docs.mapInArrow(run, f"{schema}, lang_pred string, score double")
    return out.select(*docs.columns, held_out(id_col).alias("held_out"), "lang_pred", "score")
