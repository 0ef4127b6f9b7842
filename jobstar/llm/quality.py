"""Quality rules by a hashed n-gram likelihood ratio (operator 3, DataFrame functions only).

Words and word pairs of every text are hashed into a fixed number of
buckets. Two multinomials are counted over them: the *target* over trusted
documents (``labels.quality = 1``) and the *raw corpus* over all documents.
A document's score is the mean over its n-grams of
``log(p_target / p_raw)``; it is kept when the score reaches a fixed
threshold. The same rule holds for every document: nothing is drawn at random.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstar.llm.bits import bit_table, with_may

#: separators of words, fixed by the word pattern [^\x20\x09-\x0D]+
SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 13
THRESHOLD = -0.06
MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 10, 20, 5
RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def words_of(text: Column) -> Column:
    """Words of a text; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SEPARATORS, " " * len(SEPARATORS))
    return F.array_remove(F.split(spaced, " "), "")


def base_measures(docs: DataFrame, text_col: str) -> DataFrame:
    """Add ``_hashed``, the 64-bit hash of each word, and the five counts of a text.

    What a lambda refers to is a column of its own, since an expression would
    be evaluated for every element. Only a text whose window hashes are not all distinct
    has repeated windows; these are found by sorting its hashes with their
    places, where a window repeats when a neighbour has the same hash. Its words are
    counted once each, by the distance to the next repeated window.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.translate(text, SEPARATORS, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SEPARATORS, "") != "")
    docs = (docs.withColumn("_hashed", F.transform(words_of(F.col(text_col)), lambda w: F.xxhash64(w)))
            .withColumn("_lines", lines)
            .withColumn("n_words", F.size("_hashed").cast("long"))
            .withColumn("word_chars", F.length(bare).cast("long"))
            .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .drop("_lines"))
    window = lambda x, i: F.xxhash64(x, *[F.get("_hashed", i + k) for k in range(1, WINDOW)])
    n = F.greatest(F.size("_hashed") - (WINDOW - 1), F.lit(0))
    docs = docs.withColumn("_windows", F.slice(F.transform("_hashed", window), F.lit(1), n))
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    docs = docs.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(placed)))
    same = lambda i: ((F.get("_sorted", i)["h"] == F.get("_sorted", i - 1)["h"])
                      | (F.get("_sorted", i)["h"] == F.get("_sorted", i + 1)["h"]))
    twice = F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("_sorted") - 1), lambda i: F.coalesce(same(i), F.lit(False))),
        lambda i: F.get("_sorted", i)["i"]))
    docs = docs.withColumn("_twice", F.when(F.col("_sorted").isNotNull(), twice))
    covered = F.aggregate(
        "_twice", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("n")),
        lambda acc: acc["n"])
    return (docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
            .drop("_windows", "_sorted", "_twice"))


def trusted_marks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (_doc, _text) with ``_t``, 1 for trusted documents and else 0.

    A table of bits, of one size whatever the corpus, tells which documents can be
    trusted; only the texts of these are joined with the trusted identifiers, always by a shuffle of both sides.
    """
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("string").alias("_trusted")).distinct()
    looked = with_may(docs.withColumn("_doc", F.col("_doc").cast("string")), bit_table(trusted, "_trusted"), "_doc")
    other = looked.where("NOT _may").select("_text", F.lit(0).cast("long").alias("_t"))
    some = looked.where("_may").join(trusted.hint("merge"), F.col("_doc") == F.col("_trusted"), "left")
    return other.unionByName(some.select("_text", F.col("_trusted").isNotNull().cast("long").alias("_t")))


def ngram_table(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                buckets: int = BUCKETS, smoothing: float = 1.0) -> list[float]:
    """Log likelihood ratio of every bucket, from counts over all documents.

    The raw counts cover all words and neighbouring pairs of all documents, the
    target's those of all documents of good quality.
    Counting adds up per task before the shuffle and leaves at most one row
    per bucket, so the driver receives ``buckets`` rows whatever the corpus.
    """
    words = words_of(F.col("_text"))
    n = F.size(words)
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))).alias("b"))
    bucket = lambda x: F.pmod(x, F.lit(buckets)).cast("int")
    marked = trusted_marks(docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")), labels)
    counts = (marked.select("_t", F.explode(pairs).alias("_p"))
              .select("_t", F.xxhash64("_p.a").alias("_a"),
                      F.when(F.col("_p.b").isNotNull(), F.xxhash64("_p.b")).alias("_b"))
              .select("_t", F.explode(F.array(bucket(F.col("_a")), F.when(
                  F.col("_b").isNotNull(), bucket(F.xxhash64("_a", "_b"))))).alias("_bucket"))
              .where("_bucket IS NOT NULL")
              .groupBy("_bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("_t").alias("target")))
    raw, target = [smoothing] * buckets, [0.0] * buckets
    for r in counts.collect():  # one row per bucket at most
        raw[r["_bucket"]] += r["raw"]
        target[r["_bucket"]] += r["target"]
    # the target's counts are drawn towards the corpus by as much as one count for each bucket
    n, total, prior = sum(raw), sum(target), smoothing * buckets
    return [round(math.log((t + prior * r / n) / (total + prior) * n / r), 9) for t, r in zip(target, raw)]


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with the base measures, the score and ``kept``.

    A null or empty text has no words, fails the base rules and scores 0. A
    document that labels name twice counts once; labels without a document
    or with a null identifier do nothing. With no trusted document at all the
    ratio is flat and only the base rules decide. Repeated rows are judged
    each. Columns of ``docs`` that carry a result's name are replaced, all others kept, whatever their names.
    """
    docs = docs.drop(*RESULT)
    columns = docs.columns
    own = [f"c{i}" for i in range(len(columns))]  # no helper column has such a name
    id_col, text_col = own[columns.index(id_col)], own[columns.index(text_col)]
    docs = docs.toDF(*own)
    ratio = ngram_table(docs, labels, id_col, text_col, buckets)
    table = F.split(F.lit(",".join(map(str, ratio))), ",").cast("array<double>")  # folded to a constant
    weight = lambda x: F.get(table, F.pmod(x, F.lit(buckets)).cast("int"))
    follower = lambda x, i: F.coalesce(F.when(F.get("_hashed", i + 1).isNotNull(), weight(
        F.xxhash64(x, F.get("_hashed", i + 1)))), F.lit(0.0))
    rows = base_measures(docs, text_col).withColumn(
        "_total", F.aggregate(F.transform("_hashed", lambda x, i: weight(x) + follower(x, i)), F.lit(0.0), lambda a, x: a + x))
    rows = rows.withColumn("score", F.round(
        F.when(F.col("n_words") > 0, F.col("_total") / (2 * F.col("n_words") - 1)).otherwise(0.0), 9))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    # out of a generator: a filter on a plain ``kept`` would be pushed down with all that it is computed
    # from, which is then evaluated once more for every level of lambdas
    kept = F.explode(F.array(~F.col("base_failed") & (F.col("score") >= threshold)))
    return rows.select(*[F.col(o).alias(c) for o, c in zip(own, columns)], *RESULT[:-1], kept.alias("kept"))
