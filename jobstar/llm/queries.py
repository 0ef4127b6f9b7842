"""Queries of the llm operators over the driver's tables, with DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_exact_dedup", """
    WITH d AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
        FROM documents),
    g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
    FROM d JOIN g USING (norm)
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: exact duplicates of every document."""
    from jobstar.llm.exact import exact_dedup
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op2_warc", """
    WITH d AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
    f AS (SELECT b, min(page_id) AS least FROM d GROUP BY b)
    SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
               ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
           CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> least THEN least END AS refers_to, CAST(NULL AS VARCHAR) AS error
    FROM d JOIN f USING (b)
""")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: every page written to WARC archives and read back."""
    from jobstar.llm.warc import warc_roundtrip
    return warc_roundtrip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


@register("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: quality rules of every document."""
    from jobstar.llm.quality import RESULT, quality_rules
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", *RESULT)


@register("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: all documents packed into sequences of 4096 ids."""
    import public_tokenizers

    from jobstar.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          public_tokenizers.path("word_bpe_49k.json"))


@register("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: every document encoded to byte-level BPE ids and decoded."""
    import public_tokenizers

    from jobstar.llm.bpe import roundtrip_digests
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return roundtrip_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).drop("text")


@register("op7_minhash", """
    WITH RECURSIVE d AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
                              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d),
    t AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS n, any_value(b.n) AS m
          FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
    l AS (SELECT x, y FROM p WHERE 100 * c >= 85 * (n + m - c)),
    e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    r(doc_id, comp) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.comp FROM r JOIN e ON e.x = r.doc_id WHERE r.comp < e.y),
    k AS (SELECT doc_id, min(comp) AS component_id FROM r GROUP BY doc_id)
    SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN k USING (doc_id)
""")
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: near-duplicate groups of all documents, three-word shingles, similarity 0.85."""
    from jobstar.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: toxicity of every document."""
    from jobstar.llm.toxicity import RESULT, score_toxicity
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, table(spark, sf_dir, "labels")).select("doc_id", *RESULT)


@register("op9_langid")
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: language of every document."""
    from jobstar.llm.langid import RESULT, identify_languages
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_languages(docs).select("doc_id", *RESULT)


@register("op10_suffix_array", """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    s AS (SELECT doc_id, j, substr(h, CAST(1024 * j + 1 AS BIGINT), 1422) AS s FROM (
        SELECT doc_id, h, unnest(range(0, len(h) // 1024 + 1)) AS j FROM d)),
    k AS (SELECT doc_id, 512 * j + o AS p, md5_number(substr(s, CAST(2 * o + 1 AS BIGINT), 400)) AS m FROM (
        SELECT doc_id, j, s, unnest(range(0, least(512, len(s) // 2 - 199))) AS o FROM s WHERE len(s) >= 400)),
    f AS (SELECT m FROM k GROUP BY m HAVING count(*) > 1),
    r AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM k SEMI JOIN f USING (m)),
    i AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p - before > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS n FROM r),
    c AS (SELECT doc_id, n, min(p) AS a, max(p) + 200 AS b FROM i GROUP BY doc_id, n),
    l AS (SELECT doc_id, list({'a': a, 'b': b} ORDER BY a) AS cuts, sum(b - a) AS gone FROM c GROUP BY doc_id),
    e AS (SELECT doc_id, h, coalesce(gone, 0) AS gone, coalesce(len(cuts), 0) AS n, list_concat([0], list_transform(coalesce(cuts, []), lambda x: x.b)) AS a,
                 list_concat(list_transform(coalesce(cuts, []), lambda x: x.a), [len(h) // 2]) AS b FROM d LEFT JOIN l USING (doc_id))
    SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(gone AS BIGINT) AS n_removed, CAST(n AS BIGINT) AS n_spans,
           sha256(unhex(array_to_string(list_transform(range(1, len(a) + 1), lambda j:
               substr(h, CAST(2 * a[j] + 1 AS BIGINT), CAST(2 * (b[j] - a[j]) AS BIGINT))), ''))) AS kept_sha256
    FROM e
""")
def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: every byte of a repeated 200-byte string removed."""
    from pyspark.sql import functions as F

    from jobstar.llm.suffix_array import suffix_dedup
    out = suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@register("op4_fm_index", """
    WITH d AS (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50),
    k AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM s),
    f AS (SELECT h, min(doc_id) AS least FROM k GROUP BY h),
    r AS (SELECT doc_id, p FROM k JOIN f USING (h) WHERE doc_id > least),
    c AS (SELECT DISTINCT doc_id, p + o AS p FROM r, (SELECT unnest(range(0, 50)) AS o)),
    g AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
        sha256(coalesce(array_to_string(list_filter(list_transform(w, lambda x, i: CASE WHEN list_contains(coalesce(gone, []), i)
            THEN NULL ELSE x END), lambda x: x IS NOT NULL), ' '), '')) AS kept_sha256
    FROM d LEFT JOIN g USING (doc_id)
""")
def op4_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: words of every 50-word window that an earlier document has, removed."""
    from pyspark.sql import functions as F

    from jobstar.llm.fm_index import fm_dedup
    out = fm_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op11_merge_automaton")
def op11_merge_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: every document encoded to word BPE ids by the tokenization automaton and decoded."""
    import public_tokenizers

    from jobstar.llm.merge_automaton import roundtrip_digests
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return roundtrip_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


def _centroid_sql(clusters: int = 16, rounds: int = 3) -> str:
    """The rounds one after the other; integers throughout, floors of negative quotients by the remainder."""
    steps = [f"""
    kept AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
        WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
    c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, q AS c FROM kept
        ORDER BY sha256('1:' || vec_id) LIMIT {clusters})"""]
    near = """
    a{i} AS (SELECT vec_id, any_value(q) AS q, min({{'d': d, 'cluster': cluster}}) AS b FROM (
        SELECT vec_id, q, cluster, CAST(list_sum([(q[p] - c[p]) * (q[p] - c[p]) FOR p IN range(1, 65)]) AS BIGINT) AS d FROM kept, c{i}) GROUP BY vec_id)"""
    for i in range(rounds):
        steps.append(near.format(i=i))
        steps.append(f"""
    m{i} AS (SELECT b.cluster AS cluster, p, sum(q[p]) AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, 65)) AS p)
        GROUP BY b.cluster, p),
    c{i + 1} AS (SELECT cluster, coalesce(v, c) AS c FROM c{i} LEFT JOIN (
        SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS v FROM m{i} GROUP BY cluster) USING (cluster))""")
    steps.append(near.format(i=rounds))
    return "WITH" + ",".join(steps) + f"""
    SELECT vec_id, CAST(b.cluster AS INTEGER) AS cluster, b.d AS distance,
        CAST(sum(b.d) OVER (PARTITION BY b.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} ON b.cluster = c{rounds}.cluster"""


@register("op12_laesa", _centroid_sql())
def op12_laesa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: all whole vectors in 16 clusters, centroids pruned by a pivot table."""
    from jobstar.llm.centroids import RESULT, cluster_vectors
    return cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select("vec_id", *RESULT)


@register("op13_era_phrases", """
    WITH t AS (
        SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM t),
    p AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
    f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM p GROUP BY ALL),
    n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS v FROM f WHERE k > 1 AND f >= 10),
    u AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
    s AS (
        SELECT u.*, x.f AS l, y.f AS r, 1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS score
        FROM u JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(u.v[1:u.cut], ' ')
        JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(u.v[u.cut + 1:u.k], ' ')),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    h AS (
        SELECT lang, phrase, max(a) AS longer FROM (
            SELECT lang, a, array_to_string(v[1:2], ' ') AS phrase FROM c WHERE k = 3
            UNION ALL SELECT lang, a, array_to_string(v[2:3], ' ') FROM c WHERE k = 3) GROUP BY ALL),
    o AS (
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase, a, l, r, score
        FROM b LEFT JOIN h ON b.k = 2 AND h.lang = b.lang AND h.phrase = b.phrase
        WHERE longer IS NULL OR 100 * longer < 50 * a)
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o JOIN n USING (lang)
    WHERE rank <= 2000
""")
def op13_era_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: each language's collocations of two and three words over all documents."""
    from jobstar.llm.phrases import collocations
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))
