"""The queries op1 .. op10 over the whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk_search import top_k

    rows = table(spark, sf_dir, "embeddings")
    whole = rows.select("vec_id", F.transform("embedding", lambda v: F.floor(v.cast("double") * 64).cast("double")).alias("vector"), F.exists("embedding", lambda v: F.isnan(v) | (F.abs(v) == float("inf"))).alias("odd"))
    whole = whole.withColumn("vector", F.when(~F.coalesce("odd", F.lit(False)), F.col("vector")))
    return top_k(whole, F.col("vec_id") % 20 == 0, k=20)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of low quality and toxicity, the categories that the labels hold, and toxic from 0.5."""
    from .toxicity import score, train

    docs, chain = table(spark, sf_dir, "documents"), ["low_quality", "toxic"]
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    found = score(docs, train(docs, labels, chain), chain)
    return found.select("doc_id", F.col("low_quality").alias("p_low_quality"), F.col("toxic").alias("p_toxic"), (F.col("toxic") >= 0.5).alias("toxic"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    cut = remove_repeats(table(spark, sf_dir, "documents"), window=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), shingle=3, threshold=90)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymise, session_key

    return pseudonymise(table(spark, sf_dir, "documents"), session_key(spark)).select("doc_id", "text", F.size("spans").alias("n_replaced"), F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["kind"]))).alias("kinds"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hilbert import hilbert_shards, label_number, size_number

    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", size.alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("text_hash"))
    dimensions = [label_number(F.col("lang")), label_number(F.col("source")), size_number(F.col("size"))]
    placed = hilbert_shards(rows, dimensions, F.col("text_hash"), F.col("doc_id"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve_index", "lang", "source")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of the documents, as files in the folder source/lang."""
    from .license_scan import scan

    rows = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    return scan(rows.withColumn("_path", path), path_col="_path")


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import predict, train

    rows = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    model = train(rows.filter("doc_id is not null and not held_out"))
    return predict(rows, model, ["doc_id", "held_out"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_topk_search, op2_toxicity, op3_packing, op4_suffix_dedup, op5_jaccard_join, op6_pii, op7_decontamination, op8_hilbert_sharding, op9_language_id, op10_license_scan)
}

ORACLE_SQL: dict[str, str] = {
    "op1_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 20""",
    # windows of 100 bytes as hexadecimal text; a window that stands earlier too marks its bytes
    "op4_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS s FROM d),
        r AS (SELECT doc_id, s FROM (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS m FROM w) QUALIFY row_number() OVER (PARTITION BY m ORDER BY doc_id, s) > 1),
        i AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS n FROM (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 100 THEN 0 ELSE 1 END AS fresh FROM r)),
        p AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM i GROUP BY doc_id, n),
        g AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM p),
        k AS (SELECT g.doc_id, sum(b - a) AS removed, count(*) AS spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM g JOIN d USING (doc_id) GROUP BY g.doc_id)
        SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
        FROM d LEFT JOIN k ON k.doc_id = d.doc_id""",
    # every pair of documents that share a shingle, and what links reach
    "op5_jaccard_join": """
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM w),
        t AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
        reach(a, b) AS (SELECT a, b FROM p UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a)
        SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(c, s.doc_id)) AS component_id FROM s LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = s.doc_id""",
}
