"""The registered query of each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.llm import (
    hard_negatives,
    license_scan,
    line_dedup,
    packing,
    periodic_runs,
    quality,
    quotes,
    secret_scan,
    sentencepieces,
    simhash,
    substrings,
    token_counts,
    topk,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(plan):
    QUERIES[plan.__name__] = plan
    return plan


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.digest(secret_scan.scan(_table(spark, folder, "documents")))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


@_query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return scored.select("doc_id", *measures, "base_failed", "kept", "llr", "threshold")


@_query
def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"), shingle=3, max_bits=2)


@_query
def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


ORACLES["op5_exact_top_k"] = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@_query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(_table(spark, folder, "documents"))
    ids = F.transform("pieces", lambda p: p["doc_id"])
    return packed.withColumn("doc_ids", ids).withColumn("tokens_sha256", F.sha2("tokens", 256)).drop("tokens")


@_query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", F.col("text").alias("before"))
    return line_dedup.dedup(docs, max_edits=1, min_chars=1, min_edit_chars=20).select(
        "doc_id",
        F.size(F.split("before", "\n")).alias("n_lines_before"),
        F.length("text").alias("n_chars_kept"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


@_query
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(_table(spark, folder, "documents")))


@_query
def op4_chat_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.conversations(_table(spark, folder, "conversations"))


@_query
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = sentencepieces.decode(sentencepieces.encode(docs))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@_query
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.dedup(_table(spark, folder, "documents"), min_bytes=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@_query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, label_col=label).drop("positive_rank")


ORACLES["op12_hard_negatives"] = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.w, b.w) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same
), negatives AS (
    SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
    WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's own periodic tails: where h % 10 = 0, each word from a on becomes original word a + (i - a) % p."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def tail(found):  # bound to a variable, so that the text is split once
        w, h = found["words"], found["h"]
        n, g = F.size(w).cast("long"), F.floor(h / 10).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))

        def joined(bounds):
            first, period = bounds["a"], bounds["p"]
            place = lambda i: F.when(i < first, i).otherwise(first + F.pmod(i - first, period)).cast("int")
            return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, place(i))), " ")

        return F.when(n > 0, F.transform(F.array(F.struct(a.alias("a"), p.alias("p"))), joined)[0]).otherwise("")

    h = F.crc32(F.col("doc_id").cast("string"))
    changed = F.transform(F.array(F.struct(words.alias("words"), h.alias("h"))), tail)[0]
    return docs.withColumn("text", F.when(h % 10 == 0, changed).otherwise(F.col("text")))


@_query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _with_planted_runs(_table(spark, folder, "documents"))
    return periodic_runs.digest(periodic_runs.find(docs, min_length=6, min_exponent=4))
