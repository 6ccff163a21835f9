"""The operators as queries over the test tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    cover_tree,
    decontaminate,
    filter_audit,
    linear_text,
    main_text,
    mixing,
    ngram_join,
    packing,
    posting_lists,
    quality_rff,
    secret_scan,
    sharding,
    spelling,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """The fold of a row: the CRC-32 of its key as text, modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_rff.score_quality(docs, labels.where(fold("doc_id", 3) != 1))
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = linear_text.train(docs.where(fold("doc_id", 5) != 0), "doc_id", "text", "lang")
    found = linear_text.predict(docs, model)
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "accepted")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cover_tree.top_k(
        table(spark, sf_dir, "embeddings"),
        lambda key: key % 50 == 0,
        k=5,
        transform=lambda x: F.floor(F.lit(256.0) * x).cast("double"),
    )
    return found.withColumn("score", F.col("score").cast("long"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return posting_lists.nearest(vectors, lambda key: key % 20 == 0, k=20)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digests(secret_scan.scan(docs))


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digests(decontaminate.overlaps(docs, benchmark))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = filter_audit.flagged(table(spark, sf_dir, "documents"))
    return filter_audit.audit(marked, table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), slips=spelling.SLIPS)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(e AS DOUBLE)) FOR e IN embedding] AS x
  FROM embeddings),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
            AS rank
  FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def queries() -> dict[str, Query]:
    return {
        "op1_sharding": op1_sharding,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_ngram_join": op3_ngram_join,
        "op4_mixing": op4_mixing,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_language_id": op6_language_id,
        "op7_html_extraction": op7_html_extraction,
        "op8_exact_top_k": op8_exact_top_k,
        "op9_nearest_neighbours": op9_nearest_neighbours,
        "op10_secret_scan": op10_secret_scan,
        "op11_benchmark_decontamination": op11_benchmark_decontamination,
        "op12_filter_audit": op12_filter_audit,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    """SQL twins; the others are tested against brute force, round trips or held-out labels."""
    return {
        "op1_sharding": sharding.oracle_sql(),
        "op3_ngram_join": ngram_join.ORACLE_SQL,
        "op4_mixing": mixing.ORACLE_SQL,
        "op8_exact_top_k": OP8_SQL,
        "op11_benchmark_decontamination": decontaminate.ORACLE_SQL,
        "op12_filter_audit": filter_audit.ORACLE_SQL,
        "op13_spelling_variants": spelling.ORACLE_SQL,
    }
