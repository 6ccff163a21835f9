"""From raw documents to packed training sequences, as written stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import linear_text, mixing, ngram_join, packing, secret_scan
from sparkloom.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_SHINGLE = 5  # words of a shingle of the near-duplicate stage
NEAR_PERCENT = 80  # least Jaccard measure of its near copies


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a learned language; a missing label is filled in.

    Texts that are null, empty or without a letter go. Repeated rows stay or go
    together, an empty table gives no rows, and other columns are left out.
    """
    docs = docs.select(*COLUMNS)
    model = linear_text.train(docs, "doc_id", "text", "lang")
    return linear_text.keep_accepted(docs, model, "text", "lang")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays, that with the smallest id.

    Similar are texts whose sets of five-word shingles have a Jaccard measure of
    80 % or more; the query ``op3_ngram_join`` has its own size and threshold.
    Rows are told apart by id and text, so rows that share an id but not a text
    are documents of their own; a null id comes after all others. Of rows that
    share both, one stays, that with the smallest other columns, nulls first.
    Null and empty texts are similar to none. The documents in question are
    written first, so that Spark knows their size.
    """
    of_row = F.struct(
        F.col("doc_id").isNull().alias("none"),
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"),
        F.xxhash64("text").alias("text"),
    )
    docs = docs.select(*COLUMNS).withColumn("row", of_row)
    found = ngram_join.jaccard_components(docs, "row", k=NEAR_SHINGLE, percent=NEAR_PERCENT)
    of_row = found.groupBy("row").agg(
        F.count("*").alias("rows"), F.max(F.col("component_id") < F.col("row")).alias("gone")
    )
    asked = of_row.where("gone OR rows > 1").select("row", "gone")
    asked = Scratch(spark, "near_duplicates").write(asked, "asked")
    single = docs.join(asked, "row", "left_anti")
    repeated = docs.join(asked.where("NOT gone"), "row", "left_semi").groupBy("row").agg(
        F.min(F.struct("lang", "source", "n_chars", "doc_id", "text")).alias("one")
    )
    return single.select(*COLUMNS).union(repeated.select(*[f"one.{c}" for c in COLUMNS]))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and lengths counted anew.

    A null text stays null and keeps its length; repeated rows are masked alike.
    """
    found = secret_scan.scan(docs.select(*COLUMNS))
    clean = found.select("doc_id", secret_scan.masked(found).alias("text"), "lang", "source", "n_chars")
    changed = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return clean.withColumn("n_chars", changed).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    A null source is a source of its own; null and empty texts count no words.
    """
    return mixing.mixed_documents(docs.select(*COLUMNS))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a sequence.

    Copies of a document and rows that share an id are packed each on their own.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("ngram_join", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixture),
    ("best_fit_packing", sequences),
]
# The first stage trains a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{number}_{name}")
    return docs
