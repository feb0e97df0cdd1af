"""From raw documents to packed training sequences, in five stages that each use one operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame, the next one's docs.
All but the last return the columns of documents. ``run`` stores each stage's result in the folder that the cluster
names in spark.checkpoint.dir, so a lost executor never sets it back further than one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm.line_dedup import clean_lines
from tierstone.llm.near_dedup import without_near_copies
from tierstone.llm.packing import pack_documents
from tierstone.llm.quality import fit_line_field, quality_of
from tierstone.llm.secret_scan import without_secrets
from tierstone.sources.shared import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: No SQL: labelling lines, decoding layers and packing are no relational operations.
ORACLE_SQL = None


def _with_text(docs: DataFrame, text: F.Column) -> DataFrame:
    """The documents with another text and its length."""
    new = docs.withColumn("text", text)
    return new.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold the rules and are mostly content."""
    field = fit_line_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = docs.withColumn("_quality", quality_of(F.col("text"), field))
    return judged.where("_quality.kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that stand, or nearly stand, earlier in the corpus."""
    return _with_text(clean_lines(docs), F.col("text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near copies: five-word runs, similarity 0.8 or more."""
    return without_near_copies(docs).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets, encoded ones too."""
    return _with_text(docs, without_secrets(F.col("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
