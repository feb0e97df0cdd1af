"""The operators over the test tables: name -> (query, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm.burst_trie import conversation_trie
from tierstone.llm.licences import licences_in
from tierstone.llm.line_dedup import without_repeated_lines
from tierstone.llm.oracles import CONVERSATION_TRIE, REPEATED_BYTES, SPELLING
from tierstone.llm.packing import pack_documents
from tierstone.llm.page_text import fit_labeller, main_text
from tierstone.llm.piece_sampling import sampled_documents
from tierstone.llm.quality import fit_line_field, quality_of
from tierstone.llm.run_index import without_passages
from tierstone.llm.secret_scan import KINDS, secrets_in
from tierstone.llm.simhash import near_copies
from tierstone.llm.spelling import spelling_groups
from tierstone.llm.substring_dedup import without_repeats
from tierstone.llm.vantage_trees import nearest_neighbours

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def bound(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _listed(findings: F.Column) -> F.Column:
    """kind:start:stop by start, then kind as listed, joined by commas."""
    rank = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(findings, lambda f: F.struct(
        f["start"], F.array_position(rank, f["kind"]).alias("rank"), f["stop"],
        F.concat_ws(":", f["kind"], f["start"].cast("string"), f["stop"].cast("string")).alias("shown"),
    ))
    return F.array_join(F.transform(F.array_sort(keyed), lambda f: f["shown"]), ",")


@bound("op1_secret_scan")
def op1_secret_scan(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", secrets_in(F.col("text")).alias("r"))
    found = F.col("r.findings")
    base = F.filter(found, lambda f: f["layer"] == 0)
    kinds = F.transform(base, lambda f: f["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return docs.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(found).alias("spans"),
        F.col("r.layers").alias("n_layers"), F.col("r.cut_layers").alias("n_cut_layers"),
    )


@bound("op2_nearest_neighbours")
def op2_nearest_neighbours(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"), 5)


@bound("op3_substring_dedup", r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i, len(ws) AS n FROM w),
s AS (
  SELECT doc_id, i, n, string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS words FROM p),
r AS (
  SELECT doc_id, i FROM s WHERE i <= n - 19
  QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1),
c AS (
  SELECT p.doc_id, p.i, word, max(r.i) OVER (
    PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND p.i = r.i),
k AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id""")
def op3_substring_dedup(spark, sf):
    kept = without_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@bound("op4_packing")
def op4_packing(spark, sf):
    return pack_documents(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


@bound("op5_line_dedup")
def op5_line_dedup(spark, sf):
    kept = without_repeated_lines(table(spark, sf, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_removed", "n_links", digest.alias("kept_sha256"))


@bound("op6_simhash")
def op6_simhash(spark, sf):
    return near_copies(table(spark, sf, "documents"))


@bound("op7_licences")
def op7_licences(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", licences_in(F.col("text")).alias("r"))
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return docs.select("doc_id", *[F.col(f"r.{n}").alias(n) for n in names])


@bound("op8_quality_rules")
def op8_quality_rules(spark, sf):
    docs = table(spark, sf, "documents")
    field = fit_line_field(docs, table(spark, sf, "labels"))
    names = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share",
    )
    judged = docs.select("doc_id", quality_of(F.col("text"), field).alias("r"))
    return judged.select("doc_id", *[F.col(f"r.{n}").alias(n) for n in names])


@bound("op9_page_text")
def op9_page_text(spark, sf):
    pages = table(spark, sf, "pages")
    labeller = fit_labeller(pages)
    texts = pages.select("page_id", "url", main_text(F.col("html"), labeller).alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


@bound("op10_piece_sampling")
def op10_piece_sampling(spark, sf):
    docs = sampled_documents(table(spark, sf, "documents"), public_tokenizers.path(PIECES))
    return docs.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@bound("op11_burst_trie", CONVERSATION_TRIE)
def op11_burst_trie(spark, sf):
    return conversation_trie(table(spark, sf, "conversations"))


@bound("op12_spelling", SPELLING)
def op12_spelling(spark, sf):
    return spelling_groups(table(spark, sf, "documents"))


@bound("op13_run_index", REPEATED_BYTES)
def op13_run_index(spark, sf):
    kept = without_passages(table(spark, sf, "documents"))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return kept.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))
