"""The pipeline stage by stage, and every query once over the smallest tables."""

import pytest

import __spark_entry__
import corpus_pipeline
from tierstone.llm import line_dedup, quality, queries, secret_scan, simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "secret_scan", "packing"]
    before = {r.doc_id: r for r in docs.collect()}
    field = quality.fit_line_field(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF))
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "quality_rules":
            memory = quality.WordHashes()
            assert set(after) == {d for d, r in before.items() if quality.report(r.text, memory, field)["kept"]}
            assert all(after[d] == before[d] for d in after)
        elif name == "line_dedup":
            lines = [x for d in sorted(after) for _, x in line_dedup.compared_lines(after[d].text)]
            assert set(after) == set(before) and len(lines) == len(set(lines))
        elif name == "simhash_near_dedup":
            prints = [simhash.fingerprint(r.text) for r in after.values()]
            assert all(bin(a ^ b).count("1") > 4 for i, a in enumerate(prints) for b in prints[:i])
            assert all(after[d] == before[d] for d in after)
        else:
            assert set(after) == set(before)
            assert not any(f for r in after.values() for f in secret_scan.scan_text(r.text)[0])
        before = after
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == set(before)
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())


def test_pipeline_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


CONTRACT = {
    "op1_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op2_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op3_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op4_packing": {
        "doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint",
        "offset": "bigint",
    },
    "op5_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_removed": "bigint", "n_links": "bigint", "kept_sha256": "string"},
    "op6_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7_licences": {
        "doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string",
        "labels": "string", "score": "double",
    },
    "op8_quality_rules": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op9_page_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op10_piece_sampling": {"doc_id": "bigint", "n_pieces": "bigint"},
    "op11_burst_trie": {
        "conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint",
        "saved_tokens": "bigint", "ends_sha256": "string",
    },
    "op12_spelling": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    "op13_run_index": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
}


@pytest.mark.parametrize("name", CONTRACT)
def test_query_keeps_its_contract(spark, name):
    assert name in __spark_entry__.queries()
    df = queries.QUERIES[name](spark, SF)
    types = dict(df.dtypes)
    assert {c: types[c] for c in CONTRACT[name]} == CONTRACT[name]
    table = {"op2": "embeddings", "op9": "pages", "op11": "conversations"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    n = df.count()
    if name.startswith("op2"):
        assert n == 5 * rows.where("vec_id % 50 = 0").count()
    elif name.startswith("op4"):
        assert df.select("doc_id").distinct().count() == rows.count()
    elif name.startswith("op11"):
        assert df.where("depth = 0").collect()[0].n_convs == rows.select("conv_id").distinct().count()
    elif name.startswith("op12"):
        assert n == df.select("word").distinct().count()
    else:
        assert n == rows.count()
