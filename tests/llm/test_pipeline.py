"""The pipeline against the brute-force forms of its stages."""

import re

import pytest

import corpus_pipeline
from loanfold.llm import mixing, quality
from tests.llm import test_decontamination, test_simhash
from tests.llm.helpers import documents

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_the_right_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = stage(spark, docs, SF_DIR)
        rows = after.collect()
        seen[name] = len(rows)
        if stage is corpus_pipeline.mixed:
            assert {r.doc_id for r in rows} == set(before)
            assert all(r.size == len(re.findall(mixing.WORD, before[r.doc_id])) for r in rows)
            break
        assert after.columns == docs.columns
        kept = {r.doc_id: r.text for r in rows}
        if stage is corpus_pipeline.good_quality:
            scores = quality.quality(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()
            assert set(kept) == {r.doc_id for r in scores if r.predicted}
        if stage is corpus_pipeline.one_of_each_group:
            assert set(kept) == {c for _, _, c in test_simhash.plain_components(list(before.items()))}
        if stage is corpus_pipeline.without_benchmark:
            hit = {r[0] for r in test_decontamination.plain(list(before.items()), items) if r[5]}
            assert hit and {i for i in kept if kept[i] != before[i]} == hit
            assert not any(r[5] for r in test_decontamination.plain([(i, kept[i]) for i in hit], items))
        docs = spark.createDataFrame(rows, docs.schema)
    assert seen["mixing sources to target weights"] > 100


@pytest.mark.parametrize("rows", [[], [(None, None), (1, None), (1, ""), (None, "a b"), (2, "word " * 20_000)]])
def test_odd_rows_pass_every_stage(spark, rows):
    docs = documents(spark, rows or [(1, "")], extra=True)
    docs = docs if rows else docs.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame((after := stage(spark, docs, SF_DIR)).collect(), after.schema)
