"""The registered corpus queries over the smallest tables: against their SQL, and the columns their contracts name."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from loanfold.llm.queries import ORACLES, QUERIES
from loanfold.session import scratch, shared_folder
from tests.compare import canonical, connect, kind

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op4_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op5_substrings": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op6_mtree": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op7_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op8_html": "page_id bigint, url string, text string, n_chars bigint",
    "op9_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op11_wordruns": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
                     "runs_sha256 string, collapsed_sha256 string",
    "op12_spelling": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op13_contentsort": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
}


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows_as_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    result = connect(SF_DIR).execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    kinds = {c[0]: kind(str(c[1])) for c in result.description}
    names = sorted(columns)
    assert sorted(df.columns) == names
    assert {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields} == kinds
    mine = canonical(df.collect(), [df.columns.index(c) for c in names])
    assert mine == canonical(result.fetchall(), [columns.index(c) for c in names])


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    types = dict(df.dtypes)
    assert {c.split()[0]: types.get(c.split()[0]) for c in COLUMNS[name].split(", ")} == dict(
        c.split() for c in COLUMNS[name].split(", "))


def test_all_are_registered():
    names = entry.queries()
    assert [f"op{n}_" for n in range(1, 14)] == sorted(
        {n.split("_")[0] + "_" for n in names if n.startswith("op")}, key=lambda x: int(x[2:-1]))
    assert names["pipeline"] is corpus_pipeline.run and set(ORACLES) <= set(entry.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


def test_scratch_removes_what_a_query_wrote(spark):
    folder = f"{shared_folder(spark)}/loanfold"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with scratch(spark):
        assert QUERIES["op10_simhash"](spark, SF_DIR).count() > 0
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def test_reruns_agree(spark):
    for name in ("op4_mixing", "op9_quality", "op10_simhash"):
        once, again = (sorted(map(tuple, QUERIES[name](spark, SF_DIR).collect())) for _ in range(2))
        assert once == again
