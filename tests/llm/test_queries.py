"""Registered queries: SQL twins, and one row for each row where the contract says so."""

import pytest

import __spark_entry__ as E
from dosewise.checks.compare import compare, duck_connect
from dosewise.llm import queries
from dosewise.llm.common import table

SF = "/root/testdata/sf0.01"
COLUMNS = {
    "op1_simhash_near_dedup": "doc_id fingerprint component_id", "op2_quality_fm": "doc_id held_out score predicted",
    "op3_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op8_toxicity_pu": "doc_id held_out score predicted",
    "op9_token_counts": "doc_id n_words n_tokens",
}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    r = compare(E.queries()[name](spark, SF), duck_connect(SF), E.oracle_sql()[name])
    assert r["match"], r


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_for_each_document(spark, name):
    got = E.queries()[name](spark, SF)
    assert got.columns == COLUMNS[name].split()
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in table(spark, SF, "documents").select("doc_id").collect())


def test_pipeline_is_registered(spark):
    assert "pipeline" in E.queries() and set(queries.QUERIES) <= set(E.queries())


def test_op5_keeps_near_copies_of_other_sources_apart(spark, tmp_path):
    line = " ".join(f"w{i}" for i in range(400))
    rows = [(i, line.upper() if i % 2 else line + " " * i, "en", f"s{i}", None) for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op5_best_fit_packing(spark, str(tmp_path)).collect()
    assert len({(r["shard"], r["bin"]) for r in got}) == len(got) == 6
