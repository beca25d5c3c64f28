"""Registered queries of the package against DuckDB, and the columns the contracts ask for."""

import pytest

import __spark_entry__ as E
from cordon.llm.oracle import llm_oracle_sql
from cordon.llm.queries import llm_queries
from tools.compare import compare, duck_connection

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_suffix_merge_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op3_license_rules": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
                          "base_labels": "string", "labels": "string", "score": "double"},
    "op4_jaccard_metric_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op6_candidate_boosting_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
                                   "base_sha256": "string", "spans": "string"},
    "op7_simple8b_tokens": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op8_host_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
                       "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean", "n_failed": "bigint", "host_rate": "double", "host_rejected": "boolean"},
    "op9_entropy_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op10_fair_queue_mix": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
}


@pytest.mark.parametrize("name", sorted(llm_oracle_sql()))
def test_query_matches_oracle(spark, name):
    ok, message = compare(llm_queries()[name](spark, SF), duck_connection(SF), llm_oracle_sql()[name])
    assert ok, message


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_of_the_contracts(spark, name):
    kinds = dict(llm_queries()[name](spark, SF).dtypes)
    assert list(kinds.items())[:len(COLUMNS[name])] == list(COLUMNS[name].items())


def test_entry_registers_all():
    names = set(E.queries())
    assert set(llm_queries()) <= names and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


def test_native_operators_run_no_python(spark):
    """Plans of the native operators hold no Python node."""
    jvm = spark._jvm
    for name in ("op2_quote_linking", "op6_candidate_boosting_pii", "op8_host_rules", "op9_entropy_secrets", "op10_fair_queue_mix"):
        df = llm_queries()[name](spark, SF)
        text = jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        assert not any(word in text for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin")), name
