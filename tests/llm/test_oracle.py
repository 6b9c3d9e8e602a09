"""The queries' rows by DuckDB, to the last digit, and what every query must keep."""

import pytest
from oracle_check import differences, duck

import __spark_entry__ as driver
from tickwright.llm.oracle import ORACLE_SQL
from tickwright.llm.queries import QUERIES

CONTRACTS = {
    "op1": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op2": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op4": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5": "page_id payload_bytes payload_digest record_type refers_to",
    "op6": "doc_id item_id",
    "op7": "doc_id n_shingles component_id kept",
    "op8": "doc_id size text_crc32 law shard slot grown_shard",
    "op9": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op10": "doc_id held_out score predicted",
    "op11": "lang rank phrase a l r n score",
    "op12": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op13": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert differences(driver.queries()[name](spark, sf_dir), con, driver.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_has_its_columns(spark, sf_dir, name):
    found = driver.queries()[name](spark, sf_dir)
    assert set(CONTRACTS[name.split("_")[0]].split()) <= set(found.columns)
    assert found.limit(1).count() == 1


def test_all_operators_and_the_pipeline_are_registered():
    names = [n.split("_")[0] for n in QUERIES]
    assert sorted(names) == sorted(CONTRACTS) and "pipeline" in driver.queries()
