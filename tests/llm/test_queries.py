"""The registered queries: SQL, result columns, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as E
import corpus_pipeline
from regfuse.llm import queries
from tests.conftest import SF_MID, SF_SMALL
from tests.oracle_compare import compare, duck

COLUMNS = {
    "op1_minhash_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op2_line_dedup": ["doc_id", "n_lines", "n_dropped", "n_chars", "text_md5"],
    "op3_license_scan": ["doc_id", "licenses", "n_notices", "whole_text"],
    "op4_benchmark_decontamination": ["doc_id", "item_id", "score", "end_word"],
    "op5_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op6_html_main_text": ["page_id", "url", "text", "n_chars"],
    "op7_source_mixing": ["doc_id", "source", "size", "source_size", "target", "copies", "taken"],
    "op8_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op9_token_store": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op10_quality_classifier": ["doc_id", "host", "path", "doc_score", "site_score", "score", "kept"],
    "op11_hard_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op12_web_archives": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op13_lexical_search": ["item_id", "rank", "doc_id", "score"],
}


def test_all_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS)
    assert set(COLUMNS) | {"pipeline"} <= set(E.queries())
    assert set(queries.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    r = compare(spark, SF_MID, name, duck(SF_MID))
    assert r["cols_equal"] and r["spark_rows"] == r["duck_rows"] and r["values_equal"], r


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(queries.ORACLE)))
def test_columns(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.columns == COLUMNS[name]
    assert df.count() > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, left = docs.columns, {docs.count()}
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(stage(spark, rows, SF_SMALL).collect(), docs.schema)
        assert rows.columns == columns, name
        left.add(rows.count())
    assert len(left) > 3  # decisions take effect
    last = corpus_pipeline.STAGES[-1][1](spark, rows, SF_SMALL).collect()
    assert len(last) == rows.count()
    whole = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, last))


def test_stages_take_empty_tables_and_nulls(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, "A plain text, nothing else.", "en", "a", 5), (2, None, None, None, None), (None, "Another text, also plain.", "en", "a", 1)]
    for data in ([], rows):
        df = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, df, SF_SMALL).count() <= 3 * max(1, len(data)), name
