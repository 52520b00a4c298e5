"""Every query over the smallest given tables: columns, rows, and rows of SQL where there is SQL."""

from pathlib import Path

import pytest

import corpus_pipeline
from fundlake.llm.queries import ALL, SQL
from workloads.check import connect, differences

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are not here")

COLUMNS = {
    "op1_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op2_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op3_substrings": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op4_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5_decontaminate": "doc_id bigint, item_id bigint",
    "op6_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op7_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
    "op8_html_text": "page_id bigint, url string, text string, n_chars bigint",
    "op9_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op10_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op11_merkle": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op12_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op13_conversations": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
}
#: Tables of which a query returns a row for each row.
WHOLE = {"op1_ngram_join": "documents", "op2_warc": "pages", "op3_substrings": "documents", "op4_language": "documents", "op8_html_text": "pages", "op9_token_counts": "documents", "op10_quality": "documents", "op11_merkle": "documents", "op12_rules": "documents"}


def test_all_are_registered():
    assert set(ALL) == set(COLUMNS) and set(SQL) <= set(ALL)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicate", "substring", "decontaminate", "pack"]


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query(spark, name):
    df = ALL[name](spark, FOLDER)
    assert ", ".join(f"{c} {kind}" for c, kind in df.dtypes).startswith(COLUMNS[name])
    rows = df.count()
    assert rows == spark.read.parquet(f"{FOLDER}/{WHOLE[name]}.parquet").count() if name in WHOLE else rows > 0
    if name in SQL:
        assert differences(df, connect(FOLDER), SQL[name]) == []
