"""The registered queries beside their SQL on the smallest tables, and their contracts' columns."""

import os

import duckdb
import pytest

from lectern.llm import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
COLUMNS = {
    "op1_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op2_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op3_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op6_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.mark.parametrize("name", list(Q.oracle_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, want = Q.queries()[name](spark, SF), con.sql(Q.oracle_sql()[name])
    names = sorted(want.columns)
    assert sorted(df.columns) == names
    rows = lambda found, columns: sorted(repr([r[columns.index(n)] for n in names]) for r in found)
    assert rows(df.collect(), df.columns) == rows(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", [n for n in COLUMNS if n not in Q.oracle_sql()])
def test_contract(spark, name):
    df = Q.queries()[name](spark, SF)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    assert df.columns == COLUMNS[name] and df.count() == table.count()


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries()) == list(range(1, 14))
