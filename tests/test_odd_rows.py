"""Queries against their SQL on rows that the given tables have at size only: words at a line's end, entries that two searches find."""

import random

import duckdb
import pytest

import __spark_entry__ as entry
from lectern.functions import udfs as U


def differing(spark, folder, name, documents, labels=()):
    """Rows that only the query has, and that only its SQL has, over documents (doc_id, text, lang, source)."""
    rows = [(i, text, lang, source, len(text)) for i, text, lang, source in documents]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality long, toxic long").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    df = entry.queries()[name](spark, str(folder))
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    got = sorted(map(repr, (tuple(r[c] for c in want.columns) for r in df.collect())))
    wanted = sorted(map(repr, want.fetchall()))
    return [r for r in got if r not in wanted], [r for r in wanted if r not in got]


@pytest.mark.parametrize("name", ["names_turned", "first_names_turned"])
def test_a_word_before_a_line_break_is_none(spark, tmp_path, name):
    texts = [(i, f"osrami.\n lorem\n ipsum dolor{'.' * (i % 2)} sit", "en", "src11") for i in range(57)]
    assert differing(spark, tmp_path, name, texts) == ([], [])


def test_a_body_in_lower_case_is_a_word_of_the_text(spark, tmp_path):
    texts = [(i, ["thly states erantion", "states thly erantion", "thly erantion States", "office press staff"][i % 4], "en", "src1") for i in range(56)]
    assert differing(spark, tmp_path, "first_names_turned", texts) == ([], [])


def test_what_was_there_before_stays_live_when_it_is_linked(spark, tmp_path):
    rnd, words = random.Random(2), "old stone gardens hills kyoto lake".split()
    texts = [(i, " ".join(rnd.sample(words, rnd.randint(2, 3))) + ". x", ("en", "de")[i % 2], "src1") for i in range(200)]
    assert differing(spark, tmp_path, "cascade", texts) == ([], [])


def test_an_entry_found_by_both_searches_is_one_row(spark, tmp_path):
    texts = [(i, "lorem, en the ipsum", "en", "src1") for i in range(2)] + [(2, "lorem", "en", "src1"), (3, "dolor, en the", "de", "src2")]
    assert differing(spark, tmp_path, "search_borders", texts) == ([], [])


@pytest.mark.parametrize("name", ["title_coverage", "ladder_hits"])
def test_a_text_that_goes_on_with_a_is_no_statement_of_responsibility(spark, tmp_path, name):
    texts = [(i, "stupid With a onen worthless than, onaninnd", "en", "src1") for i in (7, 23, 82)] + [(2, "stupid. x", "en", "src1"), (12, "stupid words", "en", "src1")]
    assert differing(spark, tmp_path, name, texts) == ([], [])


def test_a_sharp_s_has_no_capital_in_a_title():
    assert [U.title_case(t) for t in ("the ßch of old", "ßch", "old ße: ße")] == ["The ßch of Old", "ßch", "Old ße: ße"]
