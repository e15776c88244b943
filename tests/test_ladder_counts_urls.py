"""Searches by rungs, counters of a write, addresses and look-ups that are kept."""

import unicodedata

from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import ladder as L
from lectern.operators import language, worklists
from lectern.sources import sinks


def test_only_open_records_go_on(spark):
    records = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "x", "y"]), (3, ["q"]), (4, []), (5, ["a", "a", "b"])], "record int, words array<string>")
    corpus = spark.createDataFrame([(10, ["a", "b", "c", "d"]), (11, ["a", "x"]), (12, ["b", "a"]), (13, None)], "candidate int, words array<string>")
    seen = []

    def rung(n):
        inner = L.word_rung(corpus, n)

        def run(open_):
            seen.append(sorted(r.record for r in open_.select("record").collect()))
            return inner(open_)

        return run

    hits, asked = L.climb(records, "record", [rung(3), rung(2), rung(1)])
    assert seen == [[1, 2, 3, 4, 5], [2, 3, 4], [3, 4]] and asked == [5, 3, 2]
    assert sorted(map(tuple, hits.collect())) == [(1, 10, 0), (2, 11, 1), (5, 10, 0), (5, 12, 0)]
    hits, asked = L.climb(records.filter("record IN (1, 5)"), "record", [rung(3), rung(2)])
    assert asked == [2] and hits.count() == 3  # nothing is open: the second rung is not run
    hits, asked = L.climb(records.limit(0), "record", [rung(3), rung(2)])
    assert asked == [0] and hits.columns == ["record", "candidate", "stage"] and hits.count() == 0


def test_counters_are_observed_by_the_write(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def once(batches):
        for pdf in batches:
            made.add(len(pdf))
            yield pdf

    df = spark.range(1000, numPartitions=3).mapInPandas(once, "id long")
    flags = [("even", F.col("id") % 2 == 0), ("large", F.col("id") >= 990), ("none", F.col("id") < 0), ("null_", F.lit(None).cast("boolean"))]
    counted = sinks.write_counted(df, f"{tmp_path}/out", flags)
    assert counted == {"rows": 1000, "even": 500, "large": 10, "none": 0, "null_": 0} and made.value == 1000
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1000
    assert sinks.write_counted(df.filter("id < 0"), f"{tmp_path}/none", flags)["rows"] == 0


def test_kept_urls(spark):
    cases = [
        (["http://archive.org/details/a", "https://archive.org/details/a ", None, "ark:/1", "https://nas.local/x", "http://LocalHost/x", "https://gone.org/1", "http://b.org/.local"], ["https://archive.org/details/a", "http://b.org/.local"]),
        ([], []), (None, None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, u array<string>")
    assert [r.k for r in df.select("i", X.kept_urls(F.col("u"), ["https://gone.org/1"]).alias("k")).orderBy("i").collect()] == [c[1] for c in cases]
    assert [r.k for r in df.select("i", X.kept_urls(F.col("u")).alias("k")).orderBy("i").collect()][0][1] == "https://gone.org/1"


def test_redo(spark):
    cases = [(["a"] * 12, None, None, True), (["a"] * 12, "", True, False), (["a"] * 11, None, False, False), (None, None, None, False), ([], "timeout", None, True)]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, m array<string>, e string, r boolean")
    columns = F.col("m"), F.col("e"), F.col("r")
    assert [r.x for r in df.select("i", worklists.to_redo(*columns, old_cap=12).alias("x")).orderBy("i").collect()] == [c[3] for c in cases]
    assert [r.x for r in df.select("i", worklists.to_redo(*columns).alias("x")).orderBy("i").collect()] == [False] * 4 + [True]


def test_decomposed_titles_meet_their_markers(spark):
    titles = ["Über Kunst für alle", "Études sur les arts", "plain words", None]
    df = spark.createDataFrame([(i, k, unicodedata.normalize(k, t) if t else None) for i, t in enumerate(titles) for k in ("NFC", "NFD")], "i int, k string, t string")
    got = {(r.i, r.k): r.w for r in df.select("i", "k", language.words_of(F.col("t")).alias("w")).collect()}
    assert all(got[i, "NFC"] == got[i, "NFD"] for i in range(4)) and "für" in got[0, "NFD"] and got[3, "NFC"] is None
