"""The remote source over saved answers: partitions, retries, offsets, restarts."""

import json

import pytest
from pyspark.sql import functions as F

from lectern.sources import remote as R


@pytest.fixture
def folder(tmp_path):
    for d in ("in", "answers"):
        (tmp_path / d).mkdir()
    return tmp_path


def ask(folder, name, *requests):
    (folder / "in" / f"{name}.json").write_text("".join(json.dumps({"request": r}) + "\n" for r in requests) + "\n")
    for r in requests:
        if not r.startswith("missing"):
            (folder / "answers" / r).write_text(f"answer to {r}")


def test_batch(spark, folder):
    for k in range(5):
        ask(folder, f"f{k}", f"r{k}a", f"r{k}b")
    ask(folder, "g", "missing1", "é")
    spark.dataSource.register(R.source_of("saved_batch", R.saved(f"file://{folder}/answers")))
    df = spark.read.format("saved_batch").option("path", f"file://{folder}/in").options(parts=3, tries=2, pause=0).load()
    assert df.rdd.getNumPartitions() == 3
    got = {r.request: r for r in df.collect()}
    assert len(got) == 12 and got["é"].answer == "answer to é" and got["é"].error is None and got["r3b"].file == "f3.json"
    assert got["missing1"].answer is None and "FileNotFoundError" in got["missing1"].error
    assert df.filter("answer IS NULL").select("request").collect() == [("missing1",)]


def test_a_failing_service_is_tried_again(spark, folder):
    ask(folder, "f", "a", "b")
    count = f"{folder}/count"

    def flaky(request):
        with open(count, "a+") as f:  # how often it was asked, over all tries
            f.write(request)
            f.seek(0)
            if f.read().count(request) < 3:
                raise TimeoutError("not yet")
        return request.upper()

    spark.dataSource.register(R.source_of("flaky", flaky))
    load = lambda tries: spark.read.format("flaky").option("path", f"file://{folder}/in").options(tries=tries, pause=0.01).load().collect()
    assert sorted((r.request, r.answer, r.error) for r in load(2)) == [("a", None, "TimeoutError: not yet"), ("b", None, "TimeoutError: not yet")]
    assert sorted(r.answer for r in load(2)) == ["A", "B"]
    with pytest.raises(Exception, match="at least 1"):
        load(0)


def test_empty_folder(spark, folder):
    spark.dataSource.register(R.source_of("nothing", R.saved(f"file://{folder}/answers")))
    assert spark.read.format("nothing").option("path", f"file://{folder}/in").load().count() == 0


def test_stream_restart_asks_nothing_twice(spark, folder):
    log = f"{folder}/asked"

    def fetch(request):
        with open(log, "a") as f:
            f.write(request + "\n")
        return request.upper()

    spark.dataSource.register(R.source_of("once", fetch))

    def run():
        df = spark.readStream.format("once").option("path", f"file://{folder}/in").option("parts", 2).load().withColumn("n", F.length("answer"))
        df.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination(90)
        return sorted(tuple(r) for r in spark.read.schema("request string, answer string, error string, file string, n int").parquet(f"{folder}/out").select("request", "answer", "n").collect())

    ask(folder, "a1", "x", "yy")
    ask(folder, "a2", "z")
    assert run() == [("x", "X", 1), ("yy", "YY", 2), ("z", "Z", 1)]
    assert len(run()) == 3  # nothing new
    ask(folder, "a3", "www")
    assert run() == [("www", "WWW", 3), ("x", "X", 1), ("yy", "YY", 2), ("z", "Z", 1)]
    assert sorted(open(log).read().split()) == ["www", "x", "yy", "z"]
