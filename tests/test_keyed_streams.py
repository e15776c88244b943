"""Linking over keyed state: over several batches and a restart against a plain rendering; state that expires."""

import os
import random
import time

import pandas as pd
from lectern.functions import udfs as U
from lectern.streaming import linking
from lectern.streaming.linking import keyed_links, keyed_state

SCHEMA = "ord long, author string, title string, year int"


def rows_of(seed, n):
    r = random.Random(seed)
    base = ["History of the empire of Japan", "History of the empires of Japan", "Letters from Kyoto", "Letters from Kyouto", "Travels", "History of the empire in Japan", ""]
    return [(i, r.choice(["Satow, E.", "Aston, W.", ""]), r.choice(base), r.choice([1880, 1881, 1890, None])) for i in range(n)]


def plain(rows, least=0.9, tolerance=3):
    """One record after another against all that were accepted; equal titles first, then the earliest alike one."""
    taken, out = [], {}
    for o, author, title, year in rows:
        key, sur = U.key(title), (U.key(author.split(",")[0]) if "," in author else "")
        fit = [t for t in taken if t[1] == sur and t[2].split(" ")[0] == key.split(" ")[0] and (year is None or t[3] is None or abs(year - t[3]) <= tolerance)]
        match = next((t[0] for t in fit if t[2] == key), None)
        if match is None:
            match = next((t[0] for t in fit if U.ratio(key, t[2]) >= least), None)
        match = match if key else None
        if match is None and key:
            taken.append((o, sur, key, year))
        out[o] = match
    return out


def run(spark, tmp, rows, name, **options):
    pd.DataFrame(rows, columns=["ord", "author", "title", "year"]).astype({"year": "Int32"}).to_parquet(f"{tmp}/in/{name}.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # of the first start; a checkpoint keeps it
    found = lambda: {r.ord: r.match for r in spark.read.schema("ord long, match long").parquet(f"{tmp}/out").collect()}
    with keyed_state(spark):
        made = keyed_links(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in"), **options)
        writer = made.writeStream.format("parquet").option("path", f"{tmp}/out").option("checkpointLocation", f"{tmp}/state")
        if options.get("ttl_ms"):  # such a stream goes on for its clock: it is stopped once it has answered
            query, end = writer.start(), time.time() + 90
            while time.time() < end and not (os.path.exists(f"{tmp}/out/_spark_metadata") and rows[-1][0] in found()):
                time.sleep(0.3)
            query.stop()
        else:
            writer.trigger(availableNow=True).start().awaitTermination(120)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    return found()


def test_batches_and_a_restart_equal_a_plain_rendering(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = rows_of(1, 90)
    for k in range(2):  # the second start goes on from the checkpoint
        got = run(spark, tmp_path, rows[45 * k : 45 * (k + 1)], f"part{k}")
    assert got == plain(rows) and any(m is not None for m in got.values())


def test_state_expires(spark, tmp_path):
    (tmp_path / "in").mkdir()
    one = ("Satow, E.", "Letters from Kyoto", 1880)
    run(spark, tmp_path, [(1, *one), (2, *one)], "a", ttl_ms=1500)
    time.sleep(2)
    got = run(spark, tmp_path, [(3, *one), (4, *one)], "b", ttl_ms=1500)
    assert got == {1: None, 2: 1, 3: None, 4: 3}


def test_a_block_is_searched_by_key_length_and_letters(monkeypatch):
    """1,200 accepted records of one block; each was compared with all before it of near length."""
    calls, real = [], linking.ratio_from
    monkeypatch.setattr(linking, "ratio_from", lambda *a: calls.append(a) or real(*a), raising=False)
    rnd = random.Random(3)
    keys = ["old " + "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz 0123456789é", k=rnd.randint(1, 60))) for _ in range(1200)]
    for i in range(0, 1200, 10):
        keys[i] = keys[rnd.randrange(1200)] + "ab"[: i % 3]
    taken, plain, matched = linking._Taken(0.9, 3), [], 0
    for i, key in enumerate(keys):
        year = rnd.choice([None, 1900, 1902, 1910])
        fit = [(o, k) for o, k, y in plain if year is None or y is None or abs(year - y) <= 3]
        close = (o for o, k in fit if 2 * min(len(k), len(key)) >= 0.9 * (len(k) + len(key)) and real(0.9, key, k) is not None)
        want = next((o for o, k in fit if k == key), None)
        want = next(close, None) if want is None else want
        assert taken.best(key, year) == want
        if want is None:
            taken.add(i, key, year)
            plain.append((i, key, year))
        matched += want is not None
    assert matched > 30 and len(calls) < 5000
