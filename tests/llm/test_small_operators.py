"""WARC, exact dedup and SentencePiece: round trips, brute force, defined cases."""

import base64
import gzip
import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import exact_dedup, sentencepieces, warc
from lectern.llm.common import HOT_SHARE, attach_groups
from lectern.plans.workspace import new_path

PAGES = [(1, "http://a/1", "<p>x"), (2, "http://a/2", "<p>x"), (9, "http://a/\r\n9", "<p>x"), (3, None, None), (4, "u", ""), (5, "u", "é😀" * 50), (6, "u", "a\x00b\r\n\r\nWARC/1.1"), (None, "n", "only null"), (7, "big", "z" * 70_000), (8, "same", "twice"), (8, "same", "twice")]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, record_type string, _n int")
    path = new_path(spark, "warc")
    warc.write_warc(pages, path)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_warc(spark, path).collect()), key=repr)
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        first = max((p[0] for p in PAGES if (p[2] or "") == (html or "") and p[0] is not None), default=None)
        revisit = first is not None and first != i
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want, key=repr)
    payloads = {r.page_id: bytes(r.payload).decode() for r in warc.read_warc(spark, path).filter("record_type = 'response'").collect()}
    assert payloads[5] == "é😀" * 50 and payloads[6] == "a\x00b\r\n\r\nWARC/1.1" and payloads[7] == "z" * 70_000
    # the files are plain gzip members one after another
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    assert sum(gzip.decompress(bytes(f.content)).count(b"WARC-Record-ID") for f in files) == len(PAGES)


def test_warc_empty_table(spark):
    path = new_path(spark, "warc")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_warc(spark, path).collect() == []


def test_digest_column_is_base32(spark):
    df = spark.createDataFrame([("",), ("x",), ("é",)], "t string")
    assert [r.d for r in df.select(warc.digest_column(df.t.cast("binary")).alias("d")).collect()] == [warc.digest_of(t.encode()) for t in ("", "x", "é")]


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=3000), st.integers(-5, 5), st.text(max_size=20))
def test_records_parse_back(payload, page, url):
    record = warc.record_bytes(page, url, payload, warc.digest_of(payload), None, False)
    assert list(warc.members(warc.member(record) + b"\0")) == [record]
    assert warc.parse(record).payload == payload


def test_large_records_end_in_an_empty_member():
    data = b"a" * (1 << 24)
    packed = warc.member(data) + b"\0"
    assert list(warc.members(packed)) == [data] and gzip.decompress(packed) == data


def test_faults_are_told():
    record = warc.record_bytes(1, "u", b"payload", warc.digest_of(b"payload"), None, False)
    for broken in (record.replace(b"payload\r", b"PAYLOAD\r"), record[:-1], record.replace(b"WARC/1.1", b"NOPE/1.1", 1), record.replace(b"Content-Length: 7\r\n\r\n", b"Content-Length 7\r\n\r\n")):
        with pytest.raises((warc.WarcError, KeyError)):
            warc.parse(broken)
    with pytest.raises(warc.WarcError):
        list(warc.members(gzip.compress(b"x")[:-3]))


def texts(n):
    r = random.Random(2)
    return [(i, r.choice(["a b", "a  b", "a\n\tb", " a b", "A b", "", None, "c" * r.randint(1, 3), f"own {i}"])) for i in range(n)]


@pytest.mark.parametrize("digest", [None, "weak"])
def test_exact_dedup_equals_brute_force(spark, digest):
    rows = [*texts(300), (None, "a b"), (None, "null ids only"), (None, "null ids only"), (500, "long " * 50_000), (501, "long  " * 50_000), (7, texts(8)[7][1])]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, keep_id int, _digest string")
    weak = {"digest": lambda c: exact_dedup.sha256_of(c).substr(1, 1)} if digest else {}  # sixteen digests: collisions everywhere
    got = exact_dedup.exact_dedup(docs, **weak).collect()
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    want = []
    for i, t in rows:
        ids = groups[normal(t)]
        want.append((i, min((x for x in ids if x is not None), default=None), len(ids)))
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(r.kept for r in got) == len(groups)
    if not digest:
        assert {r.text_sha256 for r in got} == {hashlib.sha256(k.encode()).hexdigest() for k in groups}


def test_exact_dedup_empty(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_hot_groups_are_dealt_over_salts(spark):
    rows = spark.range(5000).selectExpr("id", "IF(id % 3 = 0, 'hot', concat('k', id % 2000)) AS key")
    sizes = rows.groupBy("key").count().withColumnRenamed("count", "n")
    out = attach_groups(rows, sizes, "key", "n", rows.id.cast("int"))
    assert out.count() == 5000 and out.filter("key = 'hot'").select("_salt").distinct().count() == 32
    assert sizes.filter(f"n * {HOT_SHARE} >= 5000").count() <= HOT_SHARE


MODEL = sentencepieces.default_model()
TEXTS = ["", " ", "  a", "a ", "a  ", "a b", "▁", "a▁b", "x\n y", "é😀字 the <s> </s>", "word " * 400, "\x00", "un" * 5000]


def test_pieces_equal_the_library(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*TEXTS, None])] + [(3, "a ", 1), (None, "no id", 1)], "doc_id long, text string, ids int")
    library = sentencepieces.PieceCoder(MODEL).library
    rows = sentencepieces.piece_codes(docs, MODEL).collect()
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        text = "no id" if r.doc_id is None else [*TEXTS, None][r.doc_id] or ""
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, library.decode(ids))
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab ▁é\n字😀."), max_size=30))
def test_any_text_is_segmented_as_a_whole(text):
    coder = test_any_text_is_segmented_as_a_whole.__dict__.setdefault("coder", sentencepieces.PieceCoder(MODEL, entries=8))
    ids = coder.encode(text)
    assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == coder.library.encode(text, add_bos=True, add_eos=True)
