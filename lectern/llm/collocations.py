"""Phrase collocation mining.

All runs of 1 to max_n words inside a piece of text become rows, aggregated per language; those that come often enough are kept. A
candidate's score is that of its worst cut into two parts, whose counts are joined by prefix and suffix; candidates that are
mostly part of a longer one are dropped by an anti-join with the one-word extensions, and each language's best are ranked.

Most of the runs of a corpus come once or twice. So that their text need not be shuffled, the rows are aggregated twice: first
by a 64-bit key of language and phrase, whose total is never less than any of its phrases' own, then by the phrases themselves, where
only those go through whose key's total is enough. The keys that are enough are told by a bitmap of at most MOST_BITS bits; what it
lets through wrongly costs a row, no error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import arrow_batches, materialize, mixed

#: Bytes of text that are taken together, and keys that a task holds before it hands them on.
CHUNK, MOST_KEYS = 2 << 20, 3 << 20
#: The bitmap's bits: 32 for each frequent key, within these powers of two.
LEAST_BITS, MOST_BITS = 16, 28
#: Salts of the first ranking, so that no task ranks all candidates of a language.
SALTS = 32
_U = np.uint64
_GOLDEN, _OTHER = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_LOWEST = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)


@dataclass(frozen=True)
class Mining:
    """max_n: the longest phrase; least: how often a candidate comes at least; inside: at this percentage of its count a phrase
    inside a longer one is dropped; top: rows for each language."""

    max_n: int = 3
    least: int = 10
    inside: int = 50
    top: int = 2000

    def __post_init__(self):
        if not (2 <= self.max_n <= 8 and self.least >= 1 and self.inside >= 0 and self.top >= 1):
            raise ValueError("max_n must be 2 to 8, least and top at least 1, inside not negative")


class Words:
    """The words of texts one after another: where each starts and ends in raw, two hashes, its piece, its text."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n" + b"\n".join(texts).lower() + b"\n" + bytes(8)
        data = np.frombuffer(self.raw, np.uint8, len(self.raw) - 8)
        gap = _GAP[data]
        self.start = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        self.end = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        breaks = np.flatnonzero(_BREAK[data])
        self.piece = np.searchsorted(breaks, self.start)
        self.text = np.searchsorted(np.cumsum([1, *(len(t) + 1 for t in texts)]), self.start, side="right") - 1
        eight = np.ndarray((len(self.raw) - 7,), "<u8", self.raw, strides=(1,))
        length = self.end - self.start
        low = eight[self.start] & _LOWEST[np.minimum(length, 8)]
        n = length.astype(_U)
        self.hash = mixed(low + n * _GOLDEN)
        self.check = mixed((low ^ _OTHER) + n * _OTHER)
        rest, at = np.flatnonzero(length > 8), 8
        while len(rest):
            left = length[rest] - at
            more = eight[self.start[rest] + at] & _LOWEST[np.minimum(left, 8)]
            self.hash[rest] = mixed(self.hash[rest] * _GOLDEN + more)
            self.check[rest] = mixed(self.check[rest] * _OTHER + more)
            rest, at = rest[left > 8], at + 8

    def runs(self, langs: np.ndarray, max_n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(n, first words, keys, second keys) of all runs of n words inside one piece; langs: a number for each text's language."""
        key, check = mixed(self.hash + langs[self.text]), mixed(self.check ^ langs[self.text])
        at = np.arange(len(self.start))
        for n in range(1, max_n + 1):
            if n > 1:
                whole = self.piece[at[at + n - 1 < len(self.start)] + n - 1] == self.piece[at[at + n - 1 < len(self.start)]]
                inside = np.flatnonzero(at + n - 1 < len(self.start))[whole]
                at, last = at[inside], at[inside] + n - 1
                key, check = mixed(key[inside] * _GOLDEN + self.hash[last]), mixed(check[inside] * _OTHER + self.check[last])
            yield n, at, key, check

    def phrase(self, first: int, n: int) -> bytes:
        """The words from first on, joined by single spaces; only spaces and tabs stand between words of one piece."""
        return b" ".join(self.raw[self.start[first] : self.end[first + n - 1]].split())


def _lang_number(lang: str) -> int:
    raw, h = lang.encode(), _U(len(lang))
    for i in range(0, len(raw), 8):
        h = mixed((h * _OTHER + _U(int.from_bytes(raw[i : i + 8], "little"))).reshape(1))[0]
    return int(h)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes]]]:
    """(languages, texts) of about CHUNK bytes; a longer text is alone."""
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            raw = text.as_py()
            if size + len(raw) > CHUNK and texts:
                yield langs, texts
                langs, texts, size = [], [], 0
            langs.append(lang)
            texts.append(raw)
            size += len(raw)
    if texts:
        yield langs, texts


def _numbers(langs: list[str]) -> np.ndarray:
    with np.errstate(over="ignore"):
        known = {lang: _lang_number(lang) for lang in set(langs)}
    return np.array([known[x] for x in langs], _U)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key, count = key[order], count[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    return key[new], np.add.reduceat(count, new, dtype=np.int64) if len(new) else count


def _key_rows(max_n: int):
    def run(batches):
        keys, counts, held = [], [], 0

        def rows():
            key, count = _summed(keys, counts)
            for i in range(0, len(key), 1 << 16):
                yield pa.record_batch([pa.array(key[i : i + (1 << 16)].view(np.int64)), pa.array(count[i : i + (1 << 16)].astype(np.int64))], ["key", "c"])

        for langs, texts in _chunks(batches):
            all_ = np.sort(np.concatenate([key for _, _, key, _ in Words(texts).runs(_numbers(langs), max_n)]))
            if not len(all_):
                continue
            new = np.flatnonzero(np.append(True, all_[1:] != all_[:-1]))
            keys.append(all_[new])
            counts.append(np.diff(np.append(new, len(all_))).astype(np.int32))
            held += len(new)
            if held > MOST_KEYS:
                yield from rows()
                keys, counts, held = [], [], 0
        if keys:
            yield from rows()

    return run


def _phrase_rows(max_n: int, bitmap):
    """Phrases whose key's bit is set, with their counts in a chunk; the words of each language under the empty phrase."""

    def run(batches):
        bits = bitmap.value
        mask = _U(len(bits) * 64 - 1)
        for langs, texts in _chunks(batches):
            words, of = Words(texts), _numbers(langs)
            lang_col, phrases, ns, counts = [], [], [], []
            per_text = np.bincount(words.text, minlength=len(texts))
            for lang in sorted(set(langs)):
                lang_col.append(lang)
                phrases.append(b"")
                ns.append(0)
                counts.append(int(sum(c for x, c in zip(langs, per_text.tolist(), strict=True) if x == lang)))
            for n, at, key, check in words.runs(of, max_n):
                place = key & mask
                passed = np.flatnonzero((bits[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1))
                order = passed[np.argsort(key[passed])]
                k, c = key[order], check[order]
                # equal keys of unequal phrases are told apart by the second one
                new = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (c[1:] != c[:-1]))) if len(k) else np.empty(0, np.int64)
                first = at[order[new]]
                lang_col += [langs[t] for t in words.text[first].tolist()]
                phrases += [words.phrase(i, n) for i in first.tolist()]
                ns += [n] * len(first)
                counts += np.diff(np.append(new, len(k))).tolist()
            for i in range(0, len(phrases), 1 << 14):
                part = slice(i, i + (1 << 14))
                yield pa.record_batch([pa.array(lang_col[part], pa.string()), pa.array(ns[part], pa.int32()), pa.array(phrases[part], pa.binary()).cast(pa.string()), pa.array(counts[part], pa.int64())], ["lang", "words", "phrase", "c"])

    return run


def _bitmap(frequent: DataFrame, bits: int) -> np.ndarray:
    """2^bits bits, of which those of the keys' lowest bits are set: or-ed by places of 64 before they reach the driver."""
    place = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    rows = frequent.groupBy(F.shiftright(place, 6).alias("i")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))).alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["i"].to_numpy()] = rows["b"].to_numpy()
    return out.view(_U)


def phrase_counts(docs: DataFrame, max_n: int = 3, least: int = 10, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, words, phrase, c) of all phrases of 1 to max_n words that come least times in their language; and for each language
    a row of the empty phrase, with words 0, that has the number of its words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    with arrow_batches(spark, 256):
        totals = texts.mapInArrow(_key_rows(max_n), "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
        frequent = materialize(totals.filter(F.col("c") >= least).select("key"), "keys")
        bits = min(MOST_BITS, max(LEAST_BITS, (32 * frequent.count()).bit_length()))
        bitmap = spark.sparkContext.broadcast(_bitmap(frequent, bits))
        rows = texts.mapInArrow(_phrase_rows(max_n, bitmap), "lang string, words int, phrase string, c long")
        counts = rows.groupBy("lang", "words", "phrase").agg(F.sum("c").alias("c")).filter((F.col("words") == 0) | (F.col("c") >= least))
        return materialize(counts, "phrases")


def _cut(phrase: Column, k: Column) -> tuple[Column, Column]:
    """The first k words and the rest."""
    first = F.call_function("substring_index", phrase, F.lit(" "), k)
    return first, F.substring(phrase, F.length(first) + 2, F.length(phrase))


def scored(counts: DataFrame, max_n: int) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of the candidates, by their lowest-scoring cut, of ties the first; whole numbers of 38 digits."""
    cuts = counts.filter("words >= 2").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    first, rest = _cut(F.col("phrase"), F.col("k"))
    cuts = cuts.select("lang", "words", "phrase", F.col("c").alias("a"), "k", first.alias("_first"), rest.alias("_rest"))
    part = lambda name, count: counts.filter(f"words BETWEEN 1 AND {max_n - 1}").select("lang", F.col("phrase").alias(name), F.col("c").alias(count))
    met = cuts.join(part("_first", "l"), ["lang", "_first"]).join(part("_rest", "r"), ["lang", "_rest"])
    exact = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    whole = F.expr("CAST(1000000 AS DECIMAL(7,0))") * exact("a", 15) * exact("a", 15)
    score = F.expr("_whole div _parts")
    met = met.withColumns({"_whole": whole, "_parts": exact("l", 15) * exact("r", 15)}).withColumn("score", score.cast("long"))
    best = met.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "words", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score"))


def not_inside(candidates: DataFrame, inside: int) -> DataFrame:
    """Candidates that no longer one holds with at least that percentage of their count.

    A phrase comes no more often than any part of it, so where a longer one has enough, so has one that is longer by one word.
    """
    longer = candidates.filter("words >= 3")
    cut = F.array(_cut(F.col("phrase"), F.col("words") - 1)[0], _cut(F.col("phrase"), F.lit(1))[1])
    held = longer.select("lang", F.col("a").alias("_f"), F.explode(cut).alias("phrase")).groupBy("lang", "phrase").agg(F.max("_f").alias("_f"))
    c, h = candidates.alias("c"), held.alias("h")
    same = (F.col("c.lang") == F.col("h.lang")) & (F.col("c.phrase") == F.col("h.phrase")) & (F.col("h._f") * 100 >= F.col("c.a") * inside)
    return c.join(h, same, "left_anti")


def collocations(docs: DataFrame, mining: Mining = Mining(), lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language, by descending score and count, then by their
    UTF-8 bytes.

    Whole texts are taken, however long; a null text counts as empty, a null language as "und". Rows that repeat count as
    often as they stand. Empty tables, and languages without a candidate, give no rows. Other columns are ignored, whatever their
    names. Counts up to 10^15 are exact.
    """
    counts = phrase_counts(docs, mining.max_n, mining.least, lang_col, text_col)
    words = counts.filter("words = 0").select("lang", F.col("c").alias("n"))
    kept = not_inside(materialize(scored(counts, mining.max_n), "scored"), mining.inside)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = kept.withColumn("_s", salt).withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_s").orderBy(*order))).filter(F.col("_r") <= mining.top)
    best = first.drop("_r", "_s").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= mining.top)
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
grams AS (SELECT lang, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i : i + m - 1], ' '))) AS phrase, m FROM words, (SELECT unnest([1, 2, 3]) AS m)),
f AS (SELECT lang, phrase, m, count(*) AS c FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, m, c AS a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2 AND c >= 10),
cuts AS (SELECT cand.*, k, array_to_string(ws[1:k], ' ') AS p1, array_to_string(ws[k + 1:m], ' ') AS p2 FROM cand, (SELECT unnest([1, 2]) AS k) WHERE k < m),
s AS (SELECT cuts.lang, cuts.phrase, cuts.m, a, k, f1.c AS l, f2.c AS r, ((1000000::HUGEINT * a * a) // (f1.c::HUGEINT * f2.c))::BIGINT AS score
  FROM cuts JOIN f f1 ON f1.lang = cuts.lang AND f1.phrase = p1 JOIN f f2 ON f2.lang = cuts.lang AND f2.phrase = p2),
lowest AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM lowest x WHERE NOT EXISTS (SELECT 1 FROM cand y WHERE y.lang = x.lang AND y.m > x.m AND 100 * y.a >= 50 * x.a
  AND (array_to_string(y.ws[1:2], ' ') = x.phrase OR array_to_string(y.ws[2:3], ' ') = x.phrase)))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000
"""
