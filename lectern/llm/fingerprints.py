"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, the phrases into phrases of phrases, and so on. On each level runs of one symbol count as one
symbol; then three rounds of deterministic coin tossing turn each symbol into a label of 0 to 7 that depends on the symbol and
its left neighbours only; local maxima of the labels start new phrases (of two to some fourteen symbols), and a phrase's name
is a hash of its symbols. So an equal substring is parsed alike wherever it stands, but for a bounded stretch at its ends, and
shares its interior phrase names at every level regardless of offset.

The fingerprint is the bottom-k sketch of a text's distinct phrase names from the level on whose phrases are long enough to tell
texts apart, and of its root, the phrase that is the whole text, on whatever level that stands; the rule is the same for texts of
every length. The likeness of two fingerprints estimates the Jaccard coefficient of the phrase sets.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hash values in a fingerprint.
SKETCH = 64
#: The lowest level taken: phrases of about 6 code points.
FIRST_LEVEL = 2
#: Code points parsed at once.
CHUNK = 400_000

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_DE_BRUIJN = _U(0x03F79D71B4CB0A89)
#: Position of the only set bit of x, by the top six bits of x times a de Bruijn number.
_BIT = np.zeros(64, np.uint8)
_BIT[[((1 << i) * int(_DE_BRUIJN) % 2**64) >> 58 for i in range(64)]] = np.arange(64)


def _toss_table(n: int) -> np.ndarray:
    """Label of symbol b after symbol a, for symbols under n: twice the lowest bit in which they differ, plus b's bit there."""
    a, b = np.meshgrid(np.arange(n), np.arange(n), indexing="ij")
    d = a ^ b
    low = np.where(d, np.log2(np.maximum(d & -d, 1)).astype(int), 0)
    return (2 * low + (b >> low & 1)).astype(np.uint8).ravel()


_SECOND, _THIRD = _toss_table(128), _toss_table(16)
_POWERS = np.cumprod(np.full(256, 0xD1342543DE82EF95, _U))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _without_runs(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of one symbol within a text becomes one symbol, named by symbol and length."""
    keep = np.empty(len(x), bool)
    keep[0] = True
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    keep[starts] = True
    at = np.flatnonzero(keep)
    if len(at) == len(x):
        return x, starts
    length = np.diff(np.append(at, len(x)))
    y = x[at].astype(_U)
    long = length > 1
    y[long] = mixed(y[long] + length[long].astype(_U) * _MULT)
    return y, np.searchsorted(at, starts)


def _labels(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Three rounds of coin tossing; a text's first symbol keeps its lowest bit."""
    x = x.astype(_U, copy=False)
    first = (x[starts] & _U(1)).astype(np.uint8)
    d = x[1:] ^ x[:-1]
    d &= ~d + _U(1)
    d *= _DE_BRUIJN
    d >>= _U(58)
    low = _BIT[d]
    label = np.empty(len(x), np.uint8)
    label[1:] = 2 * low + ((x[1:] >> low) & _U(1)).astype(np.uint8)
    label[starts] = first
    for table, width in ((_SECOND, 128), (_THIRD, 16)):
        pair = label[:-1].astype(np.int16 if width == 128 else np.uint8) * width
        pair += label[1:]
        label[1:] = table[pair]
        label[starts] = first
    return label


def _phrases(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level up: the phrase names, and where each text starts among them."""
    x, starts = _without_runs(x, starts)
    label = _labels(x, starts)
    rises = np.zeros(len(x), bool)
    rises[1:] = label[1:] > label[:-1]
    falls = np.ones(len(x), bool)  # the last symbol of a text has no right neighbour
    falls[:-1] = label[:-1] > label[1:]
    falls[starts[1:] - 1] = True
    cut = rises & falls
    cut[starts[starts + 1 < len(x)] + 1] = False  # a first phrase has two symbols at least, so every level is shorter
    cut[starts] = True
    at = np.flatnonzero(cut)
    length = np.diff(np.append(at, len(x)))
    offset = np.arange(len(x)) - np.repeat(at, length)
    names = np.add.reduceat(x.astype(_U, copy=False) * _POWERS[offset & 255], at)
    return mixed(names + length.astype(_U) * _MULT), np.searchsorted(at, starts)


def phrase_levels(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each level from 1, until each text is one phrase: the phrase names of all texts in turn, and where each text starts.

    Texts must not be empty. A text that is one phrase already keeps one name on further levels."""
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    x = data
    while True:
        x, starts = _phrases(x, starts)
        yield x, starts
        if len(x) == len(starts):
            return


def fingerprints(texts: list[str], size: int = SKETCH) -> list[np.ndarray]:
    """The sorted bottom-k sketch (32-bit values) of each text; an empty text has an empty one."""
    out = [np.empty(0, np.uint32)] * len(texts)
    which = [i for i, t in enumerate(texts) if t]
    if not which:
        return out
    own = np.arange(len(which), dtype=_U)
    kept, over = [], np.zeros(len(which), bool)
    for level, (names, starts) in enumerate(phrase_levels([texts[i] for i in which]), 1):
        length = np.diff(np.append(starts, len(names)))
        key = (np.repeat(own, length) << _U(32)) | (mixed(names + _U(level)) >> _U(32))
        root = (length == 1) & ~over
        kept.append(key[np.repeat(~over if level >= FIRST_LEVEL else root, length)])
        over |= root
    key = np.unique(np.concatenate(kept))
    text = (key >> _U(32)).astype(np.int64)
    at = np.searchsorted(text, np.arange(len(which) + 1))
    values = (key & _U(0xFFFFFFFF)).astype(np.uint32)
    for j, i in enumerate(which):
        out[i] = values[at[j] : min(at[j + 1], at[j] + size)]
    return out


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Estimated Jaccard coefficient, 0 to 1; 1 for two empty texts, 0 for an empty and another."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    again = both[1:] == both[:-1]
    firsts = np.flatnonzero(np.concatenate([[True], ~again]))[:size]
    return float(again[firsts[firsts < len(again)]].sum() / len(firsts))


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as many first code points of the following text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_descending_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text, _extra), dealt into partitions of neighbouring ids and sorted in each: ids descending, nulls last, repeated
    ids by a hash of their text. A partition's last rows have _extra = 1: copies of the first row of the partition that follows,
    after the last one of the first.

    Only the quantiles and each partition's first row, by id and hash, go to the driver, so as many values as there are
    partitions. An id that holds several quantiles has its rows dealt over as many partitions, by ranges of the hash.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    # nulls last in descending order: as the smallest number
    rows = rows.withColumns({"_place": F.coalesce("_id", F.lit(-(2**63))), "_hash": F.xxhash64("_text")})
    shares = [i / n for i in range(1, n)]
    quantiles = (rows.agg(F.percentile_approx("_place", shares, max(10_000, 20 * n))).first()[0] or []) if shares else []
    times = Counter(quantiles)
    bounds = sorted(times)
    split = [times[b] if times[b] > 1 else 0 for b in bounds] + [0]
    first = [i + sum(split[:i]) for i in range(len(split))]
    if bounds:
        step = max(1, int(len(bounds) ** 0.5))
        groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
        numbers = lambda xs: "array(" + ", ".join(f"{x}L" if x > -(2**63) else "(-9223372036854775807L - 1L)" for x in xs) + ")"
        heads, tails = numbers([g[-1] for g in groups]), "array(" + ", ".join(map(numbers, groups)) + ")"
        coarse = f"size(filter({heads}, x -> x < _place))"
        # the last group may be shorter than the others
        rows = rows.withColumn("_at", F.expr(f"least({coarse} * {step} + coalesce(size(filter(get({tails}, {coarse}), x -> x < _place)), 0), {len(bounds)})"))
        part = F.expr(f"int(get({numbers(split)}, _at))")
        down = F.least(part - 1, F.floor((F.col("_hash") / F.lit(2.0**64) + 0.5) * part).cast("int"))  # smaller hashes come first
        several = (part > 0) & (F.col("_place") == F.expr(f"get({numbers(bounds)}, _at)"))
        rows = rows.withColumn("_bucket", F.expr(f"int(get({numbers(first)}, _at))") + F.when(several, part - down).otherwise(0)).drop("_at")
    else:
        rows = rows.withColumn("_bucket", F.lit(0))
    leads = rows.groupBy("_bucket").agg(F.min(F.struct((-1 - F.col("_place")).alias("p"), "_hash")).alias("f")).collect()  # -1 - x turns the order round
    leads = {r["_bucket"]: (-1 - r["f"]["p"], r["f"]["_hash"]) for r in leads}
    order = sorted(leads, reverse=True)
    # the last partition goes on with the first
    heads = spark.createDataFrame([(*leads[b], order[i - 1]) for i, b in enumerate(order)], "_place long, _hash long, _to int")
    own = rows.join(F.broadcast(heads), ["_place", "_hash"], "left")  # a row per partition
    at = F.expr("CASE WHEN _to IS NULL THEN array(struct(_bucket AS b, 0 AS x)) ELSE array(struct(_bucket AS b, 0 AS x), struct(_to AS b, 1 AS x)) END")
    own = own.withColumn("_at", F.explode(at)).select("_id", "_text", "_place", "_hash", F.col("_at.b").alias("_bucket"), F.col("_at.x").alias("_extra"))
    dealt = own.repartitionById(len(split) + sum(split), "_bucket")
    return dealt.sortWithinPartitions("_extra", F.desc("_place"), "_hash", "_text").select("_id", "_text", "_extra")


def fingerprint_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller id; after the smallest comes the largest. Null ids come last; rows that
    repeat an id follow one another in the order of a hash of their texts; a single row is its own next. Null texts count as
    empty, with an empty fingerprint; two empty texts are alike (1.0). An empty table gives an empty result. Other columns are
    ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total = 0

        def flush(rows: list[tuple]) -> pa.RecordBatch | None:
            """Results of all own rows but a last one, which still waits for its next."""
            n = len(rows) - 1
            own = [i for i in range(n) if not rows[i][2]]
            texts = [r[1] for r in rows]
            prints = fingerprints(texts)
            changed = [edited(texts[i], texts[i + 1]) for i in own]
            others = fingerprints(changed)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i][0] for i in own], pa.int64()),
                    pa.array([len(texts[i]) for i in own], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    pa.array([written(prints[i]) for i in own], pa.string()),
                    pa.array([written(p) for p in others], pa.string()),
                    pa.array([likeness(prints[i], p) for i, p in zip(own, others, strict=True)], pa.float64()),
                    pa.array([likeness(prints[i], prints[i + 1]) for i in own], pa.float64()),
                ],
                names=["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        for batch in batches:
            for i, text, extra in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                held.append((i, text.as_py(), extra))
                total += len(held[-1][1])
                if total >= CHUNK and len(held) > 1:
                    yield flush(held)
                    held = held[-1:]
                    total = len(held[0][1])
        if len(held) > 1:
            yield flush(held)

    schema = "_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_descending_order(docs, id_col, text_col).mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
