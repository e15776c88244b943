"""Target-distribution importance resampling.

Documents are drawn as if from the target's distribution of hashed features: each bucket's gain is the log ratio of its smoothed
shares in target and raw texts, a document's weight is the sum of the gains of its features, and seeded Gumbel noise on top
turns the best scores into a draw without replacement.

The gains are one array of as many numbers as there are buckets, with which each row adds up its own weight. The k-th best
key is found exactly by radix selection: the composite key (score, id, row) is read digit by digit from its highest bit that
differs, each round counts one digit among the rows that share all digits before it, and at most 2^DIGIT_BITS counts reach the
driver. Only the rows up to that key are sorted, by ranges, and ranked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import free_name, materialize
from lectern.operators.dedupe import numbered

DIGIT_BITS = 12
#: Gains are one array on the driver and in the plan.
MOST_BUCKETS = 1_000_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LEAST = -(1 << 63)


@dataclass(frozen=True)
class Features:
    """Runs of 1 to most words, hashed to buckets; words are letters a-z, digits and all beyond ASCII, with A-Z lower-cased."""

    most: int = 1
    buckets: int = 10_000

    def __post_init__(self):
        if not (self.most >= 1 and 1 <= self.buckets <= MOST_BUCKETS):
            raise ValueError(f"most must be at least 1, buckets 1 to {MOST_BUCKETS}")


def words_of(text: Column) -> Column:
    """The words of a text; null has none."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _UPPER.lower())
    return F.filter(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def buckets_of(words: Column, features: Features) -> Column:
    """The bucket of each feature of a text's words, repeats included: crc32 of its UTF-8 bytes modulo the number of buckets."""
    size = F.size(words)

    def runs_of(m: int) -> Column:
        starts = F.sequence(F.lit(1), size - (m - 1))
        return F.when(size >= m, F.transform(starts, lambda i: F.array_join(F.slice(words, i, m), " "))).otherwise(F.array().cast("array<string>"))

    runs = [words, *map(runs_of, range(2, features.most + 1))]
    return F.transform(F.concat(*runs) if len(runs) > 1 else words, lambda w: (F.crc32(w.cast("binary")) % features.buckets).cast("int"))


def bucketed(df: DataFrame, text_col: str, features: Features, *kept: Column) -> DataFrame:
    """kept, _words (how many), _buckets."""
    worded = df.select(*kept, words_of(F.col(text_col)).alias("_w"))
    return worded.select(*(c for c in worded.columns if c != "_w"), F.size("_w").alias("_words"), buckets_of(F.col("_w"), features).alias("_buckets"))


def bucket_counts(rows: DataFrame, n: int) -> np.ndarray:
    """How many features fall into each bucket: summed before the shuffle, a row a bucket to the driver."""
    counts = np.zeros(n, np.int64)
    for b, c in rows.select(F.explode("_buckets").alias("b")).groupBy("b").count().collect():
        counts[b] = c
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each of B buckets, in doubles; s, t: features in the bucket; S, T: in all."""
    more = len(raw)
    whole, wanted = float(raw.sum() + more), float(target.sum() + more)
    return np.array([math.floor(1000 * math.log(float(t + 1) * whole / (float(s + 1) * wanted))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def noise(id_: Column, seed: int) -> Column:
    """Gumbel noise times 1000, rounded down, from the first 32 bits of sha256 of "seed:id"; a null id is written as nothing."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h.cast("double") + 0.5) / 4294967296.0))).cast("long")


def _unsigned(key: Column) -> Column:
    """Bits whose unsigned order is the order of longs."""
    return key.bitwiseXOR(F.lit(_LEAST))


def first_k(rows: DataFrame, keys: list[str], k: int) -> Column:
    """A condition that holds for exactly the k first rows by keys, ascending: long columns without nulls that together tell all
    rows apart. Raises nothing for k of 0 or for more rows than there are: none, or all, are meant.

    Each round groups the rows that still matter by one digit of one key; a round's answer is at most 2^DIGIT_BITS counts. It
    ends as soon as a digit's rows are all wanted. Rows with equal digits are only ever counted, never gathered.
    """
    if k <= 0:
        return F.lit(False)
    same, taken = F.lit(True), F.lit(False)
    for name in keys:
        u = _unsigned(F.col(name))
        least, most, n = rows.filter(same).agg(F.min(name), F.max(name), F.count(F.lit(1))).first()
        if n <= k:
            return taken | same
        low, high = least - _LEAST, most - _LEAST
        shift = (low ^ high).bit_length()  # all bits above are shared
        while shift:
            width = min(DIGIT_BITS, shift)
            upper, shift = shift, shift - width
            digit = F.shiftrightunsigned(u, shift).bitwiseAND(F.lit((1 << width) - 1))
            prefix = F.lit(True) if upper == 64 else F.shiftrightunsigned(u, upper) == F.lit(low >> upper)
            counts = sorted((d, c) for d, c in rows.filter(same & prefix).groupBy(digit.alias("d")).count().collect())
            for d, c in counts:
                if c >= k:
                    break
                k -= c
            low = ((low >> upper << width) | d) << shift
            if c == k:  # all of this digit's rows
                last = low + (1 << shift) - 1
                return taken | (same & (F.col(name) <= F.lit(last + _LEAST)))
        taken = taken | (same & (F.col(name) < F.lit(low + _LEAST)))
        same = same & (F.col(name) == F.lit(low + _LEAST))
    return taken | same


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, features: Features = Features(), seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_features, weight, score, rank (1, 2, 3, ... of those drawn, by descending score, then by
    id; null for the others), all long.

    Of the N rows with at least least_words words floor(percent N / 100) are drawn. Texts count whole, however long. A null text
    has no words: weight 0, never drawn while least_words is positive. Null ids come after all others among equal scores. Rows
    that repeat an id are rows of their own; where score and id are equal, any of them may be drawn first, but exactly as many
    as wanted. An empty docs gives no rows; an empty target makes all gains those of its smoothing. Other columns are
    ignored, whatever their names. Ids are whole numbers.
    """
    spark = docs.sparkSession
    own = materialize(bucketed(docs, text_col, features, F.col(f"`{id_col}`").cast("long").alias("_id")).withColumn("_row", F.monotonically_increasing_id()), "buckets")
    table = gains(bucket_counts(own, features.buckets), bucket_counts(bucketed(target, target_col, features), features.buckets))
    array = F.lit(table)
    weight = F.aggregate("_buckets", F.lit(0).cast("long"), lambda sum_, b: sum_ + F.get(array, b))
    scored = own.select("_id", "_row", F.size("_buckets").cast("long").alias("n_features"), weight.alias("weight"), (F.col("_words") >= least_words).alias("_able"))
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("_id"), seed))
    # ascending: the highest score first, ids that are null last
    keyed = scored.withColumns({"_k0": -F.col("score"), "_k1": F.col("_id").isNull().cast("long"), "_k2": F.coalesce("_id", F.lit(0).cast("long"))})
    keyed = materialize(keyed, "scores")
    keys = ["_k0", "_k1", "_k2", "_row"]
    able = keyed.filter("_able")
    k = percent * able.count() // 100
    drawn = F.col("_able") & first_k(able, keys, k)
    columns = [F.col("_id").alias(id_col), "n_features", "weight", "score"]
    name = free_name(keyed, "_rank")
    ranked = numbered(keyed.filter(drawn), *keys, name=name).select(*columns, F.col(name).cast("long").alias("rank"))
    rest = keyed.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH tab AS (SELECT list(c ORDER BY i) AS crcs FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256))::BIGINT AS i))),
own AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM documents),
goal AS (SELECT list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM benchmark),
words AS (SELECT w, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM (SELECT unnest(ws) AS w, 1 AS s, 0 AS t FROM own UNION ALL SELECT unnest(ws), 0, 1 FROM goal) GROUP BY w),
hexed AS (SELECT w, s, t, hex(encode(w)) AS x FROM words),
crc AS (SELECT w, s, t, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x) // 2 + 1), lambda i: ('0x' || x[2 * i - 1 : 2 * i])::BIGINT)), lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 10000 AS b
  FROM hexed, tab),
bucket AS (SELECT b, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM crc GROUP BY b),
total AS (SELECT sum(s) AS bs, sum(t) AS bt FROM bucket),
gain AS (SELECT b, floor(1000 * ln((t + 1) * (bs + 10000) / ((s + 1) * (bt + 10000))))::BIGINT AS g FROM bucket, total),
weighed AS (SELECT doc_id, sum(g)::BIGINT AS weight FROM (SELECT doc_id, unnest(ws) AS w FROM own) JOIN crc USING (w) JOIN gain USING (b) GROUP BY doc_id),
scored AS (SELECT own.doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || own.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM own LEFT JOIN weighed ON own.doc_id = weighed.doc_id),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END::BIGINT AS rank FROM scored s LEFT JOIN ranked USING (doc_id)
"""
