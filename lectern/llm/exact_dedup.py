"""Exact dedup by skew-safe combining.

Equal texts are combined in three steps, each of which compares the full normalised content as well as its digest:
each map task deduplicates its own rows (the partial aggregate), salted digest groups merge those, and the winners of the
salts are combined globally. No step holds more than one row per content, task and salt, so a group of copies that holds a
third of all rows costs a few rows a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import attach_groups, materialize

#: ASCII white space; a run of it counts as one space.
SPACE_RUN = r"[\x20\x09-\x0D]+"
SALTS = 16


def normalised(text: Column) -> Column:
    """Null becomes the empty text; each run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def sha256_of(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256_of, salts: int = SALTS) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, digest (as text_sha256).

    The row with the smallest id of each group of equal normalised texts stays. Null texts equal empty ones. Null ids come
    last; keep_id is null only where all ids of a group are. Of rows that repeat both id and text exactly one stays.
    Other columns of docs are ignored, whatever their names. An empty table gives an empty result. Texts of any length are compared whole.
    Texts whose digests collide stay apart: where that happens, members find their group by full content.
    """
    keyed = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_norm")).withColumn("_digest", digest(F.col("_norm")))
    salted = keyed.withColumn("_s", F.pmod(F.xxhash64("_id"), F.lit(salts))).groupBy("_digest", "_s", "_norm").agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    combined = salted.groupBy("_digest", "_norm").agg(F.min("_keep").alias("keep_id"), F.sum("_n").alias("group_size"))
    winners = materialize(combined.select("_digest", "keep_id", "group_size"), "winners")
    collides = not winners.groupBy("_digest").count().filter("count > 1").isEmpty()
    row_salt = F.xxhash64("_id")
    if collides:
        found = keyed.join(combined, ["_digest", "_norm"]).withColumn("_salt", F.lit(0))
        same = ["_digest", "_norm", "_id"]
    else:
        found = attach_groups(keyed.select("_id", "_digest"), winners, "_digest", "group_size", row_salt, "inner")
        same = ["_digest", "_salt", "_id"]  # co-located by the join: no further exchange
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("_id"))
    return found.withColumn("_nth", nth).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
"""
