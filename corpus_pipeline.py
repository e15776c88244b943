"""A corpus pipeline: toxicity, exact dedup, n-gram Jaccard join, mixing to target weights, SentencePiece encoding.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which the next one gets as docs.
All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm import exact_dedup as dedup
from lectern.llm import jaccard_join, mixing, sentencepieces, toxicity
from lectern.llm.common import free_name, materialize


#: Near copies share this percentage of their shingles of so many words.
NEAR, NEAR_WORDS = 80, 5
#: Rows that a stage hands to Python at once; they carry whole texts, and the JVM keeps what its largest batch took.
AT_ONCE = 1_000


def _in_small_batches(spark: SparkSession) -> None:
    """Stages are lazy, so this holds for the session from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", AT_ONCE)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose score reaches the threshold of their language; the model learns from labelled rows of docs.

    Null texts are scored as empty ones, texts of any length whole; a null language, or one without a threshold of its own, has the
    threshold of all. A score equal to its threshold is rejected. Repeated rows are decided alike, null ids are kept or dropped by their texts,
    an empty table stays empty; other columns, whatever their names, are kept.
    """
    _in_small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    name = free_name(docs, "_score")
    return toxicity.score(docs, model, out_col=name).filter(~F.coalesce(toxicity.rejected("lang", model, name), F.lit(False))).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts the one with the smallest id stays; of rows that repeat both, one.

    Null texts equal empty ones, null ids come last, texts of any length are compared whole; an empty table stays empty; other columns
    are kept as the row that stays has them.
    """
    key, digest, nth = (free_name(docs, x) for x in ("_key", "_digest", "_nth"))
    of = lambda id_, sha: F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("-")), sha)
    kept = dedup.exact_dedup(docs).filter("kept").select(of(F.col("doc_id"), F.col("text_sha256")).alias(key))
    keyed = docs.withColumn(key, of(F.col("doc_id"), dedup.sha256_of(dedup.normalised(F.col("text")))))
    stays = keyed.join(kept, key, "left_semi")
    # the join has dealt the rows by the same key
    return stays.withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(key))).filter(F.col(nth) == 1).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by the Jaccard join the one with the smallest id stays.

    A hash of the text tells apart rows that repeat an id; a null id is the smallest. Null and empty texts are linked with nothing and stay; texts of any
    length are compared whole; an empty table stays empty; other columns are kept.
    """
    _in_small_batches(spark)
    row = free_name(docs, "_row")
    of_row = F.struct(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("h"))
    found = jaccard_join.jaccard_components(docs.select(of_row.alias(row), "text"), percent=NEAR, size=NEAR_WORDS, id_col=row)
    dropped = materialize(found.filter(F.col(row) != F.col("component_id")).select(row), "near-copies")
    return docs.withColumn(row, of_row).join(dropped, row, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, each time with all its columns.

    A null source or language counts as "", null texts as empty ones, which have no tokens and go with the prefix that they stand in. The order within
    a leaf is by a seeded hash of id and text; rows that repeat both, or have equal texts and no id, are taken or left together. Long
    texts count with all their tokens. An empty table stays empty.
    """
    return mixing.mixed(docs, mixing.levels_of_documents(), weights=mixing.WEIGHTS, budget_share=mixing.SHARE, max_epochs=mixing.EPOCHS, seed=mixing.SEED)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's pieces, with their number and digests: one row for each row of docs, repeated ones too.

    Null texts are encoded as empty ones, texts of any length whole; null ids stay null; other columns, whatever their names, are left out.
    """
    _in_small_batches(spark)
    return sentencepieces.piece_codes(docs, sentencepieces.default_model(), keep_text=False).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode),
]

#: The learned and hashed stages have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
