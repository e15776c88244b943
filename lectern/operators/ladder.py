"""A ladder of searches: each looser one is run for the records only that all stricter ones left without a hit."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.similar import rarest_first
from lectern.plans.workspace import materialize

Rung = Callable[[DataFrame], DataFrame]


def climb(records: DataFrame, key: str, rungs: Sequence[Rung]) -> tuple[DataFrame, list[int]]:
    """(hits of all rungs with stage, from 0; how many records each rung that was run was asked for). A rung gets the records that are
    open and gives hits with their key; a record is closed by its first hits. Nothing is run once no record is open.

    Each rung's hits are written, as its cost must not be paid again by the next one's question which records are open.
    """
    open_, found, asked = materialize(records, "open"), None, []
    for stage, rung in enumerate(rungs):
        n = open_.count()
        if not n and stage:
            break
        asked.append(n)
        hits = materialize(rung(open_).withColumn("stage", F.lit(stage)), "hits")
        found = hits if found is None else found.unionByName(hits)
        open_ = materialize(open_.join(hits.select(key).distinct(), key, "left_anti"), "open")
    return found, asked


def word_rung(corpus: DataFrame, n: int, key: str = "record", also: Column | None = None, same: tuple[str, str] | None = None) -> Rung:
    """A rung over a local corpus(candidate, words): candidates that have all of the first n words of a record's title (words), and meet
    the condition, over the columns of both. Records without words have no hits. same: a column of the records and one of the
    candidates that must be equal; pairs meet by it.

    Sets of words meet by the rarest of the n words alone, the others are looked up in the candidate's own; equal sets are one until
    their hits are told to all records and candidates that have them.
    """
    by = F.col(same[1]) if same else F.lit(0)
    digest = lambda words: F.sha2(F.array_join(words, " "), 256)
    ranked = materialize(rarest_first(corpus, "candidate", "words").withColumns({"_set": digest("words"), "_same": by}), "corpus")
    sets = materialize(ranked.groupBy("_set", "_same").agg(F.first("words").alias("_has")), "sets")
    places = sets.select("_set", "_same", F.explode("_has").alias("_w"))
    counts = materialize(places.groupBy("_same", "_w").agg(F.count(F.lit(1)).alias("_c")), "counts")

    def rung(open_: DataFrame) -> DataFrame:
        first = F.array_sort(F.array_distinct(F.slice("words", 1, n)))
        asked = open_.withColumn("_first", first).filter(F.size("_first") > 0).withColumns({"_ask": digest("_first"), "_same": F.col(same[0]) if same else F.lit(0)})
        forms = asked.groupBy("_ask", "_same").agg(F.first("_first").alias("_first"))
        each = forms.select("_ask", "_same", "_first", F.explode("_first").alias("_w")).join(counts, ["_same", "_w"])
        # a word that no candidate has is not counted: its record has no hit
        anchor = each.groupBy("_ask", "_same").agg(F.min(F.struct("_c", "_w")).alias("_m"), F.count(F.lit(1)).alias("_known"), F.first("_first").alias("_first"))
        anchor = anchor.filter(F.col("_known") == F.size("_first")).select("_ask", "_same", "_first", F.col("_m._w").alias("_w"))
        met = anchor.join(places, ["_same", "_w"]).join(sets, ["_set", "_same"])
        kept = met.filter(F.size(F.array_except("_first", "_has")) == 0).select("_ask", "_set", "_same")
        found = kept.join(ranked.drop("words"), ["_set", "_same"]).drop("_set")
        pairs = found.join(asked.drop("words", "_first"), ["_ask", "_same"])
        return (pairs if also is None else pairs.filter(also)).select(key, "candidate")

    return rung
