"""The queries of this subpackage, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import collocations, exact_dedup, fingerprints, html_text, importance, jaccard_join, mixing, neighbours, secret_scan, sentencepieces, substring_dedup, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": warc.op1_warc,
        "op2_fingerprints": fingerprints.op2_fingerprints,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_secret_scan": secret_scan.op4_secret_scan,
        "op5_jaccard_join": jaccard_join.op5_jaccard_join,
        "op6_sentencepiece": sentencepieces.op6_sentencepiece,
        "op7_substring_dedup": substring_dedup.op7_substring_dedup,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_html_text": html_text.op9_html_text,
        "op10_mixing": mixing.op10_mixing,
        "op11_importance": importance.op11_importance,
        "op12_neighbours": neighbours.op12_neighbours,
        "op13_collocations": collocations.op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": warc.ORACLE,
        "op3_exact_dedup": exact_dedup.ORACLE,
        "op4_secret_scan": secret_scan.ORACLE,
        "op5_jaccard_join": jaccard_join.ORACLE,
        "op11_importance": importance.ORACLE,
        "op13_collocations": collocations.ORACLE,
    }
