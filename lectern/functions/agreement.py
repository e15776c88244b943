"""Whether two descriptions are of one work, as column expressions; only the sequence ratio of two strings is a UDF's work, and only
where nothing else has settled the matter.

Titles and names are compared in the form of text.norm. Words of a title that are alike but not equal (Architektur, Architeckur)
count as spellings of one word.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from lectern.functions import text as X
from lectern.functions.udfs import ratio, similarity, similarity_from

#: Words that may open a title, and words that do not tell titles apart.
ARTICLES = "the a an der die das le la les l".split()
AGREE_STOP = "the a an of and in on to for by with from its their de la le les du des et der die das und von in".split()
#: Where a statement of responsibility starts, and what stands before and after the start of a subtitle.
RESPONSIBLE = r"(?i)[.,;]\s+(?:ed\.|tr\.|trans\.|translated|edited|comp\.|compiled|illus\.|by |with (?:an? )?(?:introd|forew|pref))"
SUBTITLE = r"(?is)^(.{8,}?)(?:[:;]|\.\s|,\s(?=(?:with|being|an?|or|the)\b))(.*)"


def _best(word: str, pool: list[str]) -> float:
    """The word's ratio to the most similar one of the pool; those whose lengths allow no better one are passed by."""
    best = 0.0
    for other in pool:
        both = len(word) + len(other)
        if both and 2 * min(len(word), len(other)) / both > best:
            best = max(best, ratio(word, other))
    return best


def _best_ratios(words: pd.Series, pools: pd.Series) -> pd.Series:
    """For each word its ratio to the most similar one of the pool; nothing where either is null."""
    rows = ([] if own is None or pool is None else [_best(w, list(pool)) for w in own] for own, pool in zip(words, pools, strict=True))
    return pd.Series(list(rows), dtype=object)


best_ratios = F.pandas_udf(_best_ratios, ArrayType(DoubleType()))
#: The same where a filter on the answer must not be moved before the columns that it is asked for.
best_ratios_in_place = F.pandas_udf(_best_ratios, ArrayType(DoubleType())).asNondeterministic()


def words_in(normed: Column) -> Column:
    return F.filter(F.split(normed, " "), lambda w: w != "")


def _every(words: Column, ratios: Column, condition) -> Column:
    return F.forall(F.zip_with(words, ratios, condition), lambda holds: holds)


def spelled_alike(a: Column, b: Column) -> Column:
    """Whether the words that only one of two normalised titles has are spellings of one another, rather than other words."""
    only_a, only_b = F.array_except(words_in(a), words_in(b)), F.array_except(words_in(b), words_in(a))
    fit_a, fit_b = best_ratios(only_a, only_b), best_ratios(only_b, only_a)
    long_fit = lambda w, fit: (F.length(w) <= 2) | (fit >= 0.75)
    short_fit = ~F.exists(only_b, lambda w: F.length(w) <= 2) | _every(only_a, fit_a, lambda w, fit: (F.length(w) > 2) | (fit >= 0.5))
    return (F.size(only_a) == 0) | (F.size(only_b) == 0) | (_every(only_a, fit_a, long_fit) & _every(only_b, fit_b, long_fit) & short_fit)


def _alike(a: Column, b: Column, least: Column | float) -> Column:
    """False where either is null."""
    return a.isNotNull() & b.isNotNull() & (similarity(a, b) >= least) & F.coalesce(spelled_alike(a, b), F.lit(False))


def _settled(a: Column, b: Column, full_a: Column, full_b: Column, strict: Column) -> Column:
    """What same_title says where no ratio is needed for it; null elsewhere."""
    numbers = [F.array_distinct(F.regexp_extract_all(x, F.lit(r"(\d+)"), F.lit(1))) for x in (a, b)]
    other_numbers = (F.size(numbers[0]) > 0) & (F.size(numbers[1]) > 0) & ((F.size(F.array_except(*numbers)) > 0) | (F.size(F.array_except(*numbers[::-1])) > 0))
    goes_on = lambda x, y: y.startswith(F.concat(x, F.lit(" ")))
    begins = goes_on(a, b) | goes_on(b, a) | goes_on(full_a, full_b) | goes_on(full_b, full_a)
    return F.when((F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "") | other_numbers, False).when(a == b, True).when(~strict & (F.least(F.length(a), F.length(b)) >= 14) & begins, True)


def _whole(strict: Column, x: Column, full: Column) -> Column:
    return F.when(strict, full).otherwise(x)


def same_title(a: Column, b: Column, full_a: Column, full_b: Column, strict: Column) -> Column:
    """Whether two normalised titles name one work. a, b: titles proper; strict (parts, anonymous works): a shared series title
    is not enough, whole titles must be alike."""
    settled = _settled(a, b, full_a, full_b, strict)
    shared = F.least(F.length(full_a), F.length(full_b))
    left = lambda x: F.when(settled.isNull() & ~strict & (shared >= 20), F.substring(x, F.lit(1), shared))
    whole = lambda x, full: F.when(settled.isNull(), _whole(strict, x, full))
    found = _alike(whole(a, full_a), whole(b, full_b), F.when(strict, 0.95).otherwise(0.9)) | _alike(left(full_a), left(full_b), 0.93)
    return F.coalesce(settled, found)


def with_same_title(df: DataFrame, keep: list[str], a: str, b: str, full_a: str, full_b: str, strict: str) -> DataFrame:
    """The rows of df, with the columns keep only, that same_title holds for. Ratios are asked for only where nothing settles the
    matter and lengths allow them, spellings only where ratios are high; and titles are dealt over all tasks only there."""
    c = lambda name: F.col(f"_{name}")
    titles = [F.col(x) for x in (a, b, full_a, full_b)]
    shared = F.least(F.length(full_a), F.length(full_b))
    sides = [(F.col(a), F.col(full_a)), (F.col(b), F.col(full_b))]
    least = F.when(F.col(strict), 0.95).otherwise(0.9)
    # what a ratio says of two lengths, a little lower than it is
    fits = lambda x, y: 2 * F.least(F.length(x), F.length(y)) >= (least - 1e-9) * (F.length(x) + F.length(y))
    open_ = df.withColumn("_settled", _settled(*titles, F.col(strict))).filter("_settled IS NULL OR _settled")
    asked = open_.withColumn("_ask", F.col("_settled").isNull()).withColumns(
        {
            "_whole": c("ask") & fits(*(_whole(F.col(strict), *side) for side in sides)),
            "_left": c("ask") & ~F.col(strict) & (shared >= 20),
        }
    )
    parts = {f"_w{i}": F.when(c("whole"), _whole(F.col(strict), *side)) for i, side in enumerate(sides)}
    parts |= {f"_l{i}": F.when(c("left"), F.substring(side[1], F.lit(1), shared)) for i, side in enumerate(sides)}
    asked = asked.filter("_settled OR _whole OR _left").select(*keep, "_settled", least.alias("_least"), *(x.alias(name) for name, x in parts.items()))
    asked = asked.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rated = asked.withColumn("_wr", similarity_from(0.9)("_w0", "_w1")).withColumn("_lr", similarity_from(0.93)("_l0", "_l1"))
    near = rated.filter("_settled OR _wr >= _least OR _lr >= 0.93")
    # no title, so no words, where the ratio is too low
    spelled = lambda x, y, high: high & F.coalesce(spelled_alike(F.when(high, c(x)), F.when(high, c(y))), F.lit(False))
    same = spelled("w0", "w1", F.coalesce(c("wr") >= c("least"), F.lit(False))) | spelled("l0", "l1", F.coalesce(c("lr") >= 0.93, F.lit(False)))
    return near.filter(F.coalesce("_settled", F.lit(False)) | same).select(*keep)


def telling(words: Column) -> Column:
    """Of the words of a part of a title those that tell it from others."""
    first = F.when((F.size(words) > 1) & F.get(words, F.lit(0)).isin(ARTICLES), 2).otherwise(1)
    return F.filter(F.slice(words, first, F.greatest(F.size(words), F.lit(1))), lambda w: ~w.isin(AGREE_STOP) & ((F.length(w) > 1) | w.rlike("^[0-9]$")))


def share(words: Column, pool: Column) -> Column:
    """The share of words that the pool has, or has with another spelling; 0 without words. Only words of four letters that the
    pool does not have are compared with its own of four."""
    long = lambda w: F.length(w) >= 4
    missing = F.filter(F.array_except(words, pool), long)
    fit = best_ratios(missing, F.when(F.size(missing) > 0, F.filter(F.array_distinct(pool), long)))
    spelled = F.array_compact(F.zip_with(missing, fit, lambda w, x: F.when(x >= 0.8, w)))
    there = F.filter(F.zip_with(words, F.array_repeat(spelled, F.size(words)), lambda w, others: F.array_contains(pool, w) | F.array_contains(others, w)), lambda holds: holds)
    return F.coalesce(F.size(there) / F.nullif(F.size(words), F.lit(0)), F.lit(0.0))


def with_found_share(df: DataFrame, name: str, words: Column, pool: Column) -> DataFrame:
    """df with the share of words that a pool of words has, has at greater or smaller length (from five letters), or has with
    another spelling (from four letters); numbers must be the same. 0 without words.

    Equal words and beginnings are settled by columns, each worked out once; the ratio is asked for what they leave.
    """
    c = lambda stem: F.col(f"_found_{stem}")
    nothing = F.array().cast("array<string>")
    lettered = lambda w: ~w.rlike("^[0-9]*$") & (F.length(w) >= 4)
    begun = lambda w: F.exists(c("stems"), lambda p: (F.length(p) >= 5) & (p.startswith(w) | w.startswith(p)))
    steps = {
        "words": F.coalesce(words, nothing),
        "pool": F.coalesce(pool, nothing),
        "stems": F.filter(F.array_distinct(c("pool")), lettered),
        "other": F.filter(F.array_except(c("words"), c("pool")), lettered),
        "grown": F.filter(c("other"), lambda w: (F.length(w) >= 5) & begun(w)),
        "doubtful": F.array_except(c("other"), c("grown")),
        "fit": best_ratios_in_place(c("doubtful"), F.when(F.size(c("doubtful")) > 0, c("stems"))),
        "spelled": F.array_compact(F.zip_with(c("doubtful"), c("fit"), lambda w, x: F.when(x >= 0.84, w))),
        "known": F.concat(F.array_intersect(c("words"), c("pool")), c("grown"), c("spelled")),
    }
    out = df
    for stem, column in steps.items():
        out = out.withColumn(f"_found_{stem}", column)
    there = F.size(F.filter(c("words"), lambda w: F.array_contains(c("known"), w)))
    out = out.withColumn(name, F.coalesce(there / F.nullif(F.size(c("words")), F.lit(0)), F.lit(0.0)))
    return out.select(*(x for x in df.columns if x != name), name)


def offer_score(main: Column, full: Column, surname: Column, title: Column, creator: Column, ratio_of=similarity) -> Column:
    """How well an offered copy fits a record. main, full: the record's normalised titles; the best of three likenesses: of the
    title proper, of the whole title, and of the title proper to the start of the offer's, which counts 0.05 less. The surname
    among the creator's words adds 0.1, a creator without it takes 0.25. Titles without a letter or digit score 0.

    ratio_of: similarity, or a bound of it, which makes the score a bound.
    """
    return normed_offer_score(main, full, X.norm(F.coalesce(title, F.lit(""))), maker_points(surname, creator), ratio_of)


def normed_offer_score(main: Column, full: Column, offered: Column, by: Column, ratio_of=similarity) -> Column:
    """offer_score from the offer's normalised title and the maker_points."""
    start = F.substring(offered, F.lit(1), F.length(main) + 3)
    likeness = F.greatest(ratio_of(main, offered), ratio_of(full, offered), ratio_of(main, start) - 0.05)
    return F.when((F.coalesce(main, F.lit("")) == "") | (offered == ""), 0.0).otherwise(likeness + by)


def maker_points(surname: Column, creator: Column) -> Column:
    makers = words_in(X.norm(F.coalesce(creator, F.lit(""))))
    told = (F.coalesce(surname, F.lit("")) != "") & (F.coalesce(creator, F.lit("")) != "")
    return F.when(~told, 0.0).when(F.array_contains(makers, surname), 0.1).otherwise(-0.25)
