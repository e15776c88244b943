"""What is still to be looked up, what a look-up gave, and what a person said of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import agreement as A
from lectern.functions import text as X
from lectern.functions import udfs as U
from lectern.operators import dedupe
from lectern.operators.similar import letters_bound

#: Words of a title that the loose pass looks for, and the least share that a candidate must have.
LOOSE_WORDS, LEAST_COVERAGE = 8, 0.6
#: The least score of a candidate of the strict pass.
LEAST_SCORE = 0.82


def wants_lookup(type_: Column, year_num: Column, year: Column) -> Column:
    """Books and periodicals that have a year, as a number or in print."""
    dated = year_num.isNotNull() | F.coalesce(year, F.lit("")).rlike(r"\d{4}")
    return F.coalesce(type_.isin("book", "periodical"), F.lit(False)) & dated


def without_copy(links: Column) -> Column:
    """No link, or not looked up."""
    return F.coalesce(F.size(links), F.lit(0)) <= 0


def targets(books: DataFrame, language: str, done: DataFrame | None = None, key: str = "rowkey", limit: int | None = None, containing: tuple[str, str] | None = None) -> DataFrame:
    """Books and periodicals of a language without a copy, by id with undated ones last; those whose key is done are left out.
    limit is how much one run takes on. containing: a column and a text that it must have somewhere, letters a-z in either case."""
    open_ = books.filter((F.col("language") == language) & F.col("type").isin("book", "periodical") & without_copy(F.col("links")))
    if containing:
        column, text = containing
        open_ = open_.filter(F.lower(F.coalesce(F.col(column), F.lit(""))).contains(text.lower()))
    todo = open_ if done is None else dedupe.not_done(open_, done, key)
    ordered = todo.orderBy(F.col("year_num").isNull(), "id")
    return ordered if limit is None else ordered.limit(limit)


def split_matches(rows: DataFrame, cache: DataFrame, key: str = "lkey", most: int = 6, tolerance: int = 3) -> DataFrame:
    """rows with links and others: the cached matches that are of the row's edition, and of another one, best first.

    rows: key, author, title, years (array); cache: key, matches (array of identifier, year, creator, score), one row for a key.
    links and others are null where the key was never looked up, empty where nothing was found. An undated match needs a personal
    author, or a title of six words and a score of 0.97; another edition needs a personal author and a creator.
    """
    joined = rows.join(cache.select(key, F.col("matches").alias("_m")), key, "left")
    personal = X.surname(F.col("author")) != ""
    telling = F.size(F.filter(F.split(X.norm(F.coalesce("title", F.lit(""))), " "), lambda w: w != "")) >= 6
    years = F.coalesce("years", F.array().cast("array<int>"))
    joined = joined.withColumns({"_personal": personal, "_telling": telling, "_years": years})
    exact = lambda m: F.coalesce(F.array_contains("_years", m["year"]), F.lit(False))
    near = lambda m: F.exists("_years", lambda y: F.abs(m["year"] - y) <= tolerance)
    same = lambda m: F.when(m["year"].isNull(), F.col("_personal") | (F.col("_telling") & (m["score"] >= 0.97))).otherwise(near(m))
    other = lambda m: m["year"].isNotNull() & ~near(m) & F.col("_personal") & (F.coalesce(m["creator"], F.lit("")) != "")

    def best(kept, *order) -> Column:
        ranked = F.transform("_m", lambda m, i: F.struct(*(f(m).alias(f"k{n}") for n, f in enumerate(order)), i.alias("i"), m.alias("m")))
        sorted_ = F.array_sort(F.filter(ranked, lambda x: kept(x["m"])))
        return F.transform(F.slice(sorted_, 1, most), lambda x: x["m"]["identifier"])

    links = best(same, lambda m: ~exact(m), lambda m: m["year"].isNull(), lambda m: -m["score"])
    others = best(other, lambda m: -m["score"], lambda m: m["year"])
    return joined.withColumns({"links": links, "others": others}).drop("_m", "_personal", "_telling", "_years")


def covering(candidates: DataFrame, words: str = "words", pool: str = "pool", least: float = LEAST_COVERAGE) -> DataFrame:
    """Candidates whose title has enough of the first words of the record's, with the share as cov."""
    return A.with_found_share(candidates, "cov", F.slice(words, 1, LOOSE_WORDS), F.col(pool)).filter(F.col("cov") >= least)


def scored(candidates: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """Candidates (main, full, surname, c_title, c_creator) that score enough, with score. Those whose letters alone rule that out
    are not compared; each of the others is compared once."""
    main, full, by = F.col("main"), F.col("full"), F.col("_by")
    # each column is worked out once for a row: bounds go through explode, which no filter is moved before, and into each ratio by itself
    offered = X.once(X.norm(F.coalesce("c_title", F.lit(""))), lambda t: F.struct(t.alias("t"), (A.normed_offer_score(main, full, t, by, letters_bound) >= least).alias("possible")))
    possible = candidates.withColumn("_by", A.maker_points(F.col("surname"), F.col("c_creator"))).withColumn("_t", F.explode(F.transform(F.filter(F.array(offered), lambda o: o["possible"]), lambda o: o["t"])))
    return possible.withColumn("score", A.normed_offer_score(main, full, F.col("_t"), by, U.similarity_in_place)).filter(F.col("score") >= least).drop("_by", "_t")


def batch_verdicts(review: DataFrame, line: str, first: int, yes: Sequence[int]) -> DataFrame:
    """The first lines of a review file, line numbers from 0, with verdict: y for those named, n for all others among them."""
    named = F.col(line).isin([int(n) for n in yes]) if yes else F.lit(False)
    return review.filter(F.col(line).between(0, first - 1)).withColumn("verdict", F.when(named, "y").otherwise("n"))


def fresh(items: DataFrame, known: DataFrame, key: str, urls: str = "urls") -> DataFrame:
    """Items none of whose addresses any known item has; items without addresses are fresh. key must tell items apart."""
    address = F.explode(urls).alias("_u")
    met = items.select(key, address).join(known.select(address), "_u", "left_semi").select(key)
    return items.join(met, key, "left_anti")


def to_redo(matches: Column, error: Column, redone: Column, old_cap: int | None = None) -> Column:
    """Whether a look-up that was made is to be made again: it ended in an error; or it stopped at the number of matches that was once
    the most, and has not been repeated since."""
    cut = F.lit(False) if old_cap is None else (F.size(matches) == old_cap) & ~F.coalesce(redone, F.lit(False))
    return F.coalesce(error, F.lit("")) != "" if old_cap is None else (F.coalesce(error, F.lit("")) != "") | F.coalesce(cut, F.lit(False))
