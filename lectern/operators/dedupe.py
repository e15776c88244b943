"""Keyed logs, first and last wins, numbering, neighbours and runs."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lectern.operators.graph import components
from lectern.plans.workspace import materialize


def _free(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    while stem in df.columns:
        stem += "_"
    return stem


def _wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def first_wins(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The first row of each key, in the order of the given columns."""
    return _wins(df, keys, [F.col(c).asc_nulls_last() for c in order])


def last_wins(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The last row of each key: an append-only log read as a table."""
    return _wins(df, keys, [F.col(c).desc_nulls_last() for c in order])


def collapse_log(df: DataFrame, key: str, order: str) -> DataFrame:
    """last_wins by aggregation: a struct of all columns is compared by its order, with partial sums before the shuffle, so a
    key with very many lines costs a row a task."""
    rest = [c for c in df.columns if c not in (key, order)]
    best = F.max_by(F.struct(*df.columns), order)
    return df.groupBy(key).agg(best.alias("_r")).select(*(F.col(f"_r.{c}") for c in [key, order, *rest])).select(*df.columns)


def not_done(todo: DataFrame, done: DataFrame, key: str, retry: Column | None = None) -> DataFrame:
    """Rows of todo whose key is not in done; retry tells which rows of done count as not done."""
    kept = done if retry is None else done.filter(~F.coalesce(retry, F.lit(False)))
    return todo.join(kept.select(key), key, "left_anti")


def numbered(df: DataFrame, *order: str, start: int = 1, name: str = "id") -> DataFrame:
    """Consecutive numbers in the order given, without sorting all rows in one task: rows are range-partitioned and sorted, and
    a partition's numbers start after the rows of those before it (a count for each partition goes to the driver)."""
    spark = df.sparkSession
    placed = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("_p", F.spark_partition_id())
    placed = materialize(placed, "ranges")  # ranges are sampled: they must not be drawn twice
    counts, before, total = {r["_p"]: r["count"] for r in placed.groupBy("_p").count().collect()}, [], 0
    for p in sorted(counts):
        before.append((p, total))
        total += counts[p]
    offsets = spark.createDataFrame(before, "_p int, _before long") if before else spark.createDataFrame([], "_p int, _before long")
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return placed.withColumn("_r", rank).join(F.broadcast(offsets), "_p").withColumn(name, F.col("_r") + F.col("_before") + (start - 1)).drop("_p", "_r", "_before")


def with_previous(df: DataFrame, value: str, *order: str, name: str = "previous") -> DataFrame:
    """df with the value of the row before in the whole order, null for the first row: neighbours without one task for all rows.

    Rows are range-partitioned and sorted; inside a range the row before is the neighbour, and a range's first row gets what the
    last row of the ranges before it carries over: one row for each range goes to the driver. order must tell rows apart.
    """
    spark, kind = df.sparkSession, df.schema[value].dataType
    place, last = _free(df, "_range"), _free(df, "_carried")
    placed = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn(place, F.spark_partition_id())
    placed = materialize(placed, "ranges")  # ranges are sampled: they must not be drawn twice
    ends = placed.groupBy(place).agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("e")).collect()
    carried, before = [], None
    for r in sorted(ends, key=lambda r: r[place]):
        carried.append((r[place], before))
        before = r["e"]["v"]
    schema = StructType([StructField(place, IntegerType()), StructField(last, kind)])
    w = Window.partitionBy(place).orderBy(*order)
    met = placed.withColumns({name: F.lag(value).over(w), f"{place}_n": F.row_number().over(w)}).join(F.broadcast(spark.createDataFrame(carried, schema)), place)
    return met.withColumn(name, F.when(F.col(f"{place}_n") == 1, F.col(last)).otherwise(F.col(name))).drop(place, last, f"{place}_n")


def breaks(df: DataFrame, value: str, *order: str) -> DataFrame:
    """df with is_new: whether the value differs from that of the row before in the whole order; null is a value of its own."""
    before = _free(df, "_before")
    first = with_previous(df.withColumn(before, F.struct(F.col(value).alias("v"))), before, *order, name=f"{before}p")
    return first.withColumn("is_new", F.col(f"{before}p").isNull() | ~F.col(before).eqNullSafe(F.col(f"{before}p"))).drop(before, f"{before}p")


def gaps_over_all(df: DataFrame, number: str) -> DataFrame:
    """(after, before): neighbours among all distinct numbers that are not consecutive."""
    own = with_previous(df.select(number).filter(F.col(number).isNotNull()).distinct(), number, number, name="after")
    return own.filter(F.col(number) > F.col("after") + 1).select("after", F.col(number).alias("before"))


def sharing_none(items: DataFrame, known: DataFrame, key: str, values: str) -> DataFrame:
    """The items whose array of values has none in common with any of known's arrays; null values are in none, so an item without
    any stays. key tells items apart. Values are compared one by one, so an array that very many share costs a row a task."""
    there = known.select(F.explode(values).alias("_v")).distinct()
    met = items.select(F.col(key).alias("_id"), F.explode(F.array_distinct(values)).alias("_v")).join(there, "_v", "left_semi").select("_id").distinct()
    return items.join(met, items[key] == met["_id"], "left_anti")


def suffixed(df: DataFrame, key: str, order: str, name: str = "key") -> DataFrame:
    """Keys made distinct, in order: each row has its key, or if that is taken its key with the first of 2, 3, ... that is free.

    A key with a number can only be another row's where some key is another one and a number. Keys of which that may be so are
    worked off one by one, each family by itself; all others by their rank.
    """
    rank, by_hand, node = _free(df, "_rank"), _free(df, "_family"), _free(df, "_node")
    count = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
    parts = F.transform(F.sequence(F.lit(1), F.least(F.lit(9), F.length(F.regexp_extract("_k", "([0-9]*)$", 1)))), lambda d: F.struct(F.substring("_k", F.lit(1), F.length("_k") - d).alias("stem"), F.right("_k", d).try_cast("long").alias("n")))
    ended = materialize(count, "keys").filter(F.col("_k").rlike("[0-9]$")).select("_k", "_c", F.explode(parts).alias("p"))
    total = count.select(F.col("_k").alias("_stem"), F.col("_c").alias("_total"))
    # a family's keys may reach each other in several steps
    met = ended.join(total, F.col("p.stem") == F.col("_stem")).withColumn("_others", F.sum("_c").over(Window.partitionBy("_stem")))
    clash = met.filter(F.col("p.n").between(1, F.col("_total") + F.col("_others"))).select(F.col("_stem").alias("a"), F.col("_k").alias("b"))
    family = materialize(components(clash), "families").select(F.col("node").alias(node), F.col("component").alias(by_hand))
    marked = df.join(family, F.col(key) == F.col(node), "left").drop(node)
    ranked = marked.withColumn(rank, F.row_number().over(Window.partitionBy(key).orderBy(order)))
    plain = ranked.filter(F.col(by_hand).isNull()).withColumn(name, F.when(F.col(rank) == 1, F.col(key)).otherwise(F.concat(key, F.col(rank).cast("string"))))

    def probed(pdf: pd.DataFrame) -> pd.DataFrame:
        taken, nth, out = set(), {}, []
        for base in pdf.sort_values(order)[key]:
            made, n = base, 2
            if made in taken:
                n = nth.get(base, 2)
                while (made := f"{base}{n}") in taken:
                    n += 1
                nth[base] = n + 1
            taken.add(made)
            out.append(made)
        return pdf.sort_values(order).assign(**{name: out})

    columns = [*(c for c in df.columns if c != name), name]
    schema = StructType([*(f for f in df.schema.fields if f.name != name), StructField(name, StringType())])
    again = marked.filter(F.col(by_hand).isNotNull()).groupBy(by_hand).applyInPandas(lambda pdf: probed(pdf)[columns], schema)
    return plain.select(*columns).unionByName(again)


def gaps(df: DataFrame, group: str, number: str) -> DataFrame:
    """(group, after, before): neighbours whose numbers are not consecutive."""
    previous = F.lag(number).over(Window.partitionBy(group).orderBy(number))
    rows = df.withColumn("_p", previous)
    return rows.filter(F.col(number) > F.col("_p") + 1).select(group, F.col("_p").alias("after"), F.col(number).alias("before"))


def islands(df: DataFrame, group: str, number: str) -> DataFrame:
    """(group, first, last, n): runs of consecutive numbers."""
    own = df.select(group, number).distinct()
    run = F.col(number) - F.row_number().over(Window.partitionBy(group).orderBy(number))
    return own.withColumn("_run", run).groupBy(group, "_run").agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count(F.lit(1)).alias("n")).drop("_run")


def one_to_n(df: DataFrame, group: str, number: str) -> DataFrame:
    """(group, n, complete): whether the numbers of each group are exactly 1..n, by aggregates alone."""
    agg = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(number).alias("_d"), F.min(number).alias("_lo"), F.max(number).alias("_hi"))
    return agg.select(group, "n", ((F.col("_lo") == 1) & (F.col("_hi") == F.col("n")) & (F.col("_d") == F.col("n"))).alias("complete"))


def continuity(df: DataFrame, group: str, number: str) -> DataFrame:
    """(group, last, next_first, follows): whether each group's numbers go on where the group before it ended. Groups are
    numbered in their order without a sort in one task, and each is joined to the next."""
    ends = numbered(df.groupBy(group).agg(F.min(number).alias("first"), F.max(number).alias("last")), group, name="_i")
    following = ends.select((F.col("_i") - 1).alias("_i"), F.col("first").alias("next_first"))
    return ends.join(following, "_i").select(group, "last", "next_first", (F.col("next_first") == F.col("last") + 1).alias("follows"))


def control_breaks(df: DataFrame, group: str, value: Column, *order: str) -> DataFrame:
    """df with new_<group>: whether value differs from the row before, in order within each group."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("value", value).withColumn("is_new", F.coalesce(F.lag("value").over(w) != F.col("value"), F.lit(True)))


def missing_numbers(df: DataFrame, number: str, first: int, last: int) -> DataFrame:
    """Numbers of first..last that no row has."""
    wanted = df.sparkSession.range(first, last + 1).withColumnRenamed("id", number)
    return wanted.join(df.select(number).distinct(), number, "left_anti")
