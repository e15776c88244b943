"""Mixing sources to target weights by hierarchical budgeting.

The leaves of a domain-language-source tree hold documents. A token budget goes down the tree: each node divides its own among
its children by their weights, and what a child cannot take (its tokens times max_epochs) is divided among its siblings first;
only what a whole family cannot take reaches the siblings of its parent. A leaf then gets as many whole epochs as its budget
holds, and of the next one the longest prefix, in that epoch's seeded order, whose tokens the rest of the budget covers.

The prefix is found without ordering a leaf: tokens are summed by leaf and the leading bits of the order's hash, twice with
finer bits inside the bin where the budget ends, and only the last bin's rows are ordered. That gives one cut key per leaf,
with which each row decides for itself; no row is shuffled with its text.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import free_name, materialize

#: Leaves may not be more: their totals go to the driver, their plans are broadcast.
MOST_LEAVES = 200_000
#: Bits of the hash in a bin, coarse and fine.
COARSE, FINE = 10, 20


def n_tokens(text: Column) -> Column:
    """Words between runs of ASCII white space."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def share_out(budget: int, capacity: Mapping, weight: Mapping) -> dict:
    """Divide budget by weight among children, none above its capacity; what some cannot take goes to the others by weight.

    Whole tokens: what rounding leaves goes one by one in the order of the largest remainders, then of the names. Children of
    weight 0 get nothing.
    """
    got = dict.fromkeys(capacity, 0)
    left = min(budget, sum(c for k, c in capacity.items() if weight[k] > 0))
    open_ = sorted(k for k in capacity if weight[k] > 0 and capacity[k] > 0)
    while open_ and left > 0:
        total = sum(weight[k] for k in open_)
        full = [k for k in open_ if capacity[k] <= left * weight[k] / total]
        if full:
            for k in full:
                got[k] = capacity[k]
            left -= sum(capacity[k] for k in full)
            open_ = [k for k in open_ if k not in set(full)]
            continue
        exact = {k: left * weight[k] / total for k in open_}
        for k in open_:
            got[k] = int(exact[k])
        rest = left - sum(got[k] for k in open_)
        for k in sorted(open_, key=lambda k: (int(exact[k]) - exact[k], k)):
            if rest > 0 and got[k] < capacity[k]:
                got[k] += 1
                rest -= 1
        break
    return got


def leaf_budgets(totals: Mapping[tuple, int], budget: int, weights: Mapping[tuple, float], max_epochs: float) -> dict[tuple, int]:
    """Each leaf's tokens. totals: tokens by leaf path; weights: by path of any depth, among siblings; 1 where not given.

    A node takes what its leaves can, but for those under a weight of 0, which take nothing: so no budget is given to a node that
    cannot place it.
    """
    capacity: dict[tuple, int] = {}
    children: dict[tuple, set] = {}
    for path, tokens in totals.items():
        able = int(tokens * max_epochs)
        for d in range(len(path), -1, -1):
            capacity[path[:d]] = capacity.get(path[:d], 0) + able
            if d:
                children.setdefault(path[: d - 1], set()).add(path[:d])
                if float(weights.get(path[:d], 1.0)) <= 0:
                    able = 0
    out: dict[tuple, int] = {}
    stack = [((), min(budget, capacity.get((), 0)))]
    while stack:
        node, own = stack.pop()
        if node not in children:
            if node in totals:
                out[node] = own
            continue
        below = children[node]
        stack += share_out(own, {k: capacity[k] for k in below}, {k: float(weights.get(k, 1.0)) for k in below}).items()
    return out


def mix(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple, float] | None = None, budget: int | None = None, budget_share: float = 1.0, max_epochs: float = 2.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", out_col: str = "copies") -> DataFrame:
    """docs with out_col added (replaced where it exists): how often each document is taken, 0 included; and n_tokens and the
    levels unless docs has columns of such names.

    levels: the tree's levels from the top, by name. budget: tokens, by default budget_share of all. Null levels count as "",
    null texts as empty ones. Where several rows have the same id and text they are taken or left together. Documents without
    words go with the prefix that they stand in. An empty table stays empty.
    """
    spark = docs.sparkSession
    docs = docs.drop(out_col)
    names = [f"_l{i}" for i in range(len(levels))]
    placed = docs.withColumns({n: F.coalesce(c.cast("string"), F.lit("")) for n, c in zip(names, levels.values(), strict=True)} | {"_t": n_tokens(F.col(text_col)), "_x": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    slim = materialize(placed.select(F.col(id_col).alias("_id"), *names, "_t", "_x"), "mix")
    rows = slim.groupBy(*names).agg(F.sum("_t").alias("tokens")).limit(MOST_LEAVES + 1).collect()
    if len(rows) > MOST_LEAVES:
        raise ValueError(f"more than {MOST_LEAVES} leaves: give coarser levels")
    totals = {tuple(r[n] for n in names): r["tokens"] for r in rows}
    whole = sum(totals.values())
    budgets = leaf_budgets(totals, int(whole * budget_share) if budget is None else budget, weights or {}, max_epochs)
    plan = [(*path, own // totals[path] if totals[path] else 0, own % totals[path] if totals[path] else 0) for path, own in budgets.items()]
    kinds = ", ".join(f"{n} string" for n in names)
    plans = F.broadcast(spark.createDataFrame(plan, f"{kinds}, _full long, _rest long"))
    key = F.xxhash64(F.lit(seed), F.col("_full"), F.col("_id"), F.col("_x"))

    open_ = slim.join(plans, names).filter("_rest > 0").withColumn("_h", key)
    first, before = None, F.lit(0)
    for bits in (COARSE, FINE):
        open_ = open_.withColumn("_b", F.shiftright("_h", 64 - bits))
        bins = open_.groupBy(*names, "_rest", *(["_before"] if first else []), "_b").agg(F.sum("_t").alias("_s"))
        running = F.sum("_s").over(Window.partitionBy(*names).orderBy("_b")) + before
        ends = bins.withColumn("_upto", running).filter("_upto > _rest").groupBy(*names).agg(F.min(F.struct("_b", (F.col("_upto") - F.col("_s")).alias("_from"))).alias("_cut"))
        ends = ends.select(*names, F.col("_cut._b").alias("_b"), F.col("_cut._from").alias("_before"))
        # a row per leaf at most, and those are bounded
        open_ = open_.drop("_before").join(F.broadcast(ends), [*names, "_b"]).drop("_b")
        first, before = True, F.col("_before")
    upto = F.sum("_t").over(Window.partitionBy(*names).orderBy("_h", "_x").rangeBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("_before")
    inside = open_.withColumn("_upto", upto)
    # the first key that is not taken
    cuts = inside.filter("_upto > _rest").groupBy(*names).agg(F.min(F.struct("_h", "_x")).alias("_end")).collect()
    end_of = {tuple(r[n] for n in names): (r["_end"]["_h"], r["_end"]["_x"]) for r in cuts}
    final = [(*p, *end_of.get(p[: len(names)], (None, None))) for p in plan]
    decided = F.broadcast(spark.createDataFrame(final, f"{kinds}, _full long, _rest long, _eh long, _ex long"))
    here = placed.withColumn("_id", F.col(id_col)).join(decided, names, "left").withColumn("_h", key)
    prefix = (F.col("_rest") > 0) & (F.struct("_h", "_x") < F.struct("_eh", "_ex"))
    out = here.withColumn(out_col, (F.coalesce("_full", F.lit(0)) + F.coalesce(prefix, F.lit(False)).cast("long")).cast("long"))
    taken = {c.lower() for c in docs.columns}
    extra = [F.col(n).alias(name) for n, name in zip(names, levels, strict=True) if name.lower() not in taken] + [F.col("_t").alias("n_tokens")] * ("n_tokens" not in taken)
    return out.select(*(F.col(f"`{c}`") for c in docs.columns), *extra, out_col)


def mixed(docs: DataFrame, levels: Mapping[str, Column], **options) -> DataFrame:
    """The mixture: each row of docs as often as it is taken, with its own columns."""
    name = free_name(docs, "_copies")
    chosen = mix(docs, levels, out_col=name, **options).filter(F.col(name) > 0)
    return chosen.withColumn(name, F.explode(F.sequence(F.lit(1), F.col(name)))).select(*docs.columns)


DOMAINS = ["web", "books", "news", "reference"]


def levels_of_documents() -> dict[str, Column]:
    """The tables have no domains: a source is given one of four by the crc32 of its name."""
    number = (F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")) % len(DOMAINS)).cast("int")
    return {"domain": F.element_at(F.array(*map(F.lit, DOMAINS)), number + 1), "lang": F.col("lang"), "source": F.col("source")}


def domain_of(source: str | None) -> str:
    return DOMAINS[zlib.crc32((source or "").encode()) % len(DOMAINS)]


#: Target weights among siblings.
WEIGHTS: dict[tuple, float] = {
    ("web",): 4.0, ("books",): 3.0, ("news",): 2.0, ("reference",): 1.0,
    **{(d, "en"): 3.0 for d in DOMAINS}, **{(d, "de"): 2.0 for d in DOMAINS}, **{(d, "fr"): 2.0 for d in DOMAINS}, **{(d, "es"): 1.0 for d in DOMAINS},
}
SHARE, EPOCHS, SEED = 0.8, 2.0, 20


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs, levels_of_documents(), WEIGHTS, budget_share=SHARE, max_epochs=EPOCHS, seed=SEED).select("doc_id", "domain", "lang", "source", "n_tokens", "copies")
