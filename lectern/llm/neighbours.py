"""Approximate nearest neighbours: an inverted file of coarse centroids, residuals in product-quantised codes, asymmetric distance
tables, exact reranking.

The centroids and the codebooks are fitted in numpy on a bounded sample (SAMPLE, CODE_SAMPLE vectors); every vector is indexed.
Vectors that are equal are one entry with its smallest ids, so copies cost one entry. Entries are packed in blocks of about BLOCK
codes: small lists share a block, a large list has several. A query goes to the blocks that hold one of its nearest lists, and is
compared with those lists' codes through one table of its products with the codebooks; the best entries of each block are
merged, and the best of all are measured on the original vectors.

How many lists a query looks through, and how many entries are measured, is not a fixed number: both are read off CALIBRATION
queries whose true neighbours a scan of all entries finds, so that the share of neighbours found is TARGET or more on data with
and without clusters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import arrow_batches, materialize

#: Vectors that centroids and codebooks are fitted on, at most.
SAMPLE, CODE_SAMPLE = 50_000, 10_000
#: The most lists; codes of a block; queries compared with a block at once.
MOST_LISTS, BLOCK, CHUNK = 1024, 8192, 256
#: Queries that the depth of the search is calibrated on, and the share of their neighbours that each of its two steps must keep.
CALIBRATION, TARGET = 64, 0.985
ROUNDS = 10


@dataclass(frozen=True)
class Search:
    """k: neighbours of a query; part: dimensions of a codebook; codes: entries of a codebook; seed: of the fit."""

    k: int = 10
    part: int = 2
    codes: int = 256
    seed: int = 12

    def __post_init__(self):
        if not (self.k >= 1 and self.part >= 1 and 1 <= self.codes <= 256):
            raise ValueError("k and part must be at least 1, codes 1 to 256")


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, a few thousand rows at a time."""
    return np.concatenate([np.empty(0, np.int64), *(_squares(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096))])


def k_means(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """At most n centres of the rows of x, by Lloyd's rounds from rows drawn by seed; a centre that loses all rows stays."""
    if not len(x):
        return x
    centres = x[np.random.default_rng(seed).permutation(len(x))[:n]].copy()
    for _ in range(ROUNDS):
        own = _nearest(x, centres)
        size = np.bincount(own, minlength=len(centres))
        sums = np.stack([np.bincount(own, x[:, d], len(centres)) for d in range(x.shape[1])], axis=1)
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


@dataclass
class Model:
    """centres: lists x dimensions; books: parts x codes x part; the last part is filled up with zeros."""

    centres: np.ndarray
    books: np.ndarray

    def parts(self, x: np.ndarray) -> np.ndarray:
        m, _, width = self.books.shape
        return np.pad(x, ((0, 0), (0, m * width - x.shape[1]))).reshape(len(x), m, width)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, the part of the distance that no query changes) of each row."""
        lists = _nearest(x, self.centres)
        centre, rest = self.parts(self.centres[lists]), self.parts(x - self.centres[lists])
        codes, fixed = np.empty(rest.shape[:2], np.uint8), np.zeros(len(x))
        for m, book in enumerate(self.books):
            codes[:, m] = _nearest(rest[:, m], book)
            found = book[codes[:, m]]
            fixed += (found * found).sum(1) + 2 * (centre[:, m] * found).sum(1)
        return lists, codes, fixed

    def tables(self, q: np.ndarray) -> np.ndarray:
        """queries x parts x codes: what a code adds to the squared distance."""
        return -2 * np.einsum("qmw,mcw->qmc", self.parts(q), self.books)

    def distances(self, q: np.ndarray, lists: np.ndarray, codes: np.ndarray, fixed: np.ndarray) -> np.ndarray:
        """queries x entries: squared distances to the entries as their codes have them."""
        out = _squares(q, self.centres)[:, lists] + fixed
        for m, table in enumerate(self.tables(q).transpose(1, 0, 2)):
            out += table[:, codes[:, m]]
        return out


def fit(x: np.ndarray, n_lists: int, search: Search) -> Model:
    centres = k_means(x, n_lists, search.seed)
    some = x[:CODE_SAMPLE]
    rest = some - centres[_nearest(some, centres)]
    m = -(-x.shape[1] // search.part)
    rest = np.pad(rest, ((0, 0), (0, m * search.part - x.shape[1]))).reshape(len(rest), m, search.part)
    return Model(centres, np.stack([k_means(rest[:, i], search.codes, search.seed + i) for i in range(m)]))


def usable(vec: Column) -> Column:
    """Whether a vector takes part: not null, not zero, without null or non-finite components."""
    finite = F.forall(vec, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def entries(rows: DataFrame, most: int) -> DataFrame:
    """rows(_id, _h, _v): (c, _h, _v, ids), one row for each distinct vector, with its smallest ids, at most so many. An id that
    repeats with the same vector counts once."""
    single = rows.groupBy("_h", "_v", "_id").agg(F.lit(1).alias("_one")).drop("_one")
    nth = F.row_number().over(Window.partitionBy("_h", "_v").orderBy("_id"))
    few = single.withColumn("_n", nth).filter(F.col("_n") <= most)
    return few.groupBy("_h", "_v").agg(F.array_sort(F.collect_list("_id")).alias("ids")).withColumn("c", F.monotonically_increasing_id())


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _packed(lists: np.ndarray, codes: np.ndarray, fixed: np.ndarray, c: np.ndarray) -> list:
    order = np.argsort(lists, kind="stable")
    return [len(order), lists[order].astype("<i4").tobytes(), codes[order].tobytes(), fixed[order].astype("<f8").tobytes(), c[order].astype("<i8").tobytes()]


def _unpacked(row: dict, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = row["n"]
    return np.frombuffer(row["lists"], "<i4"), np.frombuffer(row["codes"], np.uint8).reshape(n, parts), np.frombuffer(row["fixed"], "<f8"), np.frombuffer(row["cs"], "<i8")


def block_plan(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first block, number of blocks) of each list: small lists share blocks of about BLOCK, large ones have several."""
    first, number, block, room = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), 0, BLOCK
    for i, size in enumerate(sizes.tolist()):
        if size > room and room < BLOCK:
            block, room = block + 1, BLOCK
        first[i], number[i] = block, max(1, -(-size // BLOCK))
        room -= size
        if room <= 0:
            block, room = block + int(number[i]), BLOCK
    return first, number


def list_order(q: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The lists of each query, nearest first."""
    return np.argsort(_squares(q, centres), axis=1, kind="stable")


def _calibrate(index: DataFrame, coded: DataFrame, shared, probes: pd.DataFrame, k: int) -> tuple[int, int]:
    """(lists, entries): how many a query must look through, and measure, to keep TARGET of the true neighbours of probes. Two scans
    of all entries; each batch yields a few numbers for each probe."""
    q, own = np.array(probes["_v"].tolist(), float), probes["_id"].to_numpy()

    def nearest(batches):
        model = Model(*shared.value)
        for b in batches:
            x, c = _matrix(b.column("_v")), b.column("c").to_numpy()
            d = _squares(q, x)
            firsts = [ids[0] if len(ids) == 1 else None for ids in b.column("ids").to_pylist()]
            d[np.equal.outer(own, np.array([-1 if f is None else f for f in firsts])) & np.array([f is not None for f in firsts])] = np.inf  # the query's own row
            far = model.distances(q, b.column("list").to_numpy(), np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(len(c), -1), b.column("fixed").to_numpy())
            for i in range(len(q)):
                best = np.argpartition(d[i], min(k, len(c)) - 1)[:k]
                best = best[np.isfinite(d[i][best])]
                yield pa.record_batch([pa.array(np.full(len(best), i)), pa.array(d[i][best]), pa.array(far[i][best]), pa.array(b.column("list").to_numpy()[best])], ["i", "d", "far", "list"])

    ranked = coded.mapInArrow(nearest, "i long, d double, far double, list int").withColumn("n", F.row_number().over(Window.partitionBy("i").orderBy("d", "far"))).filter(F.col("n") <= k)
    true = ranked.toPandas()
    if not len(true):
        return 1, k
    order = list_order(q, shared.value[0])
    at = np.argsort(order, axis=1)[true["i"], true["list"]] + 1
    n_lists = int(np.sort(at)[min(len(at) - 1, int(np.ceil(TARGET * len(at))))])
    seen = np.zeros(order.shape, bool)
    np.put_along_axis(seen, order[:, :n_lists], True, axis=1)
    bounds = [np.sort(true["far"][(true["i"] == i)].to_numpy()) for i in range(len(q))]
    parts = len(shared.value[1])

    def below(batches):
        model = Model(*shared.value)
        for b in batches:
            for row in b.to_pylist():
                lists, codes, fixed, _ = _unpacked(row, parts)
                far = model.distances(q, lists, codes, fixed)
                far[~seen[:, lists]] = np.inf
                for i, bound in enumerate(bounds):
                    count = np.searchsorted(np.sort(far[i]), bound, side="right")
                    yield pa.record_batch([pa.array(np.full(len(bound), i)), pa.array(np.arange(len(bound))), pa.array(count.astype(np.int64))], ["i", "j", "n"])

    counts = index.mapInArrow(below, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).toPandas()["n"].to_numpy()
    depth = int(np.sort(counts)[min(len(counts) - 1, int(np.ceil(TARGET * len(counts))))]) if len(counts) else k
    return n_lists, max(2 * k, depth)


def nearest_neighbours(table: DataFrame, query: Column, search: Search = Search(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which query holds its k nearest others found, nearest first, of equal ones the
    smallest id; score is the Euclidean distance of the original vectors in double precision.

    Null vectors, zero vectors, those with null or non-finite components, and rows without an id take no part; nor do vectors of
    another length than most have. Rows that repeat id and vector count once; where one id has several vectors each of them is
    found and asked for, and none is a neighbour of another of that id. Fewer rows than k give all of them; an empty table none.
    Other columns are ignored, whatever their names; query may use them. Ids are whole numbers.
    """
    spark, k = table.sparkSession, search.k
    vec = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double") + F.lit(0.0))  # no negative zero
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("_id"), vec.alias("_v"), F.coalesce(query, F.lit(False)).alias("_asked")).filter(F.col("_id").isNotNull() & usable(F.col("_v")))
    lengths = rows.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("_v") == lengths[0]["d"]).withColumn("_h", F.xxhash64("_v"))
    distinct = materialize(entries(rows, k + 1), "vectors")
    total = distinct.count()
    asked = materialize(rows.filter("_asked").select("_id", "_h", "_v").distinct().withColumn("_q", F.monotonically_increasing_id()), "queries")

    def sample(df: DataFrame, size: int, n: int) -> pd.DataFrame:
        """About n rows, by hash, in its order; the bound is for the planner."""
        share = F.lit(int(min(1.0, n / max(1, size)) * (1 << 20)))
        return df.filter(F.pmod(F.xxhash64(F.lit(search.seed), "_h"), F.lit(1 << 20)) < share).limit(2 * n).toPandas().sort_values("_h")

    seen = np.array(sample(distinct.select("_h", "_v"), total, SAMPLE)["_v"].tolist(), float)
    if not len(seen):  # a hash can leave out all of a few
        seen = np.array(distinct.select("_v").limit(SAMPLE).toPandas()["_v"].tolist(), float)
    fitted = fit(seen, max(1, min(MOST_LISTS, round(total**0.5))), search)
    shared = spark.sparkContext.broadcast((fitted.centres, fitted.books))  # arrays, which need no package on executors
    parts = len(fitted.books)

    def encode(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if len(b):
                lists, codes, fixed = Model(*shared.value).encode(_matrix(b.column("_v")))
                new = [pa.array(lists.astype(np.int32)), pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(fixed)]
                yield pa.record_batch([*b.columns, *new], [*b.schema.names, "list", "code", "fixed"])

    with arrow_batches(spark, 4096):
        coded = materialize(distinct.select("c", "ids", "_v").mapInArrow(encode, "c long, ids array<long>, _v array<double>, list int, code binary, fixed double"), "codes")
    counted = dict(coded.groupBy("list").count().collect())  # a row for each list
    sizes = np.array([counted.get(i, 0) for i in range(len(fitted.centres))])
    first, number = block_plan(sizes)
    plan = F.broadcast(spark.createDataFrame(pd.DataFrame({"list": np.arange(len(sizes), dtype=np.int32), "_first": first, "_number": number})))
    block = F.col("_first") + F.pmod(F.xxhash64("c"), F.col("_number"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        codes = np.frombuffer(b"".join(pdf["code"]), np.uint8).reshape(len(pdf), parts)
        return pd.DataFrame([[pdf["block"].iloc[0], *_packed(pdf["list"].to_numpy(), codes, pdf["fixed"].to_numpy(), pdf["c"].to_numpy())]], columns=["block", "n", "lists", "codes", "fixed", "cs"])

    placed = coded.select("c", "list", "code", "fixed").join(plan, "list").select(block.alias("block"), "c", "list", "code", "fixed")
    index = materialize(placed.groupBy("block").applyInPandas(pack, "block long, n long, lists binary, codes binary, fixed binary, cs binary"), "index")

    with arrow_batches(spark, 4096):
        n_asked = asked.count()
        probes = sample(asked.select("_h", "_id", "_v"), n_asked, CALIBRATION)
        if not len(probes):
            probes = asked.select("_h", "_id", "_v").limit(CALIBRATION).toPandas()
        n_lists, depth = _calibrate(index, coded, shared, probes, k) if len(probes) else (1, k)

    def looked_through(q: np.ndarray) -> list[np.ndarray]:
        """Each query's lists: as many as were found necessary, more where those hold too few entries."""
        order = list_order(q, shared.value[0])
        enough = np.argmax(np.cumsum(sizes[order], axis=1) >= min(depth, total), axis=1) + 1
        return [o[: max(n_lists, e)] for o, e in zip(order, enough.tolist(), strict=True)]

    def send(batches):
        for b in batches:
            if not len(b):
                continue
            q = _matrix(b.column("_v"))
            own, to = [], []
            for i, lists in enumerate(looked_through(q)):
                blocks = np.unique(np.concatenate([np.arange(first[x], first[x] + number[x]) for x in lists]))
                own.append(np.full(len(blocks), i))
                to.append(blocks)
            own, to = np.concatenate(own), np.concatenate(to)
            for i in range(0, len(own), 4096):
                part = pa.array(own[i : i + 4096])
                yield pa.record_batch([pa.array(to[i : i + 4096]), b.column("_q").take(part), b.column("_v").take(part)], ["block", "_q", "_v"])

    def bundle(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[pdf["block"].iloc[0], pdf["_q"].to_numpy().astype("<i8").tobytes(), np.stack(pdf["_v"].to_list()).astype("<f8").tobytes()]], columns=["block", "qs", "vs"])

    def compare(batches):
        for b in batches:
            for row in b.to_pylist():
                lists, codes, fixed, cs = _unpacked(row, parts)
                qs = np.frombuffer(row["qs"], "<i8")
                q = np.frombuffer(row["vs"], "<f8").reshape(len(qs), -1)
                far = Model(*shared.value).distances(q, lists, codes, fixed)
                for i, ours in enumerate(looked_through(q)):
                    open_ = np.zeros(len(sizes), bool)
                    open_[ours] = True
                    at = np.flatnonzero(open_[lists])
                    if len(at) > depth:
                        at = at[np.argpartition(far[i][at], depth - 1)[:depth]]
                    yield pa.record_batch([pa.array(np.full(len(at), qs[i])), pa.array(cs[at]), pa.array(far[i][at])], ["_q", "c", "far"])

    with arrow_batches(spark, 256):
        sent = asked.select("_q", "_v").mapInArrow(send, "block long, _q long, _v array<double>")
        load = dict(sent.groupBy("block").count().collect())  # a row for each block that is asked
        pieces = F.broadcast(spark.createDataFrame([(b, max(1, -(-n // CHUNK))) for b, n in load.items()] or [(-1, 1)], "block long, _pieces int"))
        chunk = F.pmod(F.xxhash64("_q"), F.col("_pieces")).alias("chunk")
        bundles = materialize(sent.join(pieces, "block").select("block", chunk, "_q", "_v").groupBy("block", "chunk").applyInPandas(bundle, "block long, qs binary, vs binary"), "asked")
    with arrow_batches(spark, 4):
        far = index.join(bundles, "block").mapInArrow(compare, "_q long, c long, far double")
        best = far.withColumn("_n", F.row_number().over(Window.partitionBy("_q").orderBy("far", "c"))).filter(F.col("_n") <= depth).select("_q", "c")
        best = materialize(best, "candidates")
    square = F.zip_with("_v", "_w", lambda a, b: (a - b) * (a - b))
    score = F.sqrt(F.aggregate(square, F.lit(0.0), lambda s, x: s + x))
    met = best.join(asked.select("_q", "_id", "_v"), "_q").join(distinct.select("c", "ids", F.col("_v").alias("_w")), "c")
    found = met.select("_q", F.col("_id").alias("query_id"), F.explode("ids").alias("vec_id"), score.alias("score")).filter("vec_id <> query_id")
    # one id with several vectors may be met twice: it stays with each
    rank = F.row_number().over(Window.partitionBy("_q").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
