"""What the operators of this subpackage share: the work folder, skew-safe attachment of group values, skew-safe sharing of
values between rows, small Arrow batches."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.plans.workspace import materialize, new_path, shared_dir

__all__ = ["arrow_batches", "attach_groups", "combined", "discard", "free_name", "materialize", "mixed", "new_path", "shared_dir", "word_hashes"]

#: A group counts as hot when it holds at least one row in this many; so there are at most this many hot groups.
HOT_SHARE = 1000


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside hands rows to Python in batches of at most this many; for eager steps whose rows are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: The lowest n bytes, by n.
_LOWEST = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the words of all texts in turn, where each text's words start, and the end). Words are runs of anything
    but ASCII white space; A-Z count as lower case. Eight bytes of all words are taken at once."""
    raw = b"\n" + b"\n".join(texts).lower() + b"\n" + bytes(8)
    space = _SPACE[np.frombuffer(raw, np.uint8, len(raw) - 8)]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    length = np.flatnonzero(~space[:-1] & space[1:]) + 1 - starts
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    out = mixed((eight[starts] & _LOWEST[np.minimum(length, 8)]) + length.astype(_U) * _U(0x9E3779B97F4A7C15))
    rest, at = np.flatnonzero(length > 8), 8
    while len(rest):
        left = length[rest] - at
        out[rest] = mixed(out[rest] * _U(0xC2B2AE3D27D4EB4F) + (eight[starts[rest] + at] & _LOWEST[np.minimum(left, 8)]))
        rest, at = rest[left > 8], at + 8
    return out, np.searchsorted(starts, np.cumsum([1, *(len(t) + 1 for t in texts)]))


def discard(table: DataFrame) -> None:
    """Delete a materialized table whose results have been materialized in their turn; shuffle files that nothing refers to any
    more go with the next collection of the driver's garbage, which is asked for."""
    spark = table.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark._jvm.System.gc()


def _lists(owner: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    """The values of each of n owners; owner: ascending."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), pa.array(values))


def combined(values: list[np.ndarray], first: int, *others: list[np.ndarray]) -> list[pa.ListArray]:
    """Each of rows first, first + 1, .. has some 64-bit values, and others in step with them. Of each row: the values that stand
    nowhere before, whether they come again after, and their others; then its values that do stand before, the rows that have
    them first, and their others.

    So a value that very many rows share costs one entry a piece of rows, under which the rest are found again.
    """
    n = len(values)
    owner = np.repeat(np.arange(n), [len(x) for x in values])
    flat = np.concatenate([*values, np.empty(0, np.uint64)])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order].view(np.int64), owner[order]
    rest = [np.concatenate(x)[order] if x else np.empty(0, np.int32) for x in others]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    followed = new & ~np.append(new[1:], True)[: len(new)]
    leader = owner[np.maximum.accumulate(np.where(new, np.arange(len(flat)), 0))]
    out = []
    for mask, kept in ((new, (flat, followed, *rest)), (~new, (flat, first + leader, *rest))):
        by = np.flatnonzero(mask)
        by = by[np.argsort(owner[by], kind="stable")]
        out += [_lists(owner[by], x[by], n) for x in kept]
    return out


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not have yet."""
    taken = {c.lower() for c in df.columns}
    name, i = stem, 0
    while name.lower() in taken:
        i += 1
        name = f"{stem}_{i}"
    return name


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, row_salt: Column, how: str = "left", salts: int = 32) -> DataFrame:
    """Join each row to its group's values; groups has one row per key, and the row count of the group in column size.

    A group with a HOT_SHARE-th of all rows is hot; at most HOT_SHARE groups can be, so their keys are broadcast.
    Rows of hot groups are dealt over salts by row_salt (an integer column), and the group's row is repeated for each salt;
    all others meet under salt 0. groups is read three times: give a materialized one.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.filter(F.col(size) * HOT_SHARE >= F.lit(total)).select(F.col(key).alias("_hot_key")).filter("_hot_key IS NOT NULL")
    hot = hot.limit(HOT_SHARE)  # proven bound, as the sizes sum to total; says so to the planner
    salt = F.pmod(row_salt, F.lit(salts)).cast("int")
    dealt = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn("_salt", F.when(F.col("_hot_key").isNotNull(), salt).otherwise(F.lit(0))).drop("_hot_key")
    spread = groups.withColumn("_salt", F.explode(F.when(F.col(size) * HOT_SHARE >= F.lit(total), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(spread, [key, "_salt"], how)
