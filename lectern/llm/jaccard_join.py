"""N-gram Jaccard join by T-occurrence search (DivideSkip), over all documents and whole texts.

Documents whose shingle sets are equal form a class; the join runs between classes. Rows are numbered, and a class goes by the
number of its first row, so that no two classes are taken for one; classes are formed by a 128-bit digest of the set.

1. Signing. Sets of size n that are similar enough differ in few elements, at most d (see Threshold.most_apart). Dealt by hash
   range into more than d segments, two such sets have a segment in common, whole and not empty. Each document signs its
   segments, for the one or two bands of sizes in which a partner's smaller set may be. This bound is exact: no link is lost.
   Equal signatures are combined in each piece of rows before they are dealt, so one that very many documents share costs one
   row a piece. Dealt and sorted by signature, each run of equal ones has a first row, its leader, which then is joined back
   to the other rows of the pieces.
2. Clusters: any two classes that share a signature are in one. A leader's cluster are the classes that share a signature that
   it leads, whichever; the clusters of one component may be taken together. The latter is less work for a group of near
   copies, which have many leaders in common, the former for chains of chance neighbours; each component is taken the way that
   moves fewer shingles. Clusters that hold more than BLOCK shingles are dealt into blocks, and each pair of blocks is searched
   by a task of its own, so memory is bounded.
3. Searching. In each cluster an inverted index lists the documents of each shingle. A query needs T common shingles at least;
   the L longest of its lists are set aside, the others merged with a heap that skips what cannot reach T - L occurrences, and
   the documents that do reach it are probed for in the long lists by binary search. The counts are exact intersection sizes.
   Documents that are in the query's component already are left out of its lists: links inside a component change nothing. So
   a query is first compared with the document that the one before it was linked with.
4. Components of the links found.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import attach_groups, combined, discard, materialize, mixed, word_hashes
from lectern.operators.graph import components

#: Shingles of a block; one task's index holds two blocks at most, about.
BLOCK = 1 << 18
#: Classes that a task keeps in mind.
TABLE = 150_000
#: Weight of DivideSkip's rule for the number of long lists.
MU = 0.0085
#: Each size band goes up to so many times its start.
RATIO = 1.25
#: Rows signed at once, or as many as have so many signatures.
PIECE, PIECE_SIGNATURES = 1000, 1 << 20

_U = np.uint64
_A, _B, _C = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)


@dataclass(frozen=True)
class Threshold:
    """Linked from percent / 100 on: 100 * intersection >= percent * union."""

    percent: int = 90

    def linked(self, common: int, n: int, m: int) -> bool:
        return 100 * common >= self.percent * (n + m - common)

    def overlap(self, n: int, m: int) -> int:
        """Least intersection of linked sets of these sizes."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def smallest(self, n: int) -> int:
        """Least size of a set that can be linked with one of size n."""
        return -(-self.percent * n // 100)

    def most_apart(self, n: int) -> int:
        """Most elements in one only of two linked sets, the smaller of size n: union - intersection, with union <= n * 100 / percent."""
        return n * (100 - self.percent) // self.percent

    def first_size(self) -> int:
        """From this size on linked sets need not be equal."""
        return next(n for n in range(1, 10_000) if self.most_apart(n))

    def bands(self, n: int) -> list[tuple[int, int, int]]:
        """(number, segments, spare ones) of each size band in which the smaller set of a linked pair may be, if the larger has
        n elements. One segment more than the elements apart would do; the spare ones make up for empty segments, of which few
        sets have more."""
        low, out = self.first_size(), []
        if n < low:
            return out
        number = max(0, int(math.log(max(self.smallest(n), low) / low) / math.log(RATIO)) - 1)
        while (start := math.ceil(low * RATIO**number)) <= n:
            end = math.ceil(low * RATIO ** (number + 1)) - 1  # bands hold sizes start to end
            if end >= max(self.smallest(n), low) and end >= start:
                apart, spare = self.most_apart(end), 1
                for _ in range(6):
                    empty = (apart + 1 + spare) * math.exp(-start / (apart + 1 + spare))
                    spare = min(math.ceil(1 + empty + 3 * math.sqrt(empty)), 2 + apart // 4)
                out.append((number, apart + 1 + spare, spare))
            number += 1
        return out


def shingles_of(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The shingle set of each text: distinct 64-bit hashes of each `size` words in turn, sorted. A-Z count as lower case."""
    words, at = word_hashes(texts)
    ends = at[1:] - at[:-1]
    n = len(words) - size + 1
    every = np.full(max(n, 0), _U(size))
    for i in range(size):
        every = mixed(every * _A + words[i : n + i])
    out = []
    for start, length in zip(at[:-1].tolist(), ends.tolist(), strict=True):
        if length >= size:
            one = np.sort(every[start : start + length - size + 1])
            same = one[1:] == one[:-1]
            out.append(one[np.concatenate([[True], ~same])] if same.any() else one)
        else:  # the whole sequence, which is no shingle of full size
            one = np.full(min(length, 1), _U(length))
            for i in range(length):
                one = mixed(one * _A + words[start + i])
            out.append(one)
    return out


def texts_with_shingles(texts: pa.Array, size: int, most: int = 1 << 21) -> Iterator[np.ndarray]:
    """The shingle set of each text, not null, for so many bytes of texts at once."""
    held, total = [], 0
    for i, text in enumerate(texts):
        held.append(text.as_buffer().to_pybytes())
        total += len(held[-1])
        if total >= most or i == len(texts) - 1:
            yield from shingles_of(held, size)
            held, total = [], 0


def signatures(tokens: np.ndarray, t: Threshold) -> np.ndarray:
    """One value for each segment of the set, in each band it belongs to. tokens: sorted, distinct.

    Two linked sets have more than `spare` segments in common. Where a set has more empty ones than that, all common ones may be
    empty; then these sign too, but for the last `spare` of them: the first common one is among the rest, in either set.
    """
    out = []
    for number, segments, spare in t.bands(len(tokens)):
        segment = ((tokens >> _U(32)) * _U(segments)) >> _U(32)
        starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        sums = np.add.reduceat(mixed(tokens), starts)
        out.append(mixed(sums + segment[starts] * _B + np.array([number + 1], _U) * _C))
        if segments - len(starts) > spare:
            empty = np.setdiff1d(np.arange(segments, dtype=_U), segment[starts])[:-spare]
            out.append(mixed(_A + empty * _B + np.array([number + 1], _U) * _C))
    return np.concatenate(out) if out else np.empty(0, _U)


def key_of(tokens: np.ndarray) -> bytes | None:
    """A digest of the set; None for the empty one."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def signed(docs: DataFrame, id_col: str, text_col: str, size: int, t: Threshold) -> DataFrame:
    """(_id, hash, row, n, key, sigs, followed, more, firsts) of each row: hash is its text's, row its number, key a digest of its
    set, null for empty sets; the lists are those of `combined`, for each piece. Of rows that a task meets with one key only the first signs."""
    source = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    source = source.withColumn("hash", F.xxhash64("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, row = set(), TaskContext.get().partitionId() << 33
        for batch in batches:
            counts, keys, sigs, held, at = [], [], [], 0, 0
            for i, tokens in enumerate(texts_with_shingles(batch.column(1), size), 1):
                key = key_of(tokens)
                counts.append(len(tokens))
                keys.append(key)
                sigs.append(signatures(tokens, t) if key and key not in seen else np.empty(0, _U))
                held += len(sigs[-1])
                if key:
                    if len(seen) > TABLE:
                        seen.clear()
                    seen.add(key)
                if i - at == PIECE or held >= PIECE_SIGNATURES or i == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0)[at:i], batch.column(2)[at:i], pa.array(range(row, row + i - at), pa.int64()), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), *combined(sigs, row)], names=["_id", "hash", "row", "n", "key", "sigs", "followed", "more", "firsts"])
                    row += i - at
                    counts, keys, sigs, held, at = [], [], [], 0, i

    return source.mapInArrow(run, f"_id {source.schema['_id'].dataType.simpleString()}, hash long, row long, n long, key binary, sigs array<long>, followed array<boolean>, more array<long>, firsts array<long>")


def candidates(rows: DataFrame) -> DataFrame:
    """(row, leader) of each row that shares a signature with a row of a smaller number; the least one leads."""
    signs = rows.filter("size(sigs) > 0").select("row", "followed", F.posexplode("sigs").alias("i", "sig"))
    signs = signs.select("sig", (F.col("row") * 2 + F.get("followed", F.col("i")).cast("long")).alias("code"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = signs.repartition(tasks, "sig").sortWithinPartitions("sig")  # by one number: a radix sort

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def led_by_least(sig, code):
            row, followed = code >> 1, (code & 1).astype(bool)
            start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            low = np.repeat(np.minimum.reduceat(row, start), np.diff(np.append(start, len(sig))))
            pairs = np.unique(np.stack([row, low])[:, row != low], axis=1)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(pairs[0]), pa.int64()), pa.array(pairs[0]), pa.array(pairs[1])], names=["sig", "row", "leader"])
            if followed.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[followed]) for x in (sig, row, low)], names=["sig", "row", "leader"])

        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            held = [np.concatenate(x) for x in zip(held, now, strict=True)] if held else now
            if not len(held[0]):
                continue
            cut = int(np.searchsorted(held[0], held[0][-1]))  # the last run may go on in the next batch: a row for each piece at most
            if cut:
                yield from led_by_least(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if held and len(held[0]):
            yield from led_by_least(*held)

    led = materialize(dealt.mapInArrow(run, "sig long, row long, leader long"), "led")
    # the other rows of a piece, under the number of its first one, so that a signature's rows are spread as pieces are
    others = rows.filter("size(more) > 0").select("row", "firsts", F.posexplode("more").alias("i", "sig")).select("row", "sig", F.get("firsts", F.col("i")).alias("first"))
    heads = led.filter("sig IS NOT NULL").select("sig", F.col("row").alias("first"), "leader")
    far = others.join(heads, ["sig", "first"]).select("row", "leader")
    return led.filter("sig IS NULL").select("row", "leader").unionByName(far).distinct()


class Forest:
    """Components of numbered items; the smaller one takes the other's label."""

    def __init__(self, n: int):
        self.label, self.items = np.arange(n), {i: [i] for i in range(n)}

    def join(self, a: int, b: int) -> bool:
        a, b = int(self.label[a]), int(self.label[b])
        if a == b:
            return False
        if len(self.items[a]) < len(self.items[b]):
            a, b = b, a
        moved = self.items.pop(b)
        self.label[moved] = a
        self.items[a] += moved
        return True


def merge_skip(lists: list[list[int]], need: int) -> Iterator[tuple[int, int]]:
    """(item, in how many lists) of the items that occur in `need` of the sorted lists at least, by a heap of the lists' heads.
    Where the least item is in too few of them, need - 1 heads are taken off in all, and their lists skip to the least one left."""
    heap = [(one[0], k, 0) for k, one in enumerate(lists) if one]
    heapq.heapify(heap)
    while len(heap) >= need:
        item, popped = heap[0][0], []
        while heap and heap[0][0] == item:
            popped.append(heapq.heappop(heap))
        if len(popped) >= need:
            yield item, len(popped)
            least = item + 1
        else:
            while len(popped) < need - 1:
                popped.append(heapq.heappop(heap))
            least = heap[0][0]  # need - 1 lists at most hold anything before it
        for _, k, at in popped:
            at = bisect.bisect_left(lists[k], least, at)
            if at < len(lists[k]):
                heapq.heappush(heap, (lists[k][at], k, at))


def divide_skip(lists: list[np.ndarray], need: int) -> tuple[np.ndarray, np.ndarray]:
    """Items that occur in `need` of the sorted lists at least, and in how many."""
    none = np.empty(0, np.int64)
    if need > len(lists):
        return none, none
    lists = sorted(lists, key=len)
    longest = len(lists[-1])
    aside = min(need - 1, int(need / (MU * math.log2(max(longest, 2)) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    found = list(merge_skip([one.tolist() for one in short], need - aside))
    items, counts = (np.array([x[k] for x in found], np.int64) for k in (0, 1))
    left = aside
    for one in long:
        if not len(items):
            break
        at = np.searchsorted(one, items)
        counts = counts + (one[np.minimum(at, len(one) - 1)] == items) if len(one) else counts
        left -= 1
        keep = counts + left >= need
        items, counts = items[keep], counts[keep]
    return items, counts


def links_within(sets: list[np.ndarray], blocks: list[int], t: Threshold, across: bool) -> Iterator[tuple[int, int]]:
    """A forest of the links among sets (sorted, distinct tokens): pairs of positions, which join all that links join.
    across: only links between sets of different blocks count."""
    n = np.array([len(s) for s in sets])
    order = np.argsort(n, kind="stable")
    tokens = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(len(order)), n[order])
    by = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[by], owner[by]
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    ends = np.append(starts[1:], len(tokens))
    shared = ends - starts > 1  # shingles of one document link nothing
    tokens, starts, ends = tokens[starts[shared]], starts[shared], ends[shared]
    sizes, block = n[order], np.array(blocks)[order]
    forest, partner = Forest(len(order)), None
    for q in range(1, len(order)):
        size = int(sizes[q])
        low = int(np.searchsorted(sizes, t.smallest(size)))  # partners are low..q-1: not larger, and large enough
        if low >= q:
            continue
        need = t.overlap(size, int(sizes[low]))
        own = sets[order[q]]
        if partner is not None and partner >= low and not (across and block[partner] == block[q]):
            # members of one group follow one another; once linked, all of the group are out of the lists
            other = sets[order[partner]]
            common = int((other[np.minimum(np.searchsorted(other, own), len(other) - 1)] == own).sum())
            if t.linked(common, size, len(other)) and forest.join(q, partner):
                yield int(order[q]), int(order[partner])
        at = np.searchsorted(tokens, own)
        at = at[(at < len(tokens)) & (tokens[np.minimum(at, len(tokens) - 1)] == own)] if len(tokens) else at[:0]
        if len(at) < need:
            continue
        label = forest.label
        lists = []
        for a in at:
            one = owner[starts[a] : ends[a]]
            one = one[np.searchsorted(one, low) : np.searchsorted(one, q)]
            one = one[label[one] != label[q]]
            if across:
                one = one[block[one] != block[q]]
            if len(one):
                lists.append(one)
        items, counts = divide_skip(lists, need)
        for y, common in zip(items[::-1].tolist(), counts[::-1].tolist(), strict=True):
            if t.linked(common, size, int(sizes[y])) and forest.join(q, y):
                partner = y
                yield int(order[q]), int(order[y])


def links(members: DataFrame, size: int, t: Threshold) -> DataFrame:
    """Links (a, b) between classes. members(cluster, block, blocks, node, key, _text): one row or more for each node."""
    pairs = members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    pairs = pairs.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "key", "_text")
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(tasks, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(group, nodes, blocks, sets) -> pa.RecordBatch:
            found = [(nodes[a], nodes[b]) for a, b in links_within(sets, blocks, t, group[1] != group[2])] if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        group, nodes, blocks, sets = None, [], [], []
        for batch in batches:
            c, i, j, b, v, keys = (batch.column(k).to_pylist() for k in range(6))
            for row, tokens in enumerate(texts_with_shingles(batch.column(6), size)):
                key = (c[row], i[row], j[row])
                if key != group:
                    if group:
                        yield flush(group, nodes, blocks, sets)
                    group, nodes, blocks, sets = key, [], [], []
                # rows that only repeat the id of a member, and further rows of a class, are passed by
                if key_of(tokens) == keys[row] and (not nodes or nodes[-1] != v[row]):
                    nodes.append(v[row])
                    blocks.append(b[row])
                    sets.append(tokens)
        if group:
            yield flush(group, nodes, blocks, sets)

    return dealt.mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = 90, size: int = 3, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Per row of docs: id_col, n_shingles (size of its shingle set), component_id (the smallest id reachable by links).

    Words are runs of anything but ASCII white space, A-Z in lower case; a set has the distinct shingles of `size` words, or the
    whole sequence if there are fewer. Rows without words, null texts included, link with nothing; their component is their own
    id. Rows with equal sets are linked; repeated rows share a component. Null ids come last: a component has a null id only if
    all its rows have. An empty table gives an empty result; other columns are ignored. Texts of any length are taken whole: a
    task holds one set, and in the search the sets of two blocks of `block` shingles, or of two larger documents.
    Sets are compared by 64-bit shingle hashes.
    """
    t = Threshold(percent)
    signs = materialize(signed(docs, id_col, text_col, size, t), "signed")
    rows = materialize(signs.select("_id", "hash", "row", "n", "key", F.expr("size(sigs) > 0 OR size(more) > 0").alias("signer")), "rows")
    classes = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("row").alias("node"), F.min("_id").alias("least"), F.min_by("hash", F.struct(F.col("_id").isNull(), "_id", "row")).alias("hash"), F.first("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    classes = materialize(classes, "classes")
    # rows of one class that have signed in several tasks are one node
    signers = rows.filter("signer").select("key", F.col("row").alias("_row"))
    same = materialize(signers.join(classes.filter("rows > 1").select("key", "node"), "key").filter("_row <> node").select("_row", "node"), "signers")
    pairs = candidates(signs)
    for end in ("row", "leader"):
        pairs = pairs.join(same, F.col(end) == F.col("_row"), "left").withColumn(end, F.coalesce("node", end)).drop("_row", "node")
    pairs = materialize(pairs.filter("row <> leader").distinct(), "pairs")
    discard(signs)
    component = materialize(components(pairs.select(F.col("row").alias("a"), F.col("leader").alias("b"))), "component")
    star = pairs.unionByName(pairs.select(F.col("leader").alias("row"), "leader").distinct())
    stars = star.select(F.col("leader").alias("cluster"), F.col("row").alias("node")).join(classes, "node")
    wholes = component.withColumnRenamed("component", "cluster").join(classes, "node")
    blocks = F.ceil(F.col("total") / block).cast("int")
    sized = lambda df: df.groupBy("cluster").agg(F.sum("n").alias("total")).select("cluster", blocks.alias("blocks"), (F.col("total") * blocks).alias("cost"))
    star_sizes = sized(stars).join(component.withColumnRenamed("node", "cluster"), "cluster")
    whole_sizes = sized(wholes).join(star_sizes.groupBy(F.col("component").alias("cluster")).agg(F.sum("cost").alias("star_cost")), "cluster")
    plans = materialize(whole_sizes.select("cluster", "blocks", (F.col("cost") <= F.col("star_cost")).alias("whole")), "plans")
    apart = star_sizes.select("cluster", "blocks", "component").join(plans.filter("NOT whole").select(F.col("cluster").alias("component")), "component", "left_semi")
    member = stars.join(apart, "cluster").drop("component").unionByName(wholes.join(plans.filter("whole").drop("whole"), "cluster"))
    member = member.select("cluster", "node", "key", F.col("least").alias("_id"), "hash", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    member = materialize(member, "members")
    texts = docs.select(F.col(id_col).alias("_tid"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    # by id and text: an id that many rows have, or none, brings no other row's text. A merge join at every size: it can spill, and
    # the plan does not change as tables grow
    whole = texts.join(member.hint("merge"), (F.col("hash") == F.xxhash64("_text")) & F.col("_id").eqNullSafe(F.col("_tid"))).drop("_tid", "hash")
    found = components(links(whole, size, t))

    merged = classes.join(found.withColumnRenamed("component", "_c"), "node", "left").withColumn("_c", F.coalesce("_c", "node"))
    merged = materialize(merged.select("key", "_c", "least", "rows"), "merged")
    label = merged.groupBy("_c").agg(F.min("least").alias("component_id"))
    named = materialize(merged.join(label, "_c").select("key", "component_id", "rows"), "named")
    out = attach_groups(rows.select("_id", "row", "n", "key"), named, "key", "rows", F.col("row"))
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) END AS g FROM d),
n AS (SELECT doc_id, len(g) AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
u AS (SELECT x AS a, y AS b FROM l UNION SELECT y, x FROM l),
t(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT t.a, u.b FROM t JOIN u ON t.b = u.a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(t.b) AS component_id FROM n JOIN t ON t.a = n.doc_id GROUP BY n.doc_id, n.n
"""
