"""Substring dedup by collinear chaining: fuzzy passages that repeat across documents.

1. Seeds. Documents with the same words form a class, by a 128-bit digest, and the search runs between classes; a class goes by
   the number of its first row. A class's seeds are the minimizers of its k-word runs (the least hash of each WINDOW runs in
   turn), so any equal stretch of K + WINDOW - 1 words has one in common. A further occurrence of a run in one text counts as
   another seed, its number in the hash, and as the run's own too, so that it meets the leader's first occurrence where the
   leader has fewer.
2. Anchors. Of the rows that share a seed the first leads; each of the others is joined to it alone, so a passage in a thousand
   documents makes a thousand anchors a seed, not a million. Equal seeds are combined in each piece of rows before they are
   dealt, so one that very many rows share costs one entry a piece.
3. Chains. Neighbouring anchors on one diagonal merge into segments; the segments of each pair of classes are chained in order
   of both texts with a cost for the gaps (GAP for each word skipped in either), by a Fenwick tree of best prefixes.
4. Alignment. Words of both sides are fetched, gaps between segments aligned by edit distance, and the ends extended until the
   texts part; an end that comes to the last word fetched is taken again with WIDER times as many. A chain that agrees too
   little is split at its gaps. Pieces of one text that touch are joined, whoever they repeat; what has MIN_WORDS words is a
   passage.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import arrow_batches, attach_groups, combined, discard, materialize, mixed, word_hashes

K, WINDOW = 5, 4
#: Words of a passage, and the share of its words that must agree.
MIN_WORDS, IDENTITY = 50, 0.75
#: Cost of a skipped word. A segment is worth a third of its words, so one of K words bridges gaps of some 8 on either side.
GAP = 0.1
#: Words fetched around a chain at first, and by how much more where an extension uses them up.
MARGIN, WIDER = 24, 16
#: An extension may pass over LOOK words where AGAIN words after them agree.
LOOK, AGAIN = 5, 3
#: Pieces of one text that are this many words apart are joined: all that repeat one text, and those of LEAST words at least
#: whoever they repeat, so that no passage is made up of odd ends from here and there.
TOUCH, LEAST = 3, 16
#: Classes that a task keeps in mind.
TABLE = 150_000
#: Parts of a task's seeds that are put in order one by one, and seeds that are dealt out together.
PARTS, DEALT = 32, 1 << 20
#: Rows whose seeds are combined, or as many as have so many seeds; stretches fetched from a text at once.
PIECE, PIECE_SEEDS, AT_ONCE = 1000, 1 << 19, 500

_U = np.uint64
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def words_of(text: bytes) -> np.ndarray:
    """64-bit hashes of a text's words: runs of anything but ASCII white space, A-Z in lower case."""
    return word_hashes([text])[0]


def spans_of(text: bytes) -> np.ndarray:
    """(start, end) of each word, in bytes."""
    data = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    edges = np.diff(inside)
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], 1)


def key_of(words: np.ndarray) -> bytes:
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def seeds_of(words: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(seed hashes, word positions) of the minimizers. Further occurrences of a run have a seed with their number, to meet those of
    the same number, and one without, to meet the first; of occurrences that overlap only one has the latter."""
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, _U), np.empty(0, np.int32)
    runs = np.zeros(n, _U)
    for i in range(k):
        runs = runs * _A + words[i : n + i]
    runs = mixed(runs)
    width = min(window, n)
    m = n - width + 1
    least, at = runs[:m].copy(), np.arange(m)
    for i in range(1, width):
        less = runs[i : i + m] < least
        least[less], at[less] = runs[i : i + m][less], np.flatnonzero(less) + i
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]  # the first least place never goes back
    seeds = runs[at]
    order = np.argsort(seeds, kind="stable")
    same = np.concatenate([[False], seeds[order][1:] == seeds[order][:-1]])
    if same.any():
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
        number = np.empty(len(at), _U)
        number[order] = (np.arange(len(at)) - first).astype(_U)
        numbered = np.where(number > 0, mixed(seeds + number * _B), seeds)
        last, more = {}, []
        for i in np.flatnonzero(np.isin(seeds, seeds[number > 0])):
            if number[i] == 0:
                last[seeds[i]] = at[i]
            elif at[i] - last[seeds[i]] >= k:
                last[seeds[i]] = at[i]
                more.append(i)
        seeds, at = np.concatenate([numbered, seeds[more]]), np.concatenate([at, at[more]])
    return seeds, at.astype(np.int32)


def texts_with_words(texts: pa.Array, size: int = 1 << 21) -> Iterator[tuple[bytes, np.ndarray]]:
    """Each text, not null, with its words, hashed for so many bytes of texts at once."""
    held, total = [], 0
    for i, text in enumerate(texts):
        held.append(text.as_buffer().to_pybytes())
        total += len(held[-1])
        if total >= size or i == len(texts) - 1:
            words, at = word_hashes(held)
            yield from ((data, words[at[k] : at[k + 1]]) for k, data in enumerate(held))
            held, total = [], 0


def _packed(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """Stretches of a numpy array as binary cells."""
    ends = np.asarray(offsets, np.int64) * values.itemsize
    cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])
    return cells.cast(pa.binary())


def _unpacked(cells: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values): the way back from _packed."""
    ends = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset : cells.offset + len(cells) + 1]
    data = cells.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and ends[-1] > ends[0] else np.empty(0, np.uint8)
    return (ends - ends[0]) // np.dtype(kind).itemsize, np.frombuffer(flat.tobytes(), kind)


def seeded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, hash, row, key, n, chars, carries, seeds, followed, places, more, firsts, more_places) of each row: hash is its text's,
    row its number, key that of its class, n its words; the rest are the lists of `combined`, for each piece, the first three of them packed, and
    whether there are any. Of rows that a task meets with one key only the first carries seeds."""
    source = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    source = source.withColumn("hash", F.xxhash64("_text"))
    names = ["_id", "hash", "row", "key", "n", "chars", "carries", "seeds", "followed", "places", "more", "firsts", "more_places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, row = set(), TaskContext.get().partitionId() << 33
        for batch in batches:
            keys, counts, chars, seeds, places, held, at = [], [], [], [], [], 0, 0
            for i, (data, words) in enumerate(texts_with_words(batch.column(1)), 1):
                key = key_of(words)
                s, p = seeds_of(words) if key not in seen else (np.empty(0, _U), np.empty(0, np.int32))
                if len(seen) > TABLE:
                    seen.clear()
                seen.add(key)
                for one, value in ((keys, key), (counts, len(words)), (chars, len(data.decode())), (seeds, s), (places, p)):
                    one.append(value)
                held += len(s)
                if i - at == PIECE or held >= PIECE_SEEDS or i == batch.num_rows:
                    own = [pa.array(range(row, row + i - at), pa.int64()), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(chars, pa.int64()), pa.array([len(x) > 0 for x in seeds])]
                    lists = combined(seeds, row, places)
                    packed = [_packed(x.offsets.to_numpy(), x.values.to_numpy(zero_copy_only=False)) for x in lists[:3]]
                    yield pa.RecordBatch.from_arrays([batch.column(0)[at:i], batch.column(2)[at:i], *own, *packed, *lists[3:]], names=names)
                    row += i - at
                    keys, counts, chars, seeds, places, held, at = [], [], [], [], [], 0, i

    return source.mapInArrow(run, f"_id {source.schema['_id'].dataType.simpleString()}, hash long, row long, key binary, n long, chars long, carries boolean, seeds binary, followed binary, places binary, more array<long>, firsts array<long>, more_places array<int>")


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """(part, seeds, codes, places): the seeds of `seeded` rows, packed for each part and so many rows as have DEALT seeds. A code is
    twice the row's number, and one more where the seed comes again later in its piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out() -> pa.RecordBatch:
            seed, code, place = (np.concatenate(x) for x in zip(*held, strict=True))
            part = (seed.view(_U) >> _U(32)) % _U(parts)
            order = np.argsort(part.astype(np.uint16 if parts <= 1 << 16 else np.uint32), kind="stable")
            part = part[order].astype(np.int32)
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            offsets = np.append(first, len(part))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(part[first]), *(_packed(offsets, x[order]) for x in (seed, code, place))], names=["part", "seeds", "codes", "places"])

        for batch in batches:
            offsets, seed = _unpacked(batch.column(1), np.int64)
            row = np.repeat(batch.column(0).to_numpy(), np.diff(offsets))
            if len(seed):
                held.append((seed, row * 2 + _unpacked(batch.column(2), np.uint8)[1], _unpacked(batch.column(3), np.int32)[1]))
            if sum(len(x[0]) for x in held) >= DEALT:
                yield out()
        if held:
            yield out()

    return rows.select("row", "seeds", "followed", "places").mapInArrow(run, "part int, seeds binary, codes binary, places binary")


def anchors_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(anchors, the table behind them): anchors(node, lead, a, b) of each seed that a row shares with a first row, the lead, at
    words a and b.

    Seeds travel packed, many of one part in a cell: the JVM sorts cells by their part, and a task puts the seeds of one part in
    order at a time. A seed that very many rows have is there once for each piece of rows.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(rows, tasks * PARTS).repartition(tasks, "part").sortWithinPartitions("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def anchored(seed, code, a):
            order = np.argsort(seed, kind="stable")
            seed, code, a = seed[order], code[order], a[order]
            row, followed = code >> 1, (code & 1).astype(bool)
            start = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
            length = np.diff(np.append(start, len(seed)))
            lead = np.repeat(np.minimum.reduceat(row, start), length)
            b = np.repeat(a[row == lead], length)  # a seed comes once from each row
            for mask, names in ((row != lead, None), (followed, seed)):
                if mask.any():
                    yield pa.RecordBatch.from_arrays([pa.nulls(int(mask.sum()), pa.int64()) if names is None else pa.array(names[mask]), *(pa.array(x[mask]) for x in (row, lead, a, b))], names=["seed", "node", "lead", "a", "b"])

        part, held = None, []
        for batch in batches:
            parts = batch.column(0).to_numpy()
            columns = [_unpacked(batch.column(k), kind) for k, kind in ((1, np.int64), (2, np.int64), (3, np.int32))]
            first = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else []
            for i, j in zip(first, [*first[1:], len(parts)], strict=True):
                if held and parts[i] != part:
                    yield from anchored(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held = []
                part = parts[i]
                held.append([values[offsets[i] : offsets[j]] for offsets, values in columns])
        if held:
            yield from anchored(*(np.concatenate(x) for x in zip(*held, strict=True)))

    with arrow_batches(spark, 500):
        led = materialize(dealt.mapInArrow(run, "seed long, node long, lead long, a int, b int"), "led")
    others = rows.filter("size(more) > 0").select(F.col("row").alias("node"), "firsts", "more_places", F.posexplode("more").alias("i", "seed"))
    others = others.select("node", "seed", F.get("firsts", F.col("i")).alias("first"), F.get("more_places", F.col("i")).alias("a"))
    heads = led.filter("seed IS NOT NULL").select("seed", F.col("node").alias("first"), "lead", "b")
    rest = others.join(heads, ["seed", "first"]).filter("node <> lead")
    both = led.filter("seed IS NULL").select("node", "lead", "a", "b").unionByName(rest.select("node", "lead", "a", "b"))
    return both.select("node", "lead", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), led


def segments_of(a: np.ndarray, b: np.ndarray, k: int = K) -> list[tuple[int, int, int]]:
    """Anchors (a[i], b[i]), each k words, as segments (start in a, start in b, words): those of one diagonal that overlap or
    touch become one."""
    order = np.lexsort((a, a - b))
    a, b = a[order], b[order]
    new = np.concatenate([[True], (np.diff(a - b) != 0) | (np.diff(a) > k)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a)) - 1
    return [(int(x), int(y), int(z)) for x, y, z in zip(a[first], b[first], a[last] - a[first] + k, strict=True)]


class Fenwick:
    """Best value of a prefix, with the item that has it."""

    def __init__(self, n: int):
        self.best = [(float("-inf"), -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def upto(self, i: int) -> tuple[float, int]:
        """Over items 0 .. i - 1."""
        out = (float("-inf"), -1)
        while i > 0:
            if self.best[i] > out:
                out = self.best[i]
            i -= i & -i
        return out


def chains_of(segments: list[tuple[int, int, int]], gap: float = GAP) -> list[list[tuple[int, int, int]]]:
    """Disjoint chains, best first: each next segment starts after the one before ends, in both texts.

    A chain's worth is that of its segments less gap times the words skipped in either text. Ends enter the tree, by their
    place in a, as soon as the sweep over b passes them; with the cost of a gap split into a part of either end, the best
    predecessor is a prefix maximum.
    """
    if len(segments) == 1:
        return [segments]
    segments = sorted(segments, key=lambda s: (s[1], s[0]))
    ends = sorted({s[0] + s[2] for s in segments})
    rank = {e: i for i, e in enumerate(ends)}
    tree, worth, before = Fenwick(len(ends)), [], []
    waiting = sorted(range(len(segments)), key=lambda i: segments[i][1] + segments[i][2])
    ready = 0
    for i, (a, b, n) in enumerate(segments):
        # a segment that ends in b before this one starts has been valued: it starts before too
        while ready < len(waiting) and segments[waiting[ready]][1] + segments[waiting[ready]][2] <= b:
            j = waiting[ready]
            x, y, m = segments[j]
            tree.put(rank[x + m], (worth[j] + gap * (x + m + y + m), j))
            ready += 1
        value, j = tree.upto(bisect.bisect_right(ends, a))
        value -= gap * (a + b)
        own = n / 3
        worth.append(own + max(0.0, value))
        before.append(j if value > 0 else -1)
    used, out = [False] * len(segments), []
    for i in sorted(range(len(segments)), key=lambda i: -worth[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(segments[i])
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def edit_matches(a: np.ndarray, b: np.ndarray) -> int:
    """Words that agree in an alignment of a and b of least edit distance, the most of all such; equal ends are taken off first.

    An edit costs 1 and a replaced word a little more, so that of alignments of least distance one with most agreeing words is
    cheapest. Rows of the table are computed at once, within a band about the diagonal; a result that fits into its band is
    the least one of all, else the band is doubled.
    """
    n = min(len(a), len(b))
    if not n:
        return 0
    same = a[:n] == b[:n]
    head = n if same.all() else int(same.argmin())
    n -= head
    tail = 0
    if n:
        same = (a[len(a) - n :] == b[len(b) - n :])[::-1]
        tail = n if same.all() else int(same.argmin())
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    if len(a) > len(b):
        a, b = b, a
    edit = 2 * (len(a) + 1)  # more than all replacements' extra costs
    far, band = edit * (len(a) + len(b) + 1), max(8, 2 * (len(b) - len(a)))
    while True:
        low, row = 0, np.arange(min(len(b), band) + 1, dtype=np.int64) * edit  # costs of b[:low + k] against a[:i]
        for i in range(1, len(a) + 1):
            start, end = max(0, i - band), min(len(b), i + band)
            up = np.full(end - start + 1, far)  # from the row before: a word of a left out, or a pair
            kept = row[start - low :]
            up[: len(kept)] = kept[: len(up)] + edit
            pair = row[max(0, start - 1 - low) :]
            to = 1 if start - 1 < low else 0
            pair = pair[: len(up) - to]
            words = b[start + to - 1 : start + to - 1 + len(pair)]
            np.minimum(up[to : to + len(pair)], pair + np.where(words == a[i - 1], 0, edit + 1), out=up[to : to + len(pair)])
            steps = np.arange(len(up), dtype=np.int64) * edit
            row, low = np.minimum.accumulate(up - steps) + steps, start
        cost = int(row[len(b) - low]) if len(b) - low < len(row) else far
        if cost // edit <= band or band >= len(b):
            break
        band *= 2
    distance, replaced = divmod(cost, edit)
    return head + tail + (len(a) + len(b) - distance - replaced) // 2


#: Words passed over in either text, nearest first.
_STEPS = [s for away in range(1, 2 * LOOK + 1) for s in sorted(((x, away - x) for x in range(max(0, away - LOOK), min(away, LOOK) + 1)), key=lambda s: abs(s[0] - s[1]))]


def extension(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(words of a, words of b, agreeing ones) by which equal starts of a and b go on. Where they part, the nearest place
    within LOOK words of each from which AGAIN words are equal takes up the thread; if there is none, they have ended."""
    i = j = agree = 0
    while True:
        n = min(len(a) - i, len(b) - j)
        same = a[i : i + n] == b[j : j + n]
        run = n if same.all() else int(same.argmin())
        i, j, agree = i + run, j + run, agree + run
        x, y = a[i : i + LOOK + AGAIN].tolist(), b[j : j + LOOK + AGAIN].tolist()
        found = next(((u, v) for u, v in _STEPS if u + AGAIN <= len(x) and v + AGAIN <= len(y) and x[u] == y[v] and x[u : u + AGAIN] == y[v : v + AGAIN]), None)
        if not found:
            return i, j, agree
        i, j = i + found[0], j + found[1]


def aligned(chain: list[tuple[int, int, int]], a: np.ndarray, b: np.ndarray, more: tuple[bool, bool, bool, bool] = (False,) * 4) -> list[tuple[int, int, int, int, int]] | None:
    """(start, end in a, start, end in b, agreeing words) of a chain, whose places count from the starts of a and b; None if
    an extension comes to an end where more words are to be had: before a, before b, after a, after b.

    Where too few words agree the chain is split at the gap with the most words that do not, and each part is aligned again, so
    that what a gap bridges does not take the passages beside it along. Ends are extended up to the neighbouring parts, unless
    the extension itself agrees too little.
    """
    inner = [(edit_matches(a[p[0] + p[2] : q[0]], b[p[1] + p[2] : q[1]]), max(q[0] - p[0] - p[2], q[1] - p[1] - p[2])) for p, q in zip(chain, chain[1:])]
    odd = np.array([words - same for same, words in inner], np.int64)
    own = np.cumsum([0] + [int((a[x : x + n] == b[y : y + n]).sum()) for x, y, n in chain])
    within = np.cumsum([0] + [same for same, _ in inner])
    parts, out, ahead_of = [(0, len(chain))], [], LOOK + AGAIN
    while parts:
        low, high = parts.pop()
        start, other, _ = chain[low]
        i, j = chain[high - 1][0] + chain[high - 1][2], chain[high - 1][1] + chain[high - 1][2]
        agree = int(own[high] - own[low] + within[high - 1] - within[low])
        left = (chain[low - 1][0] + chain[low - 1][2], chain[low - 1][1] + chain[low - 1][2]) if low else (0, 0)
        right = chain[high][:2] if high < len(chain) else (len(a), len(b))
        after = extension(a[i : right[0]], b[j : right[1]])
        ahead = extension(a[left[0] : start][::-1], b[left[1] : other][::-1])
        if not low and (more[0] and start - ahead[0] < ahead_of or more[1] and other - ahead[1] < ahead_of):
            return None
        if high == len(chain) and (more[2] and i + after[0] + ahead_of > len(a) or more[3] and j + after[1] + ahead_of > len(b)):
            return None
        none = (0, 0, 0)
        tries = [(start - h[0], i + t[0], other - h[1], j + t[1], agree + h[2] + t[2]) for h, t in ((ahead, after), (none, after), (ahead, none), (none, none))]
        found = next((x for x in tries if x[4] >= IDENTITY * max(x[1] - x[0], x[3] - x[2])), None)
        if found:
            out.append(found)
        elif high - low > 1:
            cut = low + 1 + int(odd[low : high - 1].argmax())
            parts += [(cut, high), (low, cut)]
    return out


def chained(anchors: DataFrame) -> DataFrame:
    """(node, lead, segments) of each chain; anchors(node, lead, a, b)."""
    tasks = int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by one number, which a radix sort can do; pairs that share it are told apart below
    dealt = anchors.withColumn("pair", F.xxhash64("node", "lead")).repartition(tasks, "pair").sortWithinPartitions("pair")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def flush(node, lead, a, b, pair, final):
            """Chains of all pairs, but of the last ones of one number, which may go on, unless final; and their anchors."""
            rest = len(node) if final else int(np.searchsorted(pair, pair[-1]))
            later = [x[rest:] for x in (node, lead, a, b, pair)]
            order = np.lexsort((lead[:rest], node[:rest], pair[:rest]))
            node, lead, a, b = (x[:rest][order] for x in (node, lead, a, b))
            first = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (lead[1:] != lead[:-1])])) if rest else np.empty(0, int)
            last = np.append(first[1:], rest)
            found = lambda s, e: chains_of(segments_of(*np.unique(np.stack([a[s:e], b[s:e]]), axis=1)))
            several = [(int(node[s]), int(lead[s]), [x for seg in chain for x in seg]) for s, e in zip(first, last, strict=False) if e - s > 1 for chain in found(s, e)]
            one = first[last[: len(first)] - first == 1]  # a single anchor is a chain
            flat = np.concatenate([np.stack([a[one], b[one], np.full(len(one), K)], 1).ravel(), np.array([x for r in several for x in r[2]], np.int64)]).astype(np.int32)
            offsets = np.cumsum([0, *[3] * len(one), *(len(r[2]) for r in several)])
            batch = pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[one], np.array([r[k] for r in several], np.int64)])) for k, x in enumerate((node, lead))] + [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))], names=["node", "lead", "segments"])
            return batch, later

        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            held = [np.concatenate(x) for x in zip(held, now, strict=True)] if held else now
            if len(held[0]):
                out, held = flush(*held, False)
                yield out
        if held and len(held[0]):
            yield flush(*held, True)[0]

    return dealt.mapInArrow(run, "node long, lead long, segments array<int>")


def _rows(batch: pa.RecordBatch, at_once: int = 50) -> Iterator[tuple]:
    """A batch's rows as Python values, a few at a time: rows may hold the words of long passages."""
    for start in range(0, batch.num_rows, at_once):
        yield from zip(*(c.to_pylist() for c in batch.slice(start, at_once).columns), strict=True)


def _by_text(wants: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, hint: str | None) -> DataFrame:
    """(key, wants, _text): each text once for each AT_ONCE of the stretches that wants(node, want) asks of it, about, so that one
    that very many ask of is spread over tasks."""
    often = materialize(wants.groupBy("node").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > AT_ONCE), "often")  # few: the planner sees how few
    dealt = wants.join(often, "node", "left").withColumn("part", F.when(F.col("c").isNotNull(), F.pmod(F.xxhash64("want.chain"), F.ceil(F.col("c") / AT_ONCE))).otherwise(0))
    lists = dealt.groupBy("node", "part").agg(F.collect_list("want").alias("wants"))
    named = lists.join(classes.select("node", "key", "hash", F.col("least").alias("_id")), "node").select("_id", "hash", "key", "wants")
    texts = docs.select(F.col(id_col).alias("_tid"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    # by id and text: an id that many rows have, or none, brings no other row's text
    same = (F.col("hash") == F.xxhash64("_text")) & F.col("_id").eqNullSafe(F.col("_tid"))
    return texts.join(named.hint(hint) if hint else named, same).select("key", "wants", "_text")


def _texts_of(batch: pa.RecordBatch, places: bool = False) -> Iterator[tuple]:
    """(words, what is wanted of them) of the rows that are of the class wanted, and do not only repeat an id; with places, the
    text instead of its words."""
    for i, (data, words) in enumerate(texts_with_words(batch.column(2))):
        if key_of(words) == batch.column(0)[i].as_py():
            yield data if places else words, batch.column(1)[i].values


def _joined_batches(run, rows: int = 5000, size: int = 4 << 20):
    """run, with its batches put together up to so many rows or bytes: a text gives a few rows each time."""

    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, nbytes = [], 0, 0
        for batch in run(batches):
            held.append(batch)
            n, nbytes = n + batch.num_rows, nbytes + batch.nbytes
            if n >= rows or nbytes >= size:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n, nbytes = [], 0, 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return wide


def _pieces(chains: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, margin: int, hint: str | None) -> DataFrame:
    """Aligned pieces (chain, node, lead, from, to, lead_from, lead_to, agree) of chains(chain, node, lead, segments), with margin
    words on either side; those that need more have null places."""
    size = "size(segments)"
    sides = [
        chains.select(F.col(who).alias("node"), F.struct("chain", F.lit(k).alias("side"), F.col(who).alias("node"), (F.col("segments")[k] - margin).alias("low"), F.expr(f"segments[{size} - 3 + {k}] + segments[{size} - 1] + {margin}").alias("high"), (F.col("segments") if k == 0 else F.lit(None).cast("array<int>")).alias("segments")).alias("want"))
        for k, who in enumerate(("node", "lead"))
    ]
    names = ["chain", "side", "node", "low", "left", "segments", "words"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, wants in _texts_of(batch):
                words = words.astype("<u4")
                chain, side, node, low, high, segments = wants.flatten()
                low, high = np.maximum(low.to_numpy(), 0), np.minimum(high.to_numpy(), len(words))
                for at in range(0, len(low), step := max(1, (1 << 19) // max(1, int((high - low).max())))):
                    x, y = low[at : at + step], high[at : at + step]
                    ends = np.cumsum(y - x)
                    flat = words[np.arange(ends[-1]) + np.repeat(x - ends + y - x, y - x)]
                    cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(np.append(0, ends * 4)), pa.py_buffer(flat)])
                    yield pa.RecordBatch.from_arrays([*(c[at : at + step] for c in (chain, side, node)), pa.array(x), pa.array((len(words) - y).astype(np.int32)), segments[at : at + step], cells.cast(pa.binary())], names=names)

    found = _by_text(sides[0].unionByName(sides[1]), classes, docs, id_col, text_col, hint)
    slices = found.mapInArrow(_joined_batches(cut), "chain long, side int, node long, low int, left int, segments array<int>, words binary")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = slices.repartition(tasks, "chain").sortWithinPartitions("chain")
    names = ["chain", "node", "lead", "from", "to", "lead_from", "lead_to", "agree"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            if not table.num_rows:
                continue
            whole = table.to_batches()[0]
            # a chain's rows may go on in the next batch
            cut = int(np.searchsorted(whole.column(0).to_numpy(), whole.column(0)[-1].as_py()))
            held = whole.slice(cut)
            if cut:
                yield _aligned_rows(whole.slice(0, cut), names)
        if held is not None:
            yield _aligned_rows(held, names)

    return dealt.mapInArrow(align, ", ".join(f"`{n}` long" for n in names))


def _ends(a: np.ndarray, at: np.ndarray, a_end: np.ndarray, b: np.ndarray, to: np.ndarray, b_end: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Of many pairs of stretches: the equal words from at and to on, and whether that is all that `extension` would find, with
    all the words that it would look at at hand. step: 1 forwards, -1 backwards; the ends are the first places not to be had."""
    n, look = len(at), LOOK + AGAIN
    width = MARGIN - look
    steps = np.arange(width + look) * step
    x, y = at[:, None] + steps, to[:, None] + steps
    there_a, there_b = (x - a_end[:, None]) * step < 0, (y - b_end[:, None]) * step < 0
    words_a = np.where(there_a, a[np.clip(x, 0, len(a) - 1)].astype(np.int64), -1)
    words_b = np.where(there_b, b[np.clip(y, 0, len(b) - 1)].astype(np.int64), -2)
    same = words_a == words_b
    run = np.where(same.all(1), same.shape[1], same.argmin(1))
    plain = run <= width
    rows, after = np.arange(n)[:, None], np.minimum(run, width)[:, None] + np.arange(look)
    words_a, words_b = words_a[rows, after], words_b[rows, after]
    for u, v in _STEPS:
        plain &= ~(words_a[:, u : u + AGAIN] == words_b[:, v : v + AGAIN]).all(1)
    return run, plain


def _aligned_rows(batch: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    """The pieces of the chains whose slices the batch has, sorted by chain; see _pieces. Chains of one segment whose ends part
    at once, most of all, are done together."""
    chain, side = (batch.column(k).to_numpy() for k in (0, 1))
    order = np.lexsort((side, chain))
    chain, side = chain[order], side[order]
    # rows that repeat id and text answer twice: the first of each side
    first = np.concatenate([[True], (chain[1:] != chain[:-1]) | (side[1:] != side[:-1])])[: len(chain)]
    order, chain, side = order[first], chain[first], side[first]
    pair = np.flatnonzero((chain[:-1] == chain[1:]) & (side[:-1] == 0) & (side[1:] == 1)) if len(chain) else np.empty(0, int)
    mine, other = order[pair], order[pair + 1]
    node, low, left = (batch.column(k).to_numpy() for k in (2, 3, 4))
    data = batch.column(6)
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1] // 4
    words = np.frombuffer(data.buffers()[2], "<u4") if offsets[-1] else np.empty(0, "<u4")
    lists = batch.column(5)
    starts = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    single = starts[mine + 1] - starts[mine] == 3
    out: list[tuple] = []
    done = np.zeros(len(mine), bool)
    quick = np.flatnonzero(single)
    if len(quick):
        i, j = mine[quick], other[quick]
        at, to, n = (flat[starts[i] + k] for k in range(3))
        at, to = offsets[i] + at - low[i], offsets[j] + to - low[j]
        after, plain = _ends(words, at + n, offsets[i + 1], words, to + n, offsets[j + 1], 1)
        ahead, plain_too = _ends(words, at - 1, offsets[i] - 1, words, to - 1, offsets[j] - 1, -1)
        look = LOOK + AGAIN
        # where words that would be looked at were not fetched, more are needed
        short = ((left[i] > 0) & (at + n + after + look > offsets[i + 1])) | ((left[j] > 0) & (to + n + after + look > offsets[j + 1]))
        short |= ((low[i] > 0) & (at - ahead - offsets[i] < look)) | ((low[j] > 0) & (to - ahead - offsets[j] < look))
        plain &= plain_too & ~short
        k = np.flatnonzero(plain)
        done[quick[k]] = True
        i, j, at, to, n, after, ahead = (x[k] for x in (i, j, at, to, n, after, ahead))
        place, place_too = at - offsets[i] + low[i], to - offsets[j] + low[j]
        columns = [chain[pair[quick[k]]], node[i], node[j], place - ahead, place + n + after, place_too - ahead, place_too + n + after, n + after + ahead]
    else:
        columns = [np.empty(0, np.int64)] * len(names)
    for q in np.flatnonzero(~done):
        i, j = int(mine[q]), int(other[q])
        own = flat[starts[i] : starts[i + 1]].tolist()
        x, y = int(low[i]), int(low[j])
        segments = [(own[k] - x, own[k + 1] - y, own[k + 2]) for k in range(0, len(own), 3)]
        pieces = aligned(segments, words[offsets[i] : offsets[i + 1]], words[offsets[j] : offsets[j + 1]], (x > 0, y > 0, bool(left[i] > 0), bool(left[j] > 0)))
        head = (int(chain[pair[q]]), int(node[i]), int(node[j]))
        out += [(*head, None, None, None, None, None)] if pieces is None else [(*head, x + p[0], x + p[1], y + p[2], y + p[3], p[4]) for p in pieces]
    arrays = [pa.concat_arrays([pa.array(c.astype(np.int64)), pa.array([r[k] for r in out], pa.int64())]) for k, c in enumerate(columns)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _places(passages: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(passage, side, start, end) in code points of both sides of passages(passage, node, from, to, lead, lead_from, lead_to)."""
    sides = [passages.select(F.col(who).alias("node"), F.struct(F.col("passage").alias("chain"), F.lit(k).alias("side"), F.col(low).alias("low"), F.col(high).alias("high")).alias("want")) for k, (who, low, high) in enumerate((("node", "from", "to"), ("lead", "lead_from", "lead_to")))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, wants in _texts_of(batch, places=True):
                spans = spans_of(data)
                if not data.isascii():  # bytes to code points
                    points = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
                    spans = np.stack([points[spans[:, 0]] - 1, points[spans[:, 1] - 1]], 1)
                out += [(w["chain"], w["side"], int(spans[w["low"], 0]), int(spans[w["high"] - 1, 1])) for w in wants.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], names=["passage", "side", "start", "end"])

    found = _by_text(sides[0].unionByName(sides[1]), classes, docs, id_col, text_col, None)
    # rows that repeat id and text answer alike
    return found.mapInArrow(run, "passage long, side long, start long, end long").distinct()


def _joined(pieces: DataFrame, min_words: int) -> DataFrame:
    """Pieces of each class that overlap or touch, as one, from min_words on, with the longest piece's source: first those with
    one lead, then what of these has LEAST words, whatever its lead."""
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.select("node", "from", "to", "lead", "lead_from", "lead_to", "agree").repartition(tasks, "node")
    names = ["node", "from", "to", "lead", "lead_from", "lead_to", "agree", "piece_words"]

    def run_with(same: tuple[int, ...], least: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = best = None
            upto = -1
            for batch in batches:
                out = []
                for p in _rows(batch, 1000):
                    if first and (any(p[k] != first[k] for k in same) or p[1] > upto + TOUCH):
                        out.append((*first[:2], upto, *best[3:]))
                        first = None
                    if first is None:
                        first, best, upto = p, p, p[2]
                    else:
                        upto = max(upto, p[2])
                        best = p if p[7] > best[7] else best
                out = [r for r in out if r[2] - r[1] >= least]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(len(names))], names=names)
            if first and upto - first[1] >= least:
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (*first[:2], upto, *best[3:])], names=names)

        return run

    kinds = ", ".join(f"`{n}` long" for n in names)
    one = dealt.withColumn("piece_words", F.col("to") - F.col("from")).sortWithinPartitions("node", "lead", "from", "to", "lead_from").mapInArrow(run_with((0, 3), min(LEAST, min_words)), kinds)
    # the rows of a class stay in its partition
    return one.sortWithinPartitions("node", "from", "to", "lead", "lead_from").mapInArrow(run_with((0,), min_words), kinds)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each passage of a document that repeats another's: id_col, start, end (code points), n_words, source_id,
    source_start, source_end (code points), identity (share of words that agree), group_size.

    Of all that hold a passage one is its source and is not listed for it; removing what is listed leaves each passage in its
    source only. Each copy within the other documents is listed; what the source itself holds several times stays there.
    Documents with the same words, A-Z in either case and white space aside, are one class: the smallest id stands for it, and
    each of the others is a single passage, whole, of min_words words at least; group_size is the class's rows. Null texts and
    those of fewer words have no passage. Null ids come last; rows that
    repeat the smallest id of a class all stand for it. An empty table gives an
    empty result; other columns are ignored. Texts of any length are taken whole: a task holds one text and the stretches asked of
    it, then one pair of stretches.
    """
    spark = docs.sparkSession
    with arrow_batches(spark, 500):
        seeds = materialize(seeded(docs, id_col, text_col), "seeded")
    rows = materialize(seeds.select("_id", "hash", "row", "key", "n", "chars", "carries"), "rows")
    first = F.struct(F.col("_id").isNull(), "_id", "row")
    classes = rows.groupBy("key").agg(F.min("row").alias("node"), F.min("_id").alias("least"), F.min_by("hash", first).alias("hash"), F.first("n").alias("n"), F.min_by("chars", first).alias("least_chars"), F.count(F.lit(1)).alias("rows"))
    classes = materialize(classes, "classes")
    # rows of one class that carry seeds in several tasks are one node
    same = materialize(rows.filter("carries").select("key", F.col("row").alias("_row")).join(classes.filter("rows > 1").select("key", F.col("node").alias("_node")), "key").filter("_row <> _node").select("_row", "_node"), "carriers")
    anchors, led = anchors_of(seeds)
    chains = materialize(chained(anchors), "chains")
    discard(seeds)
    discard(led)
    for end in ("node", "lead"):
        chains = chains.join(same, F.col(end) == F.col("_row"), "left").withColumn(end, F.coalesce("_node", end)).drop("_row", "_node")
    chains = materialize(chains.filter("node <> lead").distinct().withColumn("chain", F.monotonically_increasing_id()), "chains")

    found, margin, hint = None, MARGIN, "merge"  # the first time words of very many texts are fetched: by a join that can spill
    while True:
        with arrow_batches(spark, 500):
            pieces = materialize(_pieces(chains, classes, docs, id_col, text_col, margin, hint), "pieces")
        done = pieces.filter("agree IS NOT NULL")
        found = done if found is None else found.unionByName(done)
        longer = pieces.filter("agree IS NULL").select("chain").distinct()
        if longer.isEmpty():
            break
        chains = materialize(chains.join(longer, "chain", "left_semi"), "longer")
        margin, hint = margin * WIDER, None
    passages = materialize(_joined(found, min_words).withColumn("passage", F.monotonically_increasing_id()), "passages")
    with arrow_batches(spark, 500):
        places = materialize(_places(passages, classes, docs, id_col, text_col), "places")

    at = [places.filter(F.col("side") == k).select("passage", F.col("start").alias(f"{who}start"), F.col("end").alias(f"{who}end")) for k, who in enumerate(("", "source_"))]
    source = classes.select(F.col("node").alias("lead"), F.col("least").alias("source_id"))
    own = passages.join(at[0], "passage").join(at[1], "passage").join(source, "lead").join(classes.select("node", "least", "rows"), "node").select(
        F.col("least").alias("_id"), "start", "end", (F.col("to") - F.col("from")).alias("n_words"), "source_id", "source_start", "source_end", F.round(F.col("agree") / F.greatest("piece_words", "agree"), 4).alias("identity"), F.col("rows").alias("group_size")
    )
    several = classes.filter(f"rows > 1 AND n >= {min_words}")
    member = attach_groups(rows.select("_id", "row", "key", "n", "chars"), materialize(several.drop("n"), "several"), "key", "rows", F.col("row"), "inner")
    copies = member.filter(~F.col("_id").eqNullSafe(F.col("least"))).select("_id", F.lit(0).cast("long").alias("start"), F.col("chars").alias("end"), F.col("n").alias("n_words"), F.col("least").alias("source_id"), F.lit(0).cast("long").alias("source_start"), F.col("least_chars").alias("source_end"), F.lit(1.0).alias("identity"), F.col("rows").alias("group_size"))
    return own.unionByName(copies).withColumnRenamed("_id", id_col)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
