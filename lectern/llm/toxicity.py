"""Toxicity: a convolutional text classifier on hashed word embeddings, trained in numpy.

A word's vector is the sum of the hashed embeddings of the word and of its first four and five letters; filters of several
widths run over the words, each filter's maximum over the whole text is kept, and a logistic layer weighs them. Training takes
a bounded sample of labelled rows (Plan.rows and Plan.chars), the same at every input size; scoring takes every row and the
whole text. One embedding dimension starts as the shrunk log-odds of its feature, so that max pooling looks at telling words
from the first step. Models that each leave out a part of the sample calibrate the score on that part (a logistic fit) and,
language by language, the thresholds above which a document is rejected. The language is used for that decision only, never for the score.
"""

from __future__ import annotations

import pickle
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")
#: predicted is 1 from this score on.
CUT = 0.3
#: Rows in a batch that goes back to the JVM: they carry their texts.
ROWS_BACK = 500


@dataclass(frozen=True)
class Plan:
    rows: int = 12_000  # labelled rows in the sample, half of them toxic if there are as many
    chars: int = 24_000_000  # code points in the sample
    slots: int = 1 << 18  # hashed embeddings
    width: int = 8  # dimensions
    filters: int = 12  # for each of the sizes
    sizes: tuple[int, ...] = (1, 2, 3)
    steps: int = 1_200  # batches seen in training, whatever the sample's size
    parts: int = 2  # for calibration
    batch: int = 32
    rate: float = 0.01
    embedding_rate: float = 0.001
    cached_words: int = 80_000  # in a task's table of word vectors
    seed: int = 7


@dataclass
class Model:
    plan: Plan
    embeddings: np.ndarray
    kernels: list[np.ndarray]  # (size * width, filters)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)  # of the logit, from calibration
    thresholds: dict[str, float] = field(default_factory=dict)  # "" for other languages
    constant: float | None = None  # the score of all texts, where there was nothing to learn


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def slots_of(word: str, n: int) -> tuple[int, int, int]:
    """Embedding slots of a word, and of its first four and five letters."""
    data = word.encode("utf-8", "surrogatepass")
    head, longer = ("<4" + word[:4]).encode("utf-8", "surrogatepass"), ("<5" + word[:5]).encode("utf-8", "surrogatepass")
    return zlib.crc32(data) % n, zlib.crc32(head) % n, zlib.crc32(longer) % n


class Words:
    """A table from words to rows, and each row's three slots."""

    def __init__(self, plan: Plan):
        self.plan, self.rows, self.flat = plan, {}, array("i")

    def numbers(self, words: list[str]) -> np.ndarray:
        rows, n = self.rows, self.plan.slots
        for w in set(words).difference(rows):
            rows[w] = len(rows)
            self.flat.extend(slots_of(w, n))
        return np.fromiter(map(rows.__getitem__, words), np.int32, len(words))

    def slots(self, start: int = 0) -> np.ndarray:
        """Slots of the rows from start on."""
        return np.array(self.flat[3 * start :], np.int32).reshape(-1, 3)


def forward(model: Model, vectors: np.ndarray, starts: np.ndarray, want_at: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
    """Pooled filter values of each text, (texts, filters of all sizes), and where the maxima were.

    vectors: the words of all texts, each text followed by as many zero vectors as the largest size, less one; starts: where each begins.
    """
    plan, pooled, at = model.plan, [], []
    ends = np.append(starts[1:], len(vectors)) - (max(plan.sizes) - 1)  # windows start at words, not in the zeros after them
    spans = np.stack([starts, ends], 1).ravel()
    spans = spans[:-1] if spans[-1] == len(vectors) else spans
    for size, kernel, bias in zip(plan.sizes, model.kernels, model.bias, strict=True):
        n = len(vectors) - size + 1
        wide = np.lib.stride_tricks.sliding_window_view(vectors.ravel(), size * plan.width)[:: plan.width] if size > 1 else vectors
        values = wide @ kernel
        if n < len(vectors):
            values = np.concatenate([values, np.full((len(vectors) - n, plan.filters), -np.inf, np.float32)])
        best = np.maximum.reduceat(values, spans)[::2]
        pooled.append(np.maximum(best + bias, 0))
        if want_at:
            at.append(np.stack([s + values[s:e].argmax(0) for s, e in zip(starts, ends, strict=True)]))
    return np.concatenate(pooled, 1), at


def _laid_out(texts: list[np.ndarray], gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, -1 for the zero vectors after each; starts. Every text has one word position at least."""
    pad = np.full(gap, -1, np.int32)
    parts, starts, at = [], [], 0
    for t in texts:
        t = t if len(t) else np.full(1, -1, np.int32)
        starts.append(at)
        parts += [t, pad]
        at += len(t) + gap
    return np.concatenate(parts), np.array(starts)


def _log_odds(texts: list[np.ndarray], y: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
    """By how much each slot raises the log-odds at least, from the texts that have it."""
    has = np.zeros((2, n), np.float32)
    for t, label in zip(texts, y, strict=True):
        has[int(label), np.unique(slots[np.unique(t)])] += 1
    seen, share, z = np.maximum(has.sum(0), 1e-9), (y == 1).mean(), 3.0
    part = has[1] / seen
    # Wilson's lower bound of the toxic share of the texts that have it: chance pairs of rare words stay near nothing
    least = (part + z * z / (2 * seen) - z * np.sqrt(np.maximum(part * (1 - part), 0) / seen + z * z / (4 * seen * seen))) / (1 + z * z / seen)
    least = np.clip(least, 1e-6, 1 - 1e-6)
    return np.maximum(np.log(least / (1 - least)) - np.log(share / (1 - share)), 0).astype(np.float32)


def train(plan: Plan, texts: list[str], y: np.ndarray, langs: list[str | None]) -> Model:
    """Fit the classifier on all texts; models fitted on all but one part of them each calibrate it on that part.

    With one class only, or no text, the score is the share of toxic ones, 0 without any.
    """
    y = np.asarray(y, np.float32)
    table = Words(plan)
    numbers = [table.numbers(words_of(t)) for t in texts]
    slots = table.slots() if table.rows else np.zeros((1, 3), np.int32)
    rng = np.random.default_rng(plan.seed)
    part = np.empty(len(y), int)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        part[own] = rng.permutation(len(own)) % plan.parts
    model = _trained(plan, numbers, y, slots, np.arange(len(y)))
    if model.constant is None:
        logits = np.zeros(len(y))
        for k in range(plan.parts):
            own = np.flatnonzero(part == k)
            other = _trained(plan, numbers, y, slots, np.flatnonzero(part != k))
            if other.constant is not None:
                return model
            for i in range(0, len(own), 64):
                logits[own[i : i + 64]] = _logits(other, [numbers[j] for j in own[i : i + 64]], slots)
        _calibrate(model, logits, y, langs)
    return model


def _trained(plan: Plan, numbers: list[np.ndarray], y: np.ndarray, slots: np.ndarray, learn: np.ndarray) -> Model:
    """A model of the texts numbered in learn, by Adam, with Adagrad for the embeddings; gradients reach a filter's maximum only."""
    rng = np.random.default_rng(plan.seed + 1)
    draw = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    total = plan.filters * len(plan.sizes)
    model = Model(plan, 0.05 * draw(plan.slots, plan.width), [0.3 * draw(s * plan.width, plan.filters) for s in plan.sizes], [np.zeros(plan.filters, np.float32) for _ in plan.sizes], 0.3 * draw(total), 0.0, thresholds={"": CUT})
    if len(set(y[learn].tolist())) < 2:
        model.constant = float(y[learn].mean()) if len(learn) else 0.0
        return model
    model.embeddings[:, 0] = _log_odds([numbers[i] for i in learn], y[learn], slots, plan.slots)
    dense = [*model.kernels, *model.bias, model.out]
    moments = [(np.zeros_like(a), np.zeros_like(a)) for a in dense]
    weight = np.where(y == 1, len(learn) / 2 / (y[learn] == 1).sum(), len(learn) / 2 / (y[learn] == 0).sum()).astype(np.float32)
    weight = np.minimum(weight, 10)
    squares = np.full(plan.slots, 1e-3, np.float32)
    gap, step, out_moment = max(plan.sizes) - 1, 0, [0.0, 0.0]
    while step < plan.steps:
        order = rng.permutation(learn)
        for b in range(0, len(order), plan.batch)[: plan.steps - step]:
            own = order[b : b + plan.batch]
            flat, starts = _laid_out([numbers[i] for i in own], gap)
            vectors = model.embeddings[slots[flat]].sum(1)
            vectors[flat < 0] = 0
            pooled, at = forward(model, vectors, starts, want_at=True)
            p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.out_bias, -30, 30)))
            g = (p - y[own]) * weight[own] / len(own)
            back = np.outer(g, model.out) * (pooled > 0)
            grads_k, grads_b, rows, values = [], [], [], []
            for j, (size, kernel) in enumerate(zip(plan.sizes, model.kernels, strict=True)):
                own_back, places = back[:, j * plan.filters : (j + 1) * plan.filters], at[j]
                spots = np.minimum(places[:, :, None] + np.arange(size), len(flat) - 1)
                seen = vectors[spots].reshape(*places.shape, -1)
                grads_k.append(np.einsum("nfd,nf->df", seen, own_back))
                grads_b.append(own_back.sum(0))
                rows.append(flat[spots].reshape(-1))
                values.append((own_back[:, :, None] * kernel.T[None]).reshape(-1, plan.width))
            rows, values = np.concatenate(rows), np.concatenate(values)
            some = (rows >= 0) & (np.abs(values).max(1) > 0)
            step += 1
            for a, g_a, (m, v) in zip(dense, [*grads_k, *grads_b, pooled.T @ g], moments, strict=True):
                m += 0.1 * (g_a - m)
                v += 0.001 * (g_a * g_a - v)
                a -= plan.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            out_moment = [out_moment[0] + 0.1 * (g.sum() - out_moment[0]), out_moment[1] + 0.001 * (g.sum() ** 2 - out_moment[1])]
            model.out_bias -= plan.rate * (out_moment[0] / (1 - 0.9**step)) / ((out_moment[1] / (1 - 0.999**step)) ** 0.5 + 1e-8)
            if some.any():
                where, inverse = np.unique(slots[rows[some]].T.ravel(), return_inverse=True)
                grad = np.zeros((len(where), plan.width), np.float32)
                np.add.at(grad, inverse, np.tile(values[some], (3, 1)))
                squares[where] += (grad * grad).mean(1)
                model.embeddings[where] -= plan.embedding_rate * grad / np.sqrt(squares[where])[:, None]
    return model


def _calibrate(model: Model, z: np.ndarray, y: np.ndarray, langs: list[str | None]) -> None:
    """A logistic fit of the score to logits z, then the threshold of each language by its F1 (the middle of the best range)."""
    targets = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps on two parameters
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w, d = np.maximum(p * (1 - p), 1e-6), p - targets
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        move = np.linalg.solve(h, [(d * z).sum() + 1e-3 * (a - 1), d.sum()])
        a, b = float(a - np.clip(move[0], -1, 1)), float(b - np.clip(move[1], -2, 2))
    if a <= 0:
        a, b = 1.0, 0.0
    model.scale = (a, b)
    p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
    for lang in ["", *sorted({x for x in langs if x})]:
        own = np.array([not lang or x == lang for x in langs])
        if (y[own] == 1).sum() < 5:
            continue
        values, truth = p[own], y[own]
        cuts = np.unique(values)
        f1 = [2 * (truth[values >= c] == 1).sum() / ((values >= c).sum() + (truth == 1).sum()) for c in cuts]
        best = int(np.argmax(f1))
        below = cuts[best - 1] if best else 0.0
        model.thresholds[lang] = float(np.clip((cuts[best] + below) / 2, 0.1, 0.7))


def _logits(model: Model, numbers: list[np.ndarray], slots: np.ndarray) -> np.ndarray:
    flat, starts = _laid_out(numbers, max(model.plan.sizes) - 1)
    vectors = model.embeddings[slots[flat]].sum(1)
    vectors[flat < 0] = 0
    return forward(model, vectors, starts)[0] @ model.out + model.out_bias


class Scorer:
    """Scores texts; keeps the vectors of the words met so far, as far as the table's bound goes."""

    AT_ONCE = 50_000  # words

    def __init__(self, model: Model):
        self.model = model
        self.table, self.vectors = Words(model.plan), np.zeros((0, model.plan.width), np.float32)

    def _scores(self, texts: list[np.ndarray]) -> np.ndarray:
        model = self.model
        if len(self.table.rows) > len(self.vectors):
            self.vectors = np.concatenate([self.vectors, model.embeddings[self.table.slots(len(self.vectors))].sum(1)])
        flat, starts = _laid_out(texts, max(model.plan.sizes) - 1)
        table = np.concatenate([self.vectors, np.zeros((1, model.plan.width), np.float32)])  # the last row is the zero vector
        pooled, _ = forward(model, table[flat], starts)
        a, b = model.scale
        return 1 / (1 + np.exp(-np.clip(a * (pooled @ model.out + model.out_bias) + b, -30, 30)))

    def scores(self, texts: Iterator[str]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(sum(1 for _ in texts), self.model.constant)
        out, held, n = [], [], 0
        for text in texts:
            held.append(self.table.numbers(words_of(text)))
            n += len(held[-1])
            if n >= self.AT_ONCE:
                out.append(self._scores(held))
                held, n = [], 0
                if len(self.table.rows) > self.model.plan.cached_words:
                    self.table, self.vectors = Words(self.model.plan), self.vectors[:0]
        if held:
            out.append(self._scores(held))
        return np.concatenate(out) if out else np.empty(0)


def held_out(id_col: str):
    """Rows that never teach: crc32 of the id as text is 2 modulo 4. False for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, plan: Plan, id_col: str, text_col: str, label_col: str, lang_col: str | None) -> tuple[list[str], np.ndarray, list[str | None]]:
    """The bounded training sample: labelled rows that are not held out, in the order of a hash of their id, half of each
    class as far as there are as many; as many of them as Plan.chars allows. Ids and lengths are chosen first, then texts read.

    Labels that are null or of no id are ignored; of several for an id the highest counts. Null texts are empty ones; of rows that repeat an
    id one text is read, the smallest. A text longer than what is left of Plan.chars is left out whole, never cut. Equal hashes
    are ordered by id. Empty tables give an empty sample; other columns are ignored.
    """
    marks = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(~held_out(id_col)).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    order = F.xxhash64("_id", F.lit(plan.seed))
    pick = lambda y: marks.filter(F.col("_y") == y).orderBy(order, "_id").limit(plan.rows)
    toxic = pick(1)
    n_toxic = min(toxic.count(), plan.rows // 2)
    chosen = toxic.limit(n_toxic).unionByName(pick(0).limit(plan.rows - n_toxic))  # Plan.rows ids: a proven bound
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), (F.col(lang_col) if lang_col else F.lit(None)).cast("string").alias("_lang"))
    sizes = texts.select("_id", F.length("_text").alias("_n")).join(F.broadcast(chosen), "_id").groupBy("_id", "_y").agg(F.max("_n").alias("_n")).orderBy(order, "_id").collect()
    left, taken = {0: plan.chars, 1: plan.chars // 2}, []
    for y in (1, 0):
        if y == 0:
            left[0] = plan.chars - sum(n for _, n, _ in taken)
        for r in sizes:
            if r["_y"] == y and r["_n"] <= left[y]:
                taken.append((r["_id"], r["_n"], y))
                left[y] -= r["_n"]
    if not taken:
        return [], np.empty(0), []
    ids = docs.sparkSession.createDataFrame([(i,) for i, _, _ in taken], texts.select("_id").schema)
    y_of = {i: y for i, _, y in taken}
    rows = sorted({r["_id"]: (r["_id"], r["_text"], r["_lang"]) for r in texts.join(F.broadcast(ids), "_id").sort("_id", F.desc("_text")).toLocalIterator()}.values())
    return [r[1] for r in rows], np.array([y_of[r[0]] for r in rows]), [r[2] for r in rows]


def fit(docs: DataFrame, labels: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str | None = "lang") -> Model:
    """The classifier of docs, from the bounded sample that sample() takes of its labelled rows; nulls, repeats, long texts and empty tables are as there.

    Without labels every score is 0, with those of one class only it is their share. lang_col is used for thresholds alone.
    """
    return train(plan, *sample(docs, labels, plan, id_col, text_col, label_col, lang_col))


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """docs with out_col added (replaced where it exists): the score of each whole text, 0 to 1, null texts as empty ones.

    Rows, repeated ones too, keep their other columns; an empty table stays empty.
    """
    cast = docs.drop(out_col)
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))  # broadcasts alone would need the package on executors
    at = cast.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pickle.loads(shared.value))
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_BACK):
                batch = whole.slice(start, ROWS_BACK)
                scores = scorer.scores(t.as_py() or "" for t in batch.column(at))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, out_col])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return cast.mapInArrow(run, StructType([*cast.schema.fields, StructField(out_col, DoubleType())]))


def rejected(lang_col: str, model: Model, score_col: str = "score"):
    """Whether the score reaches the threshold of the row's language (of all languages where it has none of its own)."""
    cut = F.lit(model.thresholds.get("", CUT))
    for lang, value in model.thresholds.items():
        if lang:
            cut = F.when(F.col(lang_col) == lang, F.lit(value)).otherwise(cut)
    return F.col(score_col) >= cut


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
