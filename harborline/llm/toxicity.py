"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams and of itself, hashed into `BUCKETS` rows of an embedding table, so a
misspelled or inflected form never seen shares most vectors with forms that were. The bag of a passage of `PASSAGE`
words is averaged and goes through a linear softmax of two classes; table and softmax are trained together. A document
scores as its most toxic passage does (passages overlap by half), in training as in use, so that a few words are not
diluted by a long text: each round of training takes the passage of each document that the model finds most toxic, and
random ones of clean documents. A word repeated in a row counts once: a passage needs different words to be averaged.

Since averaging and the last layer are linear, a trained model is one number for each bucket, and a passage's logit is
a mean of those: tasks get a table of 1 MB and remember the sums of words they have met.

Training uses a bounded sample of labelled rows: at most `TOXIC_ROWS` and `CLEAN_ROWS` of them, the first by a hash of
doc_id, among texts of at most `SAMPLE_CHARS` characters. Scores cover every document and its whole text.

Defined results: a null or wordless text scores the share of toxic rows in training (0 if there are none); without
labelled rows of both classes every text scores that share; a label is toxic if any row of its doc_id says so, null
labels and labels without a document are left out; equal texts score alike; an empty table gives an empty result;
labels, lang, source and doc_id never enter a score. Training is seeded and its sample is put in order first.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import arrow_map, keep_rows, whole_text

BUCKETS = 1 << 18
SIZE = 8
GRAMS = (3, 4, 5)
PASSAGE = 8
THRESHOLD = 0.7

TOXIC_ROWS = 2000
CLEAN_ROWS = 4000
SAMPLE_CHARS = 20_000
AT_ONCE = 20_000

ROUNDS = 8
EPOCHS = 3
BATCH = 256
RATE = 0.3

# Words a worker remembers of the newer and of the older half.
KEPT_WORDS = 400_000


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some words and of the words themselves, and which word each belongs to."""
    code = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    owner, end = np.repeat(np.arange(len(words)), sizes), np.repeat(np.cumsum(sizes), sizes)
    found = [np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], np.int64) % BUCKETS]
    owners, h = [np.arange(len(words))], code
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * np.uint64(0x100000001B3) + code[n - 1 :]
        if n in GRAMS:
            inside = np.arange(len(h)) + n <= end[: len(h)]
            mixed = (h[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(32)).astype(np.int64) % BUCKETS)
            owners.append(owner[: len(h)][inside])
    return np.concatenate(found), np.concatenate(owners)


def words_of(text: str) -> list[str]:
    return text.lower().split()


def bounds(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the passages of a text of n words begin and end; they overlap by half."""
    starts = np.arange(0, max(n - PASSAGE // 2, 1), PASSAGE // 2)
    return starts, np.minimum(starts + PASSAGE, n)


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


class Words(dict):
    """Sum of bucket weights and number of n-grams of each word, as one complex number."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights, self.older = weights, {}

    def learn(self, words: set[str]) -> None:
        """Take in the words of a text."""
        if len(self) > KEPT_WORDS:
            self.older = dict(self)
            self.clear()
        new = []
        for word in words:
            if word in self:
                continue
            known = self.older.pop(word, None)
            if known is None:
                new.append(word)
            else:
                self[word] = known
        if new:
            found, owner = grams(new)
            sums = np.bincount(owner, self.weights[found], len(new)) + 1j * np.bincount(owner, minlength=len(new))
            self.update(zip(new, sums.tolist()))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    share: float
    words: Words | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "share": self.share, "words": None}

    def score(self, text: str | None) -> float:
        """How likely label 1 is, from 0 to 1."""
        found = words_of(text or "")
        if not found or not self.weights.any():
            return self.share
        if self.words is None:
            self.words = Words(self.weights)
        self.words.learn(set(found))
        values = np.fromiter(map(self.words.__getitem__, found), complex, len(found))
        values = values[np.concatenate([[True], values[1:] != values[:-1]])]
        sums = np.concatenate([[0], np.cumsum(values)])
        starts, ends = bounds(len(values))
        bags = sums[ends] - sums[starts]
        return sigmoid(self.bias + float((bags.real / bags.imag).max()))


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All positions of several spans, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def train(texts: list[str], labels: list[int], seed: int = 1) -> Model:
    """Fit on documents with labels 0 and 1."""
    share = float(np.mean(labels)) if labels else 0.0
    number: dict[str, int] = {}
    streams, kept = [], []
    for text, label in zip(texts, labels):
        ids = np.array([number.setdefault(w, len(number)) for w in words_of(text)], np.int32)
        if len(ids):
            streams.append(ids[np.concatenate([[True], ids[1:] != ids[:-1]])])
            kept.append(label)
    y = np.array(kept, np.int64)
    if len(set(kept)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, share)
    rng = np.random.default_rng(seed)
    stream, flat, sizes = np.concatenate(streams), [], []
    known = list(number)
    for at in range(0, len(known), AT_ONCE):
        found, of_word = grams(known[at : at + AT_ONCE])
        flat.append(found[np.argsort(of_word, kind="stable")].astype(np.int32))
        sizes.append(np.bincount(of_word))
    flat, sizes = np.concatenate(flat), np.concatenate(sizes)
    gram_ends = np.cumsum(sizes)
    gram_starts = gram_ends - sizes
    first = np.cumsum([0, *map(len, streams)])
    cuts = [bounds(len(s)) for s in streams]
    starts = np.concatenate([s + a for (s, _), a in zip(cuts, first)])
    ends = np.concatenate([e + a for (_, e), a in zip(cuts, first)])
    owner = np.repeat(np.arange(len(y)), [len(s) for s, _ in cuts])
    begin = np.cumsum([0, *(len(s) for s, _ in cuts)])[:-1]

    table = rng.uniform(-1, 1, (BUCKETS, SIZE)).astype(np.float32) / SIZE
    layer, bias = rng.normal(0, 0.1, (SIZE, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen = [np.full(BUCKETS, 1e-6, np.float32), np.full((SIZE, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)]

    def logits() -> np.ndarray:
        weights = table @ (layer[:, 1] - layer[:, 0])
        per_word = np.add.reduceat(weights[flat], gram_starts) + 1j * (gram_ends - gram_starts)
        sums = np.concatenate([[0], np.cumsum(per_word[stream])])
        total = sums[ends] - sums[starts]
        return total.real / total.imag

    def step(chosen: np.ndarray, weight: np.ndarray) -> None:
        words = stream[_spans(starts[chosen], ends[chosen])]
        per_passage = np.repeat(np.arange(len(chosen)), ends[chosen] - starts[chosen])
        found = flat[_spans(gram_starts[words], gram_ends[words])]
        passage = np.repeat(per_passage, (gram_ends - gram_starts)[words])
        count = np.bincount(passage, minlength=len(chosen))[:, None]
        mean = np.add.reduceat(table[found], np.searchsorted(passage, np.arange(len(chosen)))) / count
        out = mean @ layer + bias
        out = np.exp(out - out.max(axis=1, keepdims=True))
        slope = (out / out.sum(axis=1, keepdims=True) - np.eye(2)[y[owner[chosen]]]) * weight[:, None]
        to_layer, to_bias = mean.T @ slope / len(chosen), slope.mean(axis=0)
        to_bag = (slope @ layer.T / count).astype(np.float32)
        rows, back = np.unique(found, return_inverse=True)
        to_rows = np.zeros((len(rows), SIZE), np.float32)
        np.add.at(to_rows, back, to_bag[passage])
        seen[0][rows] += (to_rows**2).mean(axis=1)
        table[rows] -= RATE * to_rows / np.sqrt(seen[0][rows])[:, None]
        for value, slope_of, past in ((layer, to_layer, seen[1]), (bias, to_bias, seen[2])):
            past += slope_of**2
            value -= (RATE * slope_of / np.sqrt(past)).astype(np.float32)

    toxic, clean = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    for turn in range(ROUNDS):
        if turn == 0:
            # Nothing is known yet: every passage of a toxic document counts a little, clean passages as much in all.
            pool = np.flatnonzero(y[owner] == 1)
            others = rng.choice(np.flatnonzero(y[owner] == 0), min(len(pool), int((y[owner] == 0).sum())), replace=False)
            chosen = np.concatenate([pool, others])
        else:
            now = logits()
            top = begin + np.array([a.argmax() for a in np.split(now, begin[1:])])
            random = begin[clean] + rng.integers(0, np.diff(np.append(begin, len(owner)))[clean])
            chosen = np.concatenate([top[toxic], top[clean], random])
        for _ in range(1 if turn == 0 else EPOCHS):
            order = rng.permutation(chosen)
            for a in range(0, len(order), BATCH):
                step(order[a : a + BATCH], np.ones(len(order[a : a + BATCH])))
    weights = (table @ (layer[:, 1] - layer[:, 0])).astype(np.float32)
    return Model(weights, float(bias[1] - bias[0]), share)


def id_check(doc_id: str = "doc_id"):
    """crc32 of a doc_id written as text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on the bounded sample of the rows that may be learnt from: crc32(doc_id) mod 3 is not 1."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    known = known.where(id_check() % 3 != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id"), "doc_id")
    picked = [
        known.where(F.col("toxic") == value).orderBy(*order).limit(rows)
        for value, rows in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))
    ]
    texts = docs.select("doc_id", whole_text().alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    # At most TOXIC_ROWS + CLEAN_ROWS ids are broadcast.
    sample = texts.join(F.broadcast(picked[0].union(picked[1])), "doc_id").toPandas()
    sample = sample.sort_values(["doc_id", "text"]).drop_duplicates("doc_id")
    return train(sample["text"].tolist(), sample["toxic"].tolist())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = pa.array([model.score(t) for t in batch.column(1).to_pylist()], pa.float64())
        return pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])

    return arrow_map(docs.select("doc_id", whole_text().alias("text")), run, f"doc_id {kind}, score double")


def clean_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents below the threshold, with their own columns."""
    return keep_rows(docs, text, lambda texts: [model.score(t) < THRESHOLD for t in texts])
