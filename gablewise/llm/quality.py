"""A quality classifier over learned subword embeddings.

A document's features are its words, their character n-grams and its word bigrams, each hashed into one table of learned
vectors. A document is the mean of its features' vectors, and a softmax over two classes follows. Training is stochastic
gradient descent in numpy, in one task, over a sample of labelled documents of a stated size; scoring runs over all documents,
and whole texts. Python sees texts alone: ids and rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablewise.llm.common import broadcast_if_small, mix, packed, save, small_batches, tidied


@dataclass(frozen=True)
class Settings:
    #: Bound of the labelled sample that the model is fitted on.
    max_train: int = 4000
    buckets: int = 1 << 17
    dim: int = 8
    #: Passes over the sample, or more of them for a small one, until so many steps are done.
    epochs: int = 5
    steps: int = 600
    rate: float = 0.5
    ngrams: tuple[int, ...] = (3, 4)
    batch: int = 32
    seed: int = 7
    threshold: float = 0.7


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: the CRC-32 of the doc_id as text leaves 2 when divided by 4 (a null id: not)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


#: Odd multipliers of the characters of a word by their place.
ODD = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def word_features(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, bucket, hash): the buckets of the words and of their character n-grams, whose word each is, and a hash of each word.

    A word has marks at both ends, so that an n-gram tells a beginning or an end.
    """
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - starts[owner]
    own = mix(np.add.reduceat(codes * ODD[place % len(ODD)], starts))
    owners, found = [np.arange(len(words))], [own]
    for k in s.ngrams:
        n = len(codes) - k + 1
        if n > 0:
            inside = np.flatnonzero((owner[:n] == owner[k - 1 :]) & (sizes[owner[:n]] > k))
            h = np.full(len(inside), k, np.uint64)
            for j in range(k):
                h = h * ODD[0] + codes[inside + j]
            owners.append(owner[inside])
            found.append(mix(h))
    return np.concatenate(owners), (np.concatenate(found) % np.uint64(s.buckets)).astype(np.int64), own


def pair_features(hashes: np.ndarray, s: Settings) -> np.ndarray:
    """Buckets of the word bigrams of a text, from the hashes of its words. A bigram has no order; all doubled words are one."""
    return (mix((hashes[1:] ^ hashes[:-1]) + np.uint64(0x2545F4914F6CDD1D)) % np.uint64(s.buckets)).astype(np.int64)


def text_features(text: str, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text, and what share of its features each has."""
    ws = text.split()
    if not ws:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    words = {w: i for i, w in enumerate(dict.fromkeys(ws))}
    at = np.fromiter(map(words.__getitem__, ws), np.int64, len(ws))
    owner, bucket, own = word_features(list(words), s)
    times = np.bincount(at, minlength=len(words))[owner]
    pairs = pair_features(own[at], s)
    every, place = np.unique(np.concatenate([bucket, pairs]), return_inverse=True)
    c = np.bincount(place, np.concatenate([times, np.ones(len(pairs))]), len(every))
    return every, (c / c.sum()).astype(np.float32)


def sgd_step(table: np.ndarray, out: np.ndarray, bias: np.ndarray, docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rate: float) -> None:
    """One step of gradient descent on the cross entropy of a batch of (buckets, shares), in place."""
    f, c = np.concatenate([x for x, _ in docs]), np.concatenate([x for _, x in docs])
    sizes = np.array([len(x) for x, _ in docs])
    row, starts = np.repeat(np.arange(len(docs)), sizes), np.cumsum(sizes) - sizes
    h = np.add.reduceat(table[f] * c[:, None], starts)
    z = h @ out + bias
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(docs)), labels] -= 1
    back = p @ out.T
    out -= rate * (h.T @ p)
    bias -= rate * p.mean(0)
    near, at = np.unique(f, return_inverse=True)
    for d in range(table.shape[1]):
        table[near, d] -= rate * np.bincount(at, c * back[row, d], len(near)).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """The learned weight of each bucket for label 1 against 0, and the bias: the two linear layers in one."""
    known = [text_features(t, s) for t in texts]
    rng = np.random.default_rng(s.seed)
    table = rng.uniform(-1 / s.dim, 1 / s.dim, (s.buckets, s.dim)).astype(np.float32)
    out, bias = np.zeros((s.dim, 2), np.float32), np.zeros(2, np.float32)
    full = np.array([i for i, (f, _) in enumerate(known) if len(f)], np.int64)
    per_pass = -(-len(full) // s.batch)
    epochs = max(s.epochs, -(-s.steps // per_pass)) if per_pass else 0
    for step in range(epochs * per_pass):
        at = step % per_pass * s.batch
        if at == 0:
            order = rng.permutation(full)
        part = order[at : at + s.batch]
        sgd_step(table, out, bias, [known[i] for i in part], labels[part], s.rate * (1 - step / (epochs * per_pass)))
    return table @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, s: Settings) -> tuple[np.ndarray, float]:
    """Fits on at most s.max_train labelled rows that aren't held out, those with the smallest hash of their doc_id.

    Repeated doc_ids and labels other than 0 and 1 are allowed: such labels are skipped, and of repeats any counts once a
    row. Without rows of both labels the model is flat: each score is the share of label 1 seen, or 0.5.
    """
    small_batches(docs.sparkSession)
    y = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    y = y.groupBy("doc_id").agg(F.max("quality").cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.max_train)
    y = broadcast_if_small(save(y, "quality-sample"))
    rows = docs.join(y, "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(s.max_train).withColumn("one", F.lit(1))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"])
        y = pdf.y.to_numpy(np.int64)
        if len(set(y)) < 2:
            share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
            w, b = np.zeros(s.buckets, np.float32), float(np.log(share / (1 - share)))
        else:
            w, b = train(list(pdf.text), y, s)
        return pd.DataFrame({"w": [w.astype(np.float32).tobytes()], "b": [b]})

    got = rows.groupBy("one").applyInPandas(learn, "w binary, b double").first()
    return (np.frombuffer(bytes(got.w), np.float32), got.b) if got else (np.zeros(s.buckets, np.float32), 0.0)


class Scorer:
    """The score of a text. Each word's summed weight, number of features and hash are kept in tables of bounded size."""

    def __init__(self, w: np.ndarray, b: float, s: Settings, most: int = 1 << 16):
        self.w, self.b, self.s, self.most = w.astype(np.float64), b, s, most
        self.known: dict[str, int] = {}
        self.sums, self.sizes, self.hashes = np.zeros(most), np.zeros(most), np.zeros(most, np.uint64)

    def learn(self, words: list[str]) -> None:
        """Takes new words into the tables, which hold that many at least."""
        if len(self.known) + len(words) > self.most:
            self.known.clear()
        at = len(self.known)
        owner, bucket, own = word_features(words, self.s)
        end = at + len(words)
        self.sums[at:end] = np.bincount(owner, self.w[bucket], len(words))
        self.sizes[at:end] = np.bincount(owner, minlength=len(words))
        self.hashes[at:end] = own
        self.known.update(zip(words, range(at, end), strict=True))

    def __call__(self, text: str | None) -> float:
        ws = text.split() if text else []
        total = number = 0.0
        last = np.empty(0, np.uint64)
        for i in range(0, len(ws), self.most // 2):  # one part, but for the longest texts
            part = ws[i : i + self.most // 2]
            new = list(dict.fromkeys(w for w in part if w not in self.known))
            if new:
                if len(self.known) + len(new) > self.most:
                    self.known.clear()
                    new = list(dict.fromkeys(part))
                self.learn(new)
            at = np.fromiter(map(self.known.__getitem__, part), np.int64, len(part))
            h = np.concatenate([last, self.hashes[at]])
            pairs = pair_features(h, self.s)
            total += self.sums[at].sum() + self.w[pairs].sum()
            number += self.sizes[at].sum() + len(pairs)
            last = h[-1:]
        return float(1 / (1 + np.exp(-(total / max(number, 1) + self.b))))


def score_column(docs: DataFrame, labels: DataFrame, s: Settings) -> Callable[[Column], Column]:
    """Fits the model, and gives the function from a column of texts to their scores."""
    w, b = fit(docs.select("doc_id", "text"), labels, s)
    model = docs.sparkSession.sparkContext.broadcast((w, b))  # of a fixed size: one number a bucket

    @tidied
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = Scorer(*model.value, s)
        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")

    return F.pandas_udf(score, "double")


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs (doc_id, text, any others).

    score is the likelihood of quality 1, from the text alone; a null or empty text has the score of no features. predicted is
    1 from the threshold on. Equal texts have equal scores; a text of any length is scored whole. Null and repeated doc_ids
    give a row each. No rows give no rows.
    """
    s = settings or Settings()
    score = score_column(docs, labels, s)
    scored = docs.select("doc_id", score(F.col("text")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= s.threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """docs without the rows that the classifier rejects; all columns, whatever their names, stay as they are.

    A row without text is judged as quality_scores does. Null and repeated doc_ids are rows like others. No rows give no rows.
    """
    s = settings or Settings()
    score = score_column(docs, labels, s)
    return docs.select(packed(docs), score(F.col("text")).alias("score")).where(F.col("score") >= s.threshold).select("row.*")
