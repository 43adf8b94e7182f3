"""Quality classifier: supervised subword embeddings.

Words, their character n-grams and word pairs are hashed to vectors, a document is
the average of the vectors of all its features, and a softmax over two classes sits
on top. Vectors and softmax are learned by stochastic gradient descent in numpy on
a bounded sample of labelled documents (``max_train``), chosen by a hash; of a
document with over ``MAX_FEATURES`` different features that many, evenly spread over
their hashes, so that what reaches the driver is bounded whatever the texts are.
Language, source and ids are never features.

A trained model scores linearly before the softmax, so each feature comes down to
one number, and a document's score is one average: texts of any length are read
whole, word by word, in a single pass without a shuffle.

A null or empty text has no feature and gets the model's bias.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, nested, remainder, unnested, word_grams, words_of

BITS = 17
BUCKETS = 1 << BITS
DIM = 8
NGRAMS = (3, 4)
MAX_TRAIN = 4000
MAX_FEATURES = 16_384
EPOCHS = 6
RATE = 0.3
THRESHOLD = 0.3
BATCH = 256
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def pair_features(hashes: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring words. The hash does not depend on their order, and
    all immediate repetitions share bucket 0."""
    return ((hashes[1:] ^ hashes[:-1]) * MULTIPLIER >> np.uint64(64 - BITS)).astype(np.int64)


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A document's feature buckets and their counts."""
    words = words_of(text or "")
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids, _, hashes = word_grams(words, NGRAMS, BITS)
    return np.unique(np.concatenate([ids, pair_features(hashes)]), return_counts=True)


def training_bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    ids, n = bag(text)
    if len(ids) > MAX_FEATURES:
        kept = np.linspace(0, len(ids) - 1, MAX_FEATURES).astype(int)
        ids, n = ids[kept], n[kept]
    return ids, n


@dataclass(frozen=True)
class Model:
    #: What each feature adds to the log odds of class 1, and the bias.
    weights: np.ndarray
    bias: float

    def score(self, total: float, n: int) -> float:
        return float(1 / (1 + np.exp(-(total / max(n, 1) + self.bias))))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], seed: int = 7) -> Model:
    """Vectors and softmax by stochastic gradient descent, a document a step."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    softmax = np.zeros((DIM, 2), np.float32)
    share = min(max(np.mean(labels), 0.01), 0.99) if labels else 0.5
    bias = np.log(np.array([1 - share, share], np.float32))
    steps, done = EPOCHS * max(len(labels), 1), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(labels)):
            rate = RATE * (1 - done / steps)
            done += 1
            ids, n = bags[k]
            if not len(ids):
                continue
            part = (n / n.sum()).astype(np.float32)
            mean = part @ vectors[ids]
            logit = mean @ softmax + bias
            p = np.exp(logit - logit.max())
            error = p / p.sum()
            error[labels[k]] -= 1
            back = softmax @ error
            softmax -= rate * np.outer(mean, error)
            # Features of long documents have small shares: the step is scaled back up.
            vectors[ids] -= (rate * len(ids) ** 0.5) * np.outer(part, back)
            bias -= 0.1 * rate * error
    return Model((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def fit(
    docs: DataFrame, labels: DataFrame, held_out_mod: int = 5, max_train: int = MAX_TRAIN, text_col: str = "text"
) -> Model:
    """Train on at most ``max_train`` labels outside the held-out fold, chosen by a hash
    of the id, so that only their texts move. Labels other than 0 and 1 are skipped. An
    id with several rows is one document, its least text."""
    usable = labels.filter(F.col("quality").isin(0, 1) & (remainder("doc_id", held_out_mod) != 0))
    ids = usable.select("doc_id", "quality").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_train)
    rows = docs.select("doc_id", F.col(text_col).alias("text"))
    picked = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    picked = picked.select("text", "quality")  # at most max_train rows

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [training_bag(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i.astype(np.uint32).tobytes() for i, _ in found], pa.binary()),
                    pa.array([n.astype(np.uint32).tobytes() for _, n in found], pa.binary()),
                    b.column("quality").cast(pa.int32()),
                ],
                names=["ids", "n", "quality"],
            )

    got = picked.mapInArrow(bags, "ids BINARY, n BINARY, quality INT").toArrow().to_pylist()
    got.sort(key=lambda r: (r["ids"], r["n"], r["quality"]))  # steps in an order that does not depend on tasks
    unpack = lambda x: np.frombuffer(x, np.uint32).astype(np.int64)
    return train([(unpack(r["ids"]), unpack(r["n"])) for r in got], [r["quality"] for r in got])


_tables: dict = {}


def _word_scores(model: Model, words: list[str]) -> list[np.ndarray]:
    """Of each word: the sum over its features, their number, and its hash."""
    ids, of, hashes = word_grams(words, NGRAMS, BITS)
    return [np.bincount(of, model.weights[ids], len(words)), np.bincount(of, minlength=len(words)), hashes]


def score_texts(texts: list[str | None], model: Model, table: WordTable) -> list[float]:
    """Scores of whole texts, some hundred at a time so that few words are held at once."""
    out = []
    for at in range(0, len(texts), BATCH):
        split = [words_of(t or "") for t in texts[at : at + BATCH]]
        for rows in table.index(split):
            if not len(rows):
                out.append(model.score(0.0, 0))
                continue
            sums, ns, hashes = table.columns
            pairs = pair_features(hashes[rows])
            total = float(sums[rows].sum() + model.weights[pairs].sum())
            out.append(model.score(total, int(ns[rows].sum()) + len(pairs)))
    return out


def with_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "_score", drop_text: bool = False) -> DataFrame:
    """``docs`` with the probability of class 1 for every whole text."""
    kept = [f for f in docs.schema.fields if not (drop_text and f.name == text_col)]
    names = [f.name for f in kept]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{out} DOUBLE"])
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # a fixed number of buckets
    model_id = zlib.crc32(model.weights.tobytes())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _tables.get("id") != model_id:
            local = Model(*shared.value)
            _tables.update(id=model_id, model=local, words=WordTable(lambda words: _word_scores(local, words)))
        for b in batches:
            scores = score_texts(b.column(text_col).to_pylist(), _tables["model"], _tables["words"])
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(scores, pa.float64())], names=[*names, out])

    return docs.mapInArrow(add, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, held_out_mod: int = 5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; a null id is never held out."""
    model = fit(docs, labels, held_out_mod)
    scored = with_score(docs.select("doc_id", "text"), model, drop_text=True)
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", held_out_mod) == 0, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labelled: DataFrame, labels: DataFrame, held_out_mod: int = 5) -> DataFrame:
    """The documents predicted to be of quality, all columns; the model learns from
    ``labels`` of ``labelled``."""
    model = fit(labelled, labels, held_out_mod)
    return unnested(with_score(nested(docs), model).filter(F.col("_score") >= THRESHOLD), docs.columns)
