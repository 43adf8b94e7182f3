"""Language identification: a linear-chain conditional random field over words.

Every word is scored per language by hashed features (the word, its prefixes,
suffixes and character trigrams, and membership in the lexicons, which hold each
language's most frequent training words); learned transitions tie neighbouring
words together. Forward-backward gives each word's language probabilities, so text
that switches language is labelled word by word; a document's language is the one
with most probability mass over its words.

Weights and transitions are learned together by gradient descent on the sequence
likelihood, in numpy, on a bounded sample: the ``MOST_LANGUAGES`` most frequent
languages, up to ``per_language`` documents of each and ``SAMPLE`` in all, up to
``RUNS`` runs of words of each document, cut anywhere in the whole text by the tasks that
read it, and words of up to ``LONGEST`` characters. So what reaches the driver is bounded
whatever the texts and language values are. Documents
only have one label, so training sequences are spliced from runs of words of
different languages; run lengths are random and teach the transitions.

Prediction is a single pass without a shuffle. Documents of a batch advance
together, one word a step, and whole texts are read. ``und`` and score 0 stand for
a null or empty text and one without letters; with no training rows every document
is ``und``.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WordTable, remainder, word_grams, words_of

BITS = 16
BUCKETS = 1 << BITS
NGRAMS = (2, 3, 4)
PER_LANGUAGE = 250
MOST_LANGUAGES = 128
SAMPLE = 8000
RUNS = 20
LONGEST = 40
LEXICON = 300
SEQUENCE = 48
BATCH = 48
STEPS = 260
RATE = 0.5
CHUNK = 1_500_000
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def word_features(words: list[str], lexicons: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word and the word each belongs to: the word itself, its
    n-grams (those at a marked edge are its affixes) and the lexicons that have it, a
    bit each in ``lexicons``."""
    lower = [w.lower() for w in words]
    ids, of, _ = word_grams(lower, NGRAMS, BITS)
    lexicon = np.fromiter((zlib.crc32(b"lexicon%d" % lexicons.get(w, 0)) % BUCKETS for w in lower), np.int64, len(lower))
    return np.concatenate([ids, lexicon]), np.concatenate([of, np.arange(len(lower))])


def word_scores(words: list[str], weights: np.ndarray, lexicons: dict[str, int]) -> np.ndarray:
    ids, of = word_features(words, lexicons)
    return np.stack([np.bincount(of, weights[ids, c], len(words)) for c in range(weights.shape[1])], 1)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicons: dict[str, int]


def _softmax(x: np.ndarray, axis: int) -> np.ndarray:
    x = np.exp(x - x.max(axis=axis, keepdims=True))
    return x / x.sum(axis=axis, keepdims=True)


def marginals(score: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over sequences of one length: word and transition probabilities.

    ``score`` is (sequences, words, languages), ``moves`` log transition weights.
    """
    b, t, k = score.shape
    e = np.exp(score - score.max(axis=2, keepdims=True))
    m = np.exp(moves)
    ahead, back = np.empty_like(e), np.ones_like(e)
    ahead[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
    for i in range(1, t):
        a = (ahead[:, i - 1] @ m) * e[:, i]
        ahead[:, i] = a / a.sum(1, keepdims=True)
    for i in range(t - 2, -1, -1):
        a = (back[:, i + 1] * e[:, i + 1]) @ m.T
        back[:, i] = a / a.sum(1, keepdims=True)
    word = ahead * back
    word /= word.sum(2, keepdims=True)
    pair = ahead[:, :-1, :, None] * m * (back * e)[:, 1:, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    return word, pair


def train(texts: list[tuple[str, str]], seed: int = 11) -> Model:
    """Fit on (language, text) pairs."""
    languages = sorted({lang for lang, _ in texts})
    k = len(languages)
    words: dict[str, list[str]] = {lang: [] for lang in languages}
    for lang, text in texts:
        words[lang] += [w for w in words_of(text) if LETTER.search(w)]
    languages = [lang for lang in languages if words[lang]]
    k = len(languages)
    lexicons: dict[str, int] = {}
    for i, lang in enumerate(languages):
        common = Counter(w.lower() for w in words[lang])
        for w, _ in sorted(common.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicons[w] = lexicons.get(w, 0) | 1 << i
    weights = np.zeros((BUCKETS, k))
    moves = np.zeros((k, k))
    if k > 1:
        rng = np.random.default_rng(seed)
        seen = np.zeros(BUCKETS)
        for step in range(STEPS):
            picked, label = [], np.empty((BATCH, SEQUENCE), np.int64)
            for b in range(BATCH):
                i = 0
                while i < SEQUENCE:
                    lang = int(rng.integers(k))
                    run = min(1 + int(rng.geometric(1 / 16)), SEQUENCE - i)
                    own = words[languages[lang]]
                    at = int(rng.integers(max(1, len(own) - run)))
                    taken = [own[(at + j) % len(own)] for j in range(run)]
                    picked += taken
                    label[b, i : i + run] = lang
                    i += run
            ids, of = word_features(picked, lexicons)
            score = np.stack([np.bincount(of, weights[ids, c], len(picked)) for c in range(k)], 1)
            word, pair = marginals(score.reshape(BATCH, SEQUENCE, k), moves)
            truth = np.eye(k)[label]
            error = (word - truth).reshape(-1, k)
            grad = np.stack([np.bincount(ids, error[of, c], BUCKETS) for c in range(k)], 1)
            seen += (grad**2).sum(1)
            weights -= RATE * grad / (1e-8 + np.sqrt(seen))[:, None]
            moved = (pair - truth[:, :-1, :, None] * truth[:, 1:, None, :]).sum((0, 1))
            moves -= RATE * (1 - step / STEPS) * moved / (BATCH * SEQUENCE / 8)
    return Model(languages, weights, moves, lexicons)


def sample_runs(text: str) -> str:
    """A text's words, or if it is long, ``RUNS`` runs of ``SEQUENCE`` words evenly spread over it."""
    words = [w for w in words_of(text) if len(w) <= LONGEST]
    if len(words) > RUNS * SEQUENCE:
        starts = np.linspace(0, len(words) - SEQUENCE, RUNS).astype(int)
        words = [w for at in starts for w in words[at : at + SEQUENCE]]
    return " ".join(words)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, fold: int = 4, left_out: int = 2) -> Model:
    """Train on a bounded sample of documents outside the held-out fold, chosen by a hash of
    the id. An id with several rows is one document, its least text."""
    rows = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.filter(remainder("doc_id", fold) != left_out)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).select("lang").collect()
    names = [r["lang"] for r in common]
    each = min(per_language, SAMPLE // max(1, len(names)))
    ids = rows.filter(F.col("lang").isin(names)).select("doc_id", "lang").distinct()
    ids = ids.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= each)
    # at most SAMPLE rows: a bounded side
    chosen = rows.join(F.broadcast(ids.drop("n")), ["doc_id", "lang"])
    chosen = chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [sample_runs(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(texts, pa.string())], names=["lang", "text"])

    got = chosen.select("lang", "text").mapInArrow(cut, "lang STRING, text STRING").toArrow().to_pylist()
    return train(sorted((r["lang"], r["text"]) for r in got))


def _evidence(model: Model, words: list[str]) -> list[np.ndarray]:
    score = word_scores(words, model.weights, model.lexicons)
    return [np.exp(score - score.max(1, keepdims=True)).astype(np.float32)]


def word_table(model: Model) -> WordTable:
    return WordTable(lambda words: _evidence(model, words))


def _mass(evidence: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Summed word probabilities of each document by forward-backward.

    Documents come longest first, so those still running are always the first ones.
    """
    start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    k = evidence.shape[1]
    ahead = np.empty_like(evidence)
    current = evidence[start] / evidence[start].sum(1, keepdims=True)
    ahead[start] = current
    running = len(lengths) - np.searchsorted(lengths[::-1], np.arange(1, lengths[0] + 1), side="left")
    for t in range(1, lengths[0]):
        n = running[t]
        at = start[:n] + t
        current = (current[:n] @ moves) * evidence[at]
        current /= current.sum(1, keepdims=True)
        ahead[at] = current
    total = np.zeros((len(lengths), k))
    back = np.ones((len(lengths), k), evidence.dtype)
    for t in range(lengths[0] - 1, -1, -1):
        n = running[t]
        at = start[:n] + t
        word = ahead[at] * back[:n]
        word /= word.sum(1, keepdims=True)
        total[:n] += word
        step = (back[:n] * evidence[at]) @ moves.T
        back[:n] = step / step.sum(1, keepdims=True)
    return total


def predict(texts: list[str | None], model: Model, table: WordTable) -> list[tuple[str, float]]:
    """Language and share of probability mass of each text."""
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    if not model.languages:
        return out
    moves = np.exp(model.moves - model.moves.max()).astype(np.float32)
    usable = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
    split = {i: words_of(texts[i]) for i in usable}
    usable.sort(key=lambda i: -len(split[i]))
    at = 0
    while at < len(usable):
        group, n = [], 0
        while at < len(usable) and (not group or n + len(split[usable[at]]) <= CHUNK):
            group.append(usable[at])
            n += len(split[usable[at]])
            at += 1
        rows = np.concatenate(table.index([split[i] for i in group]))
        lengths = np.array([len(split[i]) for i in group])
        total = _mass(table.columns[0][rows], lengths, moves)
        best = total.argmax(1)
        for j, i in enumerate(group):
            out[i] = model.languages[best[j]], float(min(total[j, best[j]] / lengths[j], 1.0))
    return out


def label_words(text: str, model: Model) -> list[tuple[str, str, float]]:
    """Every word with its most probable language: the labelling of code-switched text."""
    words = words_of(text)
    if not words or not model.languages:
        return [(w, UNKNOWN, 0.0) for w in words]
    score = word_scores(words, model.weights, model.lexicons)
    word, _ = marginals(score[None], model.moves)
    best = word[0].argmax(1)
    return [(w, model.languages[b], float(word[0, i, b])) for i, (w, b) in enumerate(zip(words, best, strict=True))]


_tables: dict = {}


def with_language(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of ``docs`` with ``lang_pred`` and ``score``."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in keep] + ["lang_pred STRING", "score DOUBLE"])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages, whatever the corpus
    model_id = zlib.crc32(model.weights.tobytes())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _tables.get("id") != model_id:
            _tables.update(id=model_id, words=word_table(shared.value))
        for b in batches:
            found = predict(b.column("text").to_pylist(), shared.value, _tables["words"])
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep]
                + [pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    return docs.mapInArrow(add, schema)


def languages(docs: DataFrame, fold: int = 4, left_out: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; a null id is never held out."""
    model = fit(docs, fold=fold, left_out=left_out)
    found = with_language(docs.select("doc_id", "text"), model, ["doc_id"])
    held_out = F.coalesce(remainder("doc_id", fold) == left_out, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")
