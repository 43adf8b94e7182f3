"""Learned operators: held-out accuracy, exactness of their inference, and odd rows."""

import itertools
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapdelta.llm import language_id, quality_classifier

SF_DIR = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")
need_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def table(spark, name):
    from snapdelta.llm.common import ship

    ship(spark)
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@need_data
def test_quality_on_the_held_out_fold(spark):
    labels = table(spark, "labels")
    scored = quality_classifier.quality_scores(table(spark, "documents"), labels)
    assert scored.count() == table(spark, "documents").count()
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_of_odd_rows(spark, corpus, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(19)] + [(None, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id BIGINT, quality INT, toxic INT")
    rows = quality_classifier.quality_scores(corpus, labels).collect()
    assert len(rows) == corpus.count() and all(0 <= r["score"] <= 1 for r in rows)
    same = {r["score"] for r in rows if r["doc_id"] in (0, 1, 2)}
    assert len(same) == 1  # null, empty and blank texts get the bias
    assert quality_classifier.quality_scores(empty, labels).count() == 0
    none = quality_classifier.quality_scores(corpus, labels.filter("doc_id < 0")).collect()
    assert {r["score"] for r in none} == {0.5}
    kept = quality_classifier.keep_good(corpus, corpus, labels)
    assert kept.columns == corpus.columns


def test_score_is_the_average_over_all_features():
    rng = np.random.default_rng(2)
    model = quality_classifier.Model(rng.standard_normal(quality_classifier.BUCKETS), 0.1)
    words = quality_classifier.WordTable(lambda w: quality_classifier._word_scores(model, w))
    texts = ["a b c", "a", "", None, "x " * 5000, "é ñ\nq"]
    for text, score in zip(texts, quality_classifier.score_texts(texts, model, words), strict=True):
        ids, n = quality_classifier.bag(text)
        assert score == pytest.approx(model.score(float(model.weights[ids] @ n) if len(ids) else 0.0, int(n.sum())))


@need_data
def test_language_on_the_held_out_fold(spark):
    docs = table(spark, "documents")
    found = language_id.languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_letters_are_category_l(spark):
    """Number signs are no letters, neither in training nor in prediction."""
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, "Ⅷ ①", "en"), (101, "½ ² 12", "de"), (102, "Ⅷ der hund", "de"), (103, "ª", "en"), (104, "ʰ the", "en"), (105, "_ 9", "en")]
    found = {r["doc_id"]: r for r in language_id.languages(spark.createDataFrame(rows, "doc_id INT, text STRING, lang STRING")).collect()}
    assert {i for i, r in found.items() if r["lang_pred"] == "und"} == {100, 101, 105}
    assert found[102]["lang_pred"] == "de" and found[104]["lang_pred"] == "en"


def test_many_languages_and_long_texts_reach_the_driver_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 6)
    rows = [(i, f"w{i} x{i}", f"l{i}") for i in range(5000)]
    rows += [(5000 + i, "the cat and the dog " * 250_000 + "q" * 1000, "en") for i in range(3)] + [(6000 + i, "der hund", "de") for i in range(8)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id INT, text STRING, lang STRING").repartition(4))
    assert len(model.languages) == language_id.MOST_LANGUAGES and {"en", "de"} <= set(model.languages)
    runs = language_id.sample_runs("a b " * 500_000 + "q" * 1000).split()
    assert len(runs) == language_id.RUNS * language_id.SEQUENCE
    ids, n = quality_classifier.training_bag(" ".join(f"word{i}" for i in range(60_000)))
    assert len(ids) == quality_classifier.MAX_FEATURES == len(n)


@need_data
def test_code_switched_words(spark):
    rows = table(spark, "documents").filter("lang IN ('en', 'de')").orderBy("doc_id").limit(160).collect()
    model = language_id.train([(r["lang"], r["text"]) for r in rows[:120]])
    parts = {lang: [r["text"].split()[5:35] for r in rows[120:] if r["lang"] == lang and len(r["text"].split()) > 40] for lang in ("en", "de")}
    right = total = 0
    for a, b in itertools.islice(zip(parts["en"], parts["de"], strict=False), 8):
        labels = language_id.label_words(" ".join(a + b), model)
        want = ["en"] * len(a) + ["de"] * len(b)
        right += sum(x[1] == w for x, w in zip(labels, want, strict=True))
        total += len(want)
    assert total and right / total > 0.9
    assert np.diag(model.moves).min() > max(model.moves[0, 1], model.moves[1, 0])  # neighbours tend to agree


def test_forward_backward_is_exact():
    rng = np.random.default_rng(5)
    score, moves = rng.standard_normal((1, 4, 3)), rng.standard_normal((3, 3))
    word, pair = language_id.marginals(score, moves)
    total, want, want_pair = 0.0, np.zeros((4, 3)), np.zeros((3, 3, 3))
    for path in itertools.product(range(3), repeat=4):
        p = np.exp(sum(score[0, i, s] for i, s in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
        total += p
        for i, s in enumerate(path):
            want[i, s] += p
        for i, (a, b) in enumerate(itertools.pairwise(path)):
            want_pair[i, a, b] += p
    assert np.allclose(word[0], want / total) and np.allclose(pair[0], want_pair / total)
    mass = language_id._mass(np.exp(np.concatenate([score[0], score[0][:2]])), np.array([4, 2]), np.exp(moves))
    assert np.allclose(mass[0], (want / total).sum(0))
    assert np.allclose(mass[1], language_id.marginals(score[:, :2], moves)[0][0].sum(0))


def test_language_of_odd_rows(spark, corpus, empty):
    rows = language_id.languages(corpus).collect()
    assert len(rows) == corpus.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (0, 1, 2))
    assert {r["lang_pred"] for r in rows} <= {"und", "en", "fr"}
    assert by_id[None]["held_out"] is False
    assert language_id.languages(empty).count() == 0
    unlabelled = language_id.languages(corpus.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_training_rows_are_bounded_when_an_id_repeats(spark, corpus, monkeypatch):
    """One id with most of the rows is one training document."""
    rows = [(2, "the same text", "en")] * 300 + [(i, f"text number {i} of many", "en") for i in range(3, 120)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    monkeypatch.setattr(language_id, "train", lambda got: got)
    got = language_id.fit(docs, per_language=50)
    assert len(got) == len(set(got)) == 50
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 120)] + [(2, 0, 0)] * 100, "doc_id BIGINT, quality INT, toxic INT")
    monkeypatch.setattr(quality_classifier, "train", lambda bags, labels: (bags, labels))
    assert len(quality_classifier.fit(docs, labels, max_train=40)[1]) <= 40
    assert len(quality_classifier.fit(docs, labels, max_train=4000)[1]) == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(2, 120))
