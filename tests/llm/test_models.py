"""Learned operators: held-out accuracy, defined results for odd rows, same results twice."""

import numpy as np
import pytest

from auditloom.llm import language, quality, toxicity
from auditloom.llm.folds import fold, held_out, labelled_sample
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def auc(scores, labels):
    scores, labels = np.asarray(scores, float), np.asarray(labels)
    pairs = (scores[labels == 1][:, None] > scores[labels == 0][None, :]) + 0.5 * (
        scores[labels == 1][:, None] == scores[labels == 0][None, :]
    )
    return pairs.mean()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_codewords_differ():
    for n in (2, 3, 4, 7, 8, 30):
        code = language.codewords(n)
        gaps = (code[:, None, :] != code[None, :, :]).sum(axis=2)
        assert gaps[~np.eye(n, dtype=bool)].min() >= (1 if n < 3 else 2)
        assert ((code.sum(axis=0) > 0) & (code.sum(axis=0) < n)).all()


def test_ngrams_do_not_depend_on_chunks(monkeypatch):
    text = cases.messy_rows()[10][1]
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "_CHUNK", 97)
    assert (language.ngram_counts(text) == whole).all()
    assert whole.sum() == 3 * len(text) - 3


def test_languages_of_held_out_texts(spark, docs):
    model = language.train(docs.filter(fold(4) != 2))
    got = language.predict(docs, model).join(docs.select("doc_id", "lang", held_out(4, 2)), "doc_id").toPandas()
    out = got[got.held_out]
    assert (out.lang == out.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()
    # one spoiled bit does not change the language
    text = docs.filter("lang = 'fr' and n_chars > 500").first().text
    counts = language.ngram_counts(text)
    for b in range(model.code.shape[1]):
        trust = model.trust.copy()
        model.slope[b] *= -0.2
        assert model.languages[int(np.argmax(model.probabilities(counts)))] == "fr"
        model.slope[b] /= -0.2
        model.trust = trust
    odd = language.predict(cases.messy(spark), model).collect()
    assert len(odd) == len(cases.messy_rows())
    for r in odd:
        if r.doc_id in (0, 1, 2, 3):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() > 0.97 * docs.count()


def test_languages_without_training_rows(spark):
    for model in (language.train(cases.empty(spark)),):
        assert {r.lang_pred for r in language.predict(cases.messy(spark), model).collect()} == {"und"}
    one = language.train(cases.messy(spark))  # a single language
    assert {r.lang_pred for r in language.predict(cases.messy(spark), one).collect()} <= {"en", "und"}


def test_pairs_of_terms_are_learned():
    draw = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(3000):
        a, b = draw.integers(0, 2, 2)
        noise = 10 + draw.integers(0, 40, 8)
        rows.append(np.unique(np.concatenate([[1] * a, [2] * b, noise]).astype(np.int32)))
        y.append(int(a and b))
    y = np.array(y, dtype=float)
    model = toxicity.fit(rows[:2000], y[:2000], np.ones(2000))
    assert auc([model.score(r) for r in rows[2000:]], y[2000:]) > 0.98


def test_toxicity_of_held_out_texts(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.filter(fold(5) != 0))
    got = toxicity.score(docs, model).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    got = got.filter((fold(5) == 0) & (got.lang == "en")).toPandas()
    assert auc(got.score, got.toxic) > 0.95
    assert got.predicted[got.toxic == 0].mean() < 0.02
    odd = toxicity.score(cases.messy(spark), model).collect()
    assert len(odd) == len(cases.messy_rows())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in odd)


def test_toxicity_of_held_out_texts_in_each_language(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.filter(fold(5) != 0))
    got = toxicity.score(docs, model).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    got = got.filter(fold(5) == 0).toPandas()
    found = got[got.toxic == 1].groupby("lang").predicted.mean()
    assert found["en"] > 0.85 and found["es"] > 0.75 and found["de"] > 0.7 and found["fr"] > 0.85
    assert got.predicted[got.toxic == 0].mean() < 0.01


@pytest.mark.parametrize("seed", [0, 1])
def test_pairs_of_terms_that_say_nothing_alone(seed):
    """Toxic if insult and group mention occur both or neither, among neutral words."""
    draw, rows, y = np.random.default_rng(seed), [], []
    for _ in range(4_000):
        insult, group = draw.integers(0, 2, 2)
        words = [*(1_000 + draw.choice(300, 10, replace=False)), *[1] * insult, *[2] * group]
        rows.append(np.unique(np.array(words, dtype=np.int32)))
        y.append(float(insult == group))
    y = np.array(y)
    model = toxicity.fit(rows[:3_000], y[:3_000], np.ones(3_000))
    right = [(model.score(r) >= 0.5) == label for r, label in zip(rows[3_000:], y[3_000:])]
    assert np.mean(right) > 0.95
    # labels by chance: no pair stands out
    chance = draw.integers(0, 2, 3_000).astype(float)
    assert len(toxicity.telling_pairs(rows[:3_000], chance - 0.5, np.full(3_000, 0.25))) == 0


def test_rare_terms_count_in_samples_of_any_size():
    for n in (400, 4000):
        rows = [np.array([7 + i % 5] + [1] * (i < 4), dtype=np.int32) for i in range(n)]
        rows = [np.unique(r) for r in rows]
        y = (np.arange(n) < 4).astype(float)
        model = toxicity.fit(rows, y, np.ones(n))
        assert model.weights[1] > 0 and model.score(rows[0]) > 2 * model.score(rows[5])


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    model = toxicity.train(cases.messy(spark), none)
    assert {r.predicted for r in toxicity.score(cases.messy(spark), model).collect()} == {0}
    assert toxicity.score(cases.empty(spark), model).collect() == []


def test_samples_are_bounded(spark, labels):
    sample = labelled_sample(labels, "toxic", 20).toPandas()
    assert (sample.groupby("label").size() <= 20).all()
    share = labels.filter("toxic = 1").count() / labels.count()
    weighted = sample[sample.label == 1].weight.sum() / sample.weight.sum()
    assert abs(weighted - share) < 1e-9


def test_quality_of_held_out_texts(spark, docs, labels):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = quality.train(docs, labels.filter(fold(5) != 0), pages)
    got = quality.score(docs, model, pages)
    assert got.count() == docs.count()
    held = got.join(labels.filter(fold(5) == 0), "doc_id").toPandas()
    assert auc(held.score, held.quality) > 0.97
    assert held.keep[held.quality == 1].mean() > 0.95
    odd = quality.score(cases.messy(spark), model).collect()
    assert len(odd) == len(cases.messy_rows())
    assert all(0 <= r.score <= 1 for r in odd)
    assert quality.score(cases.empty(spark), model, pages).collect() == []


def test_views_teach_each_other():
    draw = np.random.default_rng(1)
    y = draw.integers(0, 2, 2000)
    views = tuple(
        np.column_stack([y + 0.4 * draw.normal(size=2000), draw.normal(size=(2000, 20))]).astype(np.float32) for _ in range(2)
    )
    known = np.where(np.arange(2000) < 60, y, -1)
    score = lambda m: quality._margin(views[0], m.text) + quality._margin(views[1], m.metadata)
    alone = auc(score(quality.co_train(views, known, np.ones(2000), rounds=0))[60:], y[60:])
    together = auc(score(quality.co_train(views, known, np.ones(2000)))[60:], y[60:])
    assert together > alone + 0.05 and together > 0.94
