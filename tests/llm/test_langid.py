"""The sparse SVM against a dense one, and more languages than one pass takes."""

import random

import numpy as np

from gleaner.llm import langid


def test_svm_by_dense_steps():
    draw = np.random.default_rng(0)
    dense = (draw.random((40, langid.DIMS)) < 0.004) * draw.random((40, langid.DIMS))
    dense[:, 0] += 0.1
    y = np.where(np.arange(40) % 3 == 0, 1.0, -1.0)
    dense[y > 0, 1:9] += 0.5
    rows = [np.flatnonzero(x) for x in dense]
    bounds = np.cumsum([0, *map(len, rows)])
    w, bias = langid.fit_svm(np.concatenate(rows), np.concatenate([x[r] for x, r in zip(dense, rows)]).astype(np.float32), bounds, y)
    assert (np.sign(dense @ w + bias) == y).all()
    # At the optimum the gradient of the objective vanishes.
    scale = np.linalg.norm(dense, axis=1).mean()
    x, v = np.hstack([dense / scale, np.ones((40, 1))]), np.append(w * scale, bias)
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    loss = lambda v: (weight * np.maximum(0, 1 - y * (x @ v)) ** 2).sum() + langid.RIDGE / 2 * v @ v
    assert loss(v) < 0.05 * loss(np.zeros(len(v))) and loss(v) <= min(loss(v * 0.9), loss(v * 1.1)) + 1e-4


def test_eighty_languages_in_passes(spark, monkeypatch):
    draw = random.Random(4)
    syllables = {f"l{k:02d}": ["".join(draw.choice("abcdefghijklmnoprstuvz") for _ in range(3)) for _ in range(12)] for k in range(80)}
    rows = [(i, " ".join("".join(draw.choice(syllables[x]) for _ in range(2)) for _ in range(40)), x) for i, x in enumerate(list(syllables) * 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(df.where("floor(doc_id / 80) <> 3"), "doc_id", "text", "lang")
    assert len(model["langs"]) == 80 and len(model["pairs"]) == 80 * 79 // 2
    monkeypatch.setattr(langid, "PAIRS_AT_ONCE", 1500)
    truth = {i: x for i, _, x in rows}
    got = langid.predict(df, model, "doc_id", "text").collect()
    assert len(got) == len(rows) and sum(r.lang_pred == truth[r.id] for r in got) > 0.95 * len(rows)
    monkeypatch.setattr(langid, "PAIRS_AT_ONCE", 10**6)
    once = {r.id: (r.lang_pred, round(r.score, 9)) for r in langid.predict(df, model, "doc_id", "text").collect()}
    assert {r.id: (r.lang_pred, round(r.score, 9)) for r in got} == once


def test_bound_holds_for_one_id(spark):
    """An id that very many rows have brings no more rows than the bound into the fit."""
    rows = [(1, f"the text of the one and only {i}", "en") for i in range(300)] + [(2, f"der text des einen und anderen {i}", "de") for i in range(30)] + [(None, "le texte et la phrase", "fr")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), "doc_id", "text", "lang", per_language=20)
    got = langid.predict(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), model, "doc_id", "text").collect()
    assert sum(r.lang_pred == "en" for r in got) == 300 and model["langs"] == ["de", "en", "fr"]
