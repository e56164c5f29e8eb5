"""Language network and quality vote: gradients, brute force, held-out accuracy, edge cases."""

import zlib
from collections import Counter

import numpy as np
import pytest

from serieslake.llm import language, quality
from serieslake.llm.common import table

ODD = [(None, None, None), (1, None, "en"), (2, "", "en"), (3, " \n", None), (4, "12 345 !!", "de"), (5, "the and of " * 3000, "en"), (5, "the and of " * 3000, "en")]


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    net = language.Network(*(a.astype(np.float64) for a in language.Network.random(4, 3, 1)))
    windows, label = rng.integers(0, 257, (7, 5)), rng.integers(0, 3, 5)
    counted = (windows != 256).astype(float)
    _, slope = language.gradients(net, windows, label, counted)
    for k, a in enumerate(net):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in a.shape)
            kept, values = a[at], []
            for step in (1e-3, -1e-3):
                a[at] = kept + step
                values.append(language.gradients(net, windows, label, counted)[0])
            a[at] = kept
            assert (values[0] - values[1]) / 2e-3 == pytest.approx(slope[k][at], abs=3e-4)


def test_reader_equals_plain_passes():
    net = language.Network.random(8, 4, 2)
    texts = ["Ein kurzer Text", "", "x", "Überlänge, naïve " * 70]
    got = language.Reader(net).probabilities(texts, most=2)
    for text, chance in zip(texts, got, strict=True):
        data, total = text.encode(), np.zeros(4)
        for start in range(0, len(data), language.WINDOW):
            span = range(start - language.LEAD, start + language.WINDOW + language.LEAD)
            window = np.array([data[i] if 0 <= i < len(data) else 256 for i in span])[:, None]
            states, _ = language.forward(net, window)
            logits = states[0] @ net.output[0] + states[1] @ net.output[1] + net.bias
            inner = language._softmax(logits)[language.LEAD : language.LEAD + language.WINDOW, 0]
            total += inner[: len(data) - start].sum(0)
        assert chance == pytest.approx(total / max(1, len(data)), abs=1e-4)


def test_language_is_right_on_held_out_rows(spark, sf):
    docs = table(spark, sf, "documents")
    rows = language.predict(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
    held = [row.lang_pred == row.lang for row in rows if row.held_out]
    assert np.mean(held) > 0.9


def test_language_edge_cases(spark, frame):
    net = language.Model(language.Network.random(8, 2, 1), ["de", "en"])
    docs = frame("doc_id long, text string, lang string, score string", *[(*r, "x") for r in ODD])
    rows = language.predict(docs, net).collect()
    assert [(r.doc_id, r.lang_pred == "und") for r in rows] == [(i, t is None or not any(c.isalpha() for c in t)) for i, t, _ in ODD]
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    kept = language.keep_identified(docs, net, 0.0)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [5, 5]
    empty = frame("doc_id long, text string, lang string")
    none = language.fit(empty)
    assert none.net is None and language.predict(empty, none).count() == 0
    assert {r.lang_pred for r in language.predict(docs, none).collect()} == {"und"}


def test_every_language_is_learnt(frame):
    """Three hundred languages, one of them with most rows; sizes follow the number."""
    rng = np.random.default_rng(4)
    names = [f"l{k:03d}" for k in range(300)]
    rows = [(k, " ".join("".join(rng.choice([chr(0x4E00 + 3 * lang + j) for j in range(3)], 4)) for _ in range(20)), names[lang]) for k, lang in enumerate(rng.permutation(np.repeat(np.arange(300), 8)))]
    rows += [(10_000 + k, "same words again", "l000") for k in range(4000)] + [(7, None, "l299"), (8, "x", None)]
    docs = frame("doc_id long, text string, lang string", *rows)
    picked = language.sample(docs, 1200, 3000, 64)
    found = Counter(row.lang for row in picked)
    assert set(found) == set(names) and max(found.values()) == 10 and len({row.key for row in picked}) == len(picked)
    model = language.fit(docs, most_texts=3000, steps=2)
    assert model.languages == names and model.net.output.shape == (2, 36, 300)
    assert language.sizes(4) == {"hidden": 8, "steps": 450, "batch": 128} and language.sizes(300)["steps"] == 2025
    assert language.least_probability(model) == 0.004 and language.least_probability(language.Model(None, ["en"])) == 0.3
    assert {r.lang_pred for r in language.predict(docs.filter("doc_id < 20 and text is not null"), model).collect()} <= set(names)


def test_equal_probabilities_fall_to_the_first_language(frame):
    net = language.Network(*(np.zeros_like(a) for a in language.Network.random(8, 3, 1)))
    model = language.Model(net, ["aa", "bb", "cc"])
    (row,) = language.predict(frame("doc_id long, text string", (1, "some text")), model).collect()
    assert row.lang_pred == "aa" and row.score == pytest.approx(1 / 3, abs=1e-6)


def test_one_repeated_text_is_learnt(frame):
    docs = frame("doc_id long, text string, lang string", *[(1, "the only text of this language", "xx")] * 3000, *[(k, "un texte", "fr") for k in range(50)])
    assert {row.lang for row in language.sample(docs, 10, 100, 64)} == {"fr", "xx"}


def test_quality_scores_a_very_long_text(frame):
    good, bad = "Plain words, and a sentence. Another one here.", "WIN!! NOW!! $$$ | click | here | !!"
    docs = frame("doc_id long, text string", *[(k, good if k % 2 else bad) for k in range(40)], (100, (good + " ") * 60_000), (101, (bad + " ") * 60_000))
    labels = frame("doc_id long, quality int", *[(k, k % 2) for k in range(40)])
    got = {r.doc_id: r.predicted for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert got[100] == 1 and got[101] == 0


def test_quality_is_right_on_held_out_rows(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows if r.held_out]) > 0.85


def test_quality_votes_equal_brute_force(spark, frame):
    good, bad = "Plain words, and a sentence. Another one here.", "WIN!! NOW!! $$$ | click | here | !!"
    docs = frame("doc_id long, text string, quality int", *[(i, (good if i % 3 else bad) * (1 + i % 4), 9) for i in range(60)], (60, None, 9), (60, "", 9), (None, bad, 9))
    labels = frame("doc_id long, quality int, toxic int", *[(i, int(i % 3 > 0), 0) for i in range(50)], (7, 1, 0), (8, None, 0), (9, 5, 0), (999, 0, 0), (None, 1, 0))
    model = quality.fit(docs, labels)
    texts = [r.text or "" for r in docs.collect()]
    got = quality.scores(model, texts, block=7)
    for text, score in zip(texts, got, strict=True):
        if not text.strip():
            assert score == model.share
            continue
        weighted = np.log1p(quality.term_counts(text)[model.terms]) * model.weight
        for half in (weighted[: model.shapes], weighted[model.shapes :]):  # shapes and words weigh the same
            half /= max(np.linalg.norm(half), 1e-12)
        vector = weighted @ model.project
        cosine = model.vectors @ (vector / np.linalg.norm(vector))
        near = np.argsort(-cosine, kind="stable")[: model.neighbours]
        votes = (np.maximum(cosine[near], 0)[:, None] ** 8 * model.votes[near]).sum(0)
        assert score == pytest.approx(votes[1] / votes.sum(), abs=1e-4)
        assert (score >= 0.3) == text.startswith("Plain")
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(60) if i % 3} | {60}


def test_quality_without_labels(spark, frame):
    docs, labels = frame("doc_id long, text string"), frame("doc_id long, quality int")
    assert quality.fit(docs, labels) is None
    assert quality.score(docs, None).count() == 0
    assert [r.score for r in quality.score(frame("doc_id long, text string", (1, "x")), None).collect()] == [0.5]


def test_quality_tells_vocabularies_apart(frame):
    rng = np.random.default_rng(6)
    words = {1: ["river", "stone", "house", "light"], 0: ["cheap", "pills", "bonus", "click"]}  # of one shape
    rows = [(k, " ".join(rng.choice(words[k % 2], 40)), k % 2) for k in range(200)]
    docs, labels = frame("doc_id long, text string", *[r[:2] for r in rows]), frame("doc_id long, quality int", *[(r[0], r[2]) for r in rows])
    got = {r.doc_id: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert any(r.held_out for r in got.values())
    assert all(got[k].predicted == label for k, _, label in rows)
