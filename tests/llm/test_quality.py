"""The additive quality model: its parts by hand, held-out accuracy, odd tables."""

from __future__ import annotations

import numpy as np
import pytest

from conftest import SF_DIR
from flowlantern.llm import quality, queries
from flowlantern.llm.common import read


def test_features_of_small_texts():
    found = dict(zip(quality.NAMES, quality.features("Ab, ab ab ab!\nAb, ab ab ab!\n12"), strict=True))
    assert found["share_digit"] == 2 / 30 and found["share_upper"] == 2 / 30 and found["share_mark"] == 4 / 30
    assert found["pair_mark_blank"] == 4 / 30 and found["pair_upper_lower"] == 2 / 30
    assert found["log_words"] == pytest.approx(np.log(10)) and found["distinct_words"] == 4 / 9 and found["top_word"] == 4 / 9
    assert found["repeated_lines"] == pytest.approx(1 / 3) and found["sentence_words"] == 9 / 2
    assert quality.features(None) == quality.features("") and np.isfinite(quality.features("")).all()
    assert np.isfinite(quality.features("\ud800 é漢🙂")).all()


def test_pieces_of_long_texts(monkeypatch):
    text = "Straße AB ab!! 12 漢 " * 50
    whole = quality.features(text)
    monkeypatch.setattr(quality, "PIECE", 7)
    assert quality.features(text) == pytest.approx(whole)


def test_trees():
    g, h = np.array([-4.0, -4, 4, 4, 0, 0]), np.full(6, 4.0)
    assert quality.tree(g, h).tolist() == [0.8, 0.8, -0.8, -0.8, 0, 0]
    g = np.array([[-4.0, 4], [4, -4]])
    gain, values = quality.square(g, np.full((2, 2), 6.0))
    assert gain == 8 and values.tolist() == [[0.5, -0.5], [-0.5, 0.5]]


def test_a_pair_is_learned_where_single_numbers_say_nothing():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(4000, 4))
    y = ((rows[:, 1] > 0) ^ (rows[:, 3] > 0)).astype(float)
    model = quality.fit(rows, y)
    test = rng.normal(size=(1000, 4))
    truth = (test[:, 1] > 0) ^ (test[:, 3] > 0)
    assert (1, 3) in model.double and ((model.score(test) >= 0.5) == truth).mean() > 0.9
    one = model.base + sum(t[b] for t, b in zip(model.single, model.bins(test[:1])[0], strict=True))
    one += sum(t[model.bins(test[:1])[0][a], model.bins(test[:1])[0][b]] for (a, b), t in model.double.items())
    assert model.log_odds(test[:1])[0] == pytest.approx(one)


def test_held_out_accuracy(spark):
    sf_dir = SF_DIR.replace("0.001", "0.1")
    found = queries.QUERIES["op12_quality"](spark, sf_dir).where("held_out").toPandas()
    found = found.merge(read(spark, sf_dir, "labels").select("doc_id", "quality").toPandas(), on="doc_id")
    right, common = (found.predicted == found.quality).mean(), found.quality.mean()
    assert len(found) > 1000 and right > common + 0.04
    good, bad = found.score[found.quality == 1].to_numpy(), found.score[found.quality == 0].to_numpy()
    assert (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean() > 0.8


def test_odd_tables(spark):
    rows = [(1, "Good text here."), (2, None), (3, ""), (None, "no id"), (4, "x " * 50_000), (4, "x"), (4, "x")]
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, quality string, features string")
    labels = [(1, 1, "a"), (2, 0, "a"), (2, 0, "a"), (3, None, "a"), (None, 1, "a"), (4, 7, "a"), (4, 0, "a"), (4, 1, "a"), (9, 1, "a")]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    model = quality.train(docs, labels)
    found = [r.s for r in docs.select(quality.scored("text", model, spark).alias("s")).collect()]
    assert len(found) == len(rows) and all(0 <= s <= 1 for s in found) and found[1] == found[2]
    none = quality.train(docs, labels.where("false"))
    assert [r.s for r in docs.select(quality.scored("text", none, spark).alias("s")).collect()] == [0.5] * len(rows)
    ones = quality.train(docs, labels.where("quality = 1"))
    assert {r.s > 0.99 for r in docs.select(quality.scored("text", ones, spark).alias("s")).collect()} == {True}
    assert docs.where("false").select(quality.scored("text", model, spark).alias("s")).count() == 0


def test_the_sample_is_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 5, f"text {i}") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality int")
    asked = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, y: asked.append(len(rows)) or fit(rows, y))
    for bound in (3, 100):
        quality.train(docs, labels, max_rows=bound)
    assert asked == [3, 100]
