import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prefkit.llm import quality
from prefkit.llm.textblocks import text_bytes
from cases import ODD_ROWS


def features(texts):
    return quality.features(*text_bytes(pa.array(texts, pa.string())))


@pytest.fixture(scope="module")
def corpus(prose):
    def poor(i):
        words = prose(20 + i % 30, i).split()
        return [" ".join(w + "!!" for w in words).upper(), " ".join(w for w in words for _ in range(3)), " | ".join(words)][i % 3]

    rows = [(i, poor(i) if i % 6 == 0 else prose(20 + i % 60, i), "en", "a") for i in range(420)]
    return rows, [(i, int(i % 6 != 0), 0) for i, *_ in rows]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, documents, corpus):
    rows, marks = corpus
    ranking = quality.trained_on(documents(rows), labels(spark, marks), ~quality.is_held_out(3, 1))
    got = quality.score(documents(rows), ranking).withColumn("held", quality.is_held_out(3, 1)).collect()
    held = [r for r in got if r["held"]]
    want = {i: q for i, q, _ in marks}
    assert sum(r["predicted"] == want[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_fit_prefers_and_thresholds_by_quantile():
    draw = np.random.default_rng(1)
    good = draw.random(600) < 0.7
    x = draw.normal(size=(600, 4))
    x[:, 2] += 1.5 * good
    r = quality.fit_ranking(x, good)
    assert r.weights[2] > 5 * np.abs(np.delete(r.weights, 2)).max()
    assert abs((r.score(x) < 0.5).mean() - (~good).mean()) < 0.01
    again = quality.fit_ranking(x, good)
    assert np.array_equal(again.weights, r.weights)


def test_weights_are_the_optimum_of_the_pairs():
    """The pairs drawn again, one by one: the gradient of their penalised loss is zero, and no step lowers it."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(40, 5))
    good = np.arange(40) % 3 > 0
    x[good, 1] += 1.0
    r = quality.fit_ranking(x, good, pairs=5000)
    z = np.clip((x - r.mean) / r.spread, -8, 8)
    again = np.random.Generator(np.random.PCG64(quality.SEED))
    above, below = again.choice(np.flatnonzero(good), 5000), again.choice(np.flatnonzero(~good), 5000)

    def loss(w):
        return sum(math.log1p(math.exp(-float(w @ (z[a] - z[b])))) for a, b in zip(above, below)) / 5000 + quality.PENALTY / 2 * w @ w

    least = loss(r.weights)
    for i in range(5):
        step = np.eye(5)[i] * 1e-3
        assert loss(r.weights + step) > least and loss(r.weights - step) > least
        assert abs(loss(r.weights + step) - loss(r.weights - step)) / 2e-3 < 1e-5


@pytest.mark.parametrize("good,predicted", [([True] * 4, 1), ([False] * 4, 0), ([], 1)])
def test_labels_of_one_kind(good, predicted):
    x = np.arange(4.0 * len(good)).reshape(len(good), 4) if good else np.zeros((0, len(quality.FEATURES)))
    r = quality.fit_ranking(x, np.array(good, bool))
    probe = np.zeros((1, x.shape[1]))
    assert int(r.score(probe)[0] >= 0.5) == predicted


def test_features_by_hand():
    x = features(["aa aa BB|", "", None, "ab\nxyz\nxyz"])
    name = quality.FEATURES.index
    assert x[0, name("repeated_word")] == pytest.approx((1 / 3) ** 0.5)
    assert x[0, name("upper")] == pytest.approx((2 / 9) ** 0.5)
    assert x[0, name("mark_|")] == pytest.approx((1 / 9) ** 0.5)
    assert x[0, name("ends_in_mark")] == pytest.approx((1 / 3) ** 0.5)
    assert x[3, name("seen_line")] == pytest.approx((1 / 2) ** 0.5)
    assert not x[1].any() and not x[2].any()


def test_features_do_not_depend_on_the_block(prose):
    texts = [prose(30, i) + ("!" * i) for i in range(12)] + [""]
    assert np.allclose(features(texts), np.concatenate([features([t]) for t in texts]))


def test_odd_rows(spark, documents, corpus):
    rows, marks = corpus
    marks = [*marks, (None, 1, 0), (5, None, 0), (2, 0, 0), (2, 1, 0)]
    ranking = quality.trained_on(documents(rows), labels(spark, marks), F.lit(True))
    got = quality.score(documents(ODD_ROWS), ranking).collect()
    assert len(got) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in got)
    docs = documents([*rows, (None, rows[1][1], "en", "a")])
    kept = quality.keep_good(docs, labels(spark, marks))
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert None in ids and sum(i % 6 == 0 for i in ids if i is not None) < 5
    assert quality.score(documents([]), ranking).count() == 0
    assert quality.keep_good(documents([]), labels(spark, [])).count() == 0
