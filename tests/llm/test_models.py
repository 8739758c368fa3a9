"""The two classifiers: held-out accuracy on the given tables, and the numerics behind them."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotebars.llm import labelled as L
from quotebars.llm import quality as Q
from quotebars.llm import toxicity as X
from tests.llm.conftest import AWKWARD

SF = "/root/testdata/sf0.01"


def held_out_pairs(spark, query, target):
    labels = {r.doc_id: r[target] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    return [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]


def test_quality_on_held_out_rows(spark):
    from quotebars.llm.queries import op6_quality
    pairs = held_out_pairs(spark, op6_quality, "quality")
    assert sum(p == y for p, y in pairs) >= 0.95 * len(pairs)


def test_toxicity_on_held_out_rows(spark):
    from quotebars.llm.queries import op7_toxicity
    pairs = held_out_pairs(spark, op7_toxicity, "toxic")
    clean = [p for p, y in pairs if y == 0]
    assert sum(p == y for p, y in pairs) >= 0.9 * len(pairs) and sum(clean) <= 0.02 * len(clean)


def test_awkward_documents_and_labels(spark, documents):
    rng = random.Random(1)
    good = ["The cat sat on the mat, and then it went home. " * rng.randrange(2, 6) + str(i) for i in range(120)]
    bad = ["BUY NOW!! $$$ ### " * rng.randrange(2, 6) + f"vilest{i % 3} word" for i in range(120)]
    texts = AWKWARD + good + bad + [None]
    docs = documents([*enumerate(texts), (None, "nothing known"), (20, texts[20])]).withColumn("score", F.lit("clash")).withColumn("toxicity", F.lit("clash"))
    n = len(AWKWARD)
    rows = [(i, 1, 0) for i in range(n, n + 120)] + [(i, 0, 1) for i in range(n + 120, n + 240)] + [(None, 1, 1), (3, None, None), (4, 7, -1), (n, 1, 0), (9999, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    scores = Q.score_documents(docs, labels).collect()
    assert len(scores) == len(texts) + 2 and all(0 <= r.score <= 1 for r in scores)
    by = {r.doc_id: r.score for r in scores}
    assert min(by[i] for i in range(n, n + 120)) > 0.5 > max(by[i] for i in range(n + 120, n + 240))
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id >= %d AND doc_id < %d" % (n, n + 240)).count() == 121
    toxic = {r.doc_id: r for r in X.toxicity(docs, labels).collect()}
    assert len(toxic) == len(texts) + 1
    assert all((toxic[i].toxicity.score >= 0.7) == (i >= n + 120) for i in range(n, n + 240))
    spans = toxic[n + 121].toxicity.spans
    assert any(texts[n + 121][s.start:s.end].startswith("vilest") for s in spans)
    assert Q.score_documents(docs.limit(0), labels).collect() == [] and X.toxicity(docs.limit(0), labels).collect() == []
    for some in (labels.limit(0), labels.where("quality = 1")):
        assert all(0 <= r.score <= 1 for r in Q.score_documents(docs, some).collect())
        assert all(0 <= r.toxicity.score <= 1 for r in X.toxicity(docs, some).collect())


def test_held_out_rows_are_never_learnt_from(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(None, 1), (0, 1)], "doc_id long, quality int")
    rows = {r.id: r.label for r in L.training_labels(labels, "quality").collect()}
    assert set(rows) == {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert all(v == i % 2 for i, v in rows.items() if i)


def test_statistics_ignore_the_neighbours():
    texts = [(t or "").encode() for t in AWKWARD]
    together = Q.statistics(texts)
    for i, t in enumerate(texts):
        assert np.allclose(Q.statistics([t])[0], together[i]), t
    assert np.isfinite(together).all() and (together[:2] == 0).all()


def test_isotonic_is_the_closest_rising_sequence():
    assert Q.isotonic(np.array([1.0, 3, 2, 2, 5]), np.ones(5)).tolist() == pytest.approx([1, 7 / 3, 7 / 3, 7 / 3, 5])
    rng = np.random.default_rng(3)
    v, w = rng.normal(size=60), rng.uniform(0.5, 2, 60)
    fit = Q.isotonic(v, w)
    assert (np.diff(fit) >= -1e-12).all()
    # the min-max formula
    mean = lambda a, b: np.average(v[a:b + 1], weights=w[a:b + 1])
    assert fit[20] == pytest.approx(max(min(mean(a, b) for b in range(20, 60)) for a in range(21)))


def test_fourier_features_approximate_the_gaussian_kernel(monkeypatch):
    monkeypatch.setattr(Q, "FEATURES", 20000)
    x = np.random.default_rng(0).normal(size=(6, len(Q.STATISTICS)))
    z = Q.fourier(x, np.zeros(x.shape[1]), np.ones(x.shape[1]))[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * Q.WIDTH ** 2))
    assert np.abs(z @ z.T - kernel).max() < 0.05


def test_marginals_equal_the_sum_over_all_taggings():
    rng = np.random.default_rng(5)
    score, moves, length = rng.normal(size=(3, 5)), rng.normal(size=(2, 2)), np.array([5, 3, 1])
    p, steps = X.marginals(score, moves, length)
    for row, n in enumerate(length):
        total, tag, pair = 0.0, np.zeros(n), np.zeros((n - 1, 4))
        for t in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(score[row, k] for k in range(n) if t[k]) + sum(moves[t[k], t[k + 1]] for k in range(n - 1)))
            total += w
            tag += w * np.array(t)
            for k in range(n - 1):
                pair[k, 2 * t[k] + t[k + 1]] += w
        assert np.allclose(p[row, :n], tag / total)
        assert np.allclose(steps[row, :n - 1], pair / total) and not steps[row, n - 1:].any()


def test_marginals_around_markers_equal_those_of_the_whole_text():
    rng = random.Random(6)
    words = [f"w{rng.randrange(50)}" for _ in range(3000)]
    for at in (0, 3, 400, 420, 470, 2999):
        words[at] = "vile"
    text = " ".join(words).encode()
    marker = X.token_features(X.find_words([b"vile"], X.ALNUM))[0, 0]
    field = X.Field(np.array([marker]), np.array([6.0]), -3.0, np.array([[1.0, -1.0], [-1.0, 0.5]]))
    _, tokens, values = X.tag_texts(field, [b"", text, b"only clean words"])
    score = np.where(np.array([w == "vile" for w in words]), 3.0, -3.0)[None]
    p, _ = X.marginals(score, field.moves, np.array([3000]))
    assert np.allclose(values, p[0, tokens], atol=1e-9) and len(tokens) < 400
