"""What toxicity learns from few labelled rows, and from all of them beyond the fitted sample."""

import zlib

import numpy as np
import pytest

from quotebars.llm import toxicity as X


@pytest.mark.parametrize(("size", "recall"), [("sf0.001", 0.4), ("sf0.01", 0.8), ("sf0.1", 0.85)])
def test_recall_and_precision_on_held_out_toxic_rows(spark, size, recall):
    from quotebars.llm.queries import op7_toxicity
    sf = f"/root/testdata/{size}"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    pairs = [(r.predicted, labels[r.doc_id]) for r in op7_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    toxic = [p for p, y in pairs if y == 1]
    assert sum(toxic) >= recall * len(toxic)
    assert sum(toxic) >= 0.9 * sum(p for p, _ in pairs)


def learnt(n):
    """Identifiers that may be learnt from, and that may not."""
    use = [i for i in range(3 * n) if zlib.crc32(str(i).encode()) % 3 != 1]
    return use[:n], [i for i in range(3 * n) if i not in set(use)]


@pytest.mark.parametrize("n_toxic", [3, 4, 6])
def test_a_few_toxic_rows_that_agree_are_enough(spark, documents, n_toxic):
    use, apart = learnt(80)
    texts = {i: f"the cat number{i} sat on the mat and went home with a " + ("vile hat" if k < n_toxic else "nice hat") for k, i in enumerate(use)}
    texts |= {i: "the dog went home with a " + ("vile hat" if k < 5 else "nice hat") for k, i in enumerate(apart[:20])}
    labels = spark.createDataFrame([(i, int(k < n_toxic)) for k, i in enumerate(use)], "doc_id long, toxic int")
    scores = {r.doc_id: r.toxicity.score for r in X.toxicity(documents(list(texts.items())), labels).collect()}
    assert min(scores[i] for i in apart[:5]) >= 0.7 > max(scores[i] for i in apart[5:20])


def test_chance_is_no_marker(spark, documents):
    use, _ = learnt(80)
    rng = np.random.default_rng(2)
    rows = [(" ".join(f"w{v}" for v in rng.integers(0, 400, 30)), int(k < 6)) for k in range(len(use))]
    markers, odds = X.count_markers(spark.createDataFrame(rows, "text string, label int"), "text")
    assert len(markers) == len(odds) == 0


def test_markers_beyond_the_sample_have_weight(spark, documents):
    """Labelled rows outside the fitted sample count too: a marker that only they hold is found."""
    use, apart = learnt(400)
    word = ["vile", "rotten"]
    texts = {i: "the cat sat on the mat and went home again " + (f"you {word[k % 2]} person" if k < 100 else "") for k, i in enumerate(use)}
    texts |= {i: "the dog went home again " + (f"with a {word[k]} friend" if k < 2 else "") for k, i in enumerate(apart[:20])}
    docs = documents(list(texts.items()))
    labels = spark.createDataFrame([(i, int(k < 100)) for k, i in enumerate(use)], "id long, label int")
    markers, odds = X.count_markers(docs.withColumnRenamed("doc_id", "id").join(labels, "id").select("label", "text"), "text")
    names = X.token_features(X.find_words([b"vile rotten"], X.ALNUM))[:, 0]
    assert set(names) <= set(markers) and (odds > 3).all()
    # a training set with the first word only
    field = X.Field(markers, np.zeros(len(markers)), 0.0, np.zeros((2, 2)))
    words = X.find_words([b"the vile cat sat"] * 20, X.ALNUM)
    text, length, piece, place, number = X.cut_pieces(field.find(X.token_features(words)), words.first)
    pieces = X.Pieces(length, piece, place, number, np.ones(20, dtype=int), np.zeros(X.PIECE + 1))
    whole = X.with_unseen(X.train_field(markers, pieces), odds, pieces)
    _, tokens, values = X.tag_texts(whole, [b"the rotten dog went home"])
    assert values[tokens == 1][0] > 0.5


def test_the_driver_gets_marked_pieces_only(spark):
    """Long texts are cut in the tasks; what comes back does not grow with quiet tokens."""
    marker = np.sort(X.token_features(X.find_words([b"vile"], X.ALNUM))[:, 0])
    rows = [("calm " * 30000 + "vile " + "calm " * 10, 1), ("vile calm vile", 0), ("calm " * 65, 1), ("", 0), (None, 1)]
    pieces = X.collect_pieces(spark.createDataFrame(rows, "text string, label int"), marker)
    assert sorted(zip(pieces.length.tolist(), pieces.toxic.tolist(), strict=True)) == [(3, 0), (30011 % X.PIECE, 1)]
    got = {(int(pieces.toxic[p]), int(a)) for p, a in zip(pieces.piece, pieces.place, strict=True)}
    assert got == {(1, 30000 % X.PIECE), (0, 0), (0, 2)} and (pieces.number == 0).all()
    assert pieces.quiet[X.PIECE] == 30011 // X.PIECE + 1 and pieces.quiet[1] == 1 and pieces.quiet.sum() == 30011 // X.PIECE + 2
