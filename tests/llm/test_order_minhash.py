"""Order MinHash against a version with Python lists, and its properties."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotebars.llm import order_minhash as O
from tests.llm.conftest import AWKWARD, SF

SCHEMA = "doc_id long, text string, fingerprint string, edge string, `a.b` int"
FULL = 1 << 64


def mixed(x):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ x >> 33) * factor % FULL
    return x ^ x >> 33


def polynomial(codes):
    h = 0
    for c in codes:
        h = (h * 0x9E3779B97F4A7C15 + c) % FULL
    return mixed(h)


def signature(text, k=O.K, size=O.TUPLE, n=O.PERMUTATIONS):
    """Every k-mer with its number, every permutation sorted in full."""
    codes, count, grams = [ord(c) for c in text], {}, []
    k = min(k, len(codes))
    for i in range(len(codes) - k + 1 if codes else 0):
        gram = tuple(codes[i:i + k])
        count[gram] = count.get(gram, -1) + 1
        h = polynomial(gram)
        if count[gram]:
            h ^= mixed(count[gram] * 0x9E3779B97F4A7C15 % FULL)
        grams.append(mixed(h) >> 32)
    out = []
    for i in range(n):
        factor = mixed((i + 1) * 0x9E3779B97F4A7C15 % FULL) >> 32 | 1
        chosen = sorted(sorted(range(len(grams)), key=lambda p: (grams[p] * factor % (1 << 32), p))[:size])
        entry = size
        if not chosen:
            entry = mixed(entry)
        for p in chosen:
            entry = mixed((entry + 0x9E3779B97F4A7C15) % FULL ^ grams[p])
        out.append(f"{entry >> 32:08x}")
    return "".join(out)


def alike(a, b):
    return sum(a[i:i + 8] == b[i:i + 8] for i in range(0, len(a), 8)) / (len(a) // 8)


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA).repartition(parts)


def brute(rows):
    texts = [(i, t or "") for i, t in rows]
    prints = [signature(t) for _, t in texts]
    out = []
    for at, (i, text) in enumerate(texts):
        after = (at + 1) % len(texts)
        third = len(text) // 3
        edited = text[:len(text) - third] + texts[after][1][:third]
        signed = signature(edited)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[at], signed, alike(prints[at], signed), alike(prints[at], prints[after])))
    return out


def test_every_column_equals_the_plain_version(spark):
    rng = random.Random(2)
    words = ["ba", "bana", "banana ", "é", "日本 ", "na\n", "x"]
    texts = [t for t in AWKWARD if t is None or len(t) < 3000] + ["".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(60)]
    ids = rng.sample(range(-500, 500), len(texts))
    rows = sorted(zip(ids, texts, strict=True), reverse=True)
    got = {r.doc_id: tuple(r) for r in O.compare_with_splices(frame(spark, rows)).collect()}
    want = {r[0]: r for r in brute(rows)}
    assert got == want


@pytest.mark.parametrize("rows", [[(1, "one text only, after itself")], [(1, None)], [(2, "ab"), (1, None)]])
def test_few_rows(spark, rows):
    assert sorted(map(tuple, O.compare_with_splices(frame(spark, rows)).collect())) == sorted(brute(rows))


def test_empty_table_null_and_repeated_identifiers(spark):
    assert O.compare_with_splices(frame(spark, [])).collect() == []
    rows = [(None, "a text without an identifier"), (None, "another one"), (5, "twice the same"), (5, "twice the same"), (5, "other text"), (9, "nine lives")]
    got = [tuple(r) for r in O.compare_with_splices(frame(spark, rows)).collect()]
    assert sorted((r[0] is None, r[0] or 0, r[3]) for r in got) == sorted((i is None, i or 0, signature(t)) for i, t in rows)
    after_itself = [r for r in got if r[3] == signature("twice the same") and r[6] == 1.0]
    assert len(after_itself) == 1 and all(r[5] <= 1 for r in got)


def test_blocks_and_pieces_of_long_texts(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choices("abc de", k=9000))
    want = signature(text)
    for block, offers in ((64, 4), (1000, 256), (O.BLOCK, O.OFFERS)):
        monkeypatch.setattr(O, "BLOCK", block)
        monkeypatch.setattr(O, "OFFERS", offers)
        sketch = O.Sketcher()
        assert sketch(O.code_points(text)).astype(">u4").tobytes().hex() == want
        assert O.Seen(1, text, sketch).print.astype(">u4").tobytes().hex() == want


def test_order_counts_and_sets_don_t():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(400)]
    sketch = O.Sketcher()
    near = lambda a, b: np.mean(sketch(O.code_points(a)) == sketch(O.code_points(b)))
    text, turned = " ".join(words), " ".join(words[200:] + words[:200])
    changed = " ".join(w if i % 40 else "changed" for i, w in enumerate(words))
    assert near(text, text) == 1
    assert near(text, changed) > 0.75
    assert 0.3 < near(text, turned) < 0.7          # the same k-mers, half of the pairs in the other order
    assert near(text, " ".join(reversed(words))) < 0.1
    assert near(text, " ".join("".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(400))) < 0.05


def test_fingerprints_and_likeness_columns(spark):
    docs = frame(spark, [(i, t) for i, t in enumerate(AWKWARD)])
    got = O.fingerprints(docs)
    assert sorted(got.columns) == sorted(docs.columns) and got.select("edge").distinct().first()[0] == "clash"
    rows = {r.doc_id: r for r in got.collect()}
    small = [i for i, t in enumerate(AWKWARD) if len(t or "") < 3000]
    assert all(rows[i].fingerprint == signature(AWKWARD[i] or "") for i in small)
    met = got.alias("a").join(got.alias("b"), F.expr("a.doc_id = b.doc_id + 1")).select(
        "a.doc_id", O.likeness(F.col("a.fingerprint"), F.col("b.fingerprint")).alias("near")).collect()
    for r in met:
        assert r.near == alike(rows[r.doc_id].fingerprint, rows[r.doc_id - 1].fingerprint)


def test_splices_are_nearer_than_neighbours(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r for r in O.compare_with_splices(docs).collect() if r.n_chars >= 12]
    assert sum(r.near_edited > r.near_next for r in rows) >= 0.99 * len(rows)


def test_edges_are_closed_in_as_many_tasks_as_there_are_slots(spark):
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    rows = [(i, f"the text of document {i}") for i in range(20, 0, -1)]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = O.compare_with_splices(frame(spark, rows))
        slots = spark.sparkContext.defaultParallelism
        assert got.rdd.getNumPartitions() <= 3 * slots      # those of the pairs and of the edges
        assert sorted(map(tuple, got.collect())) == sorted(brute(rows))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
