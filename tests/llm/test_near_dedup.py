import random
import re

import numpy as np
import pytest

from quotebars.llm import near_dedup as N
from quotebars.llm.components import components
from tests.llm.conftest import AWKWARD, lower


def brute(rows, size, share):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[i] = {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()
    group = {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and share[1] * both >= share[0] * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                group[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("size,share", [(3, (85, 100)), (5, (80, 100))])
def test_components_equal_brute_force(spark, documents, size, share):
    rng = random.Random(size)
    texts = list(AWKWARD)
    for family in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([20, 120, 300]))]
        texts += [" ".join(base)] + [edited(rng, base, rng.choice([0, 1, 2, 3, 5, 8])) for _ in range(12)]
    # a chain: neighbours are linked, the ends are not
    chain = [f"c{i}" for i in range(200)]
    for k in range(12):
        texts.append(" ".join([f"k{i}" for i in range(3 * k)] + chain[3 * k:]))
    rng.shuffle(texts)
    docs = documents(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_groups(docs, size, share).collect()}
    assert got == brute(list(enumerate(texts)), size, share)
    left = N.near_dedup(docs, size, share)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, (_, c) in got.items() if i == c}


def test_large_family_without_its_centre(spark, documents):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = [edited(rng, base, 3) for _ in range(150)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_groups(documents(texts), 3, (85, 100)).collect()}
    assert got == brute(list(enumerate(texts)), 3, (85, 100))


def test_repeated_and_null_identifiers_and_empty_table(spark, documents):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = N.near_groups(documents([(1, a), (1, a), (2, b), (None, a), (7, a), (9, None)]), 3, (85, 100)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in rows if r.doc_id is not None) == [
        (False, 1, 1), (False, 1, 1), (False, 2, 2), (False, 7, 1), (False, 9, 9)]
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert N.near_groups(documents([]).limit(0), 3, (85, 100)).collect() == []


def test_registers_agree_as_often_as_sets_overlap_and_merge():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    b = np.concatenate([a[:3400], rng.integers(0, 1 << 63, 600, dtype=np.uint64)])
    x, y, both = N.sketches([a, b, np.union1d(a, b)], 4096)
    true = 3400 / 4600
    assert abs((x == y).mean() - true) < 0.04
    assert (N.merge_sketches(np.stack([x, y])) == both).all()
    value = N.estimate(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([(x == y).sum()]), np.array([4000.0]), np.array([4000.0]))
    assert abs(value[0] - true) < 0.03


def test_bands_miss_hardly_any_pair_at_the_threshold():
    for threshold in (0.8, 0.85, 0.95):
        bands, rows = N.band_plan(threshold)
        assert bands * rows <= N.REGISTERS and (1 - threshold ** rows) ** bands <= N.MISS


def test_components_of_a_path_and_a_star(spark, tmp_path):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 7)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path)).collect())
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
