"""Merkle manifest against a recursive version that builds every tree from Python lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quotebars.llm import merkle as M
from tests.llm.conftest import AWKWARD

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree int, `a.b` int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, lower=False):
    text = row[4]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return H(*[framed(v) for v in (row[0], row[1], row[2], row[3], text)])


def grow(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def way(levels, place):
    for level in levels[:-1]:
        run = place // 8 * 8
        yield "".join(level[run:place]), "".join(level[place + 1:run + 8])
        place //= 8


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    members = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for g in langs}
    trees = {g: grow([leaf_of(r) for r in members[g]]) for g in langs}
    top = grow([trees[g][-1][0] for g in langs])
    root = top[-1][0]
    for at, g in enumerate(langs):
        for place, r in enumerate(members[g]):
            proof = [*way(trees[g], place), *way(top, at)]
            folded = leaf_of(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0)
            for left, right in proof:
                folded = H(left, folded, right)
            yield r[0], leaf_of(r), trees[g][-1][0], root, H(*[a + b for a, b in proof]), folded, folded == root


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, 8) for r in rows], SCHEMA)


def key(r):
    return tuple(map(repr, r))


def check(spark, rows):
    got = M.verify_tampered(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)
    return got


def test_awkward_rows_and_trees_of_every_height(spark):
    rows = [(i, "s", "xx", len(t or ""), t) for i, t in enumerate(AWKWARD)]
    rows += [(i * 7 % 601, None if i % 3 else "S", "en", None, f"Text {i}") for i in range(600)]
    rows += [(5, "s", None, 1, "x"), (None, "s", None, 1, "X"), (None, None, None, None, None), (6, "s", "", 1, "A"), (7, "s", "é", 1, "B")]
    rows += [(9, "s", "lone", 1, "Lone")] + [(11, "s", "repeated", 2, "Again")] * 70 + [(12, "s", "de", 1, f"tie {i % 5}") for i in range(9)]
    got = check(spark, rows)
    assert 0 < sum(r.verified for r in got) < len(got)


@pytest.mark.parametrize("n", [1, 9, 65])
def test_sizes_around_full_runs(spark, n):
    check(spark, [(i, "s", "en", 1, "lower only") for i in range(n)])


def test_lower_case_texts_survive_and_others_don_t(spark):
    rows = [(i, "s", "en", 1, "abc é É" if i % 2 else "Abc") for i in range(60)]
    for r in check(spark, rows):
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 3 != 0 or r.doc_id % 2 == 1)


def test_empty_table(spark):
    assert M.verify_tampered(frame(spark, [])).collect() == []
    assert M.write_manifest(frame(spark, [])) is None


def test_requested_leaves_only(spark):
    rows = [(i, "s", "en" if i % 4 else "fr", 1, f"t{i}") for i in range(300)]
    manifest = M.write_manifest(frame(spark, rows))
    tree = framed("en")
    requests = spark.createDataFrame([(tree, 0), (tree, 63), (tree, 64), (tree, 224), (tree, 64), (tree, 900)], "tree string, rank long")
    got = manifest.prove(requests)
    assert {"leaf", "subroot", "proof"} <= set(got.columns)
    folded = got.select("rank", M.fold(F.col("leaf"), F.col("proof")).alias("root")).collect()
    assert sorted(r["rank"] for r in folded) == [0, 63, 64, 224]
    assert {r.root for r in folded} == {manifest.root}
    assert manifest.prove().count() == 300


def test_store_is_addressed_by_content(spark):
    rows = [(1, "s", "en", 1, "same")] * 64 + [(2, "s", "de", 1, "other")]
    manifest = M.write_manifest(frame(spark, rows))
    record = manifest.groups.records(1).collect()
    assert len(record) == 1 and record[0].digest == H(*record[0].children) and len(record[0].children) == 8
