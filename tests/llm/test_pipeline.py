import os
import re
import shutil
import subprocess
import sys

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from quotebars.llm import queries as Q
from tests.llm.conftest import SF, sha
from tests.llm.test_near_dedup import brute
from tests.llm.test_text_operators import brute_hits

TABLES = ("documents", "benchmark", "pages", "labels", "conversations")


def test_every_operator_is_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(Q.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_queries_equal_their_oracles(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(Q.oracle_sql()[name])
    rows = E.queries()[name](spark, SF).collect()
    assert sorted(repr(tuple(r[c] for c in want.columns)) for r in rows) == sorted(map(repr, want.fetchall()))


def test_each_stage_against_brute_force(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(P.PIECE_MODEL))
    root, columns = scratch("stages"), docs.columns
    for k, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SF)
        out.write.mode("overwrite").parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        rows = docs.collect()
        if k < 4:
            assert docs.columns == columns
            after = {r.doc_id: r.text for r in rows}
            assert len(rows) == len(after) and all(before[i] == t for i, t in after.items())
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            known = [i for i in before if i in labels]
            assert sum((i in after) == (labels[i] == 1) for i in known) >= 0.93 * len(known)
        elif name == "exact":
            best = {}
            for i, t in before.items():
                key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
                best[key] = min(best.get(key, (0, 1 << 62)), (-len(t or ""), i))
            assert set(after) == {i for _, i in best.values()}
        elif name == "near":
            assert set(after) == {i for i, (_, c) in brute(list(before.items()), 5, (80, 100)).items() if i == c}
        elif name == "benchmark":
            gone = set()
            for i, t in before.items():
                n, hit, _, _ = brute_hits(t, bench, 13)
                if hit and 20 * hit >= n:
                    gone.add(i)
            assert set(after) == set(before) - gone and gone
        else:
            assert {r.doc_id for r in rows} == set(before)
            for r in rows:
                ids = library.encode(before[r.doc_id] or "") + [2]
                assert r.ids == " ".join(map(str, ids)) and r.n_tokens == len(ids) and r.decoded_sha256 == sha(library.decode(ids))


def test_every_stage_gives_back_columns_of_any_name(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clashing = ["kept", "digest", "keep_id", "group_size", "found", "score", "component_id", "id", "row", "_score", "_bad", "secrets", "a.b"]
    for i, name in enumerate(clashing):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")))
    root = scratch("clashes")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{root}/{name}")
        kept = spark.read.parquet(f"{root}/{name}")
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        before = {r.doc_id: r for r in docs.collect()}
        rows = kept.collect()
        assert rows and all(before[r.doc_id] == r for r in rows)
        docs = kept
    assert {r.doc_id for r in P.tokens(spark, docs, SF).collect()} == {r.doc_id for r in rows}


LEFT = ("__spark_entry__.py", "quotebars", "tests", "tools", "bench.py")


def copy_without(tmp_path):
    """The repository as the driver leaves it: without the corpus folders and the pipeline."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    for name in LEFT:
        source = os.path.join(root, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    return tmp_path


def run_python(folder, code):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)}, capture_output=True, text=True, timeout=300)


def test_the_rest_imports_and_runs_without_the_corpus_folders(tmp_path):
    done = run_python(copy_without(tmp_path), """
import __spark_entry__ as E
assert len(E.queries()) == len(E.oracle_sql()) >= 47 and not any(n.startswith("op") and n[2].isdigit() for n in E.queries())
from quotebars.session import build_session
spark = build_session("local[2]", shuffle_partitions=2)
print("rows", E.entry(spark).count())
""")
    assert done.returncode == 0 and "rows" in done.stdout and "corpus operators left out" in done.stderr, done.stderr[-2000:]


def test_a_missing_dependency_leaves_out_the_corpus_operators_only():
    done = run_python(os.path.dirname(os.path.abspath(E.__file__)), """
import sys
sys.modules["ahocorasick"] = None       # as if it were not installed
import __spark_entry__ as E
print(len(E.queries()), len(E.oracle_sql()))
""")
    assert done.returncode == 0 and "ahocorasick" in done.stderr, done.stderr[-2000:]
    queries, oracles = map(int, done.stdout.split())
    assert queries == oracles >= 47


def test_rest_works_without_the_corpus_folders():
    """Nothing outside imports the subpackage or the pipeline, but for the guarded entry."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    for folder, _, names in os.walk(os.path.join(root, "quotebars")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                source = open(os.path.join(folder, name)).read()
                assert "quotebars.llm" not in source and "corpus_pipeline" not in source, name
