"""WARC bundles, exact dedup and substring dedup against brute-force versions."""

import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from quotebars.llm import exact_dedup as E
from quotebars.llm import substring_dedup as S
from quotebars.llm import warc as W
from tests.llm.conftest import AWKWARD, sha


# ---------------------------------------------------------------- WARC
def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("bundle", F.lit("clash"))


def test_every_payload_comes_back(spark, scratch):
    big = "<p>é" * 60
    rows = [(i, f"http://x/{i}", t) for i, t in enumerate(AWKWARD)]
    rows += [(200 - i, None, big) for i in range(30)] + [(300, "a\r\nWARC-Type: x%", "s" * 99), (301, "b", "s" * 99), (302, "c", "t" * 100), (303, "d", "t" * 100)]
    rows += [(171, "again", big), (None, "no id", big), (None, None, None)]
    root = scratch("warc")
    pages = pages_of(spark, rows)
    index = W.write_archive(pages, root, frame_bytes=3000, bundle_bytes=20000)
    got = W.read_archive(index, root).collect()
    assert len(got) == len(rows) == index.count()
    smallest = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            smallest[data] = min(smallest.get(data, i), i)
    want = []
    for i, url, html in rows:
        data = (html or "").encode()
        owner = smallest.get(data)
        revisit = owner is not None and owner != i
        want.append((i, url, "revisit" if revisit else "response", None if revisit else data, len(data), sha(data), owner if revisit else None))
    key = lambda r: tuple(map(repr, r))
    assert sorted(((r.page_id, r.url, r.record_type, None if r.payload is None else bytes(r.payload), r.payload_bytes, r.payload_digest, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    few = W.read_records(index.where("page_id IN (3, 7, 185, 303)"), root).collect()
    assert sorted(r.page_id for r in few) == [3, 7, 185, 303]
    assert index.select("bundle").distinct().count() >= 1 and index.agg(F.max("frame")).first()[0] >= 1
    assert W.read_archive(W.write_archive(pages.limit(0), root + "-none"), root + "-none").collect() == []


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}"])
def test_roots_in_every_form_of_a_local_path(spark, scratch, form):
    root = form.format(scratch("warc-root"))
    index = W.write_archive(pages_of(spark, [(1, "u", "x" * 200), (2, "v", "x" * 200), (3, None, None)]), root)
    assert sorted((r.page_id, r.record_type) for r in W.read_archive(index, root).collect()) == [(1, "response"), (2, "revisit"), (3, "response")]
    assert W.read_records(index.where("page_id = 3"), root).first().payload == b""


def test_unknown_schemes_are_refused_before_anything_is_written(spark):
    spark.conf.set("fs.odd.impl", "org.apache.hadoop.fs.LocalFileSystem")
    with pytest.raises(Exception):
        W.write_archive(pages_of(spark, [(1, "u", "x")]), "odd://host/folder")


def test_bundle_is_a_zstandard_file_with_a_seek_table(tmp_path):
    bundle = W.BundleWriter(str(tmp_path))
    records = [W.format_record(i, "u", b"payload %d " % i * 9, sha(b"payload %d " % i * 9), None) for i in range(5)]
    places = []
    for r in records:
        places.append(bundle.add(r))
        bundle.flush()
    bundle.close()
    data = (tmp_path / bundle.name).read_bytes()
    magic, size = struct.unpack_from("<II", data, len(data) - 9 - 5 * 8 - 8)
    assert magic == W.SKIPPABLE and size == 5 * 8 + 9
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).readall() for _ in range(1))
    assert whole == b"".join(records)
    reader = W.BundleReader(str(tmp_path), bundle.name)
    for (frame, at, length), r in zip(places, records, strict=True):
        assert reader.frame(frame)[at:at + length] == r
    with pytest.raises(ValueError):
        W.parse_record(records[0].replace(b"payload 0", b"payload 1", 1), 0)


# ---------------------------------------------------------------- exact dedup
def test_groups_equal_brute_force_over_several_batches(spark, documents, scratch):
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [(40 + i, f"same{' ' * (i % 5)}text") for i in range(30)] + [(39, "sa\tmetext "), (None, "sametext"), (41, "same text")]
    docs = documents(rows).withColumn("kept", F.lit("clash"))
    path = scratch("docs")
    docs.repartition(6).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    for source, bound in ((docs, None), (stored, 2000)):
        got = E.exact_dedup(source, max_bytes_per_trigger=bound)
        assert got.columns == ["doc_id", "text", "source", "n_chars", "digest", "keep_id", "group_size", "kept"]
        got = got.collect()
        assert len(got) == len(rows)
        groups = {}
        for i, t in rows:
            groups.setdefault("".join((t or "").split(" ")).translate({9: None, 10: None, 11: None, 12: None, 13: None}), []).append((-len(t or ""), i is None, i))
        for r in got:
            norm = (r.text or "").translate({c: None for c in (9, 10, 11, 12, 13, 32)})
            assert (r.keep_id, r.group_size, r.digest) == (min(groups[norm])[2], len(groups[norm]), sha(norm))
    assert sum(r.kept for r in got) == len(groups)
    assert E.exact_dedup(docs.limit(0)).collect() == []


def test_repeated_rows_from_files_leave_one(spark, documents, scratch):
    path = scratch("docs")
    documents([(1, "a b")] * 5).repartition(3).write.mode("overwrite").parquet(path)
    got = E.exact_dedup(spark.read.parquet(path)).collect()
    assert [r.group_size for r in got] == [5] * 5 and sum(r.kept for r in got) == 1


def some_documents(spark, documents, path, n=240, parts=6):
    rng = random.Random(8)
    rows = [(i, rng.choice([f"own text {i}", f"common{' ' * rng.randint(0, 9)}text", f"text of {i % 17}"])) for i in range(n)]
    documents(rows).repartition(parts).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_later_batches_hit_the_state_of_earlier_ones(spark, documents, scratch):
    docs, state = some_documents(spark, documents, scratch("docs")), scratch("state")
    E.exact_dedup(docs, state=state).collect()
    changed = spark.read.parquet(f"{state}/changed")
    assert changed.select("batch").distinct().count() >= 3
    hits = changed.groupBy("digest").agg(F.countDistinct("batch").alias("batches")).where("batches > 1").count()
    assert hits >= 10


def test_two_runs_over_one_state_equal_one_run(spark, documents, scratch):
    path = scratch("docs")
    docs = some_documents(spark, documents, path)
    whole = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in E.exact_dedup(docs).collect()}
    first, second, state = scratch("first"), scratch("second"), scratch("state")
    docs.where("doc_id < 150").repartition(3).write.mode("overwrite").parquet(first)
    docs.where("doc_id >= 150").repartition(3).write.mode("overwrite").parquet(second)
    E.exact_dedup(spark.read.parquet(first), state=state, run_id="first").collect()
    later = E.exact_dedup(spark.read.parquet(second), state=state, run_id="second").collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in later} == {i: w for i, w in whole.items() if i >= 150}
    assert any(r.keep_id < 150 for r in later) and any(r.kept for r in later)
    # the first run's rows in the light of the second, by a run that is repeated under its name
    again = E.exact_dedup(spark.read.parquet(first), state=state, run_id="first").collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in again} == {i: w for i, w in whole.items() if i < 150}


def test_bytes_of_an_earlier_run_are_fetched_and_compared(spark, documents, scratch, monkeypatch):
    first, state = scratch("first"), scratch("state")
    documents([(1, "an older text")]).write.mode("overwrite").parquet(first)
    monkeypatch.setattr(F, "sha2", lambda column, bits: F.lit("one digest for all"))
    E.exact_dedup(spark.read.parquet(first), state=state).collect()
    second = scratch("second")
    documents([(2, "a text")]).write.mode("overwrite").parquet(second)
    with pytest.raises(Exception, match="texts of one digest differ"):
        E.exact_dedup(spark.read.parquet(second), state=state).collect()


def test_texts_of_one_digest_are_compared_byte_by_byte(spark, documents, monkeypatch):
    monkeypatch.setattr(F, "sha2", lambda column, bits: F.lit("one digest for all"))
    with pytest.raises(Exception, match="texts of one digest differ"):
        E.exact_dedup(documents(["a", "b"])).collect()


# ---------------------------------------------------------------- substring dedup
def brute_cut(rows):
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - S.LENGTH + 1):
            w = data[k:k + S.LENGTH]
            if w in seen:
                gone[k:k + S.LENGTH] = b"\x01" * S.LENGTH
            seen.add(w)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), sum(gone), runs, sha(bytes(c for c, g in zip(data, gone, strict=True) if not g))))
    return out


def cut_rows(docs):
    return sorted((r.doc_id if r.doc_id is not None else 10**9, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), sha(bytes(r.kept))) for r in S.remove_repeats(docs).collect())


def passages(rng, n):
    letters = "abcdefgh é"
    common = ["".join(rng.choices(letters, k=k)) for k in (99, 100, 101, 130, 400)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(5)):
            parts.append("".join(rng.choices(letters, k=rng.randrange(150))))
            p = rng.choice(common)
            a = rng.randrange(20)
            parts.append(p[a:len(p) - rng.randrange(20)] if rng.random() < 0.5 else p)
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("crowd,piece", [(20_000, 1 << 20), (2, 700)])
def test_removed_bytes_equal_brute_force(documents, monkeypatch, crowd, piece):
    monkeypatch.setattr(S, "CROWD", crowd)
    monkeypatch.setattr(S, "PIECE", piece)
    monkeypatch.setattr(S, "REFINE", piece * 4)
    rng = random.Random(crowd)
    texts = AWKWARD + passages(rng, 80) + ["ab" * 700, "ab" * 60 + "x" * 300, "é" * 200, "x" * 99, "x" * 100]
    texts += [texts[20], texts[30] + "z"]
    order = list(enumerate(texts))
    shuffled = order[:]
    rng.shuffle(shuffled)
    assert cut_rows(documents(shuffled)) == brute_cut(order)


def test_refined_buckets_are_the_equal_prefixes():
    rng = random.Random(2)
    data = bytes(rng.choices(b"ab", k=300)) * 2 + bytes(rng.choices(b"abc", k=500)) + b"a" * 250
    import numpy as np
    at = np.arange(0, len(data) - S.LENGTH + 1, 3)
    got = S.refine(data, at)
    groups = {}
    for k, a in enumerate(at):
        groups.setdefault(data[a:a + S.LENGTH], []).append(k)
    for members in groups.values():
        ids = {int(got[k]) for k in members}
        assert ids == {-1} if len(members) == 1 else len(ids) == 1 and -1 not in ids
    shared = [m for m in groups.values() if len(m) > 1]
    assert len({int(got[m[0]]) for m in shared}) == len(shared) > 0


def test_repeated_and_null_identifiers_and_empty_table(documents):
    text = "".join(random.Random(1).choices("abcdefgh", k=150))
    rows = [(5, text), (5, text), (None, text), (2, "p" + text), (3, None)]
    assert cut_rows(documents(rows)) == sorted([(2, 151, 0, 0, sha("p" + text)), (3, 0, 0, 0, sha("")), (5, 150, 150, 1, sha("")),
                                                (5, 150, 150, 1, sha("")), (10**9, 150, 150, 1, sha(""))])
    assert S.remove_repeats(documents(rows).limit(0)).collect() == []
    assert {r.doc_id: r.text for r in S.deduplicated(documents([(1, text), (2, "é" + text)])).collect()} == {1: text, 2: "é"}
