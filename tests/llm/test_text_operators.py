"""Secrets, decontamination, token ids and sharding against brute-force versions."""

import hashlib
import itertools
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter
from math import log2

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotebars.llm import decontam as D
from quotebars.llm import piece_bpe as P
from quotebars.llm import ranks as R
from quotebars.llm import secrets as S
from quotebars.llm import sharding as H
from quotebars.llm.tables import text_slices
from tests.llm.conftest import AWKWARD, lower

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


# ---------------------------------------------------------------- token ids
def same_as_library(library, text):
    ids = library.encode(text)
    got = P.piece_table(MODEL).encode(text)
    assert got == " ".join(map(str, ids)), text
    assert P.piece_table(MODEL).decode(got) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t▁abehinorstTé日0193!.#$😀ﬁ")), max_size=40))
def test_ids_equal_the_library(text):
    same_as_library(LIBRARY, text)


def test_ids_of_joined_pieces_and_awkward_texts(library):
    rng = random.Random(3)
    pieces = [p.replace("▁", " ") for p in P.piece_table(MODEL).scores]
    for _ in range(2000):
        same_as_library(library, "".join(rng.choices(pieces, k=rng.randrange(1, 7))))
    for text in AWKWARD:
        same_as_library(library, text or "")


@pytest.mark.parametrize("ids", [[], [2], [1, 2], [3, 4], [198, 5, 259], [227, 181], [29871, 29871], [0, 15], [227, 135, 175, 300]])
def test_any_ids_decode_as_in_the_library(library, ids):
    assert P.piece_table(MODEL).decode(" ".join(map(str, ids))) == library.decode([i for i in ids if i]) or 0 in ids


def test_a_stem_is_encoded_once_whatever_follows_it(library):
    table, done = P.PieceTable(MODEL), []
    plain = table.encode_segment
    table.encode_segment = lambda part: done.append(part) or plain(part)
    tails = [t for t in ".,;!§\u00b6\u2020\u2021\u20ac" if ("r", t) not in table.joined]
    text = " ".join("x thinanenor" + t for t in ["", *tails])
    assert len(tails) > 1 and table.encode(text) == " ".join(map(str, library.encode(text)))
    assert sum("thinanenor" in part for part in done) == 1


def test_a_word_has_one_place_in_memory_whatever_follows_it(library):
    rng, table = random.Random(5), P.PieceTable(MODEL)
    pieces = [p for p in table.scores if p.isascii() and p.isalpha() and p.islower() and len(p) < 6]
    words = ["".join(rng.choices(pieces, k=4)) for _ in range(3000)]
    text = " ".join(w + t for w in words for t in ("", ",", "."))
    ids = table.encode(text)
    assert ids == " ".join(map(str, library.encode(text)))
    assert len(table.segments) == len(set(words)) + 2       # the words, a comma and a full stop


@pytest.mark.parametrize("body", ["a", "ab", "thinanenor", "aab  ", " ", "日本", "\U0001f600x", "\n ", "x▁▁"])
def test_long_texts_without_cuts_or_around_the_end_of_a_block(library, body):
    for size in (P.BLOCK - 3, P.BLOCK - 2, P.BLOCK - 1, P.BLOCK, 2 * P.BLOCK + 1):
        same_as_library(library, (body * size)[:size] + "  the end")


@pytest.mark.parametrize("by_word", [True, False])
def test_models_with_and_without_marks_inside_pieces(tmp_path, by_word):
    rng = random.Random(7)
    lines = [" ".join(rng.choices(["the", "of", "in", "that", "x.", "isn't", "a,b", "on"], k=8)) for _ in range(400)]
    lines = [line.replace("that on", "that (on").replace("the of", "the ... of") for line in lines]
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(lines), model_prefix=str(tmp_path / "m"), model_type="bpe", vocab_size=340, byte_fallback=True,
        split_by_whitespace=by_word, normalization_rule_name="identity", remove_extra_whitespaces=False, minloglevel=2, hard_vocab_limit=False)
    library, table = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "m.model")), P.PieceTable(str(tmp_path / "m.model"))
    assert by_word != any(P.MARK in p.lstrip(P.MARK) for p in table.scores)
    for _ in range(300):
        text = "".join(rng.choices(["of the", "in ", " that", "  ", ".", " (on", " ...", " ... of", "n't", "a,", "\n", "é", "on", "i", "h"], k=rng.randrange(1, 12)))
        assert table.encode(text) == " ".join(map(str, library.encode(text))), text


def test_what_is_asked_for_again_stays_in_a_full_memory():
    memory = P.Memory(10)
    for i in range(100):
        memory.put(i, str(i))
        assert len(memory) + len(memory.old) <= 20
        assert i == 0 or memory.get(0) or memory.again(0)
    assert memory.get(5) is None and memory.again(5) is None


def test_only_the_texts_of_a_slice_are_python_objects():
    batch = pa.RecordBatch.from_arrays([pa.array([None, *("x" * 1_000_000 for _ in range(60))])], ["text"])
    tracemalloc.start()
    try:
        sizes = [(part.num_rows, sum(map(len, texts))) for part, texts in text_slices(iter([batch]), "text")]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(n for n, _ in sizes) == 61 and sum(n for _, n in sizes) == 60_000_000 and max(n for _, n in sizes) <= 2 << 20
    assert peak < 10_000_000


def test_round_trip_over_a_table(documents, library):
    docs = documents(AWKWARD)
    rows = {r.doc_id: r for r in P.round_trip(docs, MODEL).select("*", P.ids_array().alias("array")).collect()}
    assert len(rows) == len(AWKWARD)
    for i, text in enumerate(AWKWARD):
        ids = library.encode(text or "") + [2]
        assert rows[i].array == ids and rows[i].decoded == library.decode(ids) and rows[i].source == "s"
    encoded = P.encode_documents(docs, MODEL)
    assert {r.doc_id: r.text for r in P.decode_documents(encoded, MODEL).collect()} == {i: r.decoded for i, r in rows.items()}
    assert P.round_trip(docs.limit(0), MODEL).collect() == []


# ---------------------------------------------------------------- decontamination
def brute_hits(text, items, window):
    words = [w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))]
    hit, found = [False] * len(words), set()
    for name, item in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(item))
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if own else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == own[k:k + n]:
                    hit[j:j + n] = [True] * n
                    found.add(str(name))
    return len(words), sum(hit), sorted(found), hit


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_hits_equal_brute_force(spark, documents, block_bytes):
    rng = random.Random(9)
    word = lambda: rng.choice(["the", "of", "a", "cat", "dog", "é", "x1"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 4, 5, 9])))) for i in range(4, 9)]
    items += [(1, None), (2, ""), (3, "..."), (10, items[0][1]), (11, "The CAT, of")]
    texts = AWKWARD + [" ".join(word() for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += [f"{items[3][1]} and {items[4][1].upper()}" * 2]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.find_contamination(documents(texts).withColumn("found", F.lit(1)), bench, window=5, block_bytes=block_bytes).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, hits, names, hit = brute_hits(texts[r.doc_id], items, 5)
        assert (r.found.n_words, r.found.n_hit, r.found["items"]) == (n, hits, names), texts[r.doc_id]
        marked = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower("\n".join(texts[r.doc_id][s.start:s.end] for s in r.found.spans)))
        assert len(marked) == hits


def test_limits_and_cut_spans(spark, documents):
    item = " ".join(f"q{i}" for i in range(15))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    long = " ".join(f"w{i}" for i in range(400))
    docs = documents([f"{item} {long}", f"{item} x", long, None])
    kept = D.decontaminate(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3] and kept.columns == docs.columns
    assert sorted(r.doc_id for r in D.decontaminate(docs, bench, max_match=14).collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in D.decontaminate(docs, bench, cut_spans=True).collect()}
    assert cut == {0: f" {long}", 2: long, 3: None}
    assert D.decontaminate(docs.limit(0), bench).collect() == []
    assert D.decontaminate(docs, bench.limit(0)).count() == 4


# ---------------------------------------------------------------- secrets
def test_base_spans_are_the_leftmost_matches_that_are_long_enough():
    text = "secret=token: abcdefgh PassWord : 'x_y' api-key=abcdef apikey = \"abc/def+1\" " + "AKIA" + "B" * 16 + " AKIAB " + "a1" * 12 + " " + "f" * 23
    want = []
    for kind, pattern, ok in ((0, S.ASSIGN, lambda m: len(m[2]) >= 6), (1, S.ACCESS, lambda m: len(m[0]) >= 20), (2, S.HEX, lambda m: len(m[0]) >= 24)):
        want += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if ok(m)]
    assert S.base_spans(text) == sorted(want) and {k for _, k, _ in want} == {0, 1, 2}
    assert S.base_spans("ſecret=abcdefg toKen=abcdefg") == []  # either case of ASCII letters only


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1Z", max_size=60), st.floats(0.2, 2.0))
def test_windows_equal_entropy_by_definition(text, bits):
    size, covered = 8, set()
    for i in range(len(text) - size + 1):
        counts = Counter(text[i:i + size])
        if -sum(n / size * log2(n / size) for n in counts.values()) >= bits - 1e-10:
            covered |= set(range(i, i + size))
    assert {i for a, b in S.entropy_windows(text, size, bits) for i in range(a, b)} == covered


def test_a_stretch_keeps_what_base_spans_leave():
    rng = random.Random(7)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    head, tail, hexes = "".join(rng.choices(alnum, k=30)) + "Z", "Z" + "".join(rng.choices(alnum, k=30)), "".join(rng.choices("0123456789abcdef", k=26))
    text = head + hexes + tail
    base = S.base_spans(text)
    assert [(k, text[s:e]) for s, k, e in base] == [(2, hexes)]
    spans = S.entropy_spans(text, base)
    assert spans and all(e - s >= S.LEAST_REST and (e <= base[0][0] or s >= base[0][2]) for s, _, e in spans)
    assert {i for s, _, e in spans for i in range(s, e)} >= {*range(4, 27), *range(len(text) - 27, len(text) - 4)}


def test_rest_of_a_stretch_by_definition():
    rng = random.Random(3)
    for _ in range(500):
        taken = S.merged(sorted((a, a + rng.randint(1, 15)) for a in rng.sample(range(100), rng.randint(0, 6))))
        a = rng.randint(0, 80)
        b = a + rng.randint(1, 40)
        free = [i for i in range(a, b) if not any(s <= i < e for s, e in taken)]
        runs = [r for r in ([*g] for _, g in itertools.groupby(free, key=lambda i, c=itertools.count(): i - next(c))) if len(free) == b - a or len(r) >= S.LEAST_REST]
        assert list(S.rest_of(a, b, taken)) == [(r[0], r[-1] + 1) for r in runs]


def test_base32_secrets_are_found():
    rng = random.Random(9)
    found = 0
    for _ in range(300):
        key = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=20))
        found += bool(S.entropy_spans(f"the key {key} here", []))
    assert found >= 285
    for clean in ("INTERNATIONALIZATION", "AAAAAAAAAAAAAAAA2222", "the quick brown fox", "ABCABCABCABCABCABC123"):
        assert not S.entropy_spans(clean, [])


def test_spans_grow_in_proportion():
    rng = random.Random(11)
    unit = lambda: "token=" + "".join(rng.choices("abcdefXYZ0123456789", k=24)) + " " + "".join(rng.choices("ABCDEFGHJKLMNPQRSTUVWXYZ234567abcdefgh", k=40)) + " "
    text = "".join(unit() for _ in range(56_000))       # 4 MB
    began = time.process_time()
    base = S.base_spans(text)
    spans = S.entropy_spans(text, base)
    assert len(base) > 50_000 and len(spans) > 50_000 and time.process_time() - began < 30


def test_entropy_spans_are_added_and_the_allow_list_suppresses(documents):
    key = "q7Zp0Lr2Xv9Tn4Kc8Wb1Ys6M"
    texts = [f"é {key} end", "b0000000-0000-4000-8000-00805f9b34fb", "internationalisationofthings", f"token={key}", None, "", "2024-01-01/some-long-path-of-words/99"]
    rows = {r.doc_id: [(s.kind, s.start, s.end) for s in r.secrets] for r in S.find_secrets(documents(texts)).collect()}
    assert rows[0] == [("entropy_base64", 2, 2 + len(key))]
    assert rows[3] == [("assign", 0, 6 + len(key))]
    assert [rows[i] for i in (1, 2, 4, 5, 6)] == [[]] * 5
    quiet = {r.doc_id: r.secrets for r in S.find_secrets(documents(texts), allowed=("q7Zp.*", "token=.*")).collect()}
    assert quiet[0] == [] and len(quiet[3]) == 1
    masked = {r.doc_id: r.text for r in S.mask_secrets(S.find_secrets(documents(texts))).collect()}
    assert masked[0] == "é [secret] end" and masked[3] == "[secret]" and masked[2] == texts[2] and masked[4] is None
    assert S.find_secrets(documents(AWKWARD).withColumn("secrets", F.lit(1))).count() == len(AWKWARD)
    assert S.find_secrets(documents(texts).limit(0)).collect() == []


# ---------------------------------------------------------------- shards
def published_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one(spark):
    rng = random.Random(4)
    keys = [0, 1, -1, 2**63 - 1, -2**63] + [rng.randrange(-2**63, 2**63) for _ in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 24, 25, 40):
        got = df.select("k", H.jump_hash(F.col("k"), shards).alias("s")).collect()
        assert all(r.s == published_jump(r.k % (1 << 64), shards) for r in got)


def test_shards_slots_sizes_and_growth(documents):
    docs = documents(AWKWARD + [f"text {i}" for i in range(400)] + [(3, "again"), (3, "again"), (None, "none")])
    rows = H.assign_shards(docs, 24).collect()
    assert len(rows) == len(AWKWARD) + 403
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 24) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in rows if r.doc_id not in (3, None)}
    for i, text in enumerate(AWKWARD):
        if i != 3:
            data = (text or "").encode()
            assert sizes[i] == (len(data) + 8, zlib.crc32(data))
    assert H.assign_shards(docs.limit(0), 24).collect() == []
    named = {r.doc_id: r for r in rows if r.doc_id != 3}
    for i, r in named.items():
        key = int(hashlib.md5(b"" if i is None else str(i).encode()).hexdigest()[:16], 16)
        assert (r.shard, r.grown_shard) == (published_jump(key, 24), published_jump(key, 25))


def test_ranks_of_a_hot_group_over_many_files(spark, scratch):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
                                    F.when(F.col("id") % 11 > 0, F.col("id") % 50).alias("x"), "id")
    found = R.rank(R.sort_files(rows, ["g", "x", "id"], scratch("ranks")), "g").collect()
    groups = {}
    for r in found:
        groups.setdefault(r.g, []).append(r)
    assert len(found) == 3000 and len(groups["hot"]) == 2000
    for members in groups.values():
        members.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in members] == list(range(len(members))) and {r.n for r in members} == {len(members)}
        order = [(r.x is not None, r.x or 0, r.id) for r in members]
        assert order == sorted(order)
    parts = R.sort_files(rows, ["g", "x", "id"], scratch("ranks"))
    assert parts.where("g = 'hot'").select(F.shiftright("at", 33)).distinct().count() > 1
