"""A quality classifier on document statistics.

Random Fourier features turn a Gaussian kernel over standardised statistics into a linear
model. Partitions sum their normal equations, the sums give ridge weights, and an isotonic
curve, fitted on labelled rows apart, turns the ridge scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebars.llm.labelled import training_labels
from quotebars.llm.tables import record_batch, text_slices
from quotebars.llm.words import NOT_SPACE, find_words, hash_words
from quotebars.session import scratch_dir

FEATURES, WIDTH, RIDGE, SEED = 384, 3.0, 1e-3, 20240
#: bins of ridge scores from which the isotonic curve is fitted
BINS = 2000
#: sums that the driver reads
FAN_IN = 16


def _class(*chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for s in chars for c in s]] = True
    return out


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _class("abcdefghijklmnopqrstuvwxyz")
_LETTER[0x80:] = True
_DIGIT = _class("0123456789")
_STOP = _class(".?!")
_PLAIN = _class(",;:'\"()-") | _STOP
_SPACE = ~NOT_SPACE
_SYMBOL = ~(_LETTER | _DIGIT | _PLAIN | _SPACE)
_SYMBOL[:32] &= False

STATISTICS = ["log_bytes", "log_words", "word_bytes", "word_spread", "upper", "digit", "stop", "plain", "symbol", "wide", "lines",
              "line_words", "repeated_lines", "distinct_words", "top_word", "capitalised", "all_upper", "wordless", "symbol_end",
              "stop_end", "exclaim_end", "long_words", "short_words", "word_repeats"]


def _top(groups: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the values in each of ``n`` groups: how many are distinct, how often the commonest comes."""
    order = np.lexsort((values, groups))
    g, v = groups[order], values[order]
    new = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (v[1:] != v[:-1])]) if len(g) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.r_[new, len(g)])
    most = np.zeros(n)
    np.maximum.at(most, g[new], count)
    return np.bincount(g[new], minlength=n).astype(float), most


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of STATISTICS for each whole text (an empty text has zeros)."""
    n = len(texts)
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    words = find_words(texts, NOT_SPACE)
    at = words.offsets[:-1]
    total = np.array([len(t) for t in texts], dtype=float)
    per_byte = lambda table: np.add.reduceat(table[raw], at, dtype=np.int64) / np.maximum(total, 1)
    size = (words.end - words.start).astype(float)
    count = np.diff(words.first).astype(float)
    some = np.maximum(count, 1)
    mean = lambda x: np.bincount(words.doc, weights=x, minlength=n) / some
    first, last = raw[words.start], raw[words.end - 1]
    letters = np.r_[0, np.cumsum(_LETTER[raw])]
    uppers = np.r_[0, np.cumsum(_UPPER[raw])]
    n_letters, n_upper = letters[words.end] - letters[words.start], uppers[words.end] - uppers[words.start]
    word_bytes = mean(size)
    hashes = hash_words(words)
    distinct, top = _top(words.doc, hashes, n)
    same = np.r_[False, (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])] if len(hashes) else np.zeros(0, dtype=bool)
    # lines, by the hash of what is in them
    parts = [t.split(b"\n") for t in texts]
    owner = np.repeat(np.arange(n), [len(p) for p in parts])
    full = np.array([hash(line) if line.strip() else 0 for p in parts for line in p], dtype=np.int64)
    owner, full = owner[full != 0], full[full != 0]
    lines = np.bincount(owner, minlength=n).astype(float)
    distinct_lines, _ = _top(owner, full, n)
    out = np.stack([
        np.log1p(total), np.log1p(count), word_bytes, np.sqrt(np.maximum(mean(size ** 2) - word_bytes ** 2, 0)), per_byte(_UPPER),
        per_byte(_DIGIT), per_byte(_STOP), per_byte(_PLAIN), per_byte(_SYMBOL), np.add.reduceat(raw >= 0x80, at, dtype=np.int64) / np.maximum(total, 1),
        lines / some, np.log1p(count / np.maximum(lines, 1)), 1 - distinct_lines / np.maximum(lines, 1), distinct / some, top / some,
        mean(_UPPER[first]), mean((n_upper > 0) & (n_upper == n_letters) & (size > 2)), mean(n_letters == 0),
        mean(_SYMBOL[last] & (n_letters > 0)), mean(_STOP[last]), mean(last == ord("!")), mean(size > 12), mean(size < 4), mean(same)], axis=1)
    out[total == 0] = 0
    return out


class Model(NamedTuple):
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    curve_x: np.ndarray
    curve_y: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.centre, self.spread) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.curve_x, self.curve_y), 0, 1)


def fourier(stats: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    rng = np.random.default_rng(SEED)
    frequency = rng.normal(size=(stats.shape[1], FEATURES)) / WIDTH
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((stats - centre) / spread, -6, 6)
    return np.c_[np.cos(x @ frequency + phase) * np.sqrt(2 / FEATURES), np.ones(len(x))]


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The closest non-decreasing sequence: neighbours that fall are pooled."""
    pools: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools[-1]
            pools[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(int(n), v) for v, _, n in pools]) if pools else np.zeros(0)


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, stats) of every row; stats are packed doubles."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            out = pa.schema([batch.schema.field("id"), ("stats", pa.binary())])
            yield record_batch(out, [batch.column("id"), [r.tobytes() for r in statistics(texts)]])

    return rows.mapInArrow(run, rows.select("id").schema.add("stats", "binary"))


def _unpack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def _summed(rows: DataFrame) -> np.ndarray:
    """The sum of all packed arrays: FAN_IN tasks add up the partitions' sums one by one, the
    driver adds up theirs."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for packed in batch.column("sums").to_pylist():
                value = np.frombuffer(packed, dtype=np.float64)
                total = value.copy() if total is None else total + value
        if total is not None:
            yield record_batch(pa.schema([("sums", pa.binary())]), [[total.tobytes()]])

    rows = rows.repartition(FAN_IN).mapInArrow(add, "sums binary")
    found = [np.frombuffer(r.sums, dtype=np.float64) for r in rows.collect()]
    return np.sum(found, axis=0) if found else np.zeros(0)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on (id, stats) and (id, label). A fifth of the labelled rows, by hash, is kept for the
    curve. Without labelled rows every score is 0.5; with one label only, it is that label."""
    rows = stats.join(labels, "id").select("stats", "label", (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(5)) == 0).alias("apart"))
    width = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * width + 2)
        for batch in batches:
            if batch.num_rows:
                x = _unpack(batch.column("stats"))
                total += np.r_[x.sum(axis=0), (x ** 2).sum(axis=0), len(x), batch.column("label").to_numpy().sum()]
        yield record_batch(pa.schema([("sums", pa.binary())]), [[total.tobytes()]])

    sums = _summed(rows.mapInArrow(moments, "sums binary"))
    n = sums[-2] if len(sums) else 0
    if not n or sums[-1] in (0, n):
        value = 0.5 if not n else sums[-1] / n
        return Model(np.zeros(width), np.ones(width), np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([value, value]))
    centre = sums[:width] / n
    spread = np.sqrt(np.maximum(sums[width:2 * width] / n - centre ** 2, 1e-12)) + 1e-9

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = FEATURES + 1
        gram, right = np.zeros((d, d)), np.zeros(d)
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                z = fourier(_unpack(part.column("stats")), centre, spread)
                gram += z.T @ z
                right += z.T @ part.column("label").to_numpy()
        yield record_batch(pa.schema([("sums", pa.binary())]), [[np.r_[gram.ravel(), right].tobytes()]])

    sums = _summed(rows.where("NOT apart").select("stats", "label").mapInArrow(normal, "sums binary"))
    d = FEATURES + 1
    gram, right = sums[:d * d].reshape(d, d), sums[d * d:]
    weights = np.linalg.solve(gram + RIDGE * max(gram[-1, -1], 1) / FEATURES * np.eye(d), right)
    model = Model(centre, spread, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, ones = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            if batch.num_rows:
                at = np.clip(((model.raw(_unpack(batch.column("stats"))) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
                count += np.bincount(at, minlength=BINS)
                ones += np.bincount(at, weights=batch.column("label").to_numpy(), minlength=BINS)
        yield record_batch(pa.schema([("sums", pa.binary())]), [[np.r_[count, ones].tobytes()]])

    sums = _summed(rows.where("apart").select("stats", "label").mapInArrow(bins, "sums binary"))
    count, ones = sums[:BINS], sums[BINS:]
    used = np.flatnonzero(count) if len(sums) else np.zeros(0, dtype=int)
    if not len(used):
        return model
    # a prior of one row at the straight line through the scores keeps ends off 0 and 1
    middle = (used + 0.5) / BINS * 2 - 0.5
    curve = isotonic((ones[used] + np.clip(middle, 0, 1)) / (count[used] + 1), count[used] + 1)
    return model._replace(curve_x=middle, curve_y=curve)


def score_documents(docs: DataFrame, labels: DataFrame, target: str = "quality", key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row of ``docs``: the probability of label 1, from 0 to 1.

    Scores come from the whole text alone. Null and empty texts have the statistics of nothing
    (zeros) and a score as any other; a null identifier is scored too and never learnt from;
    repeated rows are scored alike; an empty table gives no rows."""
    spark = docs.sparkSession
    root = scratch_dir(spark, "quality")
    document_statistics(docs, key, text).write.parquet(f"{root}/statistics")
    stats = spark.read.parquet(f"{root}/statistics")
    model = fit(stats, training_labels(labels, target))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                out = pa.schema([pa.field("doc_id", part.schema.field("id").type), ("score", pa.float64())])
                yield record_batch(out, [part.column("id"), model.score(_unpack(part.column("stats")))])

    named = stats.select(F.col("id").alias("doc_id"))
    return stats.mapInArrow(run, named.schema.add("score", "double"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, target: str = "quality", key: str = "doc_id") -> DataFrame:
    """``docs`` whose score reaches ``least``; rows that share an identifier go only together."""
    scored = score_documents(docs, labels, target, key).groupBy("doc_id").agg(F.max("score").alias("_score"))
    bad = scored.where(F.col("_score") < least).select(F.col("doc_id").alias("_bad"))
    return docs.join(bad, docs[key].eqNullSafe(bad["_bad"]), "left_anti")
