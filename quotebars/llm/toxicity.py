"""Toxic spans by a linear-chain conditional random field, and document scores from them.

The labels are of documents, so tokens are labelled first: in toxic documents, tokens that carry
a marker (a word or word beginning that comes several times as often in toxic documents as in
clean ones, and in too many of them for chance) are toxic, all others are clean. Markers are
counted in all labelled documents. The field has two tags, a weight for each marker, a bias and
transitions; it is trained on a bounded sample. Forward-backward marginals of every
token give the offending offsets, and their sum, share and maximum the document's score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebars.llm.labelled import held_out, training_labels
from quotebars.llm.tables import record_batch, text_slices
from quotebars.llm.words import ALNUM, Words, find_words, hash_words, mix
from quotebars.session import scratch_dir

#: labelled documents of each label that the models are fitted on, at most (by hash of the
#: identifier; half for the field, half for the document score)
SAMPLE = 3000
#: a marker comes so many times as often in toxic texts as in clean ones; of the markers, so
#: large a share may be there by chance (Benjamini-Hochberg over all features of two documents
#: or more; evidence is binned by so much)
MARKER_RATIO, CHANCE, EVIDENCE_STEP = 6.0, 0.05, 0.05
#: beginnings of words, in bytes, that may be markers besides whole words
PREFIXES = (4, 5, 6, 7, 8)
#: tokens on either side of marked ones over which messages are passed; beyond, a token's
#: marginal is that of an endless chain of unmarked tokens
MARGIN = 24
#: training sequences are pieces of so many tokens
PIECE, STEPS, RATE, DECAY = 64, 150, 0.3, 1e-4
_U64 = np.uint64


# ---------------------------------------------------------------- tokens and markers
def token_features(words: Words) -> np.ndarray:
    """A row for each token: 64-bit features of the whole word and of its beginnings; 0 where
    the word is not longer than the beginning."""
    size = words.end - words.start
    lanes = np.ndarray((len(words.buffer) + 1,), dtype="<u8", buffer=words.buffer + bytes(8), strides=(1,))[words.start]
    out = np.zeros((len(size), 1 + len(PREFIXES)), dtype=np.uint64)
    out[:, 0] = hash_words(words)
    for k, n in enumerate(PREFIXES, 1):
        kept = lanes & _U64((1 << 8 * n) - 1)
        out[:, k] = np.where(size > n, mix(kept + _U64(n)), 0)
    return out


class Field(NamedTuple):
    markers: np.ndarray   # sorted features
    weights: np.ndarray   # of the toxic tag against the clean one
    bias: float
    moves: np.ndarray     # 2 x 2 log potentials: from tag, to tag

    def find(self, features: np.ndarray) -> np.ndarray:
        """Numbers of the markers among the features, -1 for others."""
        if not len(self.markers):
            return np.full(features.shape, -1)
        at = np.minimum(np.searchsorted(self.markers, features), len(self.markers) - 1)
        return np.where((self.markers[at] == features) & (features != 0), at, -1)


def _through(odds: np.ndarray | float, m: np.ndarray) -> np.ndarray | float:
    """Odds of the toxic tag after one move with the potentials ``m`` (not in logarithms)."""
    return (m[0, 1] + m[1, 1] * odds) / (m[0, 0] + m[1, 0] * odds)


def marginals(score: np.ndarray, moves: np.ndarray, length: np.ndarray, head: np.ndarray | float = 1.0, tail: np.ndarray | float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over rows of toxic-against-clean scores, padded to one width.

    With two tags a message is one number, the odds of the toxic tag. ``head`` and ``tail`` are
    the odds that messages from outside bring to the first and last token. Returns each token's
    probability of the toxic tag and each step's probabilities of the four moves (rows, steps, 4;
    zero beyond a row's length)."""
    rows, width = score.shape
    m, s = np.exp(moves), np.exp(np.clip(score, -60, 60))
    forward, backward = np.empty((rows, width)), np.ones((rows, width))
    forward[:, 0] = s[:, 0] * head
    for t in range(1, width):
        forward[:, t] = s[:, t] * _through(forward[:, t - 1], m)
    last = length - 1
    backward[np.arange(rows), last] = tail
    for t in range(width - 2, -1, -1):
        backward[:, t] = np.where(last > t, _through(s[:, t + 1] * backward[:, t + 1], m.T), backward[:, t])
    steps = np.zeros((rows, max(width - 1, 0), 4))
    if width > 1:
        a, b = forward[:, :-1], s[:, 1:] * backward[:, 1:]
        steps = np.stack([np.broadcast_to(m[0, 0], a.shape), m[0, 1] * b, m[1, 0] * a, m[1, 1] * a * b], axis=2)
        steps *= ((np.arange(width - 1)[None, :] < last[:, None]) / steps.sum(axis=2))[:, :, None]
    odds = forward * backward
    return odds / (1 + odds), steps


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Pieces(NamedTuple):
    """Training sequences, cut into pieces of PIECE tokens: those with a marker, and how many of each
    length have none (they differ in nothing else)."""
    length: np.ndarray    # of the pieces with a marker
    piece: np.ndarray     # a row for each marker of a token: the number of its piece,
    place: np.ndarray     # the token's place in the piece,
    number: np.ndarray    # the marker
    toxic: np.ndarray     # whether a piece is of a toxic text: its marked tokens are toxic
    quiet: np.ndarray     # pieces without a marker, by length


def train_field(markers: np.ndarray, pieces: Pieces) -> Field:
    """Maximum likelihood (Adam) on the pieces, where tokens with a marker in toxic texts are toxic."""
    loud, quiet = len(pieces.length), np.flatnonzero(pieces.quiet)
    weight = np.r_[np.ones(loud), pieces.quiet[quiet]]
    length = np.r_[pieces.length, quiet].astype(np.int64)
    inside = np.arange(PIECE)[None, :] < length[:, None]
    number, place = pieces.number, pieces.piece * PIECE + pieces.place
    tag = np.zeros((len(length), PIECE), dtype=np.int64)
    tag.ravel()[place[pieces.toxic[pieces.piece] == 1]] = 1
    n, m = len(markers), float((length * weight).sum())
    count = np.broadcast_to(weight[:, None], tag.shape)
    seen_moves = np.bincount((tag[:, :-1] * 2 + tag[:, 1:])[inside[:, 1:]], weights=count[:, 1:][inside[:, 1:]], minlength=4)
    seen = np.r_[np.bincount(number, weights=tag.ravel()[place], minlength=n), (tag * count)[inside].sum(), seen_moves]
    value = np.zeros(n + 5)
    value[n] = -2.0
    one, two = np.zeros(n + 5), np.zeros(n + 5)
    for step in range(1, STEPS + 1):
        score = np.full(tag.size, value[n])
        np.add.at(score, place, value[number])
        p, steps = marginals(score.reshape(tag.shape), value[n + 1:].reshape(2, 2), length)
        p = p * inside
        expected = np.r_[np.bincount(number, weights=p.ravel()[place], minlength=n), (p * count).sum(), np.tensordot(weight, steps.sum(axis=1), 1)]
        slope = (seen - expected) / m - DECAY * np.r_[value[:n] * 0.01, 0, value[n + 1:]]
        one, two = 0.9 * one + 0.1 * slope, 0.99 * two + 0.01 * slope ** 2
        value += RATE * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.99 ** step)) + 1e-9) * min(1, 2 * (1 - step / (STEPS + 1)))
    return Field(markers, value[:n], float(value[n]), value[n + 1:].reshape(2, 2))


def with_unseen(field: Field, odds: np.ndarray, pieces: Pieces) -> Field:
    """Markers that the training sequences lack get their weight from the counts over all labelled
    documents: their log odds above the bias, shared among the markers that a token has on average."""
    seen = np.zeros(len(field.markers), dtype=bool)
    seen[pieces.number] = True
    tokens = len(np.unique(pieces.piece * PIECE + pieces.place))
    share = tokens / len(pieces.number) if tokens else 1 / (1 + len(PREFIXES))
    return field._replace(weights=np.where(seen, field.weights, np.maximum(odds - field.bias, 0) * share))


def cut_pieces(found: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of the texts whose tokens have the markers ``found``, text i from ``first[i]`` on: the
    texts and lengths of all pieces, then the piece, place and number of each marker of a token."""
    size = np.diff(first)
    many = -(-size // PIECE)
    text = np.repeat(np.arange(len(size)), many)
    begin = np.r_[0, np.cumsum(many)]
    length = np.minimum(size[text] - (np.arange(len(text)) - begin[text]) * PIECE, PIECE)
    token, column = np.nonzero(found >= 0)
    owner = np.searchsorted(first, token, side="right") - 1
    at = token - first[owner]
    return text, length, begin[owner] + at // PIECE, at % PIECE, found[token, column]


def collect_pieces(part: DataFrame, markers: np.ndarray) -> Pieces:
    """The pieces of (label, text) rows. They are cut in the tasks: the driver gets the markers of the
    pieces that have some and one sum for each length of the others, whatever the texts' lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("length", pa.int32()), ("toxic", pa.int32()), ("marks", pa.binary()), ("n", pa.int64())])
        field = Field(markers, np.zeros(len(markers)), 0.0, np.zeros((2, 2)))
        for batch, texts in text_slices(batches, "text"):
            words = find_words(texts, ALNUM)
            text, length, piece, place, number = cut_pieces(field.find(token_features(words)), words.first)
            loud, start = np.unique(piece, return_index=True)
            marks = [m.astype("<i4").tobytes() for m in np.split(np.stack([place, number], axis=1), start[1:])] if len(loud) else []
            silent = np.ones(len(text), dtype=bool)
            silent[loud] = False
            quiet = np.bincount(length[silent], minlength=PIECE + 1)
            some = np.flatnonzero(quiet)
            yield record_batch(out, [np.r_[length[loud], some], np.r_[batch.column("label").to_numpy()[text[loud]], np.zeros(len(some), dtype=int)],
                                     marks + [None] * len(some), np.r_[np.ones(len(loud), dtype=int), quiet[some]]])

    rows = (part.select("label", "text").mapInArrow(run, "length int, toxic int, marks binary, n long")
            .groupBy("length", "toxic", "marks").agg(F.sum("n").alias("n")).collect())
    quiet = np.zeros(PIECE + 1)
    loud = []
    for r in rows:
        if r.marks is None:
            quiet[r.length] += r.n
        else:
            loud += [r] * r.n
    marks = [np.frombuffer(r.marks, dtype="<i4").reshape(-1, 2) for r in loud]
    flat = np.concatenate(marks).astype(np.int64) if marks else np.zeros((0, 2), dtype=np.int64)
    return Pieces(np.array([r.length for r in loud], dtype=np.int64), np.repeat(np.arange(len(marks)), [len(m) for m in marks]),
                  flat[:, 0], flat[:, 1], np.array([r.toxic for r in loud], dtype=np.int64), quiet)


def tag_texts(field: Field, texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words, the numbers of the tokens in reach of a marker, and their marginals."""
    words = find_words(texts, ALNUM)
    n = len(words.start)
    if not n:
        return words, np.zeros(0, dtype=np.int64), np.zeros(0)
    found = field.find(token_features(words))
    marked = np.flatnonzero((found >= 0).any(axis=1))
    if not len(marked):
        return words, marked, np.zeros(0)
    score = np.full(n, field.bias)
    np.add.at(score, marked, np.where(found[marked] >= 0, field.weights[np.maximum(found[marked], 0)], 0).sum(axis=1))
    # stretches around marked tokens, within their texts
    doc = words.doc[marked]
    begin = np.maximum(marked - MARGIN, words.first[doc])
    end = np.minimum(marked + MARGIN + 1, words.first[doc + 1])
    new = np.r_[True, (begin[1:] > end[:-1]) | (doc[1:] != doc[:-1])]
    begin, end, doc = begin[new], end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]], doc[new]
    far = _quiet_messages(field)
    head = np.where(begin > words.first[doc], far[0], 1.0)
    tail = np.where(end < words.first[doc + 1], far[1], 1.0)
    tokens, values = [], []
    order = np.argsort(end - begin, kind="stable")
    for part in np.array_split(order, max(1, len(order) // 256)):
        size = end[part] - begin[part]
        at = begin[part][:, None] + np.arange(size.max())[None, :]
        inside = at < end[part][:, None]
        p, _ = marginals(score[np.minimum(at, n - 1)], field.moves, size, head[part], tail[part])
        tokens.append(at[inside])
        values.append(p[inside])
    tokens, values = np.concatenate(tokens), np.concatenate(values)
    order = np.argsort(tokens, kind="stable")
    return words, tokens[order], values[order]


def _quiet_messages(field: Field) -> tuple[float, float]:
    """The odds that an endless chain of unmarked tokens brings forward and backward."""
    m, s = np.exp(field.moves), np.exp(field.bias)
    forward = backward = 1.0
    for _ in range(200):
        forward, backward = _through(forward * s, m), _through(backward * s, m.T)
    return float(forward), float(backward)


def aggregates(words: Words, tokens: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """For each text: expected toxic tokens, the greatest marginal, words, and a logistic's inputs."""
    doc = words.doc[tokens]
    expected = np.bincount(doc, weights=values, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, doc, values)
    count = np.diff(words.first).astype(float)
    a, b = np.log1p(expected), np.log((expected + 0.1) / (count + 20))
    return np.stack([np.ones(n), a, b, most, a * a, b * b, a * b], axis=1)


class Model(NamedTuple):
    field: Field
    logistic: np.ndarray

    def scores(self, inputs: np.ndarray) -> np.ndarray:
        return _sigmoid(inputs @ self.logistic)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps, each halved until it does not make the fit worse."""
    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.025 * v @ v)

    value = np.zeros(x.shape[1])
    now = loss(value)
    for _ in range(100):
        p = _sigmoid(x @ value)
        slope = x.T @ (weight * (y - p)) - 0.05 * value
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(value))
        step = np.linalg.solve(curve, slope)
        for _ in range(40):
            if (after := loss(value + step)) <= now:
                break
            step = step / 2
        else:
            break
        value = value + step
        if now - after <= 1e-12 * now:
            break
        now = after
    return value


# ---------------------------------------------------------------- Spark steps
def sample_labels(labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, int]]:
    """(id, label, half) of at most ``most`` rows of each label, and the labels' counts."""
    counts = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    order = F.xxhash64("id", F.lit(7))
    parts = [labels.where(F.col("label") == v).orderBy(order, "id").limit(most) for v in (0, 1)]
    return parts[0].unionByName(parts[1]).withColumn("half", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(2)).cast("int")), counts


def significant(bins: list[tuple[int, int]], tested: int) -> float:
    """The least evidence (G-test of a two-by-two table, one side) at which at most CHANCE of the
    features with as much are expected by chance, from the counts of features by bin; infinite
    where there is none. ``tested`` features were looked at."""
    least, seen = math.inf, 0
    for step, n in sorted(bins, reverse=True):
        seen += n
        evidence = step * EVIDENCE_STEP
        if tested * 0.5 * math.erfc(math.sqrt(evidence / 2)) <= CHANCE * seen:
            least = evidence
    return least


def count_markers(labelled: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features that come MARKER_RATIO times as often in toxic texts as in clean ones, and in more
    toxic documents than chance explains (see ``significant``; no fixed number of documents, so a
    few toxic ones that agree are enough): all of them, sorted, and for each the logarithm of
    its toxic occurrences over its clean ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([(c, pa.int64()) for c in ("feature", "toxic", "clean", "docs", "clean_docs")])
        for batch, texts in text_slices(batches, text):
            label = batch.column("label").to_numpy()
            words = find_words(texts, ALNUM)
            if not len(words.start):
                continue
            features = token_features(words)
            doc = np.repeat(words.doc, features.shape[1])
            flat = features.ravel()
            doc, flat = doc[flat != 0], flat[flat != 0]
            order = np.lexsort((doc, flat))
            f, d = flat[order], doc[order]
            new = np.flatnonzero(np.r_[True, f[1:] != f[:-1]])
            toxic = label[d] == 1
            fresh = np.r_[True, (f[1:] != f[:-1]) | (d[1:] != d[:-1])]
            add = lambda x: np.add.reduceat(x.astype(np.int64), new)
            yield record_batch(out, [f[new].view(np.int64), add(toxic), add(~toxic), add(toxic & fresh), add(~toxic & fresh)])
            # feature 0, which no word has, counts all tokens and documents
            known = label[np.unique(words.doc)]
            yield record_batch(out, [[0], *([int((v == k).sum())] for v in (label[words.doc], known) for k in (1, 0))])

    counted = labelled.mapInArrow(run, "feature long, toxic long, clean long, docs long, clean_docs long").groupBy("feature").agg(
        *(F.sum(c).alias(c) for c in ("toxic", "clean", "docs", "clean_docs")))
    # one document is never evidence
    path = f"{scratch_dir(labelled.sparkSession, 'markers')}/counts"
    counted.where("feature = 0 OR docs + clean_docs > 1").write.parquet(path)
    counted = labelled.sparkSession.read.parquet(path)
    total = counted.where("feature = 0").first()
    if not total or not total.docs or not total.clean_docs:
        return np.zeros(0, dtype=np.uint64), np.zeros(0)
    ratio = ((F.col("toxic") + 0.5) / float(total.toxic)) / ((F.col("clean") + 0.5) / float(total.clean))
    n1, n0 = float(total.docs), float(total.clean_docs)
    a, b = F.col("docs").cast("double"), F.col("clean_docs").cast("double")
    cells = ((a, (a + b) * n1), (b, (a + b) * n0), (n1 - a, (n1 + n0 - a - b) * n1), (n0 - b, (n1 + n0 - a - b) * n0))
    evidence = sum((F.when(o > 0, o * F.log(o * (n1 + n0) / e)).otherwise(0.0) for o, e in cells), F.lit(0.0)) * 2
    step = F.when(a * n0 > b * n1, F.floor(evidence / EVIDENCE_STEP)).otherwise(0)
    tested = counted.where("feature != 0").select("feature", "toxic", "clean", ratio.alias("ratio"), step.alias("step"))
    bins = [(r.step, r["count"]) for r in tested.groupBy("step").count().collect()]
    least = significant(bins, sum(n for _, n in bins))
    if math.isinf(least):
        return np.zeros(0, dtype=np.uint64), np.zeros(0)
    best = tested.where((F.col("step") >= round(least / EVIDENCE_STEP)) & (F.col("ratio") >= MARKER_RATIO)).select("feature", "toxic", "clean").collect()
    markers = np.array([r.feature for r in best], dtype=np.int64).view(np.uint64)
    odds = np.log(np.array([(r.toxic + 0.5) / (r.clean + 0.5) for r in best]))
    order = np.argsort(markers)
    return markers[order], odds[order]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", most: int = SAMPLE) -> Model:
    """Markers from all labelled documents; the field and the document score from at most ``most``
    documents of each label, read whole: a half each, or the whole sample where a half lacks
    a label. Without both labels, or without any marker, every document scores 0 (or, with toxic
    labels only, 1)."""
    sample, counts = sample_labels(labels, most)
    texts_of = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    # at most 2 * most narrow rows: small enough to send to every task
    chosen = texts_of.join(F.broadcast(sample), "id")
    width = 7
    nothing = Model(Field(np.zeros(0, dtype=np.uint64), np.zeros(0), -5.0, np.zeros((2, 2))), np.r_[-50.0 if counts.get(0) or not counts else 50.0, np.zeros(width - 1)])
    if not counts.get(0) or not counts.get(1):
        return nothing
    # labels grow with the corpus: never broadcast, so the plan is one at every size
    markers, odds = count_markers(texts_of.join(labels.hint("merge"), "id").select("label", "text"), "text")
    if not len(markers):
        return nothing

    pieces = collect_pieces(chosen.where("half = 0"), markers)
    if not pieces.toxic.any():
        pieces = collect_pieces(chosen, markers)
    if not len(pieces.length):
        return nothing
    field = with_unseen(train_field(markers, pieces), odds, pieces)

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            x = aggregates(*tag_texts(field, texts), len(texts))
            yield record_batch(pa.schema([("label", pa.int32()), ("x", pa.binary())]), [batch.column("label"), [r.tobytes() for r in x]])

    for part in (chosen.where("half = 1"), chosen):
        rows = part.select("label", "text").mapInArrow(inputs, "label int, x binary").collect()
        y = np.array([r.label for r in rows], dtype=float)
        if len(y) and y.min() < y.max():
            break
    else:
        return nothing
    x = np.stack([np.frombuffer(r.x, dtype=np.float64) for r in rows])
    weight = np.where(y == 1, counts[1] / max(1, y.sum()), counts[0] / max(1, (1 - y).sum()))
    return Model(field, fit_logistic(x, y, weight / weight.mean()))


FOUND = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("marginal", T.DoubleType())])))])


def score_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity``: the score (0 to 1) and the tokens whose marginal is at least
    a half, as code points of the text, end exclusive.

    Null and empty texts have no tokens and the score of none; repeated rows are scored alike;
    other columns pass through (one named ``toxicity`` is replaced); an empty table gives no rows."""
    rest = [c for c in docs.columns if c != "toxicity"]
    plain = docs.select(*[F.col(f"`{c}`") for c in rest])
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text):
            words, tokens, values = tag_texts(model.field, texts)
            score = model.scores(aggregates(words, tokens, values, len(texts)))
            spans: list[list[dict]] = [[] for _ in texts]
            points: dict[int, np.ndarray] = {}
            for token, value in zip(tokens[values >= 0.5], values[values >= 0.5], strict=True):
                i = int(words.doc[token])
                if i not in points:
                    points[i] = np.r_[0, np.cumsum((np.frombuffer(texts[i], dtype=np.uint8) & 0xC0) != 0x80)]
                a, b = words.start[token] - words.offsets[i], words.end[token] - words.offsets[i]
                spans[i].append({"start": int(points[i][a]), "end": int(points[i][b]), "marginal": float(value)})
            kept = batch.select(rest)
            found = [{"score": float(s), "spans": p} for s, p in zip(score, spans, strict=True)]
            yield record_batch(pa.schema([*kept.schema, pa.field("toxicity", kind)]), [*kept.columns, found])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("toxicity", FOUND)]))


def toxicity(docs: DataFrame, labels: DataFrame, target: str = "toxic", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the labelled rows that may be learnt from, then score every row of ``docs``."""
    # no text of a held-out row is moved to the labels
    return score_documents(docs, fit(docs.where(~held_out(key)), training_labels(labels, target, key), key, text), text)
