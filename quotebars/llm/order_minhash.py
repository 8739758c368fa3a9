"""Order MinHash: fingerprints that follow the edit distance of whole texts.

Every k-mer of a text gets the number of its occurrence. For each of the signature's permutations
the few k-mers of the least hash values are selected and put back in text order; a hash of that
tuple is one entry. Two texts agree in an entry if they select the same k-mers in the same order,
so rearranged text counts as different where plain MinHash sees the same set.

To compare a text with one that is spliced from its neighbour, the documents are dealt by range of
their identifiers and sorted; a task walks its rows and holds two texts at a time. What the last
row of one task needs of the first row of the next is exchanged afterwards, a row for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotebars.llm.tables import record_batch, text_slices
from quotebars.llm.words import mix
from quotebars.session import scratch_dir

#: code points of a k-mer, k-mers of a tuple, permutations of a signature
K, TUPLE, PERMUTATIONS = 5, 2, 64
#: positions that are hashed at once
BLOCK = 4096
#: least k-mers of so many blocks are held before they are merged
OFFERS = 256
_U32, _U64 = np.uint32, np.uint64
_GOLDEN = 0x9E3779B97F4A7C15


def factors(n: int) -> np.ndarray:
    """``n`` odd numbers: multiplied modulo 2^32 each permutes the 32-bit numbers."""
    drawn = mix(np.arange(1, n + 1, dtype=np.uint64) * _U64(_GOLDEN))
    return (drawn >> _U64(32)).astype(np.uint32)[:, None] | _U32(1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` successive code points: a polynomial, put together from halves."""
    power, base = 1, _U64(_GOLDEN)
    part, out, length = codes.astype(np.uint64), None, 0     # the hash of every `power`, and of every `length`, code points
    while True:
        if k & power:
            out = part if out is None else out[:len(part) - length] * base + part[length:] if length else part
            length += power
        power *= 2
        if power > k:
            return mix(out[:len(codes) - k + 1])
        half = power // 2
        part = part[:-half] * base + part[half:]
        base = _U64(int(base) ** 2 % (1 << 64))


def numbered_kmers(codes: np.ndarray, k: int) -> np.ndarray:
    """A 32-bit hash of each k-mer with the number of its occurrence, in text order; a text of fewer
    code points, but not none, is one k-mer."""
    if len(codes) == 0:
        return np.zeros(0, dtype=np.uint32)
    h = gram_hashes(codes, min(k, len(codes)))
    # one sort brings equal k-mers together in text order: the hash's high bits above, the position below
    low = _U64(int(len(h)).bit_length())
    packed = (h >> low << low) | np.arange(len(h), dtype=np.uint64)
    packed.sort()
    gram = packed >> low
    again = np.flatnonzero(gram[1:] == gram[:-1]) + 1
    if len(again):      # of a run's members all but the first, numbered from 1
        number = np.arange(1, len(again) + 1)
        begins = np.concatenate([[True], again[1:] - again[:-1] > 1])
        number -= np.maximum.accumulate(np.where(begins, number - 1, 0))
        place = packed[again] & ((_U64(1) << low) - _U64(1))
        h[place.astype(np.int64)] ^= mix(number.astype(np.uint64) * _U64(_GOLDEN))
    return (mix(h) >> _U64(32)).astype(np.uint32)


class Sketcher:
    """Signatures of texts: an array of PERMUTATIONS 32-bit entries each."""

    def __init__(self, k: int = K, size: int = TUPLE, permutations: int = PERMUTATIONS) -> None:
        self.k, self.size, self.n = k, size, permutations
        self.factor, self.rows = factors(permutations), np.arange(permutations)
        self.hashed = np.empty((permutations, BLOCK), dtype=np.uint32)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        grams = numbered_kmers(codes, self.k)
        return self.entries(grams, self.least(grams, 0, len(grams)))

    def least(self, grams: np.ndarray, begin: int, end: int, found: tuple | None = None) -> tuple | None:
        """(values, places) of each permutation's least k-mers among ``found`` and those from ``begin`` on."""
        offers = [found] if found is not None else []
        for at in range(begin, end, BLOCK):
            block = grams[at:min(at + BLOCK, end)]
            h = np.multiply(block, self.factor, out=self.hashed[:, :len(block)])
            for _ in range(min(self.size, len(block))):
                place = h.argmin(axis=1)
                offers.append((h[self.rows, place][:, None], place[:, None] + at))
                h[self.rows, place] = _U32(0xFFFFFFFF)
            if len(offers) > OFFERS:
                offers = [self.best(offers)]
        return self.best(offers) if offers else None

    def best(self, offers: list[tuple]) -> tuple:
        """Of equal values the earlier place wins; offers come in the order of the text."""
        values, places = (np.concatenate(x, axis=1) for x in zip(*offers, strict=True))
        if values.shape[1] <= self.size:
            return values, places
        order = np.argsort(values, axis=1, kind="stable")[:, :self.size]
        return np.take_along_axis(values, order, 1), np.take_along_axis(places, order, 1)

    def entries(self, grams: np.ndarray, found: tuple | None) -> np.ndarray:
        entry = np.full(self.n, self.size, dtype=np.uint64)
        if found is None:
            return (mix(entry) >> _U64(32)).astype(np.uint32)
        place = np.sort(found[1], axis=1)
        for i in range(place.shape[1]):
            entry = mix((entry + _U64(_GOLDEN)) ^ grams[place[:, i]])
        return (entry >> _U64(32)).astype(np.uint32)


def likeness(a: Column, b: Column) -> Column:
    """The share of equal entries of two fingerprints (strings of eight hex digits an entry)."""
    entries = F.floor(F.length(a) / 8)
    same = F.aggregate(F.sequence(F.lit(0).cast("long"), entries - 1), F.lit(0),
                       lambda n, i: n + F.when(F.substring(a, i.cast("int") * 8 + 1, F.lit(8)) == F.substring(b, i.cast("int") * 8 + 1, F.lit(8)), 1).otherwise(0))
    return same / entries


def fingerprints(docs: DataFrame, text: str = "text", k: int = K, size: int = TUPLE, permutations: int = PERMUTATIONS,
                 name: str = "fingerprint") -> DataFrame:
    """``docs`` with ``name``: the signature of each whole text in hex, eight digits an entry.

    Null counts as empty; empty texts share a signature; a text of fewer than ``k`` code points is one
    k-mer; one with fewer k-mers than a tuple takes selects all of them. A column called ``name`` is
    replaced. The memory of a task follows its longest text (about 50 bytes a code point)."""
    columns = [c for c in docs.columns if c != name]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    schema = packed.select("row", F.lit("").alias("print")).schema

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(k, size, permutations)
        for part, texts in text_slices(batches, "text"):
            prints = [sketch(code_points(t.decode())).astype(">u4").tobytes().hex() for t in texts]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(prints, pa.string())], names=["row", "print"])

    return packed.mapInArrow(sign, schema).select("row.*", F.col("print").alias(name))


# ---------------------------------------------------------------- a text and its splice
def splice(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


PAIR = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("own", pa.binary()), ("edited", pa.binary()),
                  ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())])
PAIR_DDL = ("doc_id long, n_chars long, edited_sha256 string, own binary, edited binary, near_edited double, near_next double, "
            "part int, edge string, text string")
FIRST, LAST = "first", "last"


class Seen:
    """A text with its signature and the least k-mers of the part that a splice leaves."""

    def __init__(self, doc_id: int | None, text: str, sketch: Sketcher, before: Seen | None = None) -> None:
        self.doc_id, self.text = doc_id, text
        if before is not None and before.text == text:
            self.stays, self.found, self.print = before.stays, before.found, before.print
            return
        grams = numbered_kmers(code_points(text), sketch.k)
        self.stays = max(len(text) - len(text) // 3 - sketch.k + 1, 0) if len(text) >= sketch.k else 0
        self.found = sketch.least(grams, 0, self.stays)
        self.print = sketch.entries(grams, sketch.least(grams, self.stays, len(grams), self.found))

    def pair(self, after: Seen, sketch: Sketcher) -> list:
        edited = splice(self.text, after.text)
        signed = self.print
        if edited != self.text:
            grams = numbered_kmers(code_points(edited), sketch.k)
            signed = sketch.entries(grams, sketch.least(grams, self.stays, len(grams), self.found))
        alike = lambda x: float(np.count_nonzero(self.print == x)) / len(self.print)
        return [self.doc_id, len(self.text), hashlib.sha256(edited.encode()).hexdigest(), self.print.astype(">u4").tobytes(),
                signed.astype(">u4").tobytes(), alike(signed), alike(after.print)]

    def edge(self, part: int, edge: str) -> list:
        return [self.doc_id, len(self.text), None, None, None, None, None, part, edge, self.text]


def walk(sizes: tuple[int, int, int]) -> Callable:
    """Sorted rows (doc_id, text) to pairs with the row after; the first and the last row of the task
    come out as edges, with their texts."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sketch, held = TaskContext.get().partitionId(), Sketcher(*sizes), None
        for rows, texts in text_slices(batches, "text"):
            out = []
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), texts, strict=True):
                now = Seen(doc_id, text.decode(), sketch, held)
                if held is None:
                    out.append(now.edge(part, FIRST))
                else:
                    out.append([*held.pair(now, sketch), part, None, None])
                held = now
            yield record_batch(PAIR, list(zip(*out, strict=True)))
        if held is not None:
            yield record_batch(PAIR, list(zip(held.edge(part, LAST), strict=True)))

    return stream


def close_edges(sizes: tuple[int, int, int]) -> Callable:
    """Rows (doc_id, text, next_text) to pairs."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(*sizes)
        for batch in batches:
            for row in batch.to_pylist():
                pair = Seen(row["doc_id"], row["text"], sketch).pair(Seen(None, row["next_text"], sketch), sketch)
                yield record_batch(PAIR, [[v] for v in (*pair, -1, None, None)])

    return stream


def compare_with_splices(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, size: int = TUPLE,
                         permutations: int = PERMUTATIONS) -> DataFrame:
    """One row per document: key, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, and the
    likeness ``near_edited`` and ``near_next`` of its fingerprint to the spliced text's and the next text's.

    The next document is the one with the next smaller identifier, the first one after the last. Null
    identifiers come last, rows of one identifier by a hash of their texts and then the texts. Null texts are
    empty; empty texts share a signature, so their likeness is 1. A single document is its own next one. An
    empty table gives no rows; further columns are ignored."""
    spark, sizes = docs.sparkSession, (k, size, permutations)
    root = scratch_dir(spark, "order-minhash")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    parts = max(rows.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text").mapInArrow(walk(sizes), PAIR_DDL)
     .write.parquet(f"{root}/pairs"))
    pairs = spark.read.parquet(f"{root}/pairs")
    # tasks without rows leave no edges: the next task is the next one that has some
    firsts, lasts = (pairs.where(F.col("edge") == e).select("part", "doc_id", "text") for e in (FIRST, LAST))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = firsts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(whole)).alias("after"))
    edges = lasts.join(follows, "part").join(firsts.select(F.col("part").alias("after"), F.col("text").alias("next_text")), "after")
    # an edge for each task, so as many tasks close them as there are slots, however many partitions the joins have
    closed = edges.select("doc_id", "text", "next_text").coalesce(spark.sparkContext.defaultParallelism).mapInArrow(close_edges(sizes), PAIR_DDL)
    hexed = lambda c: F.lower(F.hex(c))
    return pairs.where("edge IS NULL").union(closed).select(
        F.col("doc_id").alias(key), "n_chars", "edited_sha256", hexed("own").alias("fingerprint"), hexed("edited").alias("edited_fingerprint"),
        "near_edited", "near_next")
