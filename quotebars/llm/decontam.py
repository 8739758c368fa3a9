"""Benchmark decontamination by a generalised suffix automaton over words.

The automaton of the normalised test items takes in a document word by word and knows at
each word the longest match that ends there. A window of an item (13 words, or the whole of a
shorter item) occurs where that match is long enough, so its words are marked as hit.

Only stretches in which every successive gram of a few words also occurs in some item are
streamed: no window can lie outside of them, so this changes no result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebars.llm.tables import record_batch, set_apart, text_slices
from quotebars.llm.words import ALNUM, find_words, hash_grams, hash_words

WINDOW = 13
#: test items that one automaton holds, in bytes of text; a longer benchmark makes several,
#: and a task has one of them at work at a time
BLOCK_BYTES = 8 << 20


class ItemAutomaton:
    """Generalised suffix automaton of items' word ids, with the windows that each state stands for."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        words = find_words([text for _, text in items], ALNUM)
        hashes = hash_words(words)
        self.window = window
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes).tolist()
        runs = [(name, ids[words.first[i]:words.first[i + 1]]) for i, (name, _) in enumerate(items)]
        runs = [(name, run) for name, run in runs if run]
        self.shortest = min([window, *(len(run) for _, run in runs)])
        self.gram = min(3, self.shortest)
        grams = hash_grams(hashes, self.gram)
        same = words.doc[self.gram - 1:] == words.doc[:len(words.doc) - self.gram + 1]
        self.grams = np.unique(grams[same]) if len(grams) else np.zeros(0, dtype=np.uint64)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = [self._add(run) for _, run in runs]
        #: items of the whole windows that a state stands for; of whole short items
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, set[str]] = {}
        for (name, run), end in zip(runs, ends, strict=True):
            if len(run) < window:
                self.short.setdefault(end, set()).add(name)
            else:
                for state, size in self.walk(run):
                    if size >= window:
                        self.items.setdefault(self.top(state), set()).add(name)
        self._shorts: dict[int, tuple[tuple[int, frozenset[str]], ...]] = {}

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, before: int, word: int) -> int:
        """The state of the words up to ``before`` and then ``word``, with no longer ones in it."""
        to = self.next[before][word]
        if self.length[to] == self.length[before] + 1:
            return to
        part = self._state(self.length[before] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = part
        while before >= 0 and self.next[before].get(word) == to:
            self.next[before][word] = part
            before = self.link[before]
        return part

    def _add(self, run: list[int]) -> int:
        last = 0
        for word in run:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            new, before = self._state(self.length[last] + 1, 0, {}), last
            while before >= 0 and word not in self.next[before]:
                self.next[before][word] = new
                before = self.link[before]
            self.link[new] = self._split(before, word) if before >= 0 else 0
            last = new
        return last

    def walk(self, run: Iterable[int]) -> Iterator[tuple[int, int]]:
        """For each word: the state of the longest match that ends there, and its length."""
        moves, link, length = self.next, self.link, self.length
        state = size = 0
        for word in run:
            while state and word not in moves[state]:
                state = link[state]
                size = length[state]
            if word in moves[state]:
                state = moves[state][word]
                size += 1
            yield state, size

    def top(self, state: int) -> int:
        """The state of the last ``window`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def shorts(self, state: int) -> tuple[tuple[int, frozenset[str]], ...]:
        """(length, items) of the short items that end what ``state`` stands for."""
        if state <= 0 or not self.short:
            return ()
        found = self._shorts.get(state)
        if found is None:
            own = ((self.length[state], frozenset(self.short[state])),) if state in self.short else ()
            found = self._shorts[state] = own + self.shorts(self.link[state])
        return found

    def stretches(self, hashes: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words all of whose grams are grams of items, long enough for a window."""
        if len(hashes) < self.shortest or not len(self.grams):
            return
        at = np.searchsorted(self.vocabulary, hashes)
        known = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == hashes
        n = len(hashes) - self.gram + 1
        hit = known[:n] & (doc[:n] == doc[self.gram - 1:])
        for k in range(1, self.gram):
            hit &= known[k:n + k]
        where = np.flatnonzero(hit)
        if not len(where):
            return
        parts = [hashes[where + k] for k in range(self.gram)]
        grams = hash_grams(np.stack(parts, axis=1).reshape(-1), self.gram)[::self.gram]
        at = np.searchsorted(self.grams, grams)
        where = where[self.grams[np.minimum(at, len(self.grams) - 1)] == grams]
        if not len(where):
            return
        breaks = np.flatnonzero((np.diff(where) != 1) | (doc[where[1:]] != doc[where[:-1]]))
        begins, ends = where[np.r_[0, breaks + 1]], where[np.r_[breaks, len(where) - 1]] + self.gram
        for i in np.flatnonzero(ends - begins >= self.shortest):
            yield int(begins[i]), int(ends[i])

    def mark(self, hashes: np.ndarray, doc: np.ndarray, hit: np.ndarray, found: dict[int, set[str]],
             longest: dict[int, int]) -> None:
        """Set ``hit`` for the words that windows cover; add to each document's items and longest match."""
        for begin, end in self.stretches(hashes, doc):
            number = int(doc[begin])
            names: set[str] = set()
            best = 0
            ids = np.searchsorted(self.vocabulary, hashes[begin:end]).tolist()
            for i, (state, size) in enumerate(self.walk(ids), begin + 1):
                best = max(best, size)
                if size >= self.window:
                    hit[i - self.window:i] = True
                    names |= self.items[self.top(state)]
                for length, own in self.shorts(state):
                    if length <= size:
                        hit[i - length:i] = True
                        names |= own
            longest[number] = max(longest.get(number, 0), best)
            if names:
                found.setdefault(number, set()).update(names)


def automata(benchmark: DataFrame, key: str, text: str, window: int, block_bytes: int) -> list:
    """One broadcast automaton for each ``block_bytes`` of items (read block by block)."""
    sc = benchmark.sparkSession.sparkContext
    out, block, held = [], [], 0
    for name, value in benchmark.select(F.col(key).cast("string"), F.col(text).cast("binary")).toLocalIterator():
        block.append((name or "", bytes(value or b"")))
        held += len(block[-1][1])
        if held >= block_bytes:
            out.append(sc.broadcast(ItemAutomaton(block, window)))
            block, held = [], 0
    if block:
        out.append(sc.broadcast(ItemAutomaton(block, window)))
    return out


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("longest_match", T.IntegerType()), T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
                       item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``found``: n_words, n_hit, longest_match, items (sorted as strings) and the
    hit spans as code points, end exclusive (from a first hit word to the last one in a row).

    Words are runs of ASCII digits, letters (lower-cased) and non-ASCII characters. Null and
    empty texts have no words, null and empty items no windows; repeated rows give repeated
    results; other columns, a ``found`` among them replaced, pass through; empty tables on
    either side give no rows or no hits. The texts are never shuffled."""
    blocks = automata(benchmark, item_key, item_text, window, block_bytes)
    rest = [c for c in docs.columns if c != "found"]
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in rest]).schema.fields, T.StructField("found", FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text):
            words = find_words(texts, ALNUM)
            hashes = hash_words(words)
            hit = np.zeros(len(hashes), dtype=bool)
            found: dict[int, set[str]] = {}
            longest: dict[int, int] = {}
            for block in blocks:
                block.value.mark(hashes, words.doc, hit, found, longest)
            rows = []
            for i, value in enumerate(texts):
                a, b = words.first[i], words.first[i + 1]
                spans = [{"start": s, "end": e} for s, e in _spans(words, a, b, hit, value, int(words.offsets[i]))] if i in found else []
                rows.append({"n_words": int(b - a), "n_hit": int(hit[a:b].sum()) if i in found else 0,
                             "longest_match": longest.get(i, 0), "items": sorted(found.get(i, ())), "spans": spans})
            kept = batch.select(rest)
            kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest_match", pa.int32()), ("items", pa.list_(pa.string())),
                              ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
            yield record_batch(pa.schema([*kept.schema, pa.field("found", kind)]), [*kept.columns, rows])

    return docs.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)


def _spans(words, a: int, b: int, hit: np.ndarray, text: bytes, offset: int) -> Iterator[tuple[int, int]]:
    edge = np.diff(np.r_[0, hit[a:b].astype(np.int8), 0])
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    points = np.r_[0, np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)]
    for s, e in zip(begins, ends, strict=True):
        yield int(points[words.start[a + s] - offset]), int(points[words.end[a + e] - offset])


def is_contaminated(one_in: int = 20, max_match: int | None = None) -> Column:
    """The limits: at least one in so many words is hit; if given, a match of more words."""
    covered = (F.col("found.n_hit") > 0) & (F.col("found.n_hit") * one_in >= F.col("found.n_words"))
    return covered if max_match is None else covered | (F.col("found.longest_match") > max_match)


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """The text without its hit spans (the rest of the text is left as it is)."""
    cut = F.aggregate(F.col("found.spans"), F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
                      lambda acc, s: F.struct(F.concat(acc["kept"], F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"])).alias("kept"), s["end"].alias("at")),
                      lambda acc: F.concat(acc["kept"], F.substring(F.col(text), acc["at"] + 1, F.char_length(F.col(text)))))
    return found.withColumn(text, F.when(F.size("found.spans") > 0, cut).otherwise(F.col(text)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, one_in: int = 20, max_match: int | None = None,
                  cut_spans: bool = False, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without those beyond the limits; with ``cut_spans`` the others lose their hit spans. Columns
    of any name come back as they are."""
    plain, names, back = set_apart(docs)
    found = find_contamination(plain, benchmark, names[text], window=window).where(~is_contaminated(one_in, max_match))
    return back(remove_spans(found, names[text]) if cut_spans else found)
