"""Exact byte-fallback BPE of a SentencePiece model, by a table over prefixes.

The encoding of a prefix ends in one token only, whatever follows it in the segment. So one
pass of an automaton over the segment suffices: of the pieces that end at a position, that
one is the prefix's last token which is compatible with the last token of the prefix before
it, where two tokens are compatible if merging their joined text gives just these two. The
ids are then read off backwards. Time is linear in the text, without a priority queue.

A text is cut into segments that no merge can cross (before a white-space mark, and between two
characters that no piece has side by side: first, by one expression, where a character of the group
that makes most pieces meets one of no such piece, as between letters and punctuation), and
encodings of short segments are remembered.
"""

from __future__ import annotations

import codecs
import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebars.llm.tables import record_batch, text_slices

MARK = "▁"          # stands for a blank in pieces
#: segments that a worker remembers in each of two generations; token pairs twice as many
REMEMBERED = 200_000
#: longer segments are encoded but not remembered
SHORT = 48
#: characters of a text, at least, of which the segments are listed at once
BLOCK = 1 << 16
_EACH = "replace-each-byte"
codecs.register_error(_EACH, lambda e: ("�" * (e.end - e.start), e.end))


class Memory(dict):
    """A bounded memory of two generations. When the young one, the dictionary itself, is full, it
    becomes the old one; what is asked for again moves back, so rare keys are forgotten first."""

    def __init__(self, size: int = REMEMBERED):
        super().__init__()
        self.size, self.old = size, {}

    def put(self, key: object, value: object) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def again(self, key: object) -> object | None:
        """The value of a key that is not in the young generation, if it is in the old one."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value


class PieceTable:
    """Encoder and decoder of one model file."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.vocab_size()
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.end_id = model.eos_id()
        self.scores = {p: model.get_score(i) for i, p in enumerate(self.pieces) if i not in special and not model.is_unused(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if p in self.scores and i not in special}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in special if model.is_byte(i)}
        self.known = {c for p in self.scores for c in p}
        if not self.known <= set(self.scores):
            raise ValueError("every character of a piece must be a piece itself")
        # what an id decodes to; a byte becomes a code point that encodes to this byte alone
        self.texts = ["" if i in special else p.replace(MARK, " ") for i, p in enumerate(self.pieces)]
        for b, i in self.byte_ids.items():
            self.texts[i] = chr(b) if b < 0x80 else chr(0xDC00 + b)
        self.text_of = {str(i): t for i, t in enumerate(self.texts)}
        self.names = [str(i) for i in range(size)]
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece) - 1))
        self.automaton.make_automaton()
        # two characters, side by side, that some merge can join
        self.joined = {(a, b) for p in self.scores for a, b in zip(p, p[1:])}
        # of each token (the last: of none): whether the tokens that were met after it fit
        self.after: list[dict[int, bool]] = [{} for _ in range(size + 1)]
        self.n_pairs = 0
        self.histories: dict[int, tuple[list[float], list[str], list[str]] | None] = {}
        self.segments = Memory()
        inner = any(MARK in p.lstrip(MARK) for p in self.scores)
        group = "".join(map(re.escape, sorted(self.main_group(inner))))
        # no merge crosses the place before a mark unless a piece has one inside; in a text to cut, blanks are marks
        if inner:
            self.cut, self.block = re.compile(f"[{group}]+|[^{group}]+"), re.compile(r"(?s:.+)")
        else:
            self.cut = re.compile(f" *[{group}]+| *[^ {group}]+| +")
            self.block = re.compile(rf"(?s:.{{1,{BLOCK}}}) *[^ ]*")

    def main_group(self, inner: bool) -> set[str]:
        """Of the groups of characters that no piece mixes, that with the most pieces. If some piece
        has a mark inside, a mark counts as a character, a blank; else those at the front are left out."""
        first: dict[str, str] = {}

        def root(c: str) -> str:
            while first.setdefault(c, c) != c:
                first[c] = c = first[first[c]]
            return c

        bodies = [p.replace(MARK, " ") if inner else p.lstrip(MARK) for p in self.scores]
        for body in bodies:
            for a, b in zip(body, body[1:]):
                first[root(a)] = root(b)
        sizes = Counter(root(body[0]) for body in bodies if body)
        most = max(sizes, key=lambda c: (sizes[c], c))
        return {c for c in list(first) if root(c) == most}

    def history(self, token: int) -> tuple[list[float], list[str], list[str]] | None:
        """How plain merging (best score first, then leftmost) builds a piece from its characters:
        the scores of its merges in order, then -inf, and after each number of merges the first
        and the last part. None if merging ends in anything else."""
        if token in self.histories:
            return self.histories[token]
        parts = list(self.pieces[token])
        scores, firsts, lasts = [], [parts[0]], [parts[-1]]
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            scores.append(best)
            firsts.append(parts[0])
            lasts.append(parts[-1])
        found = (scores + [-math.inf], firsts, lasts) if len(parts) == 1 else None
        self.histories[token] = found
        return found

    def fits(self, left: int, right: int) -> bool:
        """Are the two tokens, side by side, the encoding of their text? left -1: is the right one alone?

        Merging goes on within the two as it would in each alone, whichever merge is next in score
        first, unless at some time a merge across the boundary comes before both."""
        found = self.after[left].get(right)
        if found is None:
            if self.n_pairs >= REMEMBERED * 2:
                self.n_pairs = 0
                for row in self.after:
                    row.clear()
            found = self.after[left][right] = self._fits(left, right)
            self.n_pairs += 1
        return found

    def _fits(self, left: int, right: int) -> bool:
        b = self.history(right)
        if left < 0 or b is None:
            return b is not None
        a = self.history(left)
        if a is None:
            return False
        (a_next, _, a_last), (b_next, b_first, _) = a, b
        i = j = 0
        while True:
            across = self.scores.get(a_last[i] + b_first[j])
            s, t = a_next[i], b_next[j]
            if across is not None and across > s and across >= t:   # of equal scores the leftmost merges
                return False
            if s == t == -math.inf:
                return True
            if s >= t:
                i += 1
            else:
                j += 1

    def encode_known(self, text: str) -> list[int]:
        """Ids of a text of known characters: the prefix table, then backwards."""
        after, fits = self.after, self.fits
        last, rows, done = [-1], [after[-1]], -1
        for end, (token, before) in self.automaton.iter(text):
            if end != done:
                good = rows[end - before].get(token)
                if good if good is not None else fits(last[end - before], token):
                    last.append(token)
                    rows.append(after[token])
                    done = end
        at, out, pieces = len(text), [], self.pieces
        while at:
            token = last[at]
            out.append(token)
            at -= len(pieces[token])
        return out[::-1]

    def encode_segment(self, text: str) -> list[int]:
        if self.known.issuperset(text):
            return self.encode_known(text)
        out: list[int] = []
        run: list[str] = []
        for c in text:
            if c in self.known:
                run.append(c)
                continue
            out += self.encode_known("".join(run))
            run = []
            out += [self.byte_ids[b] for b in c.encode()]
        return out + self.encode_known("".join(run))

    def parts(self, segment: str) -> list[str]:
        """The segment cut between characters that no piece has side by side: no merge crosses there."""
        joined = self.joined
        cuts = [i for i, pair in enumerate(zip(segment, segment[1:]), 1) if pair not in joined]
        return [segment[a:b] for a, b in zip([0, *cuts], [*cuts, len(segment)])] if cuts else [segment]

    def remembered(self, segment: str) -> str:
        """Ids of a segment, from memory if it is there. A long one is not remembered, but its parts are."""
        ids = self.segments.get(segment)
        if ids is None:
            ids = self.segments.again(segment)
        if ids is None:
            marked = segment.replace(" ", MARK)
            parts = self.parts(marked) if len(segment) > SHORT else ()
            if len(parts) > 1:
                return " ".join([self.remembered(part.replace(MARK, " ")) for part in parts])
            ids = " ".join(map(self.names.__getitem__, self.encode_segment(marked)))
            if len(segment) <= SHORT:
                self.segments.put(segment, ids)
        return ids

    def encode(self, text: str) -> str:
        """Decimal ids of a whole text, joined by a blank, without an end id."""
        if not text:
            return ""
        out: list[str] = []
        for block in self.block.findall(" " + text.replace(MARK, " ")):
            segments = self.cut.findall(block)
            ids = list(map(self.segments.get, segments))
            if None in ids:
                ids = [found or self.remembered(segment) for found, segment in zip(ids, segments, strict=True)]
            out.append(" ".join(ids))
        return " ".join(out)

    def decode(self, ids: str) -> str:
        """Text of decimal ids joined by a blank: control ids give nothing, runs of bytes are
        read as UTF-8 (U+FFFD for each byte that is none), the blank put in front goes."""
        if not ids:
            return ""
        parts = ids.split(" ")
        text = "".join(map(self.text_of.__getitem__, parts))
        if not text.isascii():
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", _EACH)
        first = next((p for p in parts if self.text_of[p]), None)
        return text[1:] if first is not None and self.pieces[int(first)][:1] == MARK else text


_TABLES: dict[str, PieceTable] = {}


def piece_table(model_file: str) -> PieceTable:
    if model_file not in _TABLES:
        _TABLES[model_file] = PieceTable(model_file)
    return _TABLES[model_file]


def _mapped(df: DataFrame, model_file: str, column: str, out: dict[str, object]) -> DataFrame:
    """Replace ``column`` by the columns of ``out`` (name: function of a table and a text)."""
    rest = [c for c in df.columns if c != column]
    plain = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{column}`").cast("string").alias("_text"))
    schema = plain.drop("_text").schema
    for name in out:
        schema = schema.add(name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_table(model_file)
        for batch, texts in text_slices(batches, "_text"):
            made = {name: [] for name in out}
            for text in texts:
                value = text.decode("utf-8", "replace")
                for name, f in out.items():
                    value = f(pieces, value)
                    made[name].append(value)
            kept = batch.drop_columns(["_text"])
            types = list(kept.schema) + [pa.field(n, pa.string()) for n in out]
            yield record_batch(pa.schema(types), list(kept.columns) + list(made.values()))

    return plain.mapInArrow(run, schema)


def _encoded(pieces: PieceTable, text: str) -> str:
    ids = pieces.encode(text)
    return f"{ids} {pieces.end_id}" if ids else str(pieces.end_id)


def encode_documents(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (decimal, joined by a blank, an end id last) in place of the text.

    Whole texts are encoded; a null or empty text has the end id alone; repeated rows give
    repeated results, an empty table none. Other columns pass through. ``ids_array`` turns
    the ids into an array."""
    return _mapped(docs, model_file, text, {"ids": _encoded})


def decode_documents(rows: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """``rows`` with the decoded ``text`` in place of the ids; null or empty ids give ''."""
    return _mapped(rows, model_file, ids, {"text": PieceTable.decode})


def round_trip(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """Both in one pass: ``ids`` and the text ``decoded`` from them in place of the text."""
    return _mapped(docs, model_file, text, {"ids": _encoded, "decoded": PieceTable.decode})


def ids_array(ids: str = "ids") -> Column:
    return F.split(F.col(ids), " ").cast("array<int>")
