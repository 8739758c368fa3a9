"""Secrets in texts: named patterns, and runs of high entropy found by sliding windows.

The patterns give the base spans. The entropy scan looks at candidate strings (long runs of
one character class), slides a window along each with counts that are updated by the character
that enters and the one that leaves, and adds the stretches whose windows reach the class's
entropy, unless an allow-list entry or a base span accounts for them.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebars.llm.tables import record_batch, text_slices

# fixed patterns and least sizes of the base kinds, in the order of the contract
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_VALUE, ACCESS_SIZE, HEX_SIZE = 6, 20, 24
#: the same matches as HEX of at least HEX_SIZE characters, without stopping at shorter runs
_LONG_HEX = re.compile(rf"[0-9a-f]{{{HEX_SIZE},}}")
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base32", "entropy_base64"]
#: characters that a stretch must have left beside spans that account for the rest of it
LEAST_REST = 8


class EntropyClass(NamedTuple):
    kind: str
    runs: re.Pattern[str]    # candidate strings
    window: int
    bits: float              # least entropy of a window, in bits a character


CLASSES = [EntropyClass("entropy_hex", re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{20,}(?![0-9A-Za-z])"), 20, 3.0),
           # of 1,000 random strings of 16 such characters 990 reach this limit
           EntropyClass("entropy_base32", re.compile(r"(?<![0-9A-Za-z])[A-Z0-9]{16,}(?![0-9A-Za-z])"), 16, 3.08),
           EntropyClass("entropy_base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 20, 3.8)]

#: candidates that match one of these as a whole are no secrets: one kind of letter with no
#: digit (long words), digits alone, paths and slugs of words, UUIDs, rules and padding
ALLOWED = [re.compile(p) for p in (
    r"[^0-9]*", r"[0-9_=+/-]*", r"(?:[A-Za-z]+|[0-9]{1,4})(?:[-_/=+](?:[A-Za-z]+|[0-9]{1,4}))+[-_/=+]*",
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}", r"(.)\1*")]


def entropy_windows(text: str, size: int, bits: float) -> Iterator[tuple[int, int]]:
    """Maximal stretches of ``text`` covered by windows of ``size`` whose Shannon entropy is at
    least ``bits``. The sum of n*log2(n) over the window's counts changes with the two
    characters that come and go; the entropy is log2(size) minus that sum over the size."""
    weigh = [0.0] + [n * math.log2(n) for n in range(1, size + 1)]
    most = (math.log2(size) - bits) * size + 1e-9
    counts: dict[str, int] = {}
    total, begin, end = 0.0, -1, -1
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += weigh[n + 1] - weigh[n]
        if i >= size:
            gone = text[i - size]
            n = counts[gone]
            counts[gone] = n - 1
            total += weigh[n - 1] - weigh[n]
        if i >= size - 1 and total <= most:
            if begin >= 0 and i - size + 1 > end:
                yield begin, end
                begin = -1
            if begin < 0:
                begin = i - size + 1
            end = i + 1
    if begin >= 0:
        yield begin, end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the pattern matches, leftmost first for each kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_SIZE]
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans as disjoint ones."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def rest_of(a: int, b: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What is left of a stretch beside the disjoint, sorted spans ``taken``: all of it, or parts of
    LEAST_REST characters and more."""
    i = max(bisect.bisect_right(taken, (a, a)) - 1, 0)
    i += i < len(taken) and taken[i][1] <= a
    whole, at = True, a
    while i < len(taken) and taken[i][0] < b:
        whole = False
        if taken[i][0] - at >= LEAST_REST:
            yield at, taken[i][0]
        at = max(at, taken[i][1])
        i += 1
    if whole or b - at >= LEAST_REST:
        yield at, b


def entropy_spans(text: str, base: list[tuple[int, int, int]], allowed: list[re.Pattern[str]] = ALLOWED) -> list[tuple[int, int, int]]:
    """The stretches of every class, without what base spans and earlier classes account for."""
    found: list[tuple[int, int, int]] = []
    taken = merged([(s, e) for s, _, e in base])
    for number, kind in enumerate(CLASSES, 3):
        own: list[tuple[int, int]] = []
        for m in kind.runs.finditer(text):
            if any(p.fullmatch(m[0]) for p in allowed):
                continue
            for a, b in entropy_windows(m[0], kind.window, kind.bits):
                own += rest_of(a + m.start(), b + m.start(), taken)
        found += [(a, number, b) for a, b in own]
        taken = merged(sorted(taken + own))
    return found


FOUND = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("end", T.IntegerType())]))


def find_secrets(docs: DataFrame, text: str = "text", allowed: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``secrets``: all spans by start, then in the order of KINDS; code points,
    end exclusive. ``allowed`` adds patterns to the allow-list of the entropy scan; the base
    kinds are never suppressed.

    Null and empty texts have no spans; repeated rows give repeated results; other columns
    pass through (one named ``secrets`` is replaced); an empty table gives no rows."""
    rest = [c for c in docs.columns if c != "secrets"]
    plain = docs.select(*[F.col(f"`{c}`") for c in rest])
    allow = [*ALLOWED, *(re.compile(p) for p in allowed)]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text):
            rows = []
            for data in texts:
                value = data.decode("utf-8", "replace")
                base = base_spans(value)
                spans = sorted(base + entropy_spans(value, base, allow))
                rows.append([{"start": s, "kind": KINDS[k], "end": e} for s, k, e in spans])
            kept = batch.select(rest)
            yield record_batch(pa.schema([*kept.schema, pa.field("secrets", kind)]), [*kept.columns, rows])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("secrets", FOUND)]))


def mask_secrets(found: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The text with every span replaced by ``mark``; overlapping spans become one."""
    cut = F.aggregate(F.col("secrets"), F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
                      lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
                          F.when(s["start"] >= acc["at"], F.concat(acc["kept"], F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
                          .otherwise(acc["kept"]).alias("kept"), s["end"].alias("at"))),
                      lambda acc: F.concat(acc["kept"], F.substring(F.col(text), acc["at"] + 1, F.char_length(F.col(text)))))
    return found.withColumn(text, F.when(F.size("secrets") > 0, cut).otherwise(F.col(text)))
