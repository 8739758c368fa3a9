"""Cheapest repair of conversations, by Knuth's lightest derivations.

A repair is a derivation: the item (row i, state q) says that the first i rows have been edited into
roles that leave the role order in state q. An edit deduces one item from another; a segment's item
(from state q to state r) and the item of the rows before it together deduce the item after it. The
agenda pops items by (cost, rows consumed, audit), which no rule lowers, so an item is final when it
is popped. Equal costs are settled by the audit: two audits over the same rows with the same cost
never are one the beginning of the other (only insertions could follow, and they cost), so the
lesser one stays the lesser whatever follows it.

Rows are dealt by range and sorted, so a conversation of any length is spread over tasks. Tasks solve
the conversations that they hold whole. Of a longer one each piece gives the lightest derivations
between all pairs of states; the pieces are joined in order, and the repaired rows are hashed in a
stream, which is the one thing that has to go through a conversation from end to end.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Callable, Iterable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebars.llm.exact_dedup import SPACES
from quotebars.session import scratch_dir

# fixed values: edits, their costs, and what an undeleted truncated row adds
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
# the role order (s?(ua)+)? as an automaton over role initials; it may end in START or REPLIED
START, BRIEFED, ASKED, REPLIED = range(4)
STEP = {(START, "s"): BRIEFED, (START, "u"): ASKED, (BRIEFED, "u"): ASKED, (ASKED, "a"): REPLIED, (REPLIED, "u"): ASKED}
ENDS = (START, REPLIED)
#: the role that a rerole or an insertion must give in each state
NEXT = {START: "user", BRIEFED: "user", ASKED: "assistant", REPLIED: "user"}
LEGAL = ("su", "ua", "au")

#: rows that one agenda takes at most
PIECE_ROWS = 256

Value = tuple[int, int, str]     # cost, rows consumed, audit
Item = tuple[Any, ...]


class Row(NamedTuple):
    role: str
    text: str
    delete: bool        # blank or duplicate
    truncated: bool


def lightest(axioms: Iterable[tuple[Value, Item]], deduce: Callable[[Item, Value, dict], Iterable[tuple[Value, Item]]],
             goal: Item | None = None) -> dict[Item, Value]:
    """The lightest value of every item up to the goal, or of all items. ``deduce`` gives what follows
    from a newly final item and the final ones before it (the chart)."""
    agenda = list(axioms)
    heapq.heapify(agenda)
    chart: dict[Item, Value] = {}
    while agenda:
        value, item = heapq.heappop(agenda)
        if item in chart:
            continue
        chart[item] = value
        if item == goal:
            break
        for found in deduce(item, value, chart):
            if found[1] not in chart:
                heapq.heappush(agenda, found)
    return chart


def edits(rows: list[Row], goal: Item | None = None) -> Callable:
    """The rules over ``rows``: items are (source, row, state)."""
    size = len(rows)

    def deduce(item: Item, value: Value, _: dict) -> Iterator[tuple[Value, Item]]:
        source, at, state = item
        cost, _, audit = value
        role = NEXT[state]
        turned = STEP[state, role[0]]
        yield (cost + COST[INSERT], at, audit + INSERT), (source, at, turned)
        if at == size:
            if goal and state in ENDS:
                yield (cost, size + 1, audit), goal
            return
        row = rows[at]
        yield (cost + COST[DELETE], at + 1, audit + DELETE), (source, at + 1, state)
        if row.delete:
            return
        more = cost + TRUNCATED * row.truncated
        yield (more + COST[REROLE], at + 1, audit + REROLE), (source, at + 1, turned)
        kept = STEP.get((state, row.role[:1]))
        if kept is not None:
            yield (more + COST[KEEP], at + 1, audit + KEEP), (source, at + 1, kept)

    return deduce


def repair(rows: list[Row]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a whole conversation."""
    goal = ("goal",)
    cost, _, audit = lightest([((0, 0, ""), (START, 0, START))], edits(rows, goal), goal)[goal]
    return cost, audit


def between_states(rows: list[Row]) -> dict[tuple[int, int], tuple[int, str]]:
    """(cost, audit) of the cheapest edits of a piece between any two states."""
    chart = lightest([((0, 0, ""), (q, 0, q)) for q in range(4)], edits(rows))
    return {(q, r): (v[0], v[2]) for (q, at, r), v in chart.items() if at == len(rows)}


def join_piece(before: dict[int, tuple[int, str]], piece: dict[tuple[int, int], tuple[int, str]]) -> dict[int, tuple[int, str]]:
    """The items after a piece, each deduced from one before it and one of the piece."""
    axioms = [((c, 0, a), ("before", q)) for q, (c, a) in before.items()] + [((c, 0, a), ("piece", q, r)) for (q, r), (c, a) in piece.items()]

    def deduce(item: Item, value: Value, chart: dict) -> Iterator[tuple[Value, Item]]:
        if item[0] == "before":
            met = [(value, chart["piece", item[1], r], r) for r in range(4) if ("piece", item[1], r) in chart]
        elif item[0] == "piece":
            met = [(chart["before", item[1]], value, item[2])] if ("before", item[1]) in chart else []
        else:
            met = []
        for left, right, state in met:
            yield (left[0] + right[0], 1, left[2] + right[2]), ("after", state)

    chart = lightest(axioms, deduce)
    return {item[1]: (v[0], v[2]) for item, v in chart.items() if item[0] == "after"}


def repaired(audit: str, rows: Iterable[Row]) -> Iterator[str]:
    """role:text of the rows that the audit's edits make."""
    rows, state = iter(rows), START
    for edit in audit:
        row = None if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        role = row.role if edit == KEEP else NEXT[state]
        state = STEP[state, role[0]]
        yield f"{role}:{row.text if row else ''}"


def hash_lines(lines: Iterable[str]) -> str:
    out, glue = hashlib.sha256(), b""
    for line in lines:
        out.update(glue + line.encode())
        glue = b"\n"
    return out.hexdigest()


# ---------------------------------------------------------------- what a task keeps of a piece
_PIECE = "array<struct<source:int,state:int,cost:long,audit:string>>"
COUNTS = ["n_rows", "blank", "duplicate", "truncated", "illegal"]
TURNS = ["low", "high", "turns"]
RESULT = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), *[(c, pa.int64()) for c in COUNTS + TURNS],
                    ("first_initial", pa.string()), ("last_initial", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
                    ("repaired_sha256", pa.string()),
                    ("derivations", pa.list_(pa.struct([("source", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
RESULT_DDL = ("conv string, part int, seq long, " + ", ".join(f"{c} long" for c in COUNTS + TURNS)
              + f", first_initial string, last_initial string, cost long, audit string, repaired_sha256 string, derivations {_PIECE}")


def add_counts(a: dict, b: dict) -> dict:
    """Counts of two neighbouring pieces; the turns ascend, so they share one turn at most."""
    out = {c: a[c] + b[c] for c in COUNTS}
    if a["n_rows"] and b["n_rows"]:
        out["illegal"] += a["last_initial"] + b["first_initial"] not in LEGAL
    shared = a["high"] is not None and a["high"] == b["low"]
    return out | {"low": b["low"] if a["low"] is None else a["low"], "high": a["high"] if b["high"] is None else b["high"],
                  "turns": a["turns"] + b["turns"] - shared,
                  "first_initial": a["first_initial"] if a["n_rows"] else b["first_initial"],
                  "last_initial": b["last_initial"] if b["n_rows"] else a["last_initial"]}


NOTHING = dict.fromkeys([*COUNTS, "turns"], 0) | dict.fromkeys(["low", "high", "first_initial", "last_initial"])


class Pieces:
    """Cuts a task's sorted rows into conversations, and long ones into pieces."""

    def __init__(self, part: int, piece_rows: int) -> None:
        self.part, self.piece_rows = part, piece_rows
        self.conv: str | None = None
        self.first = True       # no conversation of this task has ended yet

    def begin(self, conv: str) -> None:
        self.conv, self.seq, self.last = conv, 0, None
        self.rows: list[Row] = []
        self.counts = dict(NOTHING)

    def add(self, turn: int | None, role: str, text: str, copies: int, blank: bool, seen: bool, cut: bool) -> Iterator[dict]:
        same = self.last == (turn, role, text)
        self.last = (turn, role, text)
        for copy in range(copies):
            duplicate = not blank and (seen or same or copy > 0)
            truncated = cut and not blank and not duplicate
            one = {"n_rows": 1, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": 0, "low": turn, "high": turn,
                   "turns": int(turn is not None), "first_initial": role[:1], "last_initial": role[:1]}
            self.counts = add_counts(self.counts, one)
            self.rows.append(Row(role, text, blank or duplicate, truncated))
            if len(self.rows) == self.piece_rows:
                yield self.piece()

    def piece(self) -> dict:
        found = [{"source": q, "state": r, "cost": c, "audit": a} for (q, r), (c, a) in between_states(self.rows).items()]
        out = self.counts | {"conv": self.conv, "part": self.part, "seq": self.seq, "derivations": found}
        self.seq, self.rows, self.counts = self.seq + 1, [], dict(NOTHING)
        return out

    def end(self, last: bool) -> Iterator[dict]:
        if self.conv is None:
            return
        if self.first or last or self.seq:      # other tasks may hold more of it, or it has been cut
            yield self.piece()
        else:
            cost, audit = repair(self.rows)
            yield self.counts | {"conv": self.conv, "part": self.part, "seq": 0, "cost": cost, "audit": audit,
                                 "repaired_sha256": hash_lines(repaired(audit, self.rows))}
        self.first = False


def batches_of(rows: Iterator[dict], size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, RESULT)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, RESULT)


def solve_pieces(piece_rows: int) -> Callable:
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(TaskContext.get().partitionId(), piece_rows)

        def found() -> Iterator[dict]:
            for batch in batches:
                for conv, dropped, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if conv != pieces.conv:
                        yield from pieces.end(False)
                        pieces.begin(conv)
                    if not dropped:
                        yield from pieces.add(*row)
            yield from pieces.end(True)

        yield from batches_of(found())

    return stream


def join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one row per conversation. What the audits of all states have in common is set
    aside after each piece, so a join copies only what is still open."""

    def found() -> Iterator[dict]:
        conv = None
        for batch in batches:
            for piece in batch.to_pylist():
                if piece["conv"] != conv:
                    if conv is not None:
                        yield close()
                    conv, counts, trunk, states = piece["conv"], dict(NOTHING), [], {START: (0, "")}
                counts = add_counts(counts, piece)
                states = join_piece(states, {(d["source"], d["state"]): (d["cost"], d["audit"]) for d in piece["derivations"]})
                common = os.path.commonprefix([a for _, a in states.values()])
                trunk.append(common)
                states = {q: (c, a[len(common):]) for q, (c, a) in states.items()}

                def close(conv=conv, counts=counts, trunk=trunk, states=states) -> dict:
                    cost, audit = min(states[q] for q in ENDS if q in states)
                    return counts | {"conv": conv, "part": -1, "seq": -1, "cost": cost, "audit": "".join(trunk) + audit}
        if conv is not None:
            yield close()

    yield from batches_of(found(), 10)


def hash_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv, audit first): the digest of each conversation's repaired rows."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def found() -> Iterator[dict]:
        stream = rows()
        nxt = next(stream, None)
        while nxt is not None:
            conv, audit = nxt[0], nxt[1]
            nxt = next(stream, None)

            def own() -> Iterator[Row]:
                nonlocal nxt
                while nxt is not None and nxt[0] == conv:
                    _, _, role, text, copies = nxt
                    for _ in range(copies):
                        yield Row(role, text, False, False)
                    nxt = next(stream, None)

            mine = own()
            out = hash_lines(repaired(audit, mine))
            for _ in mine:      # none is left unless the audit is not of these rows
                raise ValueError("an audit does not cover its rows")
            yield {"conv": conv, "repaired_sha256": out}

    yield from batches_of(found())


# ---------------------------------------------------------------- the Spark side
def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, conv, dropped, turn, role, text, copies): the rows with the faults of the contract put in.

    Nulls count as one space in the key, the role and the text; a null turn stays null for the order."""
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20
    told = (F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(blank(text), ".!?", "")).otherwise(blank(text)))
    name = F.col(f"`{conv}`").cast("string")
    return rows.select(F.col(f"`{conv}`").alias("conv_id"), F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("conv"),
                       (fault == 0).alias("dropped"), F.col(f"`{turn}`").cast("long").alias("turn"),
                       F.when(fault == 4, F.lit("user")).otherwise(blank(role)).alias("role"), told.alias("text"),
                       F.when(fault == 3, 2).otherwise(1).alias("copies"))


def visible(text: str = "text") -> Column:
    return F.translate(F.col(text), SPACES, "")


#: ascending order has null turns first
ORDER = ["conv", "turn", "role"]


def faulty(rows: DataFrame) -> DataFrame:
    """Adds ``blank``, ``seen`` (the role and text are in a row of an earlier turn) and ``cut`` (no closing
    mark). Rows of one turn with the same role and text follow each other in the order and are told apart there."""
    keyed = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    known = F.col("turn").isNotNull()
    firsts = (keyed.where(~F.col("dropped")).groupBy("conv", "role", "digest")
              .agg(F.count(F.lit(1)).alias("held"), F.min(known.cast("int")).alias("known"), F.min("turn").alias("first"))
              .where("held > 1").drop("held"))
    seen = F.coalesce(known & ((F.col("known") == 0) | (F.col("first") < F.col("turn"))), F.lit(False))
    return (keyed.join(firsts, ["conv", "role", "digest"], "left")
            .select(*rows.columns, (visible() == "").alias("blank"), seen.alias("seen"),
                    (~F.substring(visible(), -1, 1).isin(".", "!", "?")).alias("cut")))


def repair_conversations(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row for each conversation of damaged ``rows`` (``damage``): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn, null turns first, rows of one turn by role and text; rows that repeat in full are
    duplicates but for one. A null conv_id is a conversation like any other; one without rows, or with
    dropped ones only, needs no edit. An empty table gives no rows."""
    spark = rows.sparkSession
    root = scratch_dir(spark, "repair")
    parts = max(rows.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    dealt = (faulty(rows).repartitionByRange(parts, *ORDER, F.substring("text", 1, 32)).sortWithinPartitions(*ORDER, "text")
             .select("conv", "dropped", "turn", "role", "text", "copies", "blank", "seen", "cut"))
    dealt.mapInArrow(solve_pieces(piece_rows), RESULT_DDL).write.parquet(f"{root}/pieces")
    pieces = spark.read.parquet(f"{root}/pieces")
    pieces.where("derivations IS NOT NULL").repartition("conv").sortWithinPartitions("conv", "part", "seq").mapInArrow(
        join_pieces, RESULT_DDL).write.parquet(f"{root}/joined")
    joined = spark.read.parquet(f"{root}/joined")
    none = lambda kind: F.lit(None).cast(kind)
    heads = joined.select("conv", "audit", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"),
                          none("string").alias("text"), none("int").alias("copies"))
    again = rows.where(~F.col("dropped")).join(joined.select("conv"), "conv", "left_semi").select(
        "conv", none("string").alias("audit"), F.lit(1).alias("kind"), "turn", "role", "text", "copies")
    stream = (heads.unionByName(again).repartition("conv").sortWithinPartitions("conv", "kind", *ORDER[1:], "text")
              .select("conv", "audit", "role", "text", "copies"))
    hashed = stream.mapInArrow(hash_repaired, RESULT_DDL).select("conv", "repaired_sha256")
    cut = joined.drop("repaired_sha256").join(hashed, "conv").select(*joined.columns)
    whole = pieces.where("derivations IS NULL").union(cut)
    kind = dict(rows.dtypes)["conv_id"]
    gaps = F.when(F.col("turns") == 0, 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    name = F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind)
    return whole.select(name.alias("conv_id"), gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                        "cost", "audit", "repaired_sha256")
