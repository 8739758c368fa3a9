"""Conversation repair against an exhaustive version that tries every sequence of edits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quotebars.llm import repair as R
from tests.llm.conftest import AWKWARD

SCHEMA = "conv_id long, turn long, role string, text string, audit string, conv string, `a.b` int"
GRAMMAR = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA)


def damaged(rows):
    """(turn, role, text) of the rows after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        told = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20
        role, text = told(role), told(text)
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def classify(rows):
    seen, kinds = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return kinds


def every_edit(rows, kinds, room):
    """(cost, audit, repaired lines) of every sequence of edits with at most ``room`` insertions."""
    if room:
        for role in ("user", "assistant"):
            for c, a, lines in every_edit(rows, kinds, room - 1):
                yield c + 2, "I" + a, ((role, ""), *lines)
    if not rows:
        yield 0, "", ()
        return
    (_, role, text), kind = rows[0], kinds[0]
    for c, a, lines in every_edit(rows[1:], kinds[1:], room):
        yield c + 3, "D" + a, lines
        if kind not in ("blank", "duplicate"):
            more = kind == "truncated"
            yield c + more, "K" + a, ((role, text), *lines)
            for other in ("user", "assistant"):
                yield c + 2 + more, "R" + a, ((other, text), *lines)


def summary(rows, best):
    kinds = classify(rows)
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, lines = best(rows, kinds)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"),
            kinds.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())


def exhaustive(rows, kinds):
    legal = (x for x in every_edit(rows, kinds, 3 if len(rows) < 5 else 2) if GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in x[2])))
    return min(legal, key=lambda x: x[:2])


def tabled(rows, kinds):
    """The cheapest edits of long conversations: from the end, the best of all four states at each row.
    Repaired lines are linked pairs (line, rest)."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def least(table, state, offer):
        if state not in table or offer[:2] < table[state][:2]:
            table[state] = offer

    def with_insertions(table):
        for _ in range(2):
            for (q, initial), r in step.items():
                if initial != "s" and r in table:
                    c, a, rest = table[r]
                    least(table, q, (c + 2, "I" + a, (("user" if initial == "u" else "assistant", ""), rest)))
        return table

    best = with_insertions({0: (0, "", None), 3: (0, "", None)})
    for (_, role, text), kind in zip(reversed(rows), reversed(kinds), strict=True):
        now = {}
        for q in range(4):
            if q in best:
                c, a, rest = best[q]
                least(now, q, (c + 3, "D" + a, rest))
            if kind in ("blank", "duplicate"):
                continue
            for edit, cost, name in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                r = step.get((q, name[:1]))
                if r in best:
                    c, a, rest = best[r]
                    least(now, q, (c + cost + (kind == "truncated"), edit + a, ((name, text), rest)))
        best = with_insertions(now)
    cost, audit, rest = best[0]
    lines = []
    while rest is not None:
        line, rest = rest
        lines.append(line)
    return cost, audit, lines


def check(spark, rows, best, **options):
    got = R.repair_conversations(R.damage(frame(spark, rows)), **options).collect()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    want = {conv: summary(damaged(mine), best) for conv, mine in by.items()}
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    return want


def some_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Yes.", "", " \n", None, "Why?", "é!", "ok .", "a. "]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "sage"])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, None, 2 * turn]), role, rng.choice(texts) if turn % 3 else f"text {turn}."))
    return rows


def test_every_sequence_of_edits(spark):
    check(spark, some_rows(1, 150, 3), exhaustive)


def test_the_table_equals_the_exhaustive_search():
    rng = random.Random(3)
    for _ in range(300):
        rows = [(i, rng.choice("sua"), rng.choice(["x.", "y", "", "z?"])) for i in range(rng.randint(0, 4))]
        kinds = classify(rows)
        assert tabled(rows, kinds)[:2] == exhaustive(rows, kinds)[:2]
        assert list(tabled(rows, kinds)[2]) == list(exhaustive(rows, kinds)[2])


@pytest.mark.parametrize("piece_rows", [3, 256])
def test_long_conversations_over_tasks_and_pieces(spark, piece_rows):
    rng = random.Random(piece_rows)
    rows = some_rows(5, 40, 9)
    rows += [(77, i // 2 if i % 5 else i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"line {i}.", f"line {i}", "again."]))
             for i in range(1500)]
    rows += [(78, 4, "user", "the same row.")] * 300
    check(spark, rows, tabled, piece_rows=piece_rows)


def test_awkward_texts(spark):
    check(spark, [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(AWKWARD)], tabled)


def test_nothing_left_and_nothing_there(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    want = check(spark, [(lost, 0, "user", "x.")], tabled)
    assert want[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert R.repair_conversations(R.damage(frame(spark, []))).collect() == []


def test_one_conversation_is_dealt_over_tasks(spark):
    rows = frame(spark, [(1, i, "user" if i % 2 else "assistant", f"t {i}.") for i in range(4000)]).repartition(4)
    dealt = R.faulty(R.damage(rows)).repartitionByRange(8, *R.ORDER)
    held = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) >= 6 and max(held) < 1500
