"""ordered_scan against a brute-force scan: skewed keys, blocks, NULLs, extreme numbers."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotebars.operators.sequence import ordered_scan


def brute(rows, zero):
    """{seq: (running sum, previous)} of rows (key, seq, value) in the order of seq, NULL first."""
    total, last, out = {}, {}, {}
    for k, s, v in sorted(rows, key=lambda r: (r[1] is not None, r[1])):
        if v is not None:
            total[k] = total.get(k, zero) + v
        out[(k, s)] = (total.get(k), last.get(k))
        last[k] = v
    return out


def scan(spark, rows, kind, block):
    df = spark.createDataFrame(rows, f"k string, s long, v {kind}")
    out = ordered_scan(df, ["k"], ["s"], "v", running_sum="rs", previous="pv", block=block and F.expr(block))
    assert out.columns == ["k", "s", "v", "rs", "pv"]
    return {(r.k, r.s): (r.rs, r.pv) for r in out.collect()}


BLOCKS = {"none": None, "tens": "floor(s / 10)", "each": "s", "one": "1"}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["HOT", "HOT", "HOT", "b", None]), st.one_of(st.none(), st.integers(-50, 50))), max_size=60),
       st.sampled_from(sorted(BLOCKS)))
def test_longs_equal_brute_force(spark, values, block):
    rows = [(k, i, v) for i, (k, v) in enumerate(values)]
    rows.append(("HOT", None, 5))
    assert scan(spark, rows, "long", BLOCKS[block]) == brute(rows, 0)


@pytest.mark.parametrize("block", sorted(BLOCKS))
def test_groups_never_touch_each_other(spark, block):
    rows = [("a", 0, 1e18), ("b", 1, 0.1), ("b", 2, 0.2), ("c", 3, math.inf), ("d", 4, 1.0), ("d", 25, -math.inf), ("e", 5, 2.5), ("e", 99, None)]
    assert scan(spark, rows, "double", BLOCKS[block]) == brute(rows, 0.0)


@pytest.mark.parametrize("block", sorted(BLOCKS))
def test_an_overflow_raises(spark, block):
    top = 2**63 - 1
    near = [("a", 0, top - 1), ("a", 20, 1), ("b", 21, -top)]
    assert scan(spark, near, "long", BLOCKS[block]) == brute(near, 0)
    with pytest.raises(Exception, match="OVERFLOW"):
        scan(spark, near + [("a", 30, 5)], "long", BLOCKS[block])


def test_a_hot_key_is_split_by_its_blocks(spark):
    df = spark.range(0, 20000).select(F.concat(F.lit("HOT"), (F.col("id") * 0).cast("string")).alias("k"), F.col("id").alias("s"), (F.col("id") % 7).alias("v"))
    out = ordered_scan(df, ["k"], ["s"], "v", running_sum="rs", previous="pv", block=F.floor(F.col("s") / 500))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_block" in plan.split("hashpartitioning(")[1].split(")")[0]
    total = 0
    for r in out.orderBy("s").collect():
        total += r.s % 7
        assert r.rs == total and r.pv == ((r.s - 1) % 7 if r.s else None)
