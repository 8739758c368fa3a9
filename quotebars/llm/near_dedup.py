"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles becomes a sketch: registers that hold, on an exponentially
spaced and truncated scale, the minimum of exponential draws over the set. Sketches of sets
merge register by register, and two sets agree in a register with about their Jaccard
similarity. Bands of register values bring candidates together, a joint likelihood estimate
from the registers that are larger, smaller and equal drops those out of reach, and the rest
are confirmed on their full sets.

Equal sets are one node. Band buckets are not expanded into pairs: each node is first compared
with one pivot, that of most of its buckets, and the links make components. Only clusters of
buckets that still hold several components are searched further, across components alone: in
cells of bounded blocks, pairs whose estimate is in reach are confirmed on the full sets there and
then, and a cell returns links, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebars.llm.components import components
from quotebars.llm.tables import quoted, record_batch, text_slices
from quotebars.llm.words import NOT_SPACE, find_words, hash_grams, hash_words, mix
from quotebars.session import scratch_dir

# the scale: registers hold 1 - log_b(min), with b = BASE and rate RATE, cut to 0 .. TOP
BASE, RATE, TOP = 1.001, 20.0, 65535
REGISTERS = 192
#: chance that a pair just at the threshold shares no band
MISS = 1e-6
#: standard deviations by which an estimate may fall short of the threshold
SLACK = 5.0
#: nodes of one side of a comparison cell, and bytes of their sets
BLOCK, BLOCK_BYTES = 512, 32 << 20
_U64 = np.uint64


# ---------------------------------------------------------------- sets and sketches
def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes; of fewer words than ``size``, one of all."""
    words = find_words(texts, NOT_SPACE)
    hashes = hash_words(words)
    grams = hash_grams(hashes, size)
    for i in range(len(texts)):
        a, b = int(words.first[i]), int(words.first[i + 1])
        if b - a >= size:
            yield np.unique(grams[a:b - size + 1])
        else:
            yield hash_grams(hashes[a:b], b - a) if b > a else hashes[:0]


def sketches(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """A row of registers for each set (an empty set's are 0).

    An element draws points of a Poisson process, each in a random register; its first point in
    a register is an exponential draw, independent between registers. Points come in ascending
    order, so an element is done once it is past the largest minimum of its set."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    least = np.full(len(sets) * registers, np.inf)
    element = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    at = np.zeros(len(element))
    draw = 0
    while len(element):
        draw += 1
        bits = mix(element + _U64((draw * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        at = at - np.log(((bits >> _U64(24)).astype(np.float64) + 0.5) / (1 << 40)) / (registers * RATE)
        slot = ((bits & _U64(0xFFFFFF)) * _U64(registers)) >> _U64(24)
        np.minimum.at(least, owner * registers + slot.astype(np.int64), at)
        if draw < 4 or draw % 8 == 0:
            limit = least.reshape(-1, registers).max(axis=1)
        live = at < limit[owner]
        element, owner, at = element[live], owner[live], at[live]
    with np.errstate(divide="ignore"):
        values = np.floor(1 - np.log(least) / math.log(BASE))
    return np.clip(np.where(np.isinf(least), 0, values), 0, TOP).astype("<u2").reshape(-1, registers)


def merge_sketches(rows: np.ndarray) -> np.ndarray:
    """The sketch of the union of the sets that the rows are sketches of."""
    return rows.max(axis=0)


def band_plan(threshold: float, registers: int = REGISTERS, miss: float = MISS) -> tuple[int, int]:
    """(bands, registers a band): the longest bands that miss a pair at the threshold at most so often."""
    rows = max([r for r in range(1, registers + 1) if (1 - threshold ** r) ** (registers // r) <= miss], default=1)
    return registers // rows, rows


def estimate(above: np.ndarray, below: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity from the counts of registers where the first sketch is
    above, below and equal, for sets of known sizes (the joint likelihood of the three counts)."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    scale = (BASE - 1) / BASE

    def share(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * scale) / math.log(BASE), 1e-12, 1 - 1e-12)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = share(u - v * j), share(v - u * j)
        return above * np.log(p) + below * np.log(q) + equal * np.log(np.clip(1 - p - q, 1e-12, 1))

    # the likelihood has one peak: thirds that cannot hold it are cut off
    low, high = np.zeros(len(u)), most.copy()
    for _ in range(20):
        third = (high - low) / 3
        left = likelihood(low + third) > likelihood(high - third)
        low, high = np.where(left, low, low + third), np.where(left, high - third, high)
    return (low + high) / 2


def least_estimate(threshold: float, registers: int = REGISTERS) -> float:
    return threshold - SLACK * math.sqrt(threshold * (1 - threshold) / registers)


# ---------------------------------------------------------------- Spark steps
def sketch_documents(docs: DataFrame, size: int, registers: int = REGISTERS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, set_hash, sketch) of every row."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    out = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("set_hash", pa.binary()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            sets = list(shingle_sets(texts, size))
            yield record_batch(out, [batch.column("id"), [len(s) for s in sets],
                                     [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                                     [r.tobytes() for r in sketches(sets, registers)]])

    return rows.mapInArrow(run, "id long, n_shingles long, set_hash binary, sketch binary")


def shingle_documents(rows: DataFrame, size: int) -> DataFrame:
    """(node, shingles): the whole set, as sorted 64-bit hashes, for rows (node, text)."""
    out = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            yield record_batch(out, [batch.column("node"), [s.tobytes() for s in shingle_sets(texts, size)]])

    return rows.select("node", "text").mapInArrow(run, "node long, shingles binary")


def band_rows(nodes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(bucket, node): a row for each band of each node."""
    out = pa.schema([("bucket", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                values = np.frombuffer(b"".join(part.column("sketch").to_pylist()), dtype="<u2").reshape(part.num_rows, -1)
                values = values[:, :bands * rows].reshape(part.num_rows, bands, rows).astype(np.uint64)
                bucket = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (part.num_rows, bands))
                for r in range(rows):
                    bucket = mix(bucket ^ (values[:, :, r] + _U64(0x9E3779B97F4A7C15)))
                node = np.repeat(part.column("node").to_numpy(), bands)
                yield record_batch(out, [bucket.reshape(-1).view(np.int64), node])

    return nodes.select("node", "sketch").mapInArrow(run, "bucket long, node long")


def estimate_pairs(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose likelihood estimate reaches ``least``."""
    side = lambda n: nodes.select(F.col("node").alias(n), F.col("n_shingles").alias(f"n_{n}"), F.col("sketch").alias(f"s_{n}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(batch.num_rows, -1) for c in ("s_a", "s_b"))
            value = estimate((x > y).sum(axis=1), (x < y).sum(axis=1), (x == y).sum(axis=1),
                             batch.column("n_a").to_numpy().astype(float), batch.column("n_b").to_numpy().astype(float))
            near = np.flatnonzero(value >= least)
            yield record_batch(out, [batch.column("a").to_numpy()[near], batch.column("b").to_numpy()[near]])

    return joined.mapInArrow(run, "a long, b long")


def verify_pairs(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b, linked) for each pair, on the full sets: share[1] * intersection >= share[0] * union."""
    a = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
    joined = a.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b").select("a", "b", "set_a", "set_b")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sure = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint64) for c in ("set_a", "set_b"))
                sure.append(linked(x, y, share))
            yield record_batch(out, [batch.column("a"), batch.column("b"), sure])

    return joined.mapInArrow(run, "a long, b long, linked boolean")


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def linked(x: np.ndarray, y: np.ndarray, share: tuple[int, int]) -> bool:
    both = overlap(x, y)
    return share[1] * both >= share[0] * (len(x) + len(y) - both)


def search_clusters(placed: DataFrame, least: float, share: tuple[int, int]) -> DataFrame:
    """Confirmed links (a, b) between different components, from rows (cell, node, component,
    is_main, n_shingles, sketch, shingles).

    In a cell every pair of different components, not both of the main one, whose estimate
    reaches ``least`` is confirmed on the full sets, the likeliest first; a pair whose components
    have been joined by then needs none. So all links between components are found, and a cell
    returns fewer links than it has nodes."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(_: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        node, part = rows.column("node").to_numpy(), rows.column("component").to_numpy()
        sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), dtype="<u2").reshape(len(node), -1)
        size = rows.column("n_shingles").to_numpy().astype(float)
        main = rows.column("is_main").to_numpy(zero_copy_only=False)
        shingles = rows.column("shingles").chunk(0) if rows.num_rows else []
        enough = max(0.0, least - 0.1) * sketch.shape[1]
        left, right, equal, over = [], [], [], []
        for x in np.flatnonzero(~main):
            other = np.flatnonzero((part != part[x]) & (main | (node > node[x]))
                                   & (np.minimum(size, size[x]) * share[1] >= np.maximum(size, size[x]) * share[0]))
            same = (sketch[other] == sketch[x]).sum(axis=1)
            other, same = other[same >= enough], same[same >= enough]
            left.append(np.full(len(other), x))
            right.append(other)
            equal.append(same)
            over.append((sketch[x] > sketch[other]).sum(axis=1))
        found: list[tuple[int, int]] = []
        if left:
            x, y, same, above = (np.concatenate(z) for z in (left, right, equal, over))
            value = estimate(above, sketch.shape[1] - above - same, same, size[x], size[y])
            near = np.flatnonzero(value >= least)
            joined: dict[int, int] = {}

            def root(c: int) -> int:
                while c in joined:
                    c = joined[c]
                return c

            for k in near[np.argsort(-value[near], kind="stable")]:
                p, q = root(int(part[x[k]])), root(int(part[y[k]]))
                if p != q and linked(*(np.frombuffer(shingles[int(i)].as_buffer(), dtype=np.uint64) for i in (x[k], y[k])), share):
                    joined[max(p, q)] = min(p, q)
                    found.append((int(node[x[k]]), int(node[y[k]])))
        return pa.Table.from_batches([record_batch(out, list(zip(*found, strict=True)) if found else [[], []])])

    return placed.groupBy("cell").applyInArrow(search, "a long, b long")


def place_in_cells(rows: DataFrame) -> DataFrame:
    """Rows (cluster, node, component, ...) of clusters that hold several components, with the
    ``cell`` they are searched in and whether they are of the cluster's largest component.

    The largest component is never compared with itself: its nodes are dealt into blocks, and
    each of them meets the blocks of the cluster's other nodes, which also meet each other. A
    block is bounded in nodes and in bytes."""
    sized = rows.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    tall = sized.groupBy("cluster").agg(F.max_by(F.struct("component", "n", "s"), F.struct("n", "component")).alias("main"),
                                        F.sum("n").alias("n"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    blocks = lambda n, s: F.greatest(F.ceil(n / BLOCK), F.ceil(s * 8 / BLOCK_BYTES), F.lit(1)).cast("int")
    tall = tall.select("cluster", F.col("main.component").alias("_main"), blocks(F.col("main.n"), F.col("main.s")).alias("_mains"),
                       blocks(F.col("n") - F.col("main.n"), F.col("s") - F.col("main.s")).alias("_rests"))
    joined = rows.join(tall, "cluster").withColumn("is_main", F.col("component") == F.col("_main"))
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("is_main"), F.col("_mains")).otherwise(F.col("_rests"))).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    cell = lambda kind, i, j: F.struct("cluster", F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    own = F.col("_block")
    cells = F.when(F.col("is_main"), F.transform(every(F.col("_rests")), lambda j: cell("main", own, j))).otherwise(
        F.concat(F.transform(every(F.col("_mains")), lambda i: cell("main", i, own)),
                 F.transform(every(F.col("_rests")), lambda j: cell("rest", F.least(own, j), F.greatest(own, j)))))
    return (joined.withColumn("_block", block).withColumn("cell", F.explode(cells))
            .drop("cluster", "_main", "_mains", "_rests", "_block"))


def near_groups(docs: DataFrame, size: int = 5, share: tuple[int, int] = (80, 100), registers: int = REGISTERS,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Words are runs of non-space characters of the ASCII-lower-cased whole text, a set holds the
    distinct shingles of ``size`` words; documents are linked if the share of common shingles
    reaches share[0]/share[1], and ``component_id`` is the smallest identifier reachable. A null,
    empty or blank text has an empty set and is linked with nothing. Rows that share an
    identifier are one node. A null identifier is linked with nothing and has a null component.
    An empty table gives no rows; other columns don't matter."""
    spark = docs.sparkSession
    root = scratch_dir(spark, "near-dedup")
    sketch_documents(docs, size, registers, key, text).write.parquet(f"{root}/sketches")
    rows = spark.read.parquet(f"{root}/sketches")
    full = rows.where("n_shingles > 0 AND id IS NOT NULL")
    # equal sets are one node, named by their smallest identifier
    nodes = full.groupBy("set_hash").agg(F.min("id").alias("node"), F.min_by("n_shingles", "id").alias("n_shingles"), F.min_by("sketch", "id").alias("sketch"))
    nodes.write.parquet(f"{root}/nodes")
    nodes = spark.read.parquet(f"{root}/nodes")

    threshold = share[0] / share[1]
    least = least_estimate(threshold, registers)
    banded = band_rows(nodes, *band_plan(threshold, registers))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    banded.join(shared.select("bucket", "pivot"), "bucket").write.parquet(f"{root}/members")
    members = spark.read.parquet(f"{root}/members")
    involved = members.select("node").distinct()
    texts = docs.select(F.col(key).cast("long").alias("node"), F.col(text).cast("string").alias("text"))
    # of a node that stands for equal sets, its own row: the sets are equal
    shingle_documents(texts.join(involved, "node", "left_semi"), size).write.parquet(f"{root}/sets")
    sets = spark.read.parquet(f"{root}/sets")
    if _repeats(rows):  # a node of several sets is compared by each of them
        sets = sets.dropDuplicates(["node", "shingles"])

    # each node against the pivot that it shares most buckets with
    stars = (members.where("node <> pivot").groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("node").agg(F.max_by("pivot", F.struct(F.col("n"), -F.col("pivot"))).alias("b")).select(F.col("node").alias("a"), "b"))
    verify_pairs(estimate_pairs(stars, nodes, least), sets, share).where("linked").select("a", "b").write.parquet(f"{root}/links")
    links = spark.read.schema("a long, b long").parquet(f"{root}/links")
    comp = components(links, f"{root}/components")
    # nodes that share buckets, directly or through others, make a cluster: no link leaves it
    clusters = components(members.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")), f"{root}/clusters")
    rows_in = (clusters.select("node", F.col("component").alias("cluster"))
               .join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
               .join(nodes.select("node", "n_shingles", "sketch"), "node"))
    placed = place_in_cells(rows_in).join(sets, "node")
    search_clusters(placed, least, share).write.parquet(f"{root}/across")
    across = spark.read.schema("a long, b long").parquet(f"{root}/across")
    known = comp.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    comp = components(across.unionByName(known), f"{root}/components-all")
    owner = full.select("id", "set_hash").join(full.groupBy("set_hash").agg(F.min("id").alias("node")), "set_hash").select("id", "node")
    placed = owner.join(comp, "node", "left").select("id", F.coalesce("component", "node").alias("component_id"))
    placed = placed.groupBy("id").agg(F.min("component_id").alias("component_id"))
    named = rows.select(F.col("id").alias("doc_id"), "n_shingles").join(placed.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return named.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _repeats(rows: DataFrame) -> bool:
    """Does an identifier come more than once?"""
    return bool(rows.groupBy("id").count().where("count > 1 AND id IS NOT NULL").take(1))


def kept() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("component_id"))


def near_dedup(docs: DataFrame, size: int = 5, share: tuple[int, int] = (80, 100), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that are in the component of a smaller identifier; columns of any name stay."""
    gone = near_groups(docs, size, share, key=key, text=text).where(~kept()).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, key, "left_anti").select(*[quoted(c) for c in docs.columns])
