"""Operator 2: embeddings linked by cosine, found through E8 lattice cells.

A table projects unit vectors to `blocks` groups of eight random orthonormal directions, scales them and decodes each
group to its nearest point of the E8 lattice; the points together are the vector's cell. Besides its own cell a vector
probes the cells made of the two next points of each block. Every pair that shares a cell through its own or a probed
one is a candidate; a 128-bit sign sketch sorts out the far ones and the cosine in double precision decides.

Groups of copies would make pairs without end, so vectors first gather in clusters: a vector joins the smallest id
found within half the angle of the threshold, which links all members of a cluster to each other without comparing
them. Candidates are pairs of clusters: an angle bound links or parts most of them as a whole, the members of the rest
are compared in blocks. Numbers of links are sums over clusters; no list of pairs within a group is made.

The number of blocks follows the logarithm of the number of vectors, so that a cell holds about as many at any size,
and the number of tables follows from the blocks; `tables_for` says how. Recall at the threshold is measured in tests.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
vectors of different lengths; exact copies link; a row without vec_id links with nothing and has no component; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, settle, width, workspace

SCALE = 2.5  # lattice units per unit of length
CELL_VECTORS = 100  # vectors that a cell may hold on average before another block is added
SPREAD = 27  # cells that one more block splits a cell into, measured on random directions
NEAR = 0.76  # chance that one block of two vectors at cosine 0.9 agrees within the probes, measured
MISS = 0.0005  # chance that all tables miss a pair at the threshold, by NEAR
SKETCH = 128
SIGMAS = 6.0  # a sketch may lie so many standard deviations off before its pair is dropped


# ---- the lattice -------------------------------------------------------------------------------------------------

def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Integer points with an even sum."""
    point = np.rint(x)
    off = x - point
    odd = np.flatnonzero(point.sum(-1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(-1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 moved by one half in every direction."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(-1) <= ((x - half) ** 2).sum(-1)
    return np.where(nearer[:, None], whole, half)


def shortest_e8() -> np.ndarray:
    """The 240 neighbours of the origin."""
    pairs = [[a if k == i else b if k == j else 0.0 for k in range(8)]
             for i, j in combinations(range(8), 2) for a, b in product((1.0, -1.0), repeat=2)]
    halves = [s for s in product((0.5, -0.5), repeat=8) if sum(v < 0 for v in s) % 2 == 0]
    return np.array([*pairs, *halves])


def blocks_for(vectors: int) -> int:
    return max(1, math.ceil(math.log(max(vectors, 1) / CELL_VECTORS, SPREAD)))


def tables_for(blocks: int) -> int:
    return max(4, math.ceil(math.log(MISS) / math.log(1 - NEAR**blocks)))


def projections(dims: int, table: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions in each block, scaled, and a shift of the lattice; the same wherever they are made."""
    rng = np.random.default_rng([dims, table, blocks, 8])
    parts = []
    for _ in range(blocks):
        q = np.linalg.qr(rng.normal(size=(max(dims, 8), 8)))[0][:dims]
        parts.append(q * SCALE * math.sqrt(dims / 64))
    return np.hstack(parts), rng.random(8 * blocks) * 2


def cells(unit: np.ndarray, table: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The own cell of each vector, and 3 ** blocks cells it looks into, its own first; as 64-bit numbers."""
    directions, shift = projections(unit.shape[1], table, blocks)
    x = unit @ directions + shift
    around = shortest_e8()
    code = np.zeros((len(x), 1), np.uint64)
    for b in range(blocks):
        part = x[:, 8 * b:8 * b + 8]
        own = nearest_e8(part)
        gap = ((part - own)[:, None, :] * around[None]).sum(-1)  # the nearer neighbour lies along the offset
        two = np.argsort(-gap, axis=1, kind="stable")[:, :2]
        points = np.stack([own, own + around[two[:, 0]], own + around[two[:, 1]]], axis=1)
        whole = np.rint(points * 2).astype(np.int64).astype(np.uint64)
        number = np.full(whole.shape[:2], np.uint64(1469598103934665603 + b))
        for k in range(8):
            number = (number ^ whole[:, :, k]) * np.uint64(1099511628211)
            number ^= number >> np.uint64(29)
        code = (code[:, :, None] * np.uint64(0x9E3779B97F4A7C15) + number[:, None, :]).reshape(len(x), -1)
    code = code.view(np.int64)
    return code[:, 0], code


def sketches(unit: np.ndarray) -> np.ndarray:
    """Signs of 128 random directions, as two 64-bit numbers."""
    rng = np.random.default_rng([unit.shape[1], SKETCH])
    signs = unit @ rng.normal(size=(unit.shape[1], SKETCH)) > 0
    return np.packbits(signs, axis=1).view("<u8").view(np.int64)


def sketch_limit(angle: np.ndarray) -> np.ndarray:
    """The largest Hamming distance that sketches of vectors at most `angle` apart have."""
    p = np.minimum(angle, np.pi) / np.pi
    return SKETCH * p + SIGMAS * np.sqrt(SKETCH * p * (1 - p)) + 1


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of doubles, scaled to length one."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    largest = np.abs(rows).max(1, keepdims=True)
    rows = rows / largest
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def by_length(column: pa.Array) -> Iterator[np.ndarray]:
    """Row numbers of the vectors of each length."""
    lengths = np.diff(column.offsets.to_numpy())
    for n in np.unique(lengths):
        yield np.flatnonzero(lengths == n)


# ---- steps ---------------------------------------------------------------------------------------------------------

def keyed(tables: int, blocks: int, probes: bool):
    """(id, leader, rho, vec) to one row per table and cell: (dims, table, cell, probe, id, leader, rho, s1, s2).

    The sketch is the leader's: rows give `vec` the leader's vector when probes are asked for by cluster, so here it
    is worked out from `lead`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, leaders, rho = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            vec, lead = batch.column(3), batch.column(4)
            for rows in by_length(vec):
                unit = matrix(vec.take(pa.array(rows)))
                sign = sketches(matrix(lead.take(pa.array(rows))))
                for t in range(tables):
                    own, all_cells = cells(unit, t, blocks)
                    many = all_cells.shape[1] if probes else 1
                    at = np.repeat(rows, many)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), unit.shape[1], np.int32)), pa.array(np.full(len(at), t, np.int32)),
                        pa.array((all_cells if probes else own[:, None]).ravel()),
                        pa.array(np.tile(np.arange(many) > 0, len(rows))),
                        pa.array(ids[at]), pa.array(leaders[at]), pa.array(rho[at]),
                        pa.array(np.repeat(sign[:, 0], many)), pa.array(np.repeat(sign[:, 1], many))],
                        names=["dims", "tab", "cell", "probe", "id", "leader", "rho", "s1", "s2"])

    return run, "dims int, tab int, cell long, probe boolean, id long, leader long, rho double, s1 long, s2 long"


def cell_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Rows of one (dims, tab, cell) at a time, from sorted batches."""
    held = None
    for batch in batches:
        rows = batch.to_pandas()
        held = rows if held is None or not len(held) else pd.concat([held, rows], ignore_index=True)
        keys = held[["dims", "tab", "cell"]].to_numpy(np.int64)
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        edges = np.concatenate([[0], cut])
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a > 1:
                yield held.iloc[a:b]
        held = held.iloc[edges[-1]:]
    if held is not None and len(held) > 1:
        yield held


def pick_leaders(tight: float):
    """Own-cell rows sorted by id to (id, leader): the smallest id of the cell whose sketch allows the angle `tight`.

    A row is compared with the leaders found so far, not with all rows, so a large group of copies costs its size.
    Batches are taken one by one; between them only the leaders of the last cell are kept.
    """
    limit = float(sketch_limit(np.array(tight)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, heads, signs = None, None, None
        for batch in batches:
            key = np.vstack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            ids = batch.column(4).to_numpy()
            sign = np.vstack([batch.column(7).to_numpy(), batch.column(8).to_numpy()]).T.copy().view(np.uint64)
            edges = np.concatenate([[0], np.flatnonzero((np.diff(key) != 0).any(0)) + 1, [len(ids)]])
            out_id, out_lead = [], []
            for a, b in zip(edges[:-1], edges[1:]):
                here = tuple(key[:, a]) if b > a else last
                if here != last:
                    last, heads, signs = here, ids[:0], sign[:0]
                left = np.arange(a, b)
                for head, mark in zip(heads.tolist(), signs):
                    near = np.bitwise_count(sign[left] ^ mark).sum(1) <= limit
                    out_id.append(ids[left[near]])
                    out_lead.append(np.full(near.sum(), head))
                    left = left[~near]
                    if not len(left):
                        break
                while len(left):
                    head, mark = ids[left[0]], sign[left[0]]
                    heads, signs = np.append(heads, head), np.vstack([signs, mark])
                    near = np.bitwise_count(sign[left] ^ mark).sum(1) <= limit
                    near[0] = True
                    out_id.append(ids[left[near]])
                    out_lead.append(np.full(near.sum(), head))
                    left = left[~near]
            if out_id:
                a, b = np.concatenate(out_id), np.concatenate(out_lead)
                told = a != b
                yield pa.RecordBatch.from_arrays([pa.array(a[told], pa.int64()), pa.array(b[told], pa.int64())],
                                                 names=["id", "leader"])

    return run


def candidate_clusters(threshold: float, rows_at_once: int = 2_000):
    """Rows of cells to pairs of leaders (a < b) whose sketches allow members within `threshold`."""
    least = float(sketch_limit(np.array(threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in cell_runs(batches):
            probe = group["probe"].to_numpy(bool)
            if probe.all():
                continue
            lead, rho = group["leader"].to_numpy(np.int64), group["rho"].to_numpy(float)
            sign = group[["s1", "s2"]].to_numpy(np.int64).view(np.uint64)
            base = np.flatnonzero(~probe)
            for at in range(0, len(base), rows_at_once):
                some = base[at:at + rows_at_once]
                for to in range(0, len(lead), rows_at_once):
                    other = np.arange(to, min(to + rows_at_once, len(lead)))
                    far = np.bitwise_count(sign[some, None, 0] ^ sign[None, other, 0]).astype(np.int16)
                    far += np.bitwise_count(sign[some, None, 1] ^ sign[None, other, 1])
                    slack = rho[some, None] + rho[None, other]
                    near = far <= (sketch_limit(threshold + slack) if slack.any() else least)
                    i, j = np.nonzero(near & (lead[some, None] != lead[None, other]))
                    if len(i):
                        x, y = lead[some[i]], lead[other[j]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))],
                                                         names=["a", "b"])

    return run


def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, left vector, right vector) to (a, b, cosine)."""
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        cosine = np.zeros(len(left))
        for rows in by_length(left):
            at = pa.array(rows)
            cosine[rows] = (matrix(left.take(at)) * matrix(right.take(at))).sum(1)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cosine)],
                                         names=["a", "b", "cosine"])


def count_members(least: float):
    """Blocks of members of two clusters to numbers of links: (a, b, id, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y = (np.array([m["vec"] for m in row[c]], np.float64) for c in ("left", "right"))
                x, y = (v / np.sqrt((v * v).sum(1, keepdims=True)) for v in (x, y))
                linked = x @ y.T >= least
                wx, wy = (np.array([m["weight"] for m in row[c]], np.int64) for c in ("left", "right"))
                ids = [m["id"] for m in row["left"]] + [m["id"] for m in row["right"]]
                n = np.concatenate([linked @ wy, wx @ linked])
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["a"]] * len(n), pa.int64()), pa.array([row["b"]] * len(n), pa.int64()),
                    pa.array(ids, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "id", "n"])

    return run


def similar_vectors(vectors: DataFrame, least: float = 0.9, member_block: int = 256) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    spark = vectors.sparkSession
    folder = workspace(spark)
    threshold = math.acos(least)
    tight = threshold / 2 * (1 - 1e-9)
    vec = F.col("embedding")
    number = F.transform(vec, lambda x: x.cast("double"))
    sound = (F.col("vec_id").isNotNull() & vec.isNotNull() & (F.size(vec) > 0)
             & F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
             & F.exists(number, lambda x: x != 0))
    distinct = settle(vectors.filter(F.coalesce(sound, F.lit(False)))
                      .groupBy(number.alias("vec")).agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")),
                      folder, "distinct")
    blocks = blocks_for(distinct.count())
    tables = tables_for(blocks)

    def dealt(rows: DataFrame, *order: str) -> DataFrame:
        return rows.repartition(width(spark), "dims", "tab", "cell").sortWithinPartitions("dims", "tab", "cell", *order)

    def cosines(pairs: DataFrame) -> DataFrame:
        left = distinct.select(F.col("id").alias("a"), F.col("vec").alias("left"))
        right = distinct.select(F.col("id").alias("b"), F.col("vec").alias("right"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
            angles, "a long, b long, cosine double")

    # Clusters: members lie within `tight` of their leader, hence within the threshold of each other.
    own, kinds = keyed(tables, blocks, probes=False)
    alone = distinct.select("id", F.col("id").alias("leader"), F.lit(0.0).alias("rho"), "vec", F.col("vec").alias("lead"))
    offers = dealt(alone.mapInArrow(own, kinds), "id").mapInArrow(pick_leaders(tight), "id long, leader long").distinct()
    found = settle(cosines(offers.toDF("a", "b")).filter(F.col("cosine") >= math.cos(tight)), folder, "offers")
    leads = settle(found.groupBy("a").agg(F.min(F.struct("b", "cosine")).alias("best"))
                   .select(F.col("a").alias("id"), "best.b", "best.cosine"), folder, "leads-0")
    for n in (1, 2, 3):  # a leader that follows another is replaced by that one where the angle allows it
        jump = leads.alias("x").join(leads.alias("y"), F.expr("x.b = y.id")).select(
            F.col("x.id").alias("a"), F.col("y.b").alias("b"))
        better = cosines(jump).filter(F.col("cosine") >= math.cos(tight)).select(
            F.col("a").alias("id"), F.col("b").alias("b2"), F.col("cosine").alias("c2"))
        leads = settle(leads.join(better, "id", "left").select(
            "id", F.coalesce("b2", "b").alias("b"), F.coalesce("c2", "cosine").alias("cosine")), folder, f"leads-{n}")
    member = settle(distinct.join(leads, "id", "left").select(
        "id", "weight", "vec", F.coalesce("b", "id").alias("leader"),
        F.when(F.col("b").isNull(), 0.0).otherwise(F.acos(F.least(F.lit(1.0), "cosine")) + 1e-9).alias("rho")),
        folder, "members")
    cluster = settle(member.groupBy("leader").agg(F.sum("weight").alias("size"), F.max("rho").alias("rho"),
                                                  F.min("id").alias("first"))
                     .join(distinct.select(F.col("id").alias("leader"), F.col("vec").alias("lead")), "leader"),
                     folder, "clusters")

    # Pairs of clusters that share a cell.
    probing, kinds = keyed(tables, blocks, probes=True)
    shown = member.select("id", "leader", "vec").join(cluster.select("leader", "rho", "lead"), "leader").select(
        "id", "leader", "rho", "vec", "lead")
    seen = shown.mapInArrow(probing, kinds).groupBy("dims", "tab", "cell", "leader").agg(
        F.min("probe").alias("probe"), F.first("rho").alias("rho"), F.first("s1").alias("s1"),
        F.first("s2").alias("s2"))
    pairs = dealt(seen).mapInArrow(candidate_clusters(threshold), "a long, b long").distinct()
    info = cluster.select("leader", "rho", "size")
    judged = settle(
        cosines(pairs).join(info.toDF("a", "rho_a", "size_a"), "a").join(info.toDF("b", "rho_b", "size_b"), "b")
        .withColumn("rho", F.col("rho_a") + F.col("rho_b"))
        .withColumn("angle", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "cosine"))))
        .withColumn("verdict", F.when(F.col("rho") == 0, F.when(F.col("cosine") >= least, "all").otherwise("none"))
                    .when(F.col("angle") + F.col("rho") <= threshold - 1e-9, "all")
                    .when(F.col("angle") - F.col("rho") > threshold + 1e-9, "none").otherwise("some"))
        .filter("verdict <> 'none'").select("a", "b", "size_a", "size_b", "verdict"), folder, "judged")
    whole, part = judged.filter("verdict = 'all'"), judged.filter("verdict = 'some'")
    ends = part.select(F.col("a").alias("leader")).unionAll(part.select("b")).distinct()
    packed = (member.join(ends, "leader").join(cluster.select("leader", "size"), "leader")
              .withColumn("block", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / member_block)))
              .groupBy("leader", "block").agg(F.collect_list(F.struct("id", "weight", "vec")).alias("members")))
    compared = settle(part.select("a", "b").join(packed.select(F.col("leader").alias("a"), F.col("members").alias("left")), "a")
                      .join(packed.select(F.col("leader").alias("b"), F.col("members").alias("right")), "b")
                      .select("a", "b", "left", "right")
                      .mapInArrow(count_members(least), "a long, b long, id long, n long").filter("n > 0"),
                      folder, "compared")

    # Links per vector, components per cluster.
    firsts = cluster.select("leader", "first")
    links = (whole.select("a", "b").unionAll(compared.select("a", "b").distinct())
             .join(firsts.toDF("a", "fa"), "a").join(firsts.toDF("b", "fb"), "b")
             .select(F.col("fa").alias("a"), F.col("fb").alias("b")))
    roots = components(links, folder)
    beside = whole.select(F.col("a").alias("leader"), F.col("size_b").alias("n")).unionAll(
        whole.select("b", "size_a")).groupBy("leader").agg(F.sum("n").alias("beside"))
    groups = cluster.join(beside, "leader", "left").join(roots, cluster["first"] == roots["node"], "left").select(
        "leader", (F.col("size") - 1 + F.coalesce("beside", F.lit(0))).alias("shared"),
        F.coalesce("root", "first").alias("component"))
    own_links = compared.groupBy("id").agg(F.sum("n").alias("own"))
    result = member.join(groups, "leader").join(own_links, "id", "left").select(
        "vec", (F.col("shared") + F.coalesce("own", F.lit(0))).alias("n_links"), "component")
    return vectors.filter("vec_id is not null").select("vec_id", F.when(sound, number).alias("vec")).join(
        result, "vec", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id")).unionAll(
        vectors.filter("vec_id is null").select("vec_id", F.lit(0).cast("long"), F.lit(None).cast("long"),
                                                F.lit(False)))
