"""Operator 5: SimHash fingerprints linked by covering locality-sensitive hashing.

A bit position i gets a vector m(i) of radius + 1 bits; mask v keeps the positions whose m(i) has an odd product with
v. For at most `radius` differing positions some v other than zero is orthogonal to all their m(i), so that mask keeps
none of them and both fingerprints fall into one bucket of table v: no pair within the radius is missed.

Buckets are compared in full, by numpy, and give links to one member per connected part. A bucket beyond `bucket`
members is not compared: its members go to a step that is linear in their number, where two fingerprints within the
radius meet in a point of both their balls of half the radius.

Defined results: null or empty text has fingerprint zero and is linked like any other; repeated rows are kept; a row
without doc_id takes part in no link and has no component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import components, first_of_equals, settle, width, workspace
from .tokens import slices

BITS = 64
SEED = 42


# ---- fingerprints --------------------------------------------------------------------------------------------------

def simhashes(texts: pa.Array, shingle: int) -> np.ndarray:
    """Unsigned 64-bit fingerprints: the majority, bit by bit, of the hashes of all word shingles."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    found = np.zeros(len(lists), np.uint64)
    hashes, owners, sizes = [], [], []

    def settle_votes() -> None:
        if hashes:
            found[owners] = majority(np.array(hashes, np.uint64), np.array(sizes))
            hashes.clear(), owners.clear(), sizes.clear()

    values, cuts = lists.values, lists.offsets.to_numpy()
    for row, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        said = [w for w in values.slice(a, b - a).to_pylist() if w]
        if not said:
            continue
        line = " ".join(said).encode()
        spans = np.cumsum([len(w.encode()) + 1 for w in said]) if not line.isascii() else np.cumsum(
            np.fromiter(map(len, said), np.int64, len(said)) + 1)
        ends = (spans - 1).tolist()
        starts = [0, *spans[:-1].tolist()]
        view = memoryview(line)
        pairs = zip(starts, ends[shingle - 1:]) if len(said) >= shingle else ((0, len(line)),)
        before = len(hashes)
        hashes.extend([xxh64_intdigest(view[s:e], SEED) for s, e in pairs])
        owners.append(row)
        sizes.append(len(hashes) - before)
        if len(hashes) > 500_000:
            settle_votes()
    settle_votes()
    return found


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per run of `sizes` hashes, the bits set in over half of them."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int32)
    return np.packbits(votes * 2 > sizes[:, None], axis=1, bitorder="little").view("<u8")[:, 0].astype(np.uint64)


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and fingerprint, as a signed long, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in slices(batch.column(1)):
                part = batch.slice(first, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(simhashes(part.column(1), shingle).view(np.int64))],
                    names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint long")


# ---- links ---------------------------------------------------------------------------------------------------------

def covering_masks(radius: int) -> list[int]:
    """2 ** (radius + 1) - 1 masks over 64 bits, as signed longs."""
    size = 2 ** (radius + 1) - 1
    masks = [sum(1 << i for i in range(BITS) if (v & (i % size + 1)).bit_count() % 2) for v in range(1, size + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def parts(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the index of the first one of its connected part."""
    root = np.arange(len(prints))
    if (np.bitwise_count(prints[1:] ^ prints[:-1]) <= radius).all():
        return np.zeros_like(root)
    left = root.copy()
    while len(left):
        seed, left = left[0], left[1:]
        queue = [seed]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(prints[left] ^ prints[at]) <= radius
            if near.any():
                queue.extend(left[near].tolist())
                root[left[near]] = seed
                left = left[~near]
    return root


def compare_buckets(radius: int, bucket: int):
    """Sorted rows (table, key, fingerprint, doc_id) to links (a, b), or to (doc_id, null) for members of big buckets."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        held, big = np.zeros((4, 0), np.int64), None  # rows of the last key so far; a key beyond `bucket`
        for batch in batches:
            rows = np.vstack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            held = np.hstack([held, rows])
            cut = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0)) + 1
            edges = np.concatenate([[0], cut])
            for a, b in zip(edges[:-1], edges[1:]):
                key = (held[0, a], held[1, a])
                if b - a > 1 or key == big:
                    yield held[2, a:b], held[3, a:b], key == big or b - a > bucket
            held = held[:, edges[-1]:] if held.shape[1] else held
            if held.shape[1] and (big == (held[0, 0], held[1, 0]) or held.shape[1] > bucket):
                big = (held[0, 0], held[1, 0])
                yield held[2], held[3], True
                held = held[:, :0]
        if held.shape[1] > 1:
            yield held[2], held[3], False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, size = [], [], 0

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()),
                                               pa.concat_arrays(b)], names=["a", "b"])
            a.clear(), b.clear()
            return made

        for prints, ids, large in runs(batches):
            if large:
                a.append(ids)
                b.append(pa.nulls(len(ids), pa.int64()))
            else:
                root = parts(prints.view(np.uint64), radius)
                linked = root != np.arange(len(root))
                a.append(ids[linked])
                b.append(pa.array(ids[root[linked]]))
            size += len(a[-1])
            if size > 50_000:
                yield out()
                size = 0
        if a:
            yield out()

    return run


def ball(radius: int) -> list[int]:
    """All bit patterns of at most `radius` ones, as signed longs."""
    points = [sum(1 << i for i in c) for n in range(radius + 1) for c in combinations(range(BITS), n)]
    return [p - (1 << BITS) if p >> (BITS - 1) else p for p in points]


def near_links(nodes: DataFrame, folder: str, radius: int = 4, bucket: int = 65_536) -> DataFrame:
    """Links (a, b) that connect whatever fingerprints within `radius` connect; nodes: fingerprint, doc_id."""
    masks = F.array(*(F.struct(F.lit(t).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key"))
                      for t, m in enumerate(covering_masks(radius))))
    rows = nodes.select(F.explode(masks).alias("at"), "fingerprint", "doc_id").select("at.*", "fingerprint", "doc_id")
    found = settle(rows.repartition(width(nodes.sparkSession), "table", "key")
                   .sortWithinPartitions("table", "key", "fingerprint")
                   .mapInArrow(compare_buckets(radius, bucket), "a long, b long"), folder, "pairs")
    big = found.filter("b is null").select(F.col("a").alias("doc_id")).distinct().join(nodes, "doc_id")
    half = F.array(*(F.lit(p) for p in ball(-(-radius // 2))))
    points = big.select("doc_id", F.explode(half).alias("flip"), "fingerprint").select(
        "doc_id", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("point"))
    first = points.groupBy("point").agg(F.min("doc_id").alias("b"))
    meet = points.join(first, "point").filter("doc_id <> b").select(F.col("doc_id").alias("a"), "b")
    return found.filter("b is not null").unionAll(meet).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, bucket: int = 65_536) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links reach."""
    folder = workspace(docs.sparkSession)
    prints = settle(fingerprints(docs, shingle), folder, "fingerprints")
    nodes = settle(prints.filter("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")),
                   folder, "nodes")
    roots = components(near_links(nodes, folder, radius, bucket), folder)
    named = nodes.join(roots, nodes.doc_id == roots.node, "left").select(
        "fingerprint", F.coalesce("root", "doc_id").alias("component_id"))
    return prints.join(named, "fingerprint", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The documents less all but one of each group of near copies: the one with the smallest doc_id.

    A document without doc_id stays. Rows that repeat a doc_id go or stay together; of those with one text too, the
    one of the smallest row hash stays.
    """
    found = settle(near_duplicates(docs, shingle, radius), workspace(docs.sparkSession), "groups")
    # One plan at any size: at scale the ids that go are too many to broadcast.
    gone = found.filter("doc_id <> component_id").select("doc_id").hint("merge")
    kept = docs.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    ids = found.filter("doc_id = component_id").agg(F.count("doc_id"), F.countDistinct("doc_id")).first()
    if ids[0] == ids[1]:
        return kept
    return kept.filter("doc_id is null").unionAll(first_of_equals(kept.filter("doc_id is not null")))
