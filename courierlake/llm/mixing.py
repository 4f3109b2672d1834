"""Operator 7: sources mixed to target weights by Pfair scheduling.

The documents of a source, in doc_id order, form blocks of about `block_chars` characters. Block j of a source with the
share w of the slots is released at floor(j / w) and due at ceil((j + 1) / w); in every slot the released block with
the earliest deadline goes next. Shares are whole numbers of a period, so the order repeats after one period and is
worked out for one only: it is a table of as many rows as the weights' sum. A source whose blocks are used up leaves,
and the others go on with their weights among themselves. In each such phase every source has, after any number of
slots, its share of them up to less than one block; no document is dropped.

Sources that the weights do not name form one stream together, so the driver's table is bounded by the weights.

Defined results: null or empty text counts as no characters; a document that spans several blocks goes with the first,
the others stay empty; a null source belongs to the unnamed ones; repeated rows are kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_totals, settle, width, workspace

REST = -1  # the stream of sources that the weights don't name


def period(shares: dict[int, int]) -> dict[int, list[tuple[int, int, int]]]:
    """Per stream, (slot, release, deadline) of its blocks in one period, by earliest deadline first."""
    size = sum(shares.values())
    found: dict[int, list[tuple[int, int, int]]] = {s: [] for s in shares}
    for slot in range(size):
        ready = []
        for s, share in shares.items():
            j = len(found[s])
            if j < share and j * size // share <= slot:
                ready.append((math.ceil((j + 1) * size / share), s, j * size // share))
        deadline, s, release = min(ready)
        found[s].append((slot, release, deadline))
    return found


def phases(shares: dict[int, int], blocks: dict[int, int]) -> list[dict]:
    """One entry for each span in which the same streams have blocks left: first slot, blocks used before, period."""
    used, start, out = {s: 0 for s in shares}, 0, []
    while left := {s: blocks.get(s, 0) - used[s] for s in shares if blocks.get(s, 0) > used[s]}:
        own = {s: shares[s] for s in left}
        table, size = period(own), sum(own.values())
        ends = min((n - 1) // own[s] * size + table[s][(n - 1) % own[s]][0] for s, n in left.items()) + 1
        out.append({"start": start, "used": dict(used), "size": size, "table": table})
        for s in left:
            used[s] += ends // size * own[s] + sum(slot < ends % size for slot, _, _ in table[s])
        start += ends
    return out


def slot_rows(plan: list[dict]):
    """Rows with stream and block to rows with slot, release and deadline."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = np.zeros((3, len(rows)), np.int64)
            stream, block = rows["stream"].to_numpy(), rows["block"].to_numpy(np.int64)
            for s in np.unique(stream):
                mine = np.flatnonzero(stream == s)
                own = [p for p in plan if s in p["table"]]
                number = np.searchsorted([p["used"][s] for p in own], block[mine], side="right") - 1
                for k in np.unique(number):
                    at, p = mine[number == k], own[k]
                    times = np.array(p["table"][s], np.int64)
                    j = block[at] - p["used"][s]
                    out[:, at] = (times[j % len(times)] + (p["start"] + j // len(times) * p["size"])[:, None]).T
            yield rows.assign(slot=out[0], release=out[1], deadline=out[2])

    return run


def mix(docs: DataFrame, weights: dict[str, int], rest: int, block_chars: int = 1_000_000) -> DataFrame:
    """doc_id, source, stream, block, slot, release, deadline, before (characters of the stream before) of every row."""
    folder = workspace(docs.sparkSession)
    names = sorted(weights)
    shares = {i: weights[n] for i, n in enumerate(names)} | {REST: rest}
    if any(w < 1 for w in shares.values()):
        raise ValueError("weights are whole numbers from 1")
    number = F.coalesce(*(F.when(F.col("source") == n, i) for i, n in enumerate(names)), F.lit(REST))
    sized = docs.select("doc_id", "source", number.alias("stream"),
                        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"))
    totals = running_totals(settle(sized, folder, "sizes"), ["stream"], ["doc_id"], "chars", "before", folder, "before")
    blocked = settle(totals.withColumn("block", F.floor(F.col("before") / block_chars)).drop("chars"), folder, "blocks")
    blocks = {r["stream"]: r["n"] for r in blocked.groupBy("stream").agg((F.max("block") + 1).alias("n")).collect()}
    return blocked.mapInPandas(slot_rows(phases(shares, blocks)),
                               "doc_id long, source string, stream int, before long, block long, "
                               "slot long, release long, deadline long").select(
        "doc_id", "source", "stream", "block", "slot", "release", "deadline", "before")


def own_weights(docs: DataFrame, weights: dict[str, int], rest: int) -> tuple[dict[str, int], int]:
    """`weights` and `rest` with a share for every source: those that `weights` doesn't name get `rest` in equal parts.

    Rows without a source are one of those parts. The driver holds one row per source.
    """
    seen = [r["source"] for r in docs.select("source").distinct().collect()]
    others = sorted(s for s in seen if s is not None and s not in weights)
    parts = max(1, len(others) + (None in seen))
    whole = {n: w * parts for n, w in weights.items()} | {s: rest for s in others}
    common = math.gcd(rest, *whole.values())
    return {n: w // common for n, w in whole.items()}, rest // common


def slot_order(docs: DataFrame, weights: dict[str, int], rest: int, block_chars: int = 1_000_000) -> DataFrame:
    """doc_id, slot and before; rows that repeat a doc_id share its first place."""
    order = settle(mix(docs, weights, rest, block_chars), workspace(docs.sparkSession), "order")
    return order.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("slot", "before")).alias("place")) \
        .select("doc_id", "place.*")


def mixed(docs: DataFrame, weights: dict[str, int], rest: int, block_chars: int = 1_000_000) -> DataFrame:
    """The documents in the order of their slots, across partitions and within them."""
    spark = docs.sparkSession
    order = settle(mix(docs, weights, rest, block_chars), workspace(spark), "order").filter("doc_id is not null")
    # Rows that repeat a doc_id share its first place.
    first = order.groupBy(F.col("doc_id").alias("id")).agg(F.min(F.struct("slot", "before")).alias("place"))
    whole = docs.select("doc_id", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    at = [F.col("place").asc_nulls_last(), F.col("doc_id")]
    # One plan at any size: at scale the places are too many to broadcast.
    return (whole.join(first.hint("merge"), F.col("doc_id") == F.col("id"), "left").repartitionByRange(width(spark), *at)
            .sortWithinPartitions(*at).select("row.*"))
