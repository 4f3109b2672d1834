"""Operator 3: documents packed into fixed-length sequences by bin completion.

Where a piece goes depends on its length only, so the search works on the histogram of lengths, which has at most
`capacity` rows at any input size. Bin completion fills the bin of the largest remaining length with an undominated
set of others, repeats that pattern as often as the counts allow, and goes on; a branch is cut when the waste so far
can no longer beat the incumbent, which starts as the best-fit-decreasing packing. The search ends at the lower bound
or after `nodes` patterns. Patterns then become sequences by the rank of each piece among those of its length.

Defined results: null or empty text is one piece that holds the end id; only documents longer than `capacity` are cut;
repeated rows are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_totals, settle, workspace
from .token_files import encode_rows

Pattern = tuple[tuple[int, ...], int]  # lengths in one sequence, and how many sequences look so


# ---- pieces ------------------------------------------------------------------------------------------------------

def cut_rows(vocabulary: str, end_id: int, capacity: int, with_ids: bool):
    encode = encode_rows(vocabulary, end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in encode(batches):
            lists = batch.column(2)
            data = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            cuts = lists.offsets.to_numpy().astype(np.int64)
            lengths = np.diff(cuts)
            pieces = -(-lengths // capacity)
            row = np.repeat(np.arange(len(lengths)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(lengths[row] - start, capacity)
            at = cuts[row] + start
            crc = [zlib.crc32(data[a:a + n]) for a, n in zip(at.tolist(), length.tolist())]
            columns = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                edges = np.append(at, cuts[-1]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(data.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1,
           with_ids: bool = False) -> DataFrame:
    """One row per piece of each document's ids, the end id included."""
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(cut_rows(vocabulary, end_id, capacity, with_ids), kinds)


# ---- search over the histogram -------------------------------------------------------------------------------------

def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing; equal bins are handled together."""
    bins: dict[tuple[int, tuple[int, ...]], int] = {}  # (room, lengths) -> number of such bins
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room, held in sorted(k for k in bins if k[0] >= length):
            if not left:
                break
            have = bins.pop((room, held))
            each = room // length
            used = min(have, left // each)
            if used:
                key = (room - each * length, held + (length,) * each)
                bins[key] = bins.get(key, 0) + used
                left -= used * each
            if have > used and 0 < left < each:
                key = (room - left * length, held + (length,) * left)
                bins[key] = bins.get(key, 0) + 1
                used, left = used + 1, 0
            if have > used:
                bins[room, held] = bins.get((room, held), 0) + have - used
        each = capacity // length
        for many, size in ((left // each, each), (1, left % each)):
            if many and size:
                key = (capacity - size * length, (length,) * size)
                bins[key] = bins.get(key, 0) + many
    return [(held, many) for (_, held), many in bins.items()]


def dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the items of b fit into places as large as the items of a."""
    if not b:
        return True
    tried = set()
    for i, place in enumerate(a):
        if place >= b[0] and place not in tried:
            tried.add(place)
            if dominates(a[:i] + (place - b[0],) + a[i + 1:], b[1:]):
                return True
    return False


def fillings(counts: dict[int, int], lengths: np.ndarray, room: int, most: int, steps: int) -> list[tuple[int, ...]]:
    """Undominated sets of remaining lengths for `room`, the least waste first.

    Sets are walked length by length, the largest first, each with as many copies as fit and then fewer. The walk ends
    after `steps` sets in part or whole, or when `most` sets without waste are found; it always reaches a whole one.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    whole = 0

    def choices(rest: int, top: int):
        """(index, copies) that may follow: smaller lengths only, so a set is met once."""
        if top and rest in counts and rest <= lengths[top - 1]:
            yield int(np.searchsorted(lengths, rest)), 1
            return
        for i in range(min(top, int(np.searchsorted(lengths, rest, side="right"))) - 1, -1, -1):
            n = int(lengths[i])
            for copies in range(min(counts[n], rest // n), 0, -1):
                yield i, copies

    open_: list[tuple[tuple[int, ...], int, Iterator[tuple[int, int]], bool]] = [
        ((), room, choices(room, len(lengths)), True)]
    while open_ and whole < most and (steps > 0 or not found):
        held, rest, left, fresh = open_.pop()
        step = next(left, None)
        if step is None:
            if fresh:
                found.append((rest, held))
                whole += not rest
            continue
        open_.append((held, rest, left, False))
        i, copies = step
        n = int(lengths[i])
        open_.append((held + (n,) * copies, rest - n * copies, choices(rest - n * copies, i), True))
        steps -= 1
    kept: list[tuple[int, ...]] = []
    for _, held in sorted(found, key=lambda f: (f[0], len(f[1])))[: 4 * most]:
        if not any(len(held) <= 12 and dominates(k, held) for k in kept):
            kept.append(held)
        if len(kept) == most:
            break
    return kept


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = 20_000, branches: int = 6,
                   steps: int = 128) -> list[Pattern]:
    """Patterns that hold every length as often as `counts` says, in as few sequences as the search finds.

    What bounds the search: `nodes` patterns tried in all; per pattern at most `branches` fillings, taken from a walk of
    `steps` sets; dominance is tested on fillings of up to 12 items; a pattern is repeated as often as it can be, and on
    the way back half as often, a quarter and so on. None of these drops a document: the best packing found holds all.
    """
    total = sum(n * c for n, c in counts.items())
    bound = -(-total // capacity)
    incumbent = best_fit(counts, capacity)
    fewest = sum(m for _, m in incumbent)
    counts = dict(counts)
    chosen: list[Pattern] = []
    open_nodes: list[tuple[int, int, list[tuple[tuple[int, ...], int]]]] = []  # (bins, waste before, (filling, most) left)
    bins = waste = 0

    def undo() -> None:
        held, many = chosen.pop()
        for n in held:
            counts[n] = counts.get(n, 0) + many

    def lengths() -> np.ndarray:
        return np.array(sorted(counts), np.int64)

    while fewest > bound and nodes > 0:
        slack = (fewest - 1) * capacity - total  # the waste a better packing may have
        if not counts:
            fewest, incumbent = bins, list(chosen)
            options: list[tuple[tuple[int, ...], int]] = []
        else:
            nodes -= 1
            largest = max(counts)
            counts[largest] -= 1
            if not counts[largest]:
                del counts[largest]
            options = [((largest, *f), 1 << 62) for f in fillings(counts, lengths(), capacity - largest, branches, steps)]
            counts[largest] = counts.get(largest, 0) + 1
        open_nodes.append((bins, waste, options))
        while open_nodes:
            bins, waste, options = open_nodes[-1]
            slack = (fewest - 1) * capacity - total
            held, most = options.pop(0) if options else (None, 0)
            spare = capacity - sum(held) if held else 0
            if held and (waste + spare <= slack or len(held) == sum(counts.values())):
                use = Counter(held)
                many = min(most, *(counts[n] // k for n, k in use.items()))
                if spare:
                    many = max(1, min(many, (slack - waste) // spare))
                if many > 1:
                    options.append((held, many // 2))
                for n, k in use.items():
                    counts[n] -= k * many
                    if not counts[n]:
                        del counts[n]
                chosen.append((held, many))
                bins, waste = bins + many, waste + spare * many
                break
            if not options:
                open_nodes.pop()
                if chosen:
                    undo()
        if not open_nodes:
            break
    return incumbent


# ---- places --------------------------------------------------------------------------------------------------------

def places(patterns: list[Pattern]) -> pd.DataFrame:
    """Per length, runs of ranks: the piece with rank `first + i` goes to sequence `sequence + i` at `offset`."""
    rows, sequence, used = [], 0, {}
    for held, many in patterns:
        offset = 0
        for n in held:
            rows.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + many
            offset += n
        sequence += many
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "offset"]).sort_values(["length", "first"])


def place_rows(table: pd.DataFrame):
    key = (table["length"].to_numpy(np.int64) << 40) + table["first"].to_numpy(np.int64)
    first, sequence, offset = (table[c].to_numpy(np.int64) for c in ("first", "sequence", "offset"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rank = b["rank"].to_numpy(np.int64)
            at = np.searchsorted(key, (b["length"].to_numpy(np.int64) << 40) + rank, side="right") - 1
            yield b.drop(columns="rank").assign(sequence_id=sequence[at] + rank - first[at], offset=offset[at])

    return place


def in_order(placed: DataFrame, order: list[str], folder: str) -> DataFrame:
    """Sequences numbered anew by the first of their pieces in `order`."""
    first = F.min(F.struct(*order, "sequence_id")).alias("first")
    heads = placed.groupBy("sequence_id").agg(first).select("first.*", F.lit(1).alias("one"))
    numbers = running_totals(heads, [], [*order, "sequence_id"], "one", "number", folder, "numbers")
    numbered = placed.join(numbers.select("sequence_id", "number"), "sequence_id")
    return numbered.withColumn("sequence_id", F.col("number")).drop("number")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, nodes: int = 20_000,
         slots: DataFrame | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    With `slots` (doc_id, slot, before; one row per doc_id) pieces of a length find their places in that order, and
    sequences are numbered by it; documents without a slot come last.

    The driver holds the histogram (at most `capacity` rows) and the patterns: whenever a pattern ends, one of its
    lengths has less than half of what it had or none left, so their number is bounded by `capacity` as well.
    """
    folder = workspace(docs.sparkSession)
    cut = settle(pieces(docs, vocabulary, capacity, end_id), folder, "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = places(bin_completion(counts, capacity, nodes))
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, "
    order = ["doc_id", "piece"]
    if slots is not None:
        kinds += "slot long, before long, "
        order = ["slot", "before", *order]
        last = F.lit(2**62)
        # One plan at any size: at scale the slots are too many to broadcast.
        cut = cut.join(slots.hint("merge"), "doc_id", "left").select(
            *cut.columns, F.coalesce("slot", last).alias("slot"), F.coalesce("before", last).alias("before"))
    ranked = running_totals(cut.withColumn("one", F.lit(1)), ["length"], order, "one", "rank", folder,
                            "ranks").drop("one")
    placed = ranked.mapInPandas(place_rows(table), kinds + "sequence_id long, offset long")
    if slots is None:
        return placed
    return in_order(settle(placed, folder, "placed"), order, folder).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(packed: DataFrame, cut: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from `pack` and `pieces(..., with_ids=True)`; doc_id must be unique."""
    held = packed.select("doc_id", "piece", "sequence_id", "offset").join(cut.select("doc_id", "piece", "ids"),
                                                                           ["doc_id", "piece"])
    return held.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")) \
        .select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
