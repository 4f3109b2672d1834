"""Operator 12: periodic runs of words, found with string synchronising sets.

A run is a longest stretch of words with smallest period q whose words q apart are equal, of `least` words or more and
`times` periods or more. Texts of a slice are laid out one after another, each closed by a mark of its own, longest first.

Periods below 4 come from regions of equal neighbours at that distance. For t = 4, 8, 16, ... the synchronising set
holds the places i where the least hash among the strings of t words that begin in i..i+t is found at i or i+t; strings
of period t/4 or less are left out, so that the set stays sparse inside runs that are known by then. Membership depends
on the next 2t words only. A run of period q in [t, 2t) of four periods has a member in its first t places, and the place q
words on has the same 2t words: neighbours in the order of (context, place) that are q apart propose every period.
A proposal is extended to both sides and compared word by word, and dropped if a shorter period divides it.

Defined results: null, empty and blank text have no words and no run; repeated rows and ties are kept, each row has its
own result; a null doc_id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .tokens import slices

DIRECT = (1, 2, 3)
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_NONE = np.uint64(2**64 - 1)


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def doubled(prints: np.ndarray, reach: int) -> np.ndarray:
    """Fingerprints of strings of 2 * reach words from those of `reach` words."""
    return scramble(prints[:-reach] * np.uint64(0x9E3779B97F4A7C15) + prints[reach:])


def primitive(codes: np.ndarray, start: int, period: int) -> bool:
    """Whether the stretch's root is no power of a shorter string."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            step = period // factor
            if (codes[start:start + period - step] == codes[start + step:start + period]).all():
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def equal_stretch(codes: np.ndarray, at: int, shift: int) -> tuple[int, int]:
    """The longest [a, b) around `at` where codes[i] == codes[i + shift]; codes at `at` are equal so."""
    end, block = at + 1, 16
    while end + shift < len(codes):
        n = min(block, len(codes) - shift - end)
        same = codes[end:end + n] == codes[end + shift:end + shift + n]
        if not same.all():
            end += int(np.argmin(same))
            break
        end, block = end + n, block * 2
    begin, block = at, 16
    while begin > 0:
        n = min(block, begin)
        same = codes[begin - n:begin] == codes[begin - n + shift:begin + shift]
        if not same.all():
            begin -= int(np.argmin(same[::-1]))
            break
        begin, block = begin - n, block * 2
    return begin, end


def direct_runs(codes: np.ndarray, period: int, least: int, times: int) -> list[tuple[int, int, int]]:
    """Runs of a small period: stretches where neighbours at that distance are equal."""
    same = np.concatenate([[False], codes[:-period] == codes[period:], [False]])
    edges = np.flatnonzero(same[1:] != same[:-1])
    begins, lengths = edges[::2], edges[1::2] - edges[::2] + period
    long = lengths >= max(least, times * period)
    return [(s, n, period) for s, n in zip(begins[long].tolist(), lengths[long].tolist()) if primitive(codes, s, period)]


def known_places(found: list[tuple[int, int, int]], size: int, reach: int) -> np.ndarray:
    """Places below `size` whose next `reach` words have a period of reach / 4 or less."""
    step = np.zeros(size + 1, np.int32)
    runs = np.array([(s, s + n - reach + 1) for s, n, p in found if 4 * p <= reach <= n and s < size], np.int64)
    if len(runs):
        np.add.at(step, runs[:, 0], 1)
        np.add.at(step, np.minimum(runs[:, 1], size), -1)
    return np.cumsum(step[:-1]) > 0


def synchronising(prints: np.ndarray, left_out: np.ndarray, reach: int) -> np.ndarray:
    """Places i where the least print of i..i+reach stands at i or at i+reach."""
    rank = np.where(left_out, _NONE, prints)
    least, span = rank, 1
    while span < reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    return np.flatnonzero((least != _NONE) & ((rank[:n] == least) | (rank[reach:reach + n] == least)))


def runs_of(codes: np.ndarray, sizes: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """(start, length, period) of all runs in `codes`: texts of `sizes` codes, longest first, an own mark behind each.

    A code is not negative and names a word; marks are all different and negative. `times` must be 4 or more.
    """
    found = [r for p in DIRECT for r in direct_runs(codes, p, least, times) if len(codes) > p]
    ends = np.cumsum(sizes + 1)
    prints, reach = scramble(codes.astype(np.uint64)), 1
    while True:
        if reach >= 4:
            texts = int(np.searchsorted(-sizes, -times * reach, side="right"))
            if not texts:
                break
            prints = prints[:ends[texts - 1]]
        wider = doubled(prints, reach)
        if reach >= 4:
            known = known_places(found, len(prints), reach) if reach > 4 else np.zeros(len(prints), bool)
            at = synchronising(prints, known, reach)
            at = at[at < len(wider)]
            order = np.argsort(wider[at], kind="stable")
            at, context = at[order], wider[at[order]]
            apart = np.diff(at)
            close = np.flatnonzero((context[1:] == context[:-1]) & (apart >= reach) & (apart < 2 * reach))
            proposed = sorted(zip(apart[close].tolist(), at[close].tolist()))
            last, reached = 0, -1
            for period, place in proposed:
                if period == last and place < reached:
                    continue
                if codes[place] != codes[place + period]:
                    continue
                begin, end = equal_stretch(codes, place, period)
                last, reached = period, end
                length = end - begin + period
                if length >= max(least, times * period) and primitive(codes, begin, period):
                    found.append((begin, length, period))
        if len(wider) < 2 * reach + 1:
            break
        prints, reach = wider, 2 * reach
    return np.array(sorted(found), np.int64).reshape(-1, 3)


def find_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed: the text's words, joined by one space, less those
    that a run holds after its first period."""
    if times < 4:
        raise ValueError("runs of fewer than four periods are not found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in slices(batch.column(1)):
                yield searched(batch.slice(first, rows), least, times)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def searched(batch: pa.RecordBatch, least: int, times: int) -> pa.RecordBatch:
    lists = pc.ascii_split_whitespace(pc.fill_null(batch.column(1).cast(pa.large_string()), ""))
    flat, cuts = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    said = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.cumsum(said)])[cuts - cuts[0]]
    flat = flat.filter(pa.array(said))
    words = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(cuts)
    order = np.argsort(-sizes, kind="stable")
    ends = np.cumsum(sizes[order] + 1)
    begins = ends - sizes[order] - 1
    codes = np.empty(int(ends[-1]), np.int64)
    marks = np.ones(len(codes), bool)
    marks[ends - 1] = False
    codes[ends - 1] = -1 - np.arange(len(order))
    place = np.repeat(cuts[:-1][order] - begins, sizes[order]) + np.flatnonzero(marks)  # of each word in `flat`
    codes[marks] = words[place]
    found = runs_of(codes, sizes[order], least, times)

    owner = np.searchsorted(ends, found[:, 0], side="right")
    by_text = np.argsort(order[owner], kind="stable")
    found, owner = found[by_text], owner[by_text]
    many = np.bincount(order[owner], minlength=len(sizes))
    fields = [found[:, 0] - begins[owner], found[:, 1], found[:, 2]]
    runs = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], names=["start", "length", "period"]))

    step = np.zeros(len(flat) + 1, np.int64)
    at = cuts[order[owner]] + fields[0]
    np.add.at(step, at + found[:, 2], 1)
    np.add.at(step, at + found[:, 1], -1)
    kept = np.cumsum(step[:-1]) == 0
    left = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept)])[cuts].astype(np.int32)),
                                    flat.filter(pa.array(kept)))
    collapsed = pc.binary_join(left, pa.scalar(" ", pa.large_string())).cast(pa.string())
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), runs, collapsed],
                                      names=["doc_id", "n_words", "runs", "collapsed"])
