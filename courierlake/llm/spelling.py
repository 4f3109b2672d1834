"""Operator 13: spelling variants of one word, found by range searches in k-d trees over letter counts.

One inserted or deleted letter moves a word's vector of letter counts by 1 in L1 distance, a replaced one by 2. Words of
each length have a k-d tree. Its upper part is fitted on a bounded sample of the vocabulary (`sample_words`, those of
the least hash) and deals every word to the cell it lies in and, as a visitor, to the cells of its own length within
distance 2 and of the next length within 1: a box is entered only if it reaches into the ball. A cell is one key of a
shuffle. Its task builds the lower part over the cell's words and lets the visitors come by in batches. What the boxes
leave over is compared letter by letter. Cells with more than `cell` words, such as those of many anagrams, are split
by hash, and each part is visited by all visitors of the cell, so no task holds more than about `cell` words.

Defined results: null and empty text have no words; repeated rows count each; a null doc_id reads as an empty one where
`mistyped` letters are left out; an empty table gives no rows; other columns are ignored; equal counts are settled by
code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, width, workspace
from .tokens import slices

LETTERS = "A-Za-zÀ-ÿ"
FIRST, DIMENSIONS = (97, 192), 26 + 64  # a to z, and U+00C0 to U+00FF
SAME, LONGER = 2, 1  # L1 distance to words of the same and of the next length
BUCKET = 32


# ---- words ---------------------------------------------------------------------------------------------------------

def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, mistyped: int | None = None) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of `shortest` letters or more that occur `least` times or more.

    With `mistyped`, h being the crc32 of "<doc_id>:<run>", a run whose h that number divides loses letter h % length.
    """
    pattern = re.compile(f"[{LETTERS}]+")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            rows = [(w, n) for w, n in seen.items() if len(w) >= shortest]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                               pa.array([r[1] for r in rows], pa.int64())], names=["word", "n"])

        for batch in batches:
            for first, rows in slices(batch.column(1)):
                part = batch.slice(first, rows)
                texts = pc.ascii_lower(pc.fill_null(part.column(1), "")).to_pylist()
                for doc_id, text in zip(part.column(0).to_pylist(), texts):
                    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for word, n in Counter(pattern.findall(text)).items():
                        if mistyped:
                            h = zlib.crc32(word.encode(), head)
                            if h % mistyped == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1:]
                        seen[word] = seen.get(word, 0) + n
                if len(seen) > 200_000:
                    yield out()
        yield out()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def letters(words: list[str], length: int) -> np.ndarray:
    """The letters of words of one length, one row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def vectors(spelled: np.ndarray) -> np.ndarray:
    """How often each letter stands in each word."""
    at = np.where(spelled >= FIRST[1], spelled.astype(np.int64) - FIRST[1] + 26, spelled.astype(np.int64) - FIRST[0])
    at += np.arange(len(spelled))[:, None] * DIMENSIONS
    return np.bincount(at.ravel(), minlength=len(spelled) * DIMENSIONS).reshape(-1, DIMENSIONS).astype(np.int32)


# ---- trees ---------------------------------------------------------------------------------------------------------

class Tree:
    """A k-d tree: node -> dimension, threshold (values up to it go left) and children; leaves have a number."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.dim, self.threshold, self.left, self.right, self.number = [], [], [], [], []
        low, high = [np.full(DIMENSIONS, -1)], [np.full(DIMENSIONS, 1 << 30)]
        members: list[np.ndarray] = []
        stack = [(self._node(), np.arange(len(points)), low[0], high[0])]
        bounds = {0: (low[0], high[0])}
        while stack:
            node, own, lo, hi = stack.pop()
            split = self._split(points[own]) if len(own) > leaf else None
            if split is None:
                self.number[node] = len(members)
                members.append(own)
                continue
            self.dim[node], self.threshold[node] = split
            goes = points[own, split[0]] <= split[1]
            for left in (True, False):
                child = self._node()
                (self.left if left else self.right)[node] = child
                edge = (hi if left else lo).copy()
                edge[split[0]] = split[1] + (0 if left else 1)
                box = (lo, edge) if left else (edge, hi)
                bounds[child] = box
                stack.append((child, own[goes == left], *box))
        self.dim, self.threshold, self.left, self.right, self.number = (
            np.array(a, np.int32) for a in (self.dim, self.threshold, self.left, self.right, self.number))
        self.low, self.high = (np.array([bounds[n][i] for n in range(len(self.dim))], np.int32) for i in (0, 1))
        sizes = np.array([len(m) for m in members])
        self.members, self.first = np.concatenate(members), np.concatenate([[0], np.cumsum(sizes)])

    def _node(self) -> int:
        for a in (self.dim, self.threshold, self.left, self.right, self.number):
            a.append(-1)
        return len(self.dim) - 1

    @staticmethod
    def _split(points: np.ndarray) -> tuple[int, int] | None:
        """The dimension of the widest spread and a threshold near its median that leaves both sides filled."""
        dim = int(np.argmax(points.var(axis=0)))
        values = points[:, dim]
        if values.min() == values.max():
            return None
        middle = int(np.partition(values, len(values) // 2)[len(values) // 2])
        below = int((values < middle).sum())
        upto = int((values <= middle).sum())
        # The cut behind the median or before it, whichever is more even; never an empty side.
        if upto == len(values) or (below and abs(2 * below - len(values)) < abs(2 * upto - len(values))):
            return dim, middle - 1
        return dim, middle

    def within(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) for all leaves whose box is within `radius` of the point in L1 distance."""
        row, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        paid = np.zeros(len(points), np.int32)
        rows, leaves = [], []
        while len(row):
            done = self.number[node] >= 0
            rows.append(row[done])
            leaves.append(self.number[node[done]])
            row, node, paid = row[~done], node[~done], paid[~done]
            dim = self.dim[node]
            value = points[row, dim]
            own = np.maximum(np.maximum(self.low[node, dim] - value, value - self.high[node, dim]), 0)
            parts = []
            for child in (self.left[node], self.right[node]):
                new = np.maximum(np.maximum(self.low[child, dim] - value, value - self.high[child, dim]), 0)
                cost = paid - own + new
                near = cost <= radius
                parts.append((row[near], child[near].astype(np.int64), cost[near]))
            row, node, paid = (np.concatenate(p) for p in zip(*parts))
        return np.concatenate(rows), np.concatenate(leaves)

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf in which each point lies."""
        row, leaf = self.within(points, 0)
        out = np.zeros(len(points), np.int64)
        out[row] = leaf
        return out


def fit(words: DataFrame, sizes: dict[int, int], cell: int, sample_words: int) -> dict[int, Tree]:
    """Trees of the lengths with more than `cell` words; the driver holds `sample_words` words at most."""
    large = [n for n, count in sizes.items() if count > cell]
    if not large:
        return {}
    total = sum(sizes[n] for n in large)
    sample = (words.filter(F.length("word").isin(large)).orderBy(F.xxhash64("word"), "word").limit(sample_words)
              .select("word").toPandas()["word"].tolist())
    by_length: dict[int, list[str]] = {}
    for w in sample:
        by_length.setdefault(len(w), []).append(w)
    share = max(2, int(cell * len(sample) / total))
    return {n: Tree(vectors(letters(held, n)), share) for n, held in by_length.items()}


# ---- links ---------------------------------------------------------------------------------------------------------

def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        if len(own):
            yield int(sizes[own[0]]), own


def dealt(words: DataFrame, trees: dict[int, Tree], lengths: set[int], parts: dict[tuple[int, int], int],
          visitors: bool = True) -> DataFrame:
    """Rows (length, leaf, part, visit, word, n): every word in its cell, and as a visitor wherever its ball reaches."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            rows: list[tuple[np.ndarray, ...]] = []
            for length, own in by_length(said):
                points = vectors(letters([said[i] for i in own], length))
                searches = [(length, 0, False)]
                if visitors:
                    searches += [(length, SAME, True), (length + 1, LONGER, True)]
                for at, radius, visit in searches:
                    if at not in lengths:
                        continue
                    tree = trees.get(at)
                    row, leaf = tree.within(points, radius) if tree else (np.arange(len(own)), np.zeros(len(own), int))
                    many = np.array([parts.get((at, x), 1) for x in leaf.tolist()], np.int64)
                    if visit:
                        row, leaf = np.repeat(row, many), np.repeat(leaf, many)
                        part = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                    else:
                        part = np.array([zlib.crc32(said[own[r]].encode()) for r in row.tolist()], np.int64) % many
                    rows.append((np.full(len(row), at), leaf, part, np.full(len(row), visit), own[row]))
            if not rows:
                continue
            length, leaf, part, visit, at = (np.concatenate(c) for c in zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c.astype(np.int32)) for c in (length, leaf, part, visit)),
                 batch.column(0).take(pa.array(at)), pa.array(n[at])],
                names=["length", "leaf", "part", "visit", "word", "n"])

    return words.select("word", "n").mapInArrow(
        deal, "length int, leaf int, part int, visit int, word string, n long")


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a[i] becomes b[i] by one replaced letter, or by one inserted where b is one longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= a.shape[1]


def coded(spelled: np.ndarray) -> np.ndarray:
    """A number for each row of letters; equal rows have equal numbers."""
    out = np.zeros(len(spelled), np.uint64)
    for column in spelled.T:
        out = out * np.uint64(0x9E3779B97F4A7C15) + column
    return out


class Cell:
    """The words of one cell, with the lower part of the tree; a leaf's words stand together."""

    def __init__(self, words: list[str], n: list[int]):
        spelled = letters(words, len(words[0]))
        self.tree = Tree(vectors(spelled), BUCKET)
        self.words = [words[i] for i in self.tree.members.tolist()]
        self.n, self.spelled = np.array(n, np.int64)[self.tree.members], spelled[self.tree.members]
        self.halves: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def links(self, words: list[str], n: np.ndarray) -> Iterator[tuple[list[str], list[str], np.ndarray]]:
        """(word, near word, its n) for visitors of one length, in both directions where the lengths differ.

        One edit leaves the letters before it or those behind it as they are, so the first half of a visitor or the
        rest of it must be found at the same end of the other word; what passes is compared letter by letter.
        """
        spelled = letters(words, len(words[0]))
        length = spelled.shape[1]
        longer, half = self.spelled.shape[1] > length, length // 2
        if length not in self.halves:
            self.halves[length] = coded(self.spelled[:, :half]), coded(self.spelled[:, half - length:])
        (head, tail), my_head, my_tail = self.halves[length], coded(spelled[:, :half]), coded(spelled[:, half:])
        row, leaf = self.tree.within(vectors(spelled), LONGER if longer else SAME)
        size = self.tree.first[leaf + 1] - self.tree.first[leaf]
        block = (np.cumsum(size) - size) // (1 << 20)
        cuts = (np.flatnonzero(np.diff(block)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(size)]):
            many = size[a:b]
            visitor = np.repeat(row[a:b], many)
            target = np.arange(len(visitor)) + np.repeat(self.tree.first[leaf[a:b]] - (np.cumsum(many) - many), many)
            close = np.flatnonzero((head[target] == my_head[visitor]) | (tail[target] == my_tail[visitor]))
            for c in range(0, len(close), max(1, (8 << 20) // length)):
                at = close[c:c + max(1, (8 << 20) // length)]
                mine, theirs = visitor[at], target[at]
                good = one_edit(spelled[mine], self.spelled[theirs])
                mine, theirs = mine[good].tolist(), theirs[good]
                said, near = [words[i] for i in mine], [self.words[i] for i in theirs.tolist()]
                yield said, near, self.n[theirs]
                if longer:
                    yield near, said, n[mine]


def near_words(words: DataFrame, cell: int = 16_384, sample_words: int = 50_000) -> DataFrame:
    """(word, near, near_n): every pair of words one edit apart, in both directions."""
    spark = words.sparkSession
    sizes = {r[0]: r[1] for r in words.groupBy(F.length("word")).agg(F.count("*")).collect()}
    trees, lengths = fit(words, sizes, cell, sample_words), set(sizes)
    held = dealt(words, trees, lengths, {}, visitors=False).groupBy("length", "leaf").agg(F.count("*").alias("c"))
    parts = {(r[0], r[1]): -(-r[2] // cell) for r in held.filter(F.col("c") > 2 * cell).collect()}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, words, n, built = None, [], [], None
        for batch in batches:
            keys = np.vstack([batch.column(c).to_numpy() for c in range(4)])
            cuts = np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if b == a:
                    continue
                length, leaf, part, visit = keys[:, a].tolist()
                if key != (length, leaf, part):
                    key, words, n, built = (length, leaf, part), [], [], None
                said = batch.column(4).slice(a, b - a).to_pylist()
                if not visit:
                    words += said
                    n += batch.column(5).slice(a, b - a).to_pylist()
                elif words:
                    built = built or Cell(words, n)
                    count = batch.column(5).slice(a, b - a).to_numpy()
                    for size, own in by_length(said):
                        for found in built.links([said[i] for i in own.tolist()], count[own]):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(found[0], pa.string()), pa.array(found[1], pa.string()),
                                 pa.array(found[2], pa.int64())], names=["word", "near", "near_n"])

    cells = dealt(words, trees, lengths, parts).repartition(width(spark), "length", "leaf", "part")
    return cells.sortWithinPartitions("length", "leaf", "part", "visit").mapInArrow(
        search, "word string, near string, near_n long")


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) by pointer doubling: after k rounds a word points 2 ** k forms on, or to the last one."""
    at = settle(forms.select("word", F.col("form").alias("root")), folder, "roots-0")
    n = 0
    while True:
        n += 1
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                  F.col("further").isNotNull().alias("moved"))
        step = settle(step, folder, f"roots-{n}")
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return at


def variants(words: DataFrame, times: int = 2, cell: int = 16_384, sample_words: int = 50_000) -> DataFrame:
    """word, form, root, n, n_near, form_n of every (word, n).

    A word's form is its near word of the largest n (ties: the first in code-point order), if that is `times` the
    word's n or more; its root is where following forms ends.
    """
    folder = workspace(words.sparkSession)
    words = settle(words.select("word", "n"), folder, "words")
    best = near_words(words, cell, sample_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    much = -F.col("best.less") >= times * F.col("n")
    named = settle(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(much, F.col("best.near")).alias("form"), F.when(much, -F.col("best.less")).alias("form_n")),
        folder, "forms")
    last = roots(named.filter("form is not null"), folder)
    return named.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                   "n_near", "form_n")
