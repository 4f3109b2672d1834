"""Operator 6: byte strings that occur twice removed, by a distributed difference cover.

A byte goes if a string of `length` bytes that covers it also starts anywhere else. To bring equal strings together
without sorting all suffixes in one place, every start is dealt by the smallest hash among the 32-byte grams of its
string: equal strings have the same smallest gram, at the same place. The starts that share a smallest gram are
neighbours and form a context, the text that their strings cover. What follows goes one way for every gram, however
many contexts it has:

- A gram that all its places show with the same context repeats in all of its strings.
- Else the starts of a context are cut into pieces of `window` neighbours, by their distance from the gram. The bytes
  that all strings of a piece share are its core: of each `window` starts the last one is sampled, and the core is what
  stands behind it. Cores are named by 64-bit hashes, so names agree across tasks. A core that occurs once has no
  repeats, and one that stands in equal pieces only repeats in all their strings.
- What is left are pieces with the same core and different ends. They are dealt by core, at most about `together` of one
  core to a batch, and a batch sorts the suffixes at their starts by the difference-cover algorithm: triples at
  positions not divisible by three are sorted and named, names are sorted by recursion until they span `length` bytes,
  the remaining suffixes are ordered by their first byte and the rank behind it, and neighbours in the order are compared
  over `length` bytes. Pieces lie so that their gram starts at a multiple of three, hence equal strings fall into the
  same residue class and the classes need not be merged at the top; below they are. The different strings of all
  batches are then merged under 128-bit names with the number of their copies.

Every step is linear in its rows, counts have a map-side part, and no gram, context or core meets whole in one task.

Defined results: null or empty text is no bytes; repeated rows remove each other where they are long enough; a row
without doc_id is handled like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from .common import drop, settle, width, workspace

GRAM = 32
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
PLACE = (1 << 24) - 1  # low bits of a window's key: the place of the gram in the piece at hand
PIECE = 1 << 20  # bytes handled at once; hashes take eight bytes each, several times over


# ---- contexts ------------------------------------------------------------------------------------------------------

def sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n neighbours."""
    span = 1
    while span * 2 <= n:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (n - span)], x[n - span:]) if n > span else x


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the gram at each place, from running sums of a polynomial."""
    n = len(data)
    powers = np.cumprod(np.full(n, BASE, np.uint64))
    back = np.cumprod(np.full(n - GRAM + 1, UNBASE, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)])
    h = (sums[GRAM:] - sums[:-GRAM]) * back
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def contexts_of(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first start, last start, gram place, gram hash) of each context; ends: for each place, its document's end."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    if len(data) < length:
        return none
    h = gram_hashes(data)
    key = (h & ~np.uint64(PLACE)) | np.arange(len(h), dtype=np.uint64)
    gram = (sliding_least(key, length - GRAM + 1) & np.uint64(PLACE)).astype(np.int64)
    start = np.flatnonzero(np.arange(len(gram)) + length <= ends[:len(gram)])
    if not len(start):
        return none
    gram = gram[start]
    cut = np.flatnonzero((np.diff(gram) != 0) | (np.diff(start) != 1))
    first = np.concatenate([[0], cut + 1])
    return start[first], start[np.concatenate([cut, [len(start) - 1]])], gram[first], h[gram[first]]


def text_pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, offsets in their texts, sizes) of what is joined to one piece; long texts are cut with an overlap."""
    rows, offsets, sizes, total = [], [], [], 0
    for row, text in enumerate(texts):
        step = PIECE - length
        for at in range(0, max(len(text) - length + 1, 0), step):
            size = min(len(text) - at, step + length - 1)
            if rows and total + size > PIECE:
                yield np.array(rows), np.array(offsets), np.array(sizes)
                rows, offsets, sizes, total = [], [], [], 0
            rows.append(row), offsets.append(at), sizes.append(size)
            total += size
    if rows:
        yield np.array(rows), np.array(offsets), np.array(sizes)


def find_contexts(length: int):
    """(doc, mark, text) to one row per context: doc, mark, gram, context, first (start), starts, place (of the gram)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            for rows, offsets, sizes in text_pieces(texts, length):
                joined = b"".join(texts[r][o:o + s] for r, o, s in zip(rows, offsets, sizes))
                edge = np.cumsum(sizes)
                part = np.repeat(np.arange(len(sizes)), sizes)
                a, b, place, h = contexts_of(np.frombuffer(joined, np.uint8), edge[part], length)
                if not len(a):
                    continue
                said = np.fromiter((xxh3_64_intdigest(joined[i:j]) for i, j in zip(a.tolist(), (b + length).tolist())),
                                   np.uint64, len(a))
                said ^= (place - a).astype(np.uint64) * np.uint64(BASE)
                at = part[a]
                row = pa.array(rows[at])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(row), batch.column(1).take(row), pa.array(h.view(np.int64)),
                    pa.array(said.view(np.int64)), pa.array(a - (edge - sizes)[at] + offsets[at], pa.int64()),
                    pa.array(b - a + 1, pa.int32()), pa.array(place - a, pa.int32())],
                    names=["doc", "mark", "gram", "context", "first", "starts", "place"])

    return run, "doc long, mark long, gram long, context long, first long, starts int, place int"


def cut_texts(length: int):
    """(text, wanted) to (gram, context, starts, place, copies, said), the text of each wanted context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([
                    *(pa.array([w[c] for w in wanted], t) for c, t in
                      (("gram", pa.int64()), ("context", pa.int64()), ("starts", pa.int32()), ("place", pa.int32()),
                       ("copies", pa.int64()))),
                    pa.array([text[w["first"]:w["first"] + w["starts"] - 1 + length] for w in wanted], pa.binary())],
                    names=["gram", "context", "starts", "place", "copies", "said"])

    return run, "gram long, context long, starts int, place int, copies long, said binary"


# ---- difference cover ----------------------------------------------------------------------------------------------

def named(x: np.ndarray) -> np.ndarray:
    """Ranks from 1 in the order of the values, equal values having equal ranks."""
    return np.unique(x, return_inverse=True)[1].astype(np.int64) + 1


def sample_ranks(x: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes at places not divisible by three over at least `depth` symbols, 0 elsewhere.

    x has symbols from 1; suffixes that agree over `depth` symbols have neighbouring ranks.
    """
    n = len(x)
    y = np.concatenate([x, np.zeros(3, np.int64)])
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    at = np.concatenate([one, two])
    top = int(y.max()) + 1
    pair = y[at] * top + y[at + 1]
    if top > 1 << 20:
        pair = named(pair)
    name = named(pair * top + y[at + 2]) if len(at) else np.zeros(0, np.int64)
    if depth > 3 and len(name) and int(name.max()) < len(name):
        # Suffixes of the names: those at 1 mod 3, an end mark, those at 2 mod 3.
        order = all_ranks(np.concatenate([name[:len(one)] + 1, [1], name[len(one):] + 1]), -(-depth // 3))
        name = np.concatenate([order[:len(one)], order[len(one) + 1:]])
    rank = np.zeros(n + 3, np.int64)
    rank[at] = name
    return rank


def all_ranks(x: np.ndarray, depth: int) -> np.ndarray:
    """Ranks from 1 of all suffixes over at least `depth` symbols: samples by recursion, the others merged in."""
    if depth <= 1 or len(x) < 3:
        return named(x) if depth <= 1 else named_suffixes(x)
    n = len(x)
    rank = sample_ranks(x, depth)
    y = np.concatenate([x, np.zeros(3, np.int64)])
    top = int(rank.max()) + 1
    pairs = named(y[:-1] * (int(y.max()) + 1) + y[1:])
    zero, one, two = (np.arange(k, n, 3) for k in range(3))
    by_one = {k: y[i] * top + rank[i + 1] for k, i in ((0, zero), (1, one))}  # a symbol, and a sample behind it
    by_two = {k: pairs[i] * top + rank[i + 2] for k, i in ((0, zero), (2, two))}  # two symbols, and a sample
    ones, twos, zeros1, zeros2 = (np.sort(v) for v in (by_one[1], by_two[2], by_one[0], by_two[0]))
    samples = np.sort(np.concatenate([rank[one], rank[two]]))
    out = np.zeros(n, np.int64)  # how many suffixes are smaller
    out[zero] = (np.searchsorted(zeros1, by_one[0]) + np.searchsorted(ones, by_one[0])
                 + np.searchsorted(twos, by_two[0]))
    out[one] = np.searchsorted(samples, rank[one]) + np.searchsorted(zeros1, by_one[1])
    out[two] = np.searchsorted(samples, rank[two]) + np.searchsorted(zeros2, by_two[2])
    return out + 1


def named_suffixes(x: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes of a string of at most two symbols."""
    tails = [tuple(x[i:].tolist()) for i in range(len(x))]
    return np.array([sorted(set(tails)).index(t) + 1 for t in tails], np.int64)


def same_strings(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int, at_once: int = 20_000) -> np.ndarray:
    """Whether the strings at a and at b are equal."""
    out = np.zeros(len(a), bool)
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    likely = np.flatnonzero((data[a] == data[b]) & (data[a + length - 1] == data[b + length - 1])
                            & (data[a + length // 2] == data[b + length // 2]))
    for i in range(0, len(likely), at_once):
        some = likely[i:i + at_once]
        out[some] = (view[a[some]] == view[b[some]]).all(1)
    return out


def string_names(said: list[bytes], place: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A number for the string at each start of each text; equal strings have equal numbers."""
    sizes = np.fromiter(map(len, said), np.int64, len(said))
    begin = np.zeros(len(said), np.int64)
    at = 0
    for i, n in enumerate(sizes.tolist()):
        at += -(at + int(place[i])) % 3
        begin[i] = at
        at += n
    data = np.zeros(at + length + 3, np.uint8)
    for b, n, s in zip(begin.tolist(), sizes.tolist(), said):
        data[b:b + n] = np.frombuffer(s, np.uint8)
    x = data.astype(np.int64) + 1
    rank = sample_ranks(x, length)
    owner = np.repeat(np.arange(len(said)), starts)
    start = begin[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    names = np.zeros(len(owner), np.int64)
    told = 0
    for k in range(3):
        mine = np.flatnonzero(start % 3 == k)
        if not len(mine):
            continue
        s = start[mine]
        order = rank[s] if k else x[s] * (int(rank.max()) + 1) + rank[s + 1]
        mine = mine[np.argsort(order, kind="stable")]
        equal = same_strings(data, start[mine[:-1]], start[mine[1:]], length)
        names[mine] = told + np.concatenate([[0], np.cumsum(~equal)])
        told = int(names[mine[-1]]) + 1
    return names


# ---- pieces --------------------------------------------------------------------------------------------------------

def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def split_windows(length: int, window: int):
    """Rows of cut_texts to pieces: the starts of a context whose gram lies at a distance of the same window.

    A piece has the hash of its core, the bytes that all strings of the window share, and of its whole text. Equal
    strings have equal cores; equal pieces hold equal strings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for gram, context, starts, place, copies, text in zip(*(c.to_pylist() for c in batch.columns)):
                for q in range((place - starts + 1) // window, place // window + 1):
                    near, far = q * window, q * window + window - 1  # distances from a start to the gram
                    low, high = max(0, place - far), min(starts - 1, place - near)
                    out.append((gram, context, low, high - low + 1, copies,
                                signed(xxh3_64_intdigest(text[place - near:place - far + length], q)),
                                signed(xxh3_64_intdigest(text[low:high + length], place - low))))
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i in (2, 3) else pa.int64()) for i, c in enumerate(columns)],
                names=["gram", "context", "start", "n", "copies", "core", "whole"])

    return run, "gram long, context long, start int, n int, copies long, core long, whole long"


def cut_pieces(length: int):
    """(gram, context, place, said, wanted) to the wanted pieces with their texts and the batch they are dealt to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"core": pa.int64(), "part": pa.int64(), "gram": pa.int64(), "context": pa.int64(), "start": pa.int32(),
                 "n": pa.int32(), "copies": pa.int64(), "place": pa.int32(), "said": pa.binary()}
        for batch in batches:
            out = [(w["core"], w["part"], gram, context, w["start"], w["n"], w["copies"], place - w["start"],
                    text[w["start"]:w["start"] + w["n"] - 1 + length])
                   for gram, context, place, text, wanted in zip(*(c.to_pylist() for c in batch.columns))
                   for w in wanted]
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())],
                                             names=list(kinds))

    return run, ("core long, part long, gram long, context long, start int, n int, copies long, place int, said binary")


def sort_pieces(length: int, batch_bytes: int = 1 << 20):
    """Rows of cut_pieces to one row per start: (gram, context, start, copies, k1, k2).

    Of the starts with the same string in a batch one has the name of the string in k1 and k2 and the copies of all; the
    others are known to repeat and have nulls there. A batch may be cut anywhere, since names agree across batches.
    """

    def judge(rows: pd.DataFrame) -> pa.RecordBatch:
        said, starts = rows["said"].tolist(), rows["n"].to_numpy(np.int64)
        name = string_names(said, rows["place"].to_numpy(np.int64), starts, length)
        owner = np.repeat(np.arange(len(said)), starts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
        _, first, which = np.unique(name, return_index=True, return_inverse=True)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, which, rows["copies"].to_numpy(np.int64)[owner])
        copies = np.zeros(len(owner), np.int64)
        copies[first] = total
        keys = np.frombuffer(b"".join(xxh3_128_digest(said[o][i:i + length]) for o, i in zip(
            owner[first].tolist(), inside[first].tolist())), np.int64).reshape(-1, 2)
        told = copies == 0
        return pa.RecordBatch.from_arrays([
            pa.array(rows["gram"].to_numpy()[owner]), pa.array(rows["context"].to_numpy()[owner]),
            pa.array((rows["start"].to_numpy(np.int64)[owner] + inside).astype(np.int32)), pa.array(copies),
            pa.array(keys[which, 0], mask=told), pa.array(keys[which, 1], mask=told)],
            names=["gram", "context", "start", "copies", "k1", "k2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            rows = batch.to_pandas()
            if not len(rows):
                continue
            held.append(rows)
            size += int(rows["said"].map(len).sum())
            if size >= batch_bytes:
                yield judge(pd.concat(held, ignore_index=True))
                held, size = [], 0
        if held:
            yield judge(pd.concat(held, ignore_index=True))

    return run, "gram long, context long, start int, copies long, k1 long, k2 long"


def repeated_runs(said: DataFrame, length: int, window: int, together: int, folder: str) -> DataFrame:
    """(gram, context, runs) for contexts of the texts in `said`: the runs of starts whose strings repeat."""
    spark = said.sparkSession
    cut, kinds = split_windows(length, window)
    pieces = settle(said.mapInArrow(cut, kinds), folder, "pieces")
    cores = pieces.groupBy("core").agg(
        F.sum("copies").alias("all"), (F.min("whole") != F.max("whole")).alias("mixed")).filter("all > 1")
    shared = settle(pieces.join(cores.select("core", "mixed"), "core"), folder, "shared")
    drop(spark, folder, "pieces")
    run = [F.col("start").alias("a"), (F.col("start") + F.col("n") - 1).alias("b")]
    equal = shared.filter("not mixed").select("gram", "context", *run)

    mixed = shared.filter("mixed")
    wholes = settle(mixed.groupBy("core", "whole").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("gram", "context", "start", "n")).alias("at")), folder, "wholes")
    known = wholes.filter("copies > 1").select("core", "whole")
    equal = equal.unionAll(mixed.join(known, ["core", "whole"]).select("gram", "context", *run))

    # Each different piece once, where its core has several.
    many = wholes.groupBy("core").agg(F.count("*").alias("several"))
    part = F.expr(f"pmod(whole, ceil(several / {together}))").alias("part")
    wanted = wholes.join(many, "core").select("core", part, "copies", "at.*").groupBy("gram", "context").agg(
        F.collect_list(F.struct("core", "part", "start", "n", "copies")).alias("wanted"))
    cut, kinds = cut_pieces(length)
    texts = said.select("gram", "context", "place", "said").join(wanted, ["gram", "context"]).mapInArrow(cut, kinds)
    sort, kinds = sort_pieces(length)
    strings = settle(texts.repartition(width(spark), "core", "part").sortWithinPartitions("core", "part")
                     .mapInArrow(sort, kinds), folder, "strings")
    one = [F.col("start").alias("a"), F.col("start").alias("b")]
    told, named = strings.filter("k1 is null"), strings.filter("k1 is not null")
    twice = named.groupBy("k1", "k2").agg(F.sum("copies").alias("all")).filter("all > 1").select("k1", "k2")
    single = told.select("gram", "context", *one).unionAll(
        named.select("gram", "context", "start", "k1", "k2").join(twice, ["k1", "k2"]).select("gram", "context", *one))
    verdicts = settle(equal.unionAll(single).groupBy("gram", "context").agg(
        F.collect_list(F.struct("a", "b")).alias("runs")), folder, "verdicts")
    for name in ("shared", "wholes", "strings"):
        drop(spark, folder, name)
    return verdicts


# ---- removal -------------------------------------------------------------------------------------------------------

def merged_spans(runs: pa.ListArray, length: int) -> tuple[list[int], list[int], list[int]]:
    """Starts and ends of the spans that runs of starts cover, row by row, and where each row's spans begin.

    All rows are sorted and merged at once: a row's places are moved behind those of the rows before it.
    """
    n = len(runs)
    sizes = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not sizes.sum():
        return [], [], [0] * (n + 1)
    a, b = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in runs.flatten().flatten())
    room = int(b.max()) + length + 1
    base = np.repeat(np.arange(n), sizes) * room
    order = np.argsort(base + a, kind="stable")
    begin, base = (base + a)[order], base[order]
    reach = np.maximum.accumulate(base + b[order] + length)
    first = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    last = np.concatenate([first[1:], [len(begin)]]) - 1
    at = np.searchsorted(base[first], np.arange(n + 1) * room)
    return (begin - base)[first].tolist(), (reach - base)[last].tolist(), at.tolist()


def remove_spans(length: int, with_text: bool):
    """(doc_id, text, starts) to the digest of what is left, starts being runs of places of repeated strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            start, stop, at = merged_spans(batch.column(2), length)
            for text, i, j in zip(batch.column(1).to_pylist(), at[:-1], at[1:]):
                text = text or b""
                left = text
                if i < j:
                    left = b"".join(text[a:b] for a, b in zip([0, *stop[i:j]], [*start[i:j], len(text)]))
                rows.append((len(text), len(text) - len(left), j - i, hashlib.sha256(left).hexdigest(), left))
            columns = [pa.array([r[k] for r in rows], t) for k, t in
                       ((0, pa.int64()), (1, pa.int64()), (2, pa.int64()), (3, pa.string()))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns.append(pa.array([r[4] for r in rows], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return run, kinds + ", kept binary" * with_text


def remove_repeats(docs: DataFrame, length: int = 200, window: int = 16, together: int = 512,
                   with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and the bytes kept if asked for.

    A row is known by its doc_id and a hash of its text; rows equal in both share their result.
    """
    spark = docs.sparkSession
    folder = workspace(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("doc"), F.xxhash64(text).alias("mark"), F.encode(text, "UTF-8").alias("text"))
    find, kinds = find_contexts(length)
    # Hashing every text twice is cheaper than a table of all contexts, which is as large as half the input.
    found = rows.mapInArrow(find, kinds)
    grams = found.groupBy("gram").agg(
        F.count("*").alias("all"), (F.min("context") != F.max("context")).alias("several")).filter("all > 1")
    hits = settle(found.join(grams.select("gram", "several"), "gram"), folder, "hits")

    # The texts of contexts that share their gram with others, each once.
    contexts = hits.filter("several").groupBy("gram", "context").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc", "mark", "first", "starts", "place")).alias("at"))
    known = ["id", "nameless", "mark"]
    ids = [F.coalesce("doc", F.lit(0)).alias("id"), F.col("doc").isNull().alias("nameless"), "mark"]
    wanted = contexts.select("gram", "context", "copies", "at.*").select("*", *ids[:2]).groupBy(*known).agg(
        F.collect_list(F.struct("gram", "context", "first", "starts", "place", "copies")).alias("wanted"))
    # Rows equal in doc_id and text give their contexts once.
    holders = rows.select(*ids, "text").join(wanted, known).groupBy(*known).agg(
        F.first("text").alias("text"), F.first("wanted").alias("wanted"))
    cut, kinds = cut_texts(length)
    said = settle(holders.select("text", "wanted").mapInArrow(cut, kinds), folder, "texts")
    verdicts = repeated_runs(said, length, window, together, folder)
    drop(spark, folder, "texts")

    # Back to all places of each context, and to the documents.
    place = F.col("first")
    spans = hits.filter("several").join(verdicts, ["gram", "context"]).select("doc", "mark", F.transform(
        "runs", lambda r: F.struct((place + r["a"]).alias("a"), (place + r["b"]).alias("b"))).alias("runs"))
    alone = hits.filter("not several").select("doc", "mark", F.array(F.struct(
        place.alias("a"), (place + F.col("starts") - 1).alias("b"))).alias("runs"))
    starts = settle(spans.unionAll(alone).groupBy("doc", "mark").agg(
        F.flatten(F.collect_list("runs")).alias("starts")), folder, "starts")
    same = F.col("r.doc").eqNullSafe(F.col("s.doc")) & (F.col("r.mark") == F.col("s.mark"))
    remove, kinds = remove_spans(length, with_text)
    return rows.alias("r").join(starts.alias("s"), same, "left").select("r.doc", "r.text", "s.starts").mapInArrow(
        remove, kinds)
