"""Near copies of the pipeline: documents whose sets of word shingles have Jaccard similarity 4/5 or more.

Candidates come from MinHash: 32 keys of 5 minima each. Two sets at exactly 4/5 share no key with probability
(1 - 0.8 ** 5) ** 32, about 3 in a million, nearer ones more rarely. Every candidate is checked by its whole sets, so no
link is a guess. First each member of a key meets the key's smallest document, which joins large groups of near copies
in rows linear in their size. Whatever shares a key and is not yet in one component is then compared in full, inside
tasks that hold the sets of a block of documents and give one link where many would say the same.

Links of operator 5 (fingerprints within its radius) count too. Equal sets are one node. Defined results: texts
without words are near copies of one another; a text of fewer words than a shingle is one shingle; case is ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import components, first_of_equals, settle, width, workspace
from .simhash import SEED, near_duplicates
from .tokens import slices

KEYS, MINIMA = 32, 5
BLOCK = 2_000  # documents whose sets one step of a task holds
_random = np.random.default_rng(SEED)
FLIPS = _random.integers(0, 2**64, KEYS * MINIMA, np.uint64)
FACTORS = _random.integers(0, 2**64, KEYS * MINIMA, np.uint64) | np.uint64(1)
SALTS = _random.integers(0, 2**64, KEYS, np.uint64)


def shingle_sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """Per text the sorted hashes of its different word shingles."""
    found = []
    for words in pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))).to_pylist():
        said = [w for w in words if w]
        lines = [" ".join(said[i:i + shingle]) for i in range(len(said) - shingle + 1)] or [" ".join(said)][:len(said)]
        found.append(np.unique(np.array([xxh64_intdigest(x, SEED) for x in lines], np.uint64)))
    return found


def minhash_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One row of keys per set; no set may be empty."""
    if not sets:
        return np.zeros((0, KEYS), np.uint64)
    hashes, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    keys = np.zeros((len(sets), KEYS), np.uint64)
    for n, (flip, factor) in enumerate(zip(FLIPS, FACTORS)):
        least = np.minimum.reduceat((hashes ^ flip) * factor, starts)
        at = n // MINIMA
        mixed = (keys[:, at] ^ least ^ SALTS[at]) * FACTORS[0]
        keys[:, at] = mixed ^ (mixed >> np.uint64(29))
    return keys


def per_slice(docs: DataFrame, columns: list[str], kinds: str, made) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in slices(batch.column(1)):
                part = batch.slice(first, rows)
                yield pa.RecordBatch.from_arrays([part.column(0), *made(part.column(1))], names=["doc_id", *columns])

    return docs.select("doc_id", "text").mapInArrow(run, kinds)


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, a digest of the set, and its keys."""

    def made(texts: pa.Array) -> list[pa.Array]:
        sets = shingle_sets(texts, shingle)
        full = np.array([len(s) > 0 for s in sets])
        keys = minhash_keys([s for s in sets if len(s)])
        edges = np.concatenate([[0], np.cumsum(full * KEYS)]).astype(np.int32)
        return [pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(edges), pa.array(keys.ravel().view(np.int64)))]

    return per_slice(docs, ["same", "keys"], "doc_id long, same binary, keys array<long>", made)


def whole_sets(docs: DataFrame, shingle: int) -> DataFrame:
    def made(texts: pa.Array) -> list[pa.Array]:
        sets = shingle_sets(texts, shingle)
        edges = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(sets).view(np.int64)))]

    return per_slice(docs, ["grams"], "doc_id long, grams array<long>", made)


def similar(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sets have Jaccard similarity of `least` (a fraction) or more."""
    up, down = least
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("x")).hint("merge"), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("y")).hint("merge"), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(shared * (up + down) >= (F.size("x") + F.size("y")) * up).select("a", "b")


def near_copies(docs: DataFrame, shingle: int = 5, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """(node, root) of every document that has a near copy; root is the smallest doc_id that links reach."""
    folder = workspace(docs.sparkSession)
    named = docs.filter("doc_id is not null").select("doc_id", "text")
    prints = settle(near_duplicates(named), folder, "prints")
    signed = settle(signatures(named, shingle), folder, "signatures")
    nodes = settle(signed.groupBy("same").agg(F.min(F.struct("doc_id", "keys")).alias("n")).select("same", "n.*"),
                   folder, "nodes")
    known = prints.filter("doc_id <> component_id").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
    equal = signed.select("same", F.col("doc_id").alias("a")).join(
        nodes.select("same", F.col("doc_id").alias("b")).hint("merge"), "same").filter("a <> b").select("a", "b")
    rows = nodes.select("doc_id", F.explode("keys").alias("key"))
    heads = rows.groupBy("key").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last")).filter("head <> last")
    shared = settle(rows.join(heads.select("key", "head").hint("merge"), "key"), folder, "shared")
    wanted = shared.select("doc_id").distinct().hint("merge")
    sets = settle(whole_sets(named.join(wanted, "doc_id", "left_semi"), shingle).distinct(), folder, "sets")
    stars = shared.filter("doc_id <> head").select(F.col("doc_id").alias("a"), F.col("head").alias("b")).distinct()
    first = settle(known.unionAll(equal).unionAll(similar(stars, sets, least)).distinct(), folder, "first")
    roots = settle(components(first, folder).distinct(), f"{folder}/first", "roots")

    # Members of one key in different components: those outside its largest one are held against that component, and
    # against one another.
    rooted = settle(shared.join(roots.hint("merge"), shared.doc_id == roots.node, "left").select(
        "key", "doc_id", F.coalesce("root", "doc_id").alias("root")), folder, "rooted")
    parts = rooted.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("big"), F.count("*").alias("parts"), F.sum("n").alias("n")).filter("parts > 1")
    few = settle(rooted.join(parts.select("key", F.col("big.root").alias("big"), "parts",
                                          (F.col("n") - F.col("big.n")).alias("n")).hint("merge"), "key")
                 .filter("root <> big"), folder, "few")
    second = settle(asked_of_components(few, rooted, sets, least).unionAll(
        asked_of_one_another(few, sets, least)).distinct(), folder, "second")
    return components(first.unionAll(second).distinct(), f"{folder}/second").distinct()


def asked_of_components(few: DataFrame, rooted: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Links of documents to the largest component of a key they share, one at most per block of its members.

    The members are connected already, so one link is as good as all. A component is dealt in blocks of about BLOCK
    members; who asks goes to every block.
    """
    spark = few.sparkSession
    asks = few.select("doc_id", F.col("big").alias("root")).distinct()
    members = rooted.select("doc_id", "root").distinct()
    blocks = members.join(asks.select("root").distinct().hint("merge"), "root").groupBy("root").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    targets = members.join(blocks.hint("merge"), "root").select(
        "root", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("kind"), "doc_id")
    asking = asks.join(blocks.hint("merge"), "root").select(
        "root", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"), "doc_id")
    rows = targets.unionAll(asking).join(sets.hint("merge"), "doc_id").select("root", "block", "kind", "doc_id", "grams")
    return (rows.repartition(width(spark), "root", "block").sortWithinPartitions("root", "block", "kind")
            .mapInArrow(compare_groups(least, mutual=False), "a long, b long"))


def asked_of_one_another(few: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Links between documents of one key that stand in different smaller components.

    Beyond BLOCK documents a key is dealt in blocks, and every two blocks meet once.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    rows = few.filter("parts > 2").select("key", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
                                          "doc_id", "root")
    rows = rows.select("key", (F.least("own", "other") * F.lit(1 << 15) + F.greatest("own", "other")).alias("block"),
                       F.col("root").alias("kind"), "doc_id").join(sets.hint("merge"), "doc_id")
    return (rows.select("key", "block", "kind", "doc_id", "grams").repartition(width(few.sparkSession), "key", "block")
            .sortWithinPartitions("key", "block").mapInArrow(compare_groups(least, mutual=True), "a long, b long"))


class Postings:
    """Which of some sets hold a hash, to count what another set shares with each of them."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        hashes, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], owners[order]

    def similar(self, one: np.ndarray, least: tuple[int, int]) -> np.ndarray:
        """Whether each set's Jaccard similarity with `one` is `least` or more."""
        up, down = least
        begin, end = np.searchsorted(self.hashes, one, "left"), np.searchsorted(self.hashes, one, "right")
        many = end - begin
        at = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        shared = np.bincount(self.owners[at], minlength=len(self.sizes))
        return shared * (up + down) >= (self.sizes + len(one)) * up


def compare_groups(least: tuple[int, int], mutual: bool):
    """Rows (group, block, kind, doc_id, grams), sorted by group and block, to links (a, b).

    With `mutual`, kind is a component and all documents of a group of different components are compared; else
    those of kind 1 are held against those of kind 0, which come first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, kinds, sets, built = None, [], [], [], None
        found: list[tuple[int, int]] = []

        def close() -> None:
            if not mutual or len(ids) < 2:
                return
            postings, part = Postings(sets), np.array(kinds, np.int64)
            for i in range(len(ids)):
                near = np.flatnonzero(postings.similar(sets[i], least) & (part != part[i]))
                for j in near.tolist():
                    if part[j] != part[i]:
                        found.append((ids[i], ids[j]))
                        part[part == part[j]] = part[i]

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], pa.int64()) for n in (0, 1)],
                                              names=["a", "b"])
            found.clear()
            return made

        for batch in batches:
            heads = zip(*(batch.column(c).to_pylist() for c in range(4)))
            values, cuts = batch.column(4).values.to_numpy(zero_copy_only=False), batch.column(4).offsets.to_numpy()
            for n, (group, block, kind, doc_id) in enumerate(heads):
                if key != (group, block):
                    close()
                    key, ids, kinds, sets, built = (group, block), [], [], [], None
                grams = values[cuts[n]:cuts[n + 1]]
                if mutual or not kind:
                    ids.append(doc_id), kinds.append(kind), sets.append(grams)
                elif ids:
                    built = built or Postings(sets)
                    near = built.similar(grams, least)
                    if near.any():
                        found.append((doc_id, ids[int(np.argmax(near))]))
            if found:
                yield out()
        close()
        if found:
            yield out()

    return run


def keep_first_similar(docs: DataFrame, shingle: int = 5, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """The documents less all but one of each group of near copies: the one with the smallest doc_id.

    A document without doc_id stays. Rows that repeat a doc_id go or stay together; of those with one text too, the
    one of the smallest row hash stays.
    """
    found = settle(near_copies(docs, shingle, least), workspace(docs.sparkSession), "copies")
    gone = found.filter("node <> root").select(F.col("node").alias("doc_id")).distinct().hint("merge")
    kept = docs.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    if docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return kept
    return kept.filter("doc_id is null").unionAll(first_of_equals(kept.filter("doc_id is not null")))
