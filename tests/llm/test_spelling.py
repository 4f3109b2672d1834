"""Operator 13 against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from courierlake.llm import queries
from courierlake.llm.common import ship
from courierlake.llm.spelling import Tree, letters, variants, vectors, word_counts

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(rows, mistyped=97):
    found = Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % mistyped == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts, times=2):
    by_size = {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    out, form = {}, {}
    for w, n in counts.items():
        found = [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, []) if near(w, v)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * n else None
        out[w] = len(found)
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, out[w], counts.get(form[w])))
    return rows


def rows_of(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_query_against_all_pairs(spark, small, documents):
    want = plain_variants(plain_words(documents.select("doc_id", "text").collect()))
    assert rows_of(queries.op13_spelling_trees(spark, small)) == want
    assert any(r[1] is not None and r[2] != r[1] for r in want)


def test_small_cells_and_many_anagrams(spark):
    """Trees of several levels, and one cell of equal vectors that no split can part."""
    ship(spark)
    rng = random.Random(3)
    words = {"".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 8))): rng.randint(3, 60) for _ in range(900)}
    letters_ = list("abcdefgh")
    for _ in range(250):
        rng.shuffle(letters_)
        words["".join(letters_)] = rng.randint(3, 9)
        words["".join(letters_[:-1])] = rng.randint(3, 90)
    words["x" * 3000] = words["x" * 3001] = 5
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    want = plain_variants(words)
    assert rows_of(variants(table, cell=20, sample_words=300)) == want
    assert rows_of(variants(table, cell=100_000)) == want


def test_range_search_misses_nothing():
    rng = np.random.default_rng(5)
    spelled = rng.choice(np.frombuffer("abcdefgé".encode("latin-1"), np.uint8), (2000, 7))
    points = vectors(spelled)
    tree = Tree(points, 20)
    assert sorted(tree.members.tolist()) == list(range(2000))
    leaf = np.empty(2000, int)
    leaf[tree.members] = np.repeat(np.arange(len(tree.first) - 1), np.diff(tree.first))
    assert (tree.home(points) == leaf).all()
    for radius in (1, 2):
        row, found = tree.within(points[:100], radius)
        reached = set(zip(row.tolist(), found.tolist()))
        assert len(reached) == len(row) < 100 * (len(tree.first) - 1)
        close = np.abs(points[:100, None] - points[None]).sum(axis=2) <= radius
        assert all((i, leaf[j]) in reached for i, j in zip(*np.nonzero(close)))


def test_long_chain_of_forms(spark):
    chain = [("a" * (5 + i), 3 * 2 ** i) for i in range(20)]
    got = rows_of(variants(spark.createDataFrame(chain, "word string, n long")))
    assert {r[2] for r in got} == {"a" * 24} and got == plain_variants(dict(chain))


def test_rows_with_nulls_repeats_and_other_columns(spark, texts, odd):
    ship(spark)
    docs = texts([(*r, 1) for r in odd], ", n int")
    assert {(r.word, r.n) for r in word_counts(docs, mistyped=97).collect()} == set(plain_words(odd).items())
    assert word_counts(docs.limit(0)).count() == 0
    assert variants(word_counts(docs.limit(0))).count() == 0
    assert letters(["àÿabc"], 5).shape == (1, 5)
