"""Operator 12 against a plain search for runs."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from courierlake.llm import queries
from courierlake.llm.common import ship
from courierlake.llm.runs import find_runs, searched
from plain import WORD


def plain_runs(words, least=6, times=4):
    found = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            root, length = words[i:i + q], j - i + q
            if length >= max(least, times * q) and not any(
                    q % r == 0 and root == root[:r] * (q // r) for r in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found)


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def compare(texts, least=6, times=4):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())],
                                       names=["doc_id", "text"])
    total = 0
    for text, row in zip(texts, searched(batch, least, times).to_pylist()):
        words = WORD.findall(text or "")
        want = plain_runs(words, least, times)
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == want
        assert row["n_words"] == len(words) and row["collapsed"] == collapsed(words, want)
        total += len(want)
    return total


def some_text(rng):
    words = []
    for _ in range(rng.randint(0, 6)):
        root = [rng.choice(rng.choice(["ab", "abc", "abcdefgh"])) for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 9, 16, 31]))]
        if rng.random() < 0.3:  # a root that is nearly periodic itself
            root = (root * 6)[:len(root) * 4 + rng.randint(0, 2)] + [rng.choice("abc")]
        length = rng.choice([2 * len(root), 4 * len(root) - 1, 4 * len(root), rng.randint(4, 9) * len(root) + 1])
        words += (root * 10)[:length] + [rng.choice("xyzab") for _ in range(rng.randint(0, 6))]
    return " ".join(words) if rng.random() < 0.9 else None


def test_random_texts():
    rng = random.Random(1)
    assert sum(compare([some_text(rng) for _ in range(rng.randint(1, 8))]) for _ in range(80)) > 1000
    for least, times in ((1, 4), (30, 5), (12, 9)):
        assert compare([some_text(rng) for _ in range(40)], least, times)


def test_nested_periods_and_long_texts():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    inner = ("x " * 9 + "y ") * 7 + "z "
    assert compare([" ".join(b[:377] * 5), inner * 6, "q " * 20_000, "one two three " * 3, "", " \t\n", None])
    assert compare(["a b\x0bc\x1cd " * 9, "é é é é é é", "x" * 100_000])


def test_query_against_plain(spark, small, documents):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, small).collect()}
    planted = 0
    for doc_id, text in documents.select("doc_id", "text").collect():
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        runs = plain_runs(words)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        r = got.pop(doc_id)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), top[0], top[1], top[2])
        assert r.exponent_milli == (1000 * top[1] // top[2] if runs else None)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert not got and planted > 5


def test_rows_with_nulls_repeats_and_other_columns(spark, texts, odd):
    ship(spark)
    docs = texts([(*r, 1) for r in odd], ", runs int")
    rows = find_runs(docs).collect()
    assert sorted((r.doc_id or 0, r.n_words) for r in rows) == sorted((d or 0, len(WORD.findall(t or ""))) for d, t in odd)
    assert {r.collapsed for r in rows if r.doc_id == 11} == {"same text again"}
    assert find_runs(docs.limit(0)).count() == 0
    assert queries.with_planted_runs(docs).count() == len(odd)
    with pytest.raises(ValueError):
        find_runs(docs, times=3)
