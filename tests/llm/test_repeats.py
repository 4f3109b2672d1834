import hashlib

import numpy as np
import plain
import pyarrow as pa
import pytest

from courierlake.llm import suffixes


def test_ranks_order_all_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 70))
        x = rng.integers(1, int(rng.integers(2, 5)), n).astype(np.int64)
        rank = suffixes.all_ranks(x, 200)
        tails = [tuple(x[i:].tolist()) for i in range(n)]
        assert sorted(range(n), key=lambda i: tails[i]) == sorted(range(n), key=lambda i: rank[i])


def checked(df, rows, length, **more):
    got = {r["doc_id"]: r for r in suffixes.remove_repeats(df, length, **more).collect()}
    want = plain.repeats([(t or "").encode() for _, t in rows], length)
    for (doc, _), (n_bytes, removed, spans, left) in zip(rows, want):
        r = got[doc]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            n_bytes, removed, spans, hashlib.sha256(left).hexdigest()), doc


def planted(seed, n):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdeé\n "), rng.integers(2, 9)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(4)]
    out = []
    for i in range(n):
        text = " ".join(word() for _ in range(rng.integers(0, 80)))
        for _ in range(rng.integers(0, 3)):
            p = passages[rng.integers(0, 4)]
            a, b = sorted(rng.integers(0, len(p), 2))
            at = rng.integers(0, len(text) + 1)
            text = text[:at] + p[a:b] + text[at:]
        out.append((i, text))
    return out + [(n, out[3][1]), (n + 1, None), (n + 2, ""), (n + 3, "ab" * 400), (n + 4, "x" * 61), (n + 5, "y" * 60)]


@pytest.mark.parametrize("window, together", [(16, 512), (8, 1), (1, 2)])  # with 1 every batch has its own pieces
def test_against_all_strings(texts, window, together):
    rows = planted(3, 60)
    checked(texts(rows), rows, 60, window=window, together=together)


def test_strings_that_differ_at_their_ends_only(texts):
    passage = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(75))
    rows = [(i, f"{i:03d}" * 9 + passage + f"{i * 7:04d}" * 9) for i in range(300)]
    checked(texts(rows), rows, 60, together=16)


def test_names_are_those_of_equal_strings():
    said = [b"abcabcabcabcabcab", b"xabcabcabcabcabc", b"abcabcabcabx"]
    names = suffixes.string_names(said, np.array([3, 4, 3]), np.array([8, 7, 3]), 10)
    strings = [t[i:i + 10] for t, n in zip(said, (8, 7, 3)) for i in range(n)]
    place = [(i - p) % 3 for p, n in zip((3, 4, 3), (8, 7, 3)) for i in range(n)]
    for a in range(len(names)):
        for b in range(len(names)):
            if place[a] == place[b]:  # the caller's strings that are equal lie alike to their gram
                assert (names[a] == names[b]) == (strings[a] == strings[b])


def test_given_documents(texts, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    checked(texts(rows), rows, 200)


def test_long_texts_are_cut_with_an_overlap(texts, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 700)
    rows = planted(8, 40)
    data = [t.encode() if t else b"" for _, t in rows]
    found = {}
    for part, offsets, sizes in suffixes.text_pieces(data, 60):
        for r, o, s in zip(part, offsets, sizes):
            found.setdefault(r, []).extend(range(o, o + s - 60 + 1))
    for r, t in enumerate(data):
        assert sorted(found.get(r, [])) == list(range(len(t) - 60 + 1))


def test_odd_rows(texts, odd):
    got = suffixes.remove_repeats(texts(odd, ""), with_text=True).collect()
    assert len(got) == len(odd)
    by = {r["doc_id"]: r for r in got}
    assert bytes(by[10]["kept"]) == b"" and by[11]["n_removed"] == by[11]["n_bytes"] and by[1]["n_bytes"] == 0
    assert suffixes.remove_repeats(texts([])).count() == 0


def test_spans_of_a_batch_are_merged_at_once():
    """Row by row as a loop would, for rows without runs, runs that touch, and a batch cut out of another."""
    rng = np.random.default_rng(3)
    rows = [None if i % 7 == 3 else [{"a": int(a), "b": int(a + rng.integers(0, 4))} for a in rng.integers(0, 300, i % 9)]
            for i in range(60)]
    rows += [[{"a": 0, "b": 0}, {"a": 20, "b": 20}, {"a": 41, "b": 41}], []]
    runs = pa.array(rows, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
    for part, some in ((runs, rows), (runs.slice(5, 40), rows[5:45]), (runs.slice(0, 0), [])):
        start, stop, at = suffixes.merged_spans(part, 20)
        for i, row in enumerate(some):
            want = []
            for a, b in sorted((r["a"], r["b"] + 20) for r in row or ()):
                if want and a <= want[-1][1]:
                    want[-1] = want[-1][0], max(b, want[-1][1])
                else:
                    want.append((a, b))
            assert list(zip(start[at[i]:at[i + 1]], stop[at[i]:at[i + 1]])) == want
