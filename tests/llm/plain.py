"""Plain single-machine versions of the operators, to hold their results against."""

import re
import zlib

import numpy as np
import pandas as pd
from xxhash import xxh64_intdigest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(n, links):
    """Smallest index reachable from each of n nodes."""
    at = list(range(n))

    def find(i):
        while at[i] != i:
            at[i] = at[at[i]]
            i = at[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    lines = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)][: len(words)]
    votes = [0] * 64
    for line in lines:
        h = xxh64_intdigest(line.encode(), 42)
        for i in range(64):
            votes[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * votes[i] > len(lines))


def near_duplicates(docs, shingle=4, radius=4):
    docs = docs.sort_values("doc_id")
    prints = np.array([simhash(t, shingle) for t in docs["text"]], np.uint64)
    links = [(i, j) for i in range(len(prints))
             for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= radius) if j > i]
    ids = docs["doc_id"].tolist()
    return pd.DataFrame({"doc_id": ids, "fingerprint": [f"{p:016x}" for p in prints.tolist()],
                         "component_id": [ids[r] for r in roots(len(ids), links)]})


def token_digests(docs, tokenizer, end_id=2):
    rows, start = [], 0
    for doc_id, text in docs.sort_values("doc_id")[["doc_id", "text"]].itertuples(index=False):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])


def pieces(docs, tokenizer, capacity=4096, end_id=1):
    rows = []
    for doc_id, text in docs[["doc_id", "text"]].itertuples(index=False):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            rows.append((doc_id, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])


def similar_vectors(vectors, least=0.9):
    """vectors: vec_id, embedding. Links by cosine in double precision, all pairs."""
    vectors = vectors.sort_values("vec_id")
    ids = vectors["vec_id"].tolist()
    rows = [None if e is None or any(x is None for x in e) else np.asarray(e, np.float64) for e in vectors["embedding"]]
    fit = [r is not None and len(r) and np.isfinite(r).all() and np.linalg.norm(r) > 0 for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if fit[i] and fit[j] and len(rows[i]) == len(rows[j])
             and rows[i] @ rows[j] / (np.linalg.norm(rows[i]) * np.linalg.norm(rows[j])) >= least]
    n_links = np.bincount([i for link in links for i in link], minlength=len(ids)) if links else [0] * len(ids)
    return pd.DataFrame({"vec_id": ids, "n_links": [int(n) for n in n_links],
                         "component_id": [ids[r] for r in roots(len(ids), links)]})


def repeats(texts, length=200):
    """(n_bytes, n_removed, n_spans, kept) of each byte string."""
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        left = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), left))
    return out
