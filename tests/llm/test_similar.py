"""Near copies of the pipeline against all pairs of shingle sets."""

import corpus_pipeline
import numpy as np
import plain

from courierlake.llm import near


def sets_of(text, shingle=5):
    said = plain.WORD.findall((text or "").lower())
    return {" ".join(said[i:i + shingle]) for i in range(max(1, len(said) - shingle + 1))} if said else set()


def firsts(rows, least=0.8):
    sets = [sets_of(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]
    return {rows[i][0] for i, root in enumerate(plain.roots(len(rows), links)) if i == root}


def edited(seed, groups, copies, length=100):
    """Texts of `length` words, each with copies that have one or two words changed."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        text = [f"w{n}" for n in rng.integers(0, 5000, length)]
        rows.append((len(rows), " ".join(text)))
        for c in range(copies):
            copy = list(text)
            for at in rng.choice(length, 1 + c % 2, replace=False):
                copy[at] = "changed"
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_copies_with_changed_words_go(spark, texts):
    rows = edited(3, 12, 12) + [(900, None), (901, ""), (902, "One two"), (903, "one  TWO")]
    docs = texts([(i, t, "en", "s", 0) for i, t in rows], ", lang string, source string, n_chars long")
    got = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert got == firsts(rows) and len(got) < 30


def test_documents_against_all_pairs(texts, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = {r["node"]: r["root"] for r in near.near_copies(texts(rows)).collect()}
    assert {i for i, _ in rows if found.get(i, i) == i} == firsts(sorted(rows))


def test_repeated_and_missing_ids_stay_once(texts, odd):
    ids = [r["doc_id"] for r in near.keep_first_similar(texts(odd)).collect()]
    assert len(ids) == len(set(ids)) and {1, 10, None} <= set(ids) and not {2, 3, 11} & set(ids)
    assert near.keep_first_similar(texts([])).count() == 0


def test_repeated_ids_keep_their_texts_and_choose_alike(spark):
    rows = [(1, "one text of its own", "x"), (1, "another text entirely", "x"), (2, "said twice", "b"), (2, "said twice", "a"),
            (2, "said twice", None), (None, "said twice", "c"), (None, "said twice", "c")]
    kept = set()
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, `a.b` string").repartition(3)
        got = near.keep_first_similar(docs)
        assert got.columns == docs.columns
        got = [tuple(r) for r in got.collect()]
        assert len(got) == 5 and {g[:2] for g in got} == {r[:2] for r in rows}
        kept.add(tuple(sorted(map(str, got))))
    assert len(kept) == 1


def test_pairs_at_the_limit_share_a_key():
    rng = np.random.default_rng(5)
    met = 0
    for _ in range(400):
        both = rng.integers(0, 2**63, 100).astype(np.uint64)
        a, b = np.sort(both[:90]), np.sort(both[10:])  # 80 of 100
        keys = near.minhash_keys([a, b])
        met += bool((keys[0] == keys[1]).any())
    assert met == 400


def test_chains_beyond_the_first_document(spark, texts, monkeypatch):
    """Copies of copies: many are too far from the smallest document and only link to one another."""
    rng = np.random.default_rng(9)
    rows = []
    for _ in range(4):
        text = [f"w{n}" for n in rng.integers(0, 5000, 100)]
        for step in range(40):
            text = list(text)
            text[int(rng.integers(0, 100))] = f"v{step}"
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    monkeypatch.setattr(near, "BLOCK", 7)
    found = {r["node"]: r["root"] for r in near.near_copies(texts([(int(i), t) for i, t in rows])).collect()}
    assert {int(i) for i, _ in rows if found.get(int(i), int(i)) == int(i)} == firsts(sorted((int(i), t) for i, t in rows))
