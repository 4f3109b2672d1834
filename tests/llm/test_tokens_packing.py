import os
import random
from collections import Counter

import numpy as np
import pandas as pd
import plain
import pyarrow as pa
import pytest

from courierlake.llm import packing, queries, token_files, tokens
from courierlake.llm.common import running_totals, workspace


def same(df, want, key):
    got = df.toPandas()[list(want.columns)]
    order = lambda x: x.astype(object).where(x.notna(), None).astype(str).sort_values(list(want.columns)).to_numpy().tolist()
    assert order(got) == order(want), key



def test_word_encoder_equals_the_tokenizer(tokenizer, odd, documents):
    texts = [t for _, t in odd] + [r["text"] for r in documents.collect()]
    enc = tokens.WordEncoder(queries.vocabulary(), remembered=500)  # so small that words are forgotten in between
    for _ in range(2):
        for at in range(0, len(texts), 40):
            part = texts[at:at + 40]
            flat, starts = enc.ids(pa.array(part, pa.string()))
            for i, t in enumerate(part):
                assert flat[starts[i]:starts[i + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_letters_are_encoded_once_whatever_their_case_and_marks(monkeypatch, tokenizer):
    cores = ["one", "naïve", "straße", "zzxqv"]
    forms = [c.upper().replace("SS", "ß") + m for c in cores for m in ("", ".", ",", "!?", "$$$", "'", '.")')]
    forms += [c + m for c in cores for m in ("", "***", "-", "|>")]
    enc = tokens.WordEncoder(queries.vocabulary())
    asked = []

    def told(method):
        def call(words):
            asked.extend([words] if isinstance(words, str) else words)
            return method(words)
        return call

    monkeypatch.setattr(enc, "_model", told(enc._model))
    monkeypatch.setattr(enc, "_whole", told(enc._whole))
    for part in (forms[:20], forms[20:], forms):
        text = " ".join(part)
        assert enc.ids(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(w for w in asked if any(c.isalpha() for c in w)) == sorted(cores)


def test_marks_that_belong_to_a_token_stay_with_their_word(tmp_path, tokenizer):
    from tokenizers import AddedToken, Tokenizer
    marked = Tokenizer.from_str(tokenizer.to_str())
    marked.add_tokens([AddedToken("here!", normalized=False)])
    marked.save(str(tmp_path / "marked.json"))
    text = "here here! There! it's <|endoftext|> end<|endoftext|>! |>"
    want = marked.encode(text, add_special_tokens=False).ids
    assert want != tokenizer.encode(text, add_special_tokens=False).ids
    assert tokens.WordEncoder(str(tmp_path / "marked.json")).ids(pa.array([text]))[0].tolist() == want


def test_slices_cover_all_rows():
    texts = pa.array(["a" * n for n in (0, 5, 9, 100, 1, 1, 0)] + [None])
    parts = list(tokens.slices(texts, 10))
    assert [i for a, n in parts for i in range(a, a + n)] == list(range(8)) and len(parts) > 2


def test_token_files_round_trip(spark, texts, tokenizer, odd):
    rows = [r for r in odd if r[0] != 11 and r[0] is not None]
    same(token_files.token_digests(texts(rows), queries.vocabulary()),
         plain.token_digests(pd.DataFrame(rows, columns=["doc_id", "text"]), tokenizer), "digests")


def test_token_files_null_ids_and_repeats(texts, odd):
    got = token_files.token_digests(texts(odd), queries.vocabulary()).toPandas()
    assert len(got) == len(odd) and got.sort_values("start")["doc_id"].isna().iloc[0]
    ends = got.sort_values("start")
    assert (ends["start"].to_numpy()[1:] == (ends["start"] + ends["n_tokens"]).to_numpy()[:-1]).all()


def test_token_files_layout(spark, documents, tokenizer):
    import pyarrow.parquet as pq
    path = f"{workspace(spark)}/files"
    token_files.write_tokens(documents, path, queries.vocabulary(), meta=("lang",))
    files = sorted(f for f in spark.read.parquet(path).inputFiles())
    meta = pq.ParquetFile(files[0].removeprefix("file://"))
    column = {meta.metadata.row_group(0).column(i).path_in_schema: meta.metadata.row_group(0).column(i)
              for i in range(meta.metadata.num_columns)}
    ids = next(c for p, c in column.items() if p.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings and column["doc_id"].has_column_index
    assert "DELTA_BINARY_PACKED" in column["doc_id"].encodings
    some = token_files.read_tokens(spark, path, ("doc_id", "n_tokens"), first=10, last=19)
    assert sorted(r["doc_id"] for r in some.collect()) == list(range(10, 20))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan and "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("maker", [token_files.token_digests, packing.pack])
def test_empty_tables(texts, maker):
    assert maker(texts([]), queries.vocabulary()).count() == 0


def test_pieces_and_sequences(spark, texts, tokenizer, odd, documents):
    rows = [r for r in odd if r[0] not in (11, None)] + [(100 + r["doc_id"], r["text"]) for r in documents.collect()]
    docs, capacity = texts(rows), 512
    got = packing.pack(docs, queries.vocabulary(), capacity)
    same(got.drop("sequence_id", "offset"),
         plain.pieces(pd.DataFrame(rows, columns=["doc_id", "text"]), tokenizer, capacity), "pieces")
    filled = packed_right(got.toPandas(), capacity)
    cut = packing.pieces(docs, queries.vocabulary(), capacity, with_ids=True)
    whole = packing.sequences(got, cut).collect()
    assert {r["sequence_id"]: len(r["ids"]) for r in whole} == filled
    counts = Counter(got.toPandas()["length"].tolist())
    assert len(filled) <= sum(m for _, m in packing.best_fit(counts, capacity))


def packed_right(got, capacity):
    filled = {}
    for seq, part in got.sort_values("offset").groupby("sequence_id"):
        at = 0
        for offset, length in zip(part["offset"], part["length"]):
            assert offset == at
            at += length
        assert at <= capacity
        filled[seq] = at
    return filled


def test_repeated_rows_are_packed_each(texts, odd):
    got = packing.pack(texts(odd), queries.vocabulary()).toPandas()
    packed_right(got, 4096)
    assert (got["doc_id"] == 11).sum() == 2 and got["doc_id"].isna().sum() == 1


def fewest(sizes, capacity):
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= capacity:
                go(i + 1, bins[:j] + [bins[j] + sizes[i]] + bins[j + 1:])
        go(i + 1, bins + [sizes[i]])

    go(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(3)
    for _ in range(250):
        sizes = [rng.randint(1, 12) for _ in range(rng.randint(0, 8))]
        found = packing.bin_completion(dict(Counter(sizes)), 12)
        held = Counter()
        for pattern, many in found:
            assert sum(pattern) <= 12
            for n in pattern:
                held[n] += many
        assert held == Counter(sizes) and sum(m for _, m in found) == fewest(sizes, 12)


def test_thousands_of_equal_short_pieces():
    for counts, capacity, want in (({3: 4096}, 4096, 4), ({2: 100_000}, 4096, 49), ({1: 1, 4096: 3}, 4096, 4),
                                   ({3: 100_000, 5: 7, 1000: 33}, 4096, 82), ({7: 5000, 11: 4999, 13: 3}, 4096, 22)):
        held = Counter()
        found = packing.bin_completion(dict(counts), capacity)
        for pattern, many in found:
            assert sum(pattern) <= capacity
            for n in pattern:
                held[n] += many
        assert held == Counter(counts) and sum(m for _, m in found) == want


def test_completion_is_never_worse_than_best_fit():
    rng = np.random.default_rng(5)
    for size in (50, 400):
        counts = dict(Counter(rng.integers(1, 1000, size).tolist()))
        assert sum(m for _, m in packing.bin_completion(counts, 1000, nodes=500)) <= sum(
            m for _, m in packing.best_fit(counts, 1000))


def test_dominance():
    assert packing.dominates((5, 3), (3, 2, 3)) and not packing.dominates((5, 3), (6,))


def test_running_totals_over_a_hot_key(spark):
    rows = [(k, i, i % 7) for i in range(4000) for k in ([0] if i % 3 else [None])] + [(5, 1, 2)]
    df = spark.createDataFrame(rows, "k int, i long, v long")
    got = running_totals(df, ["k"], ["i"], "v", "before", workspace(spark), "t").toPandas()
    assert len(got) == len(rows)
    for _, part in got.fillna(-1).groupby("k"):
        part = part.sort_values("i")
        assert (part["before"] == part["v"].cumsum() - part["v"]).all()


def test_a_waiting_worker_keeps_little(monkeypatch, documents):
    """No threads beside the task's own, and what Arrow holds of freed memory is given back when a task ends."""
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    tokens.encoder.cache_clear()
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    rows = documents.select("doc_id", "text").limit(20).toArrow()
    cut = packing.cut_rows(queries.vocabulary(), 1, 4096, False)
    monkeypatch.setattr(token_files.pa, "default_memory_pool", lambda: Pool())
    assert sum(b.num_rows for b in cut(iter(rows.to_batches()))) >= 20
    assert released == [True] and os.environ["TOKENIZERS_PARALLELISM"] == "false"
