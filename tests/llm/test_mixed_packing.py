"""The mix of sources decides where documents go in the pipeline's sequences."""

import corpus_pipeline
import numpy as np

from courierlake.llm import mixing, queries


def test_weights_reach_the_sequences(spark, texts, tokenizer, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"{n}" for n in rng.integers(0, 9, 300)), "en", f"src{i // 40}", 0) for i in range(240)]
    docs = texts(rows, ", lang string, source string, n_chars long")
    monkeypatch.setattr(queries, "BLOCK_CHARS", 1000)

    def packed(weights):
        monkeypatch.setattr(queries, "WEIGHTS", weights)
        mixed = corpus_pipeline.source_mix(spark, docs, "")
        return corpus_pipeline.packing(spark, mixed.orderBy("doc_id"), "").toPandas()

    first, last = packed({"src0": 30, "src4": 1}), packed({"src0": 1, "src4": 30})
    for got in (first, last):
        assert sorted(got["doc_id"]) == list(range(240)) and (got.groupby("sequence_id")["length"].sum() <= 4096).all()
        assert sorted(got["sequence_id"].unique()) == list(range(got["sequence_id"].nunique()))
    place = lambda got, source: got.loc[got["doc_id"] // 40 == source, "sequence_id"].mean()
    assert place(first, 0) < place(first, 4) and place(last, 0) > place(last, 4)


def test_every_source_has_a_share(spark, texts):
    rows = [(i, "x" * 50, f"s{i % 5}" if i % 6 else None) for i in range(120)]
    docs = texts(rows, ", source string")
    weights, rest = mixing.own_weights(docs, {"s0": 6, "s1": 3}, 10)
    assert weights == {"s0": 12, "s1": 6, "s2": 5, "s3": 5, "s4": 5} and rest == 5
    got = mixing.mix(docs, weights, rest, 100).toPandas()
    assert got.dropna(subset="source").groupby("source")["stream"].nunique().max() == 1
    assert got["stream"].nunique() == 6
