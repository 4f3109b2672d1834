"""Operator 11 against the sentencepiece library."""

import hashlib

import numpy as np
import pytest

from courierlake.llm import queries
from courierlake.llm.common import ship
from courierlake.llm.pieces import Normalizer, PieceEncoder, decode_pieces, encode_pieces, fields

ODD = ["", " ", "  two  blanks  ", "▁", "a▁ b", "tab\tline\n\r\n", "x\0y", "<s> </s> <unk> <0x41>", "👍🏽 é é ſ",
       "日本語 текст", "﻿mark", "a" * 5000, "ends in blank ", "　wide　"]


@pytest.fixture(scope="module")
def model():
    pytest.importorskip("public_tokenizers")
    return queries.pieces_model()


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def test_ids_spans_and_text_of_odd_texts(model, library):
    enc = PieceEncoder(model, remembered=5)
    for texts in (ODD, ODD[::-1], ["only"], []):
        ids, begins, ends, cuts = enc.encode(texts)
        assert enc.decode(ids, cuts) == [library.decode(library.encode(t)) for t in texts]
        for n, text in enumerate(texts):
            a, b = cuts[n], cuts[n + 1]
            assert ids[a:b].tolist() == library.encode(text)
            if text:
                # spans cover the text without gap, and each is what its piece spells
                assert begins[a] == 0 and ends[b - 1] == len(text.encode())
                assert (begins[a + 1:b] == ends[a:b - 1]).all()
            raw = text.encode()
            for i, begin, end in zip(ids[a + 1:b].tolist(), begins[a + 1:b].tolist(), ends[a + 1:b].tolist()):
                said = raw[begin:end].replace(b" ", "▁".encode())
                assert said == (bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i)
                                else library.id_to_piece(i).encode())


def test_compiled_character_map_against_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    if not hasattr(sentencepiece, "SentencePieceNormalizer"):
        pytest.skip("no normaliser in this version")
    for name in ("nmt_nfkc", "nfkc_cf", "identity"):
        own = sentencepiece.SentencePieceNormalizer(rule_name=name)
        spec = next(v for n, v, _ in fields(own.serialized_model_proto()) if n == 3)
        made = Normalizer(spec)
        for text in [*ODD, "ﬁ ㍿ Å ｶﾞ ²", " 　 lead", "straße İ"]:
            whole, begins, ends = made(text)
            assert whole == own.normalize(text)
            assert len(begins) == len(ends) == len(whole.encode())
            assert (np.diff(begins) >= 0).all() and (begins <= ends).all()
            assert not len(ends) or ends.max() <= len(text.encode())
    whole, begins, ends = Normalizer(next(v for n, v, _ in fields(sentencepiece.SentencePieceNormalizer(
        rule_name="nmt_nfkc").serialized_model_proto()) if n == 3))("a ㍿b")
    at = whole.encode().index("式".encode())
    assert (begins[at], ends[at]) == (2, 5)  # each character of the replacement stands for all bytes of the source


def test_model_that_normalises_encodes_as_the_library(model, tmp_path):
    """The same vocabulary under another normaliser: rules, trimmed spaces, whole texts."""
    import sentencepiece

    spec = next(raw for n, _, raw in fields(
        sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()) if n == 3)
    with open(model, "rb") as file:
        changed = b"".join(raw for n, _, raw in fields(file.read()) if n != 3) + spec
    path = tmp_path / "other.model"
    path.write_bytes(changed)
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    enc = PieceEncoder(str(path))
    texts = [*ODD, "ﬁne ㍿ text"]
    ids, begins, ends, cuts = enc.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [library.encode(t) for t in texts]
    assert enc.decode(ids, cuts) == [library.decode(library.encode(t)) for t in texts]
    assert (begins <= ends).all()


def test_query_against_the_library(spark, small, documents, library):
    got = queries.op11_offset_pieces(spark, small).toPandas().set_index("doc_id").sort_index()
    docs = documents.toPandas().set_index("doc_id").sort_index()
    want = [library.encode(t or "") for t in docs["text"]]
    assert got.index.tolist() == docs.index.tolist()
    assert got["n_tokens"].tolist() == [len(w) for w in want]
    assert got["ids_sha256"].tolist() == [hashlib.sha256(",".join(map(str, w)).encode()).hexdigest() for w in want]
    assert got["decoded_sha256"].tolist() == [hashlib.sha256(library.decode(w).encode()).hexdigest() for w in want]


def test_rows_with_nulls_repeats_and_other_columns(spark, texts, odd, model, library):
    ship(spark)
    docs = texts([(*r, "x") for r in odd], ", ids string")
    encoded = encode_pieces(docs, model)
    rows = encoded.collect()
    assert sorted((r.doc_id or 0, list(r.ids)) for r in rows) == sorted((d or 0, library.encode(t or "")) for d, t in odd)
    decoded = {(r.doc_id, r.text) for r in decode_pieces(encoded, model).collect()}
    assert decoded == {(d, library.decode(library.encode(t or ""))) for d, t in odd}
    assert encode_pieces(docs.limit(0), model).count() == 0
