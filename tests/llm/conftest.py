import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def texts(spark):
    """A table of documents from (doc_id, text, ...) rows."""
    def made(rows, extra=""):
        return spark.createDataFrame(rows, "doc_id long, text string" + extra)
    return made


@pytest.fixture(scope="session")
def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{os.environ.get('TESTDATA', '/root/testdata')}/sf0.001/documents.parquet")


#: Null, empty and blank texts, marks, letters beyond ASCII, ties, a repeated row, a null id.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One two. Three, four five!"), (6, "ÉLÈVE naïve straße Þórr"),
       (7, "it's don't we'll <|endoftext|> x" * 3), (8, "日本語 текст 👍🏽 éa ẖ H̱"), (9, "a" * 5000),
       (10, "same text again " * 40), (11, "same text again " * 40), (11, "same text again " * 40),
       (None, "no id " * 30), (12, "1.2.3.4 5 6 . , ., ,."), (13, " x　y \x1cz\x0b\x0cw")]


@pytest.fixture(scope="session")
def odd():
    return ODD
