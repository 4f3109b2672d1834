"""Token ids of whole texts with a `tokenizers` file, remembering the ids of words already met.

The vocabulary file drops white space and never lets a token cross it, so a text's ids are the ids of its
runs of characters between ASCII white space, one after another. Words repeat, so each task encodes the
distinct words of a slice of texts once and lays the ids out with numpy.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]"
MARKS = r"[!-/:-@\[-`{-~]"
SHAPE = f"^(?P<core>{LETTERS}+)(?P<tail>{MARKS}*)$"
PROBES = ["Tion", "forthe", "über", "ÉLÈVE", "niño", "zzxqv", "straße", "Þórr", "àéîõü"]
TAILS = [".", ",", "'", "-", "!?", "$$$", '.")', "_|>"]


class WordEncoder:
    """ids(texts) gives the ids of all texts in one array, and where each text's ids begin in it.

    A word of Latin letters with any number of ASCII marks behind it has the ids of its letters, lower-cased and given
    to the tokenizer's model directly, and those of its marks; every other word goes through the whole tokenizer.
    What is kept is therefore the ids of lower-case letters and of other words. `remembered` bounds those kept between
    slices; beyond it those met in one slice only are forgotten.
    """

    def __init__(self, path: str, remembered: int = 300_000):
        from tokenizers import Tokenizer, pre_tokenizers

        # A task has one core: threads of its own would only bring a heap each, in every worker of an executor.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The letter that the model has for a byte, for all bytes of lower-case Latin letters and what parts words.
        self.table = {b: ord(m) for c in map(chr, [0x0A, *range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)])
                      for b, m in zip(c.encode(), letters.pre_tokenize_str(c)[0][0] if c > "\n" else c)}
        self.remembered = remembered
        added = pa.array([t.content for t in self.tokenizer.get_added_tokens_decoder().values()], pa.string())
        self.plain = self._model([w.lower() for w in PROBES]) == self._whole(PROBES)
        self.plain &= self._whole([f"ab{t}" for t in TAILS]) == [self._whole(["ab"])[0] + t for t in self._whole(TAILS)]
        # Added tokens are looked for in the raw text: none may stand inside such a word.
        self.plain &= not pc.any(pc.match_substring_regex(added, f"^{LETTERS}*{MARKS}*$")).as_py()
        self._keep(pa.array([], pa.large_string()), np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _whole(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _model(self, words: list[str]) -> list[list[int]]:
        """Words of lower-case Latin letters; all are put into the model's letters for bytes at once."""
        tokenize = self.tokenizer.model.tokenize
        listed = "\n".join(words).encode().decode("latin-1").translate(self.table).split("\n") if words else []
        return [[t.id for t in tokenize(w)] for w in listed]

    def _keep(self, words: pa.Array, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.words, self.flat, self.lengths = words, flat, lengths
        self.starts = np.cumsum(lengths) - lengths
        self.hits = np.zeros(len(lengths), np.int32)

    def _forget(self) -> None:
        kept = np.flatnonzero(self.hits > 1)
        if len(kept) > self.remembered // 2:
            kept = np.sort(kept[np.argsort(-self.hits[kept], kind="stable")[: self.remembered // 2]])
        self._keep(self.words.take(pa.array(kept)), gather(self.flat, self.starts[kept], self.lengths[kept]),
                   self.lengths[kept])

    def _numbers(self, words: pa.Array, plain: np.ndarray) -> np.ndarray:
        """The places among the words kept of distinct words, of which the `plain` ones are lower-case letters."""
        found = pc.index_in(words, value_set=self.words)
        missing = found.is_null().to_numpy(zero_copy_only=False)
        numbers = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if missing.any():
            letters, others = np.flatnonzero(missing & plain), np.flatnonzero(missing & ~plain)
            encoded = self._model(words.take(pa.array(letters)).to_pylist())
            encoded += self._whole(words.take(pa.array(others)).to_pylist())
            new = np.concatenate([letters, others])
            numbers[new] = np.arange(len(self.lengths), len(self.lengths) + len(new))
            flat, lengths = joined(encoded)
            self.words = pa.concat_arrays([self.words, words.take(pa.array(new))])
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.flat = np.concatenate([self.flat, flat])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.hits = np.concatenate([self.hits, np.zeros(len(new), np.int32)])
        self.hits[numbers] += 1
        return numbers

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words in one array, and how many each has."""
        if not self.plain:
            number = self._numbers(words, np.zeros(len(words), bool))
            return gather(self.flat, self.starts[number], self.lengths[number]), self.lengths[number]
        core, tail = pc.extract_regex(words, SHAPE).flatten()
        coded = pc.coalesce(pc.utf8_lower(core), words).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        plain = np.zeros(len(coded.dictionary), bool)
        plain[code] = core.is_valid().to_numpy(zero_copy_only=False)
        number = self._numbers(coded.dictionary, plain)[code]
        marks = pc.fill_null(tail, "").dictionary_encode()
        flat, lengths = joined(self._whole(marks.dictionary.to_pylist()))
        mark = marks.indices.to_numpy(zero_copy_only=False)
        starts = np.column_stack([self.starts[number], (len(self.flat) + np.cumsum(lengths) - lengths)[mark]])
        lengths = np.column_stack([self.lengths[number], lengths[mark]])
        return gather(np.concatenate([self.flat, flat]), starts.ravel(), lengths.ravel()), lengths.sum(axis=1)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        if len(self.words) > self.remembered:
            self._forget()
        flat, lengths = self._distinct(coded.dictionary.cast(pa.large_string()))
        code = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths[code])])
        edges = words.offsets.to_numpy().astype(np.int64)
        return gather(flat, (np.cumsum(lengths) - lengths)[code], lengths[code]), ends[edges - edges[0]]


def joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in one array, and how many each list has."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum())), lengths


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[0]:starts[0]+lengths[0]], flat[starts[1]:...], ... as one array."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, flat.dtype)
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    at += np.arange(total)
    return flat[at]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One per worker process and vocabulary file."""
    return WordEncoder(path)


def slices(texts: pa.Array, most_bytes: int = 4 << 20):
    """(first row, rows) of pieces of about `most_bytes` of text, so a batch of long texts stays small in memory."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // most_bytes
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield int(a), int(b - a)
