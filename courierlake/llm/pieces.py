"""Operator 11: sentencepiece ids with the bytes of the source text that every piece stands for, and back to text.

The text is normalised here, by the rules in the model file: at each place the longest prefix that the compiled
character map knows is replaced, spaces become U+2581, a leading one is added. Every byte of the result keeps the
begin and end of the source bytes it came from; a byte that no rule touched keeps its own. The sentencepiece library
then merges pieces of the normalised text, by a copy of the model that normalises nothing, and the place of a piece in
the normalised text gives its source bytes. The ids are those of the library on the raw text.

Where no piece of the vocabulary has U+2581 behind another character, nothing is merged across the begin of a word;
the words of a slice of texts are then encoded once each and laid out with numpy. Other models encode whole texts.

Defined results: null and empty text have no pieces and decode to empty text; repeated rows are kept; a null doc_id
stays null; an empty table gives no rows; other columns are ignored. Models whose spaces come behind the word are refused.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .tokens import gather, slices

SPACE = "▁"
WORD_STARTS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
REMEMBERED = 300_000


# ---- model file ----------------------------------------------------------------------------------------------------

def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """(number, value, the field as it stands) of a protocol buffer message."""
    at = 0
    while at < len(data):
        begin = at
        tag, at = varint(data, at)
        if tag & 7 == 0:
            value, at = varint(data, at)
        else:
            size, at = varint(data, at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value, data[begin:at]


# ---- normalisation -------------------------------------------------------------------------------------------------

def character_map(blob: bytes) -> dict[bytes, bytes]:
    """The rules of a compiled character map: a double-array trie of sources over offsets of their replacements.

    A unit holds its label in the low byte, whether a leaf follows in bit 8, and the offset of its children from bit
    10 on, scaled by bit 9; a leaf holds the place of the replacement in the strings behind the trie.
    """
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units, strings = np.frombuffer(blob[4:4 + size], "<u4").astype(np.int64), blob[4 + size:]

    def children(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 512) >> 6)

    rules, labels = {}, np.arange(1, 256)
    nodes, keys = children(units[:1]), [b""]
    while len(nodes):
        at = nodes[:, None] ^ labels
        unit = units[np.minimum(at, len(units) - 1)]
        row, column = np.nonzero((unit & ((1 << 31) | 255) == labels) & (at < len(units)))
        keys = [keys[r] + bytes([labels[c]]) for r, c in zip(row.tolist(), column.tolist())]
        unit = unit[row, column]
        nodes = at[row, column] ^ children(unit)
        for i in np.flatnonzero(unit >> 8 & 1).tolist():
            begin = int(units[nodes[i]]) & ((1 << 31) - 1)
            rules[keys[i]] = strings[begin:strings.index(0, begin)]
    return rules


class Normalizer:
    """text -> (normalised text, begin and end of the source bytes of each of its bytes)."""

    def __init__(self, spec: bytes, kept: tuple[str, ...] = ()):
        given = {number: value for number, value, _ in fields(spec)}
        self.lead, self.trim, self.escape = (bool(given.get(n, 1)) for n in (3, 4, 5))
        self.rules = {k.decode(): v.decode() for k, v in character_map(given.get(2, b"")).items()}
        self.rules |= {k: k for k in kept}
        self.identity = not self.rules and not self.trim and self.escape
        self.longest: dict[str, int] = {}
        for key in self.rules:
            self.longest[key[0]] = max(self.longest.get(key[0], 0), len(key))

    def parts(self, text: str) -> Iterator[tuple[str, int]]:
        """(replacement, source characters) by the longest rule at each place."""
        at, rules, longest = 0, self.rules, self.longest
        while at < len(text):
            for n in range(longest.get(text[at], 0), 0, -1):
                made = rules.get(text[at:at + n])
                if made is not None:
                    yield made, n
                    at += n
                    break
            else:
                yield text[at], 1
                at += 1

    def __call__(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        made: list[str] = []
        begins: list[int] = []
        ends: list[int] = []
        at, taken, gap = 0, 0, self.trim  # gap: whether spaces here are dropped
        space = SPACE if self.escape else " "
        for put, n in self.parts(text):
            width = len(text[taken:taken + n].encode())
            own = put == text[taken:taken + n]
            taken += n
            if gap:
                put = put.lstrip(" ")
            if put:
                if not made and self.lead:
                    made.append(space)
                    begins += [at] * len(space.encode())
                    ends += [at] * len(space.encode())
                gap = self.trim and put.endswith(" ")
                made.append(put.replace(" ", space))
                size = len(made[-1].encode())
                if own and size == width:
                    begins += range(at, at + width)
                    ends += range(at + 1, at + width + 1)
                else:
                    begins += [at] * size
                    ends += [at + width] * size
            at += width
        whole = "".join(made)
        if self.trim:
            whole = whole.rstrip(space)
        size = len(whole.encode())
        return whole, np.array(begins[:size], np.int64), np.array(ends[:size], np.int64)

    def identical(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The same for many texts at once where only spaces change; their arrays one after another."""
        lead = SPACE if self.lead else ""
        whole = [lead + t.replace(" ", SPACE) if t else "" for t in texts]
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        sizes = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int64, len(texts))
        first = np.cumsum(sizes) - sizes
        local = np.arange(len(raw)) - np.repeat(first, sizes)
        many = np.where(raw == 32, 3, 1)
        begin, end = np.repeat(local, many), np.repeat(local + 1, many)
        if self.lead:
            edges = np.concatenate([[0], np.cumsum(many)])[first[sizes > 0]]
            at = np.repeat(edges, 3)
            begin, end = np.insert(begin, at, 0), np.insert(end, at, 0)
        return whole, begin, end


# ---- encoding and decoding -----------------------------------------------------------------------------------------

class PieceEncoder:
    """ids and source spans of texts; `remembered` bounds the words kept between slices."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as file:
            data = file.read()
        top = list(fields(data))
        trainer = {n: v for n, v, _ in fields(b"".join(v for number, v, _ in top if number == 2))}
        if trainer.get(24):
            raise ValueError("models that put spaces behind words are not supported")
        self.library = SentencePieceProcessor(model_proto=data)
        # Fields 3 and 4 hold the normaliser and samples of its work; this copy takes normalised text as it is.
        plain = b"".join(raw for number, _, raw in top if number not in (3, 4)) + b"\x1a\x04\x18\x00\x20\x00"
        self.merger = SentencePieceProcessor(model_proto=plain)
        kinds = [{n: v for n, v, _ in fields(v)}.get(3, 1) for number, v, _ in top if number == 1]
        pieces = [self.library.id_to_piece(i) for i in range(len(kinds))]
        kept = tuple(p for p, kind in zip(pieces, kinds) if kind == 4)
        spec = b"".join(v for number, v, _ in top if number == 3)
        self.normalizer = Normalizer(spec, kept)
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.unknown = self.library.unk_id()
        self.sizes = np.array([1 if kind == 6 else len(p.encode()) for p, kind in zip(pieces, kinds)], np.int64)
        # What a piece decodes to; only where nothing but the leading space needs care.
        self.simple = self.normalizer.lead and not self.normalizer.trim and not any(n == 5 for n, _, _ in top)
        spelled = [bytes([int(p[3:5], 16)]) if kind == 6 else b"" if kind == 3 else p.replace(SPACE, " ").encode()
                   for p, kind in zip(pieces, kinds)]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_sizes = np.array([len(s) for s in spelled], np.int64)
        self.spelled_starts = np.cumsum(self.spelled_sizes) - self.spelled_sizes
        self.remembered = remembered
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.widths, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, new: list[str]) -> None:
        found = self.merger.encode(new)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum()))
        widths = self.sizes[flat]
        if (flat == self.unknown).any():  # an unknown piece is as long as its surface
            widths = np.array([1 if self.merger.is_byte(i) else len(p.encode()) for ids, word in zip(found, new)
                               for i, p in zip(ids, self.merger.encode_as_pieces(word))], np.int64)
        first = len(self.lengths)
        self.known.update(zip(new, range(first, first + len(new))))
        at = len(self.flat)
        self.flat = np.concatenate([self.flat, flat])
        self.widths = np.concatenate([self.widths, widths])
        self.starts = np.concatenate([self.starts, at + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids, begins and ends of all pieces, and where those of each text start (one more than texts)."""
        if self.normalizer.identity:
            whole, begin, end = self.normalizer.identical(texts)
        else:
            made = [self.normalizer(t) for t in texts]
            whole = [m[0] for m in made]
            begin, end = (np.concatenate([np.zeros(0, np.int64), *(m[n] for m in made)]) for n in (1, 2))
        if len(self.known) > self.remembered:
            self._clear()
        said = [WORD_STARTS.findall(t) if self.by_word else [t] if t else [] for t in whole]
        words = [w for row in said for w in row]
        new = list({w: None for w in words if w not in self.known})
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        lengths = self.lengths[number]
        ids, widths = (gather(a, self.starts[number], lengths) for a in (self.flat, self.widths))
        edges = np.concatenate([[0], np.cumsum(lengths)])
        cuts = edges[np.concatenate([[0], np.cumsum(np.fromiter(map(len, said), np.int64, len(said)))])]
        last = np.cumsum(widths)
        if not len(ids):
            return ids, np.zeros(0, np.int64), np.zeros(0, np.int64), cuts
        return ids, begin[last - widths], end[last - 1], cuts

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> list[str]:
        """The text of each run of ids, as the library decodes it."""
        if not self.simple or (ids == self.unknown).any():
            return [self.library.decode(ids[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:])]
        sizes = self.spelled_sizes[ids]
        data = gather(self.spelled, self.spelled_starts[ids], sizes).tobytes()
        edges = np.concatenate([[0], np.cumsum(sizes)])[cuts].tolist()
        out = []
        for n, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            try:
                text = data[a:b].decode()
            except UnicodeDecodeError:
                out.append(self.library.decode(ids[cuts[n]:cuts[n + 1]].tolist()))
                continue
            out.append(text[1:] if text.startswith(" ") else text)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One per worker process and model file."""
    return PieceEncoder(path)


def lists(cuts: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    edges = pa.array(cuts.astype(np.int32))
    return [pa.ListArray.from_arrays(edges, pa.array(v.astype(np.int32))) for v in values]


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, begins, ends: every document's ids, and the bytes [begin, end) of its text behind each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            for first, rows in slices(batch.column(1)):
                part = batch.slice(first, rows)
                ids, begins, ends, cuts = enc.encode(pc.fill_null(part.column(1), "").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *lists(cuts, ids, begins, ends)],
                                                 names=["doc_id", "ids", "begins", "ends"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, begins array<int>, "
                                                         "ends array<int>")


def flat_ids(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    cuts = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), cuts - cuts[0]


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text from (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = encoder(model).decode(*flat_ids(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def piece_digests(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and spans_crc32 (begins, then ends) from `encode_pieces`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        decimal = [str(i) for i in range(len(enc.sizes))]
        for batch in batches:
            ids, cuts = flat_ids(batch.column(1))
            begins, ends = (flat_ids(batch.column(c))[0].astype("<u4") for c in (2, 3))
            text = [hashlib.sha256(t.encode()).hexdigest() for t in enc.decode(ids, cuts)]
            runs = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
            named = [hashlib.sha256(",".join(map(decimal.__getitem__, ids[a:b].tolist())).encode()).hexdigest()
                     for a, b in runs]
            spans = [zlib.crc32(ends[a:b], zlib.crc32(begins[a:b])) for a, b in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(cuts)), pa.array(named, pa.string()), pa.array(text, pa.string()),
                 pa.array(spans, pa.int64())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"])

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, "
                                   "spans_crc32 long")
