"""BPE encoding by forced boundaries, and decoding, equal to the tokenizers library.

A pair of bytes that occurs inside no token of the vocabulary can lie inside no token of
any encoding: between the two there is certainly a cut. Texts are cut there, the fragments
are encoded one by one, and their ids are concatenated. Fragments repeat, so a worker
remembers the ids of short ones, up to a bounded number.

The pattern that splits a text before merging must not see a difference either. So a cut
is made only after a character that is not white space, and not before an apostrophe:
a run of white space then stays with what follows it, and so do the English contractions.
Strings of special tokens are taken out first, as the library does.

Results for odd input: a null or empty text has no ids; rows that repeat an id are encoded
one by one; an empty table gives an empty table. A text is held whole by one task, and
nothing larger than a text's ids.
"""

from __future__ import annotations

import re
from collections import ChainMap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stackroom.llm.common import Remembered, process_cache

REMEMBERED = 150_000
LONGEST_REMEMBERED = 64
ROWS_OUT = 128


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies use for bytes: printable ones stand for
    themselves, the others for the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder for a byte-level vocabulary file."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = byte_alphabet()
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = [b""] * (max(vocabulary.values()) + 1)
        inside = np.zeros((256, 256), bool)
        for token, number in vocabulary.items():
            plain = token.encode() if token in special else bytes(alphabet[c] for c in token)
            self.token_bytes[number] = plain
            if token not in special:
                inside[list(plain[:-1]), list(plain[1:])] = True
        self.special = {s.encode(): np.uint32(i).tobytes() for s, i in special.items()}
        self.at_special = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + b")")
        self.cuts = self._cut_table(inside)
        self.simple = re.compile(rb" ?(?:[!-~]|[\xc3-\xdf][\x80-\xbf])+")
        self.line_end = np.frombuffer(self.tokenizer_ids("\n"), np.uint32)[0]
        self.ids = Remembered(REMEMBERED)

    def tokenizer_ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    @staticmethod
    def _cut_table(inside: np.ndarray) -> np.ndarray:
        """By byte pair: 0 no cut, 1 a cut, 2 a cut if the left character is two bytes long and
        begins with 0xC3 or more (of the two-byte characters, those are no white space)."""
        left, right = np.indices((256, 256))
        starts = ((right & 0xC0) != 0x80) & (right != ord("'"))
        plain = (left > 0x20) & (left < 0x7F)
        allowed = ~inside & starts
        return (allowed & plain).astype(np.uint8).ravel() + 2 * (allowed & (left >= 0x80)).astype(np.uint8).ravel()

    def fragments(self, text: bytes) -> list[bytes]:
        held = np.frombuffer(text, np.uint8)
        if len(held) < 2:
            return [text] if text else []
        kind = self.cuts[(held[:-1].astype(np.uint16) << 8) | held[1:]]
        two = np.flatnonzero(kind == 2)
        lead = held[np.maximum(two - 1, 0)]
        kind[two[(lead < 0xC3) | (lead > 0xDF)]] = 0
        at = (np.flatnonzero(kind) + 1).tolist()
        return [text[i:j] for i, j in zip([0, *at], [*at, len(text)])]

    def _learn(self, unknown: list[bytes]) -> dict[bytes, bytes]:
        """Remember the ids of fragments not met before; the ids of long ones are returned.

        Simple fragments (a space at most, then no white space) are encoded as lines of one
        text, which spares a call for each: a line end is a piece and a token of its own.
        """
        simple = [f for f in unknown if self.simple.fullmatch(f)]
        others = [f for f in unknown if not self.simple.fullmatch(f)]
        lines = self.tokenizer.encode_batch_fast([b"\n".join(simple).decode()], add_special_tokens=False)
        numbers = np.array(lines[0].ids, np.uint32)
        ends = np.flatnonzero(numbers == self.line_end).tolist()
        raw = numbers.tobytes()
        found = {f: raw[4 * i : 4 * j] for f, i, j in zip(simple, [0, *(e + 1 for e in ends)], [*ends, len(numbers)])}
        if others:
            encoded = self.tokenizer.encode_batch_fast([f.decode() for f in others], add_special_tokens=False)
            found.update((f, np.array(e.ids, np.uint32).tobytes()) for f, e in zip(others, encoded))
        self.ids.update((f, i) for f, i in found.items() if len(f) <= LONGEST_REMEMBERED)
        return {f: i for f, i in found.items() if len(f) > LONGEST_REMEMBERED}

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self.at_special.split(t) for t in texts]
        cut = [[self.fragments(p) for p in text[::2]] for text in parts]
        unknown = self.ids.known_of(set().union(*(f for text in cut for f in text)))
        long = self._learn(list(unknown)) if unknown else {}
        known = self.ids if not long else ChainMap(long, self.ids)
        out = []
        for text, fragments in zip(parts, cut):
            ids = [b"".join(map(known.__getitem__, f)) for f in fragments]
            between = [self.special[s] for s in text[1::2]] + [b""]
            out.append(b"".join(x for pair in zip(ids, between) for x in pair))
        return out

    def encode(self, text: bytes) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.token_bytes.__getitem__, numbers)).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    known = process_cache()
    if ("bpe", path) not in known:
        known["bpe", path] = Codec(path)
    return known["bpe", path]


def _whole_text(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of each text as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = codec(path).encode_all
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                ids = pa.array(encode_all(part.column(1).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])
        codec(path).ids.forget()  # the worker may idle or serve other stages from here on

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), _whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (``doc_id, ids``) with the ``text`` that the ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(path).decode
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                texts = pa.array([decode(i.as_py()) for i in part.column(1)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, text string")
