"""Byte-level BPE on the tokenizers library, many texts at a time.

A vocabulary file's content is read once, by the caller's session, and broadcast (its
size is the vocabulary's, not the corpus's). Text is cut before spaces that follow a
non-space: no match of the split pattern crosses such a place, so the parts encode
independently. Arrow finds the distinct parts of a batch; those are looked up in a memo
or merged by the library, and numpy lays their ids out again. The memo is bounded;
beyond the bound, parts are encoded without being remembered.

Added tokens of a file (as ``<|endoftext|>``) are found in the text, as the library does.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from pathlib import Path
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import SparkSession
from tokenizers import Tokenizer
from tokenizers.models import BPE

MEMO = 150_000
LONG = 64  # longer parts are rare and not remembered
BLOCK_BYTES = 1 << 20  # long texts go in blocks of about this size
BATCH_BYTES = 4 << 20  # so much text is encoded at once
_CUT = re.compile(rb"(?<=[\x21-\x7e]) ")


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


_CHARS = byte_chars()
_TO_CHARS = dict(enumerate(_CHARS))
_TO_BYTE = {c: b for b, c in enumerate(_CHARS)}


def spelled(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARS)


def unspelled(token: str) -> bytes:
    return bytes(_TO_BYTE[c] for c in token)


def read_ranks(path: str) -> dict[bytes, int]:
    lines = map(bytes.split, Path(path).read_bytes().splitlines())
    return {base64.b64decode(token): int(rank) for token, rank in filter(None, lines)}


def from_ranks(ranks: dict[bytes, int]) -> str:
    """A rank file's vocabulary as a tokenizers file.

    Any two neighbours whose bytes together are a token may merge, lowest rank first;
    a piece that is itself a token stays whole.
    """
    merges = [(spelled(t[:k]), spelled(t[k:])) for t in sorted(ranks, key=ranks.get) for k in range(1, len(t))
              if t[:k] in ranks and t[k:] in ranks]
    vocab = {spelled(t): r for t, r in ranks.items()}
    return Tokenizer(BPE(vocab=vocab, merges=merges, ignore_merges=True)).to_str()


def _blocks(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > BLOCK_BYTES:
        cut = _CUT.search(text, at + BLOCK_BYTES)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _part_starts(data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where parts begin: at ``firsts``, and at spaces after what surely isn't white space."""
    at = np.flatnonzero(data[1:] == 32) + 1
    last, two, three = data[at - 1], data[at - 2], data[at - 3]
    # The last bytes of U+0085, U+00A0, U+1680, U+2000 to U+206F and U+3000 to U+307F, and of some others.
    doubt = (two == 0xC2) | (((two | 1) == 0x81) | (two == 0x9A)) & (three >= 0xE1) & (three <= 0xE3)
    begins = np.zeros(len(data), bool)
    begins[at[(last > 32) & (last < 127) | (last > 127) & ~doubt]] = True
    begins[firsts] = True
    return np.flatnonzero(begins)


class Codec:
    """Texts to ids (uint32, little-endian as bytes) and back."""

    def __init__(self, content: str, pattern: str, memo: int = MEMO):
        self.memo = memo
        self.model = Tokenizer.from_str(content).model
        self.find = regex.compile(pattern).findall
        held = json.loads(content)
        vocab, added = held["model"]["vocab"], {t["content"]: t["id"] for t in held.get("added_tokens", ())}
        self.table = [b""] * (max([*vocab.values(), *added.values()], default=-1) + 1)
        for token, i in vocab.items():
            if all(c in _TO_BYTE for c in token):
                self.table[i] = unspelled(token)
        for token, i in added.items():
            self.table[i] = token.encode()
        self.sizes = np.array([len(t) for t in self.table], np.int64)
        # An added token is always a part of its own.
        self.parts: dict[bytes, bytes] = {t.encode(): np.array([i], "<u4").tobytes() for t, i in added.items()}
        self.pieces: dict[str, bytes] = {}
        marks = b"|".join(map(re.escape, sorted(self.parts, key=len, reverse=True)))
        self.marks = re.compile(b"(" + marks + b")") if marks else None

    def _piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_TO_CHARS))]
        ids = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= LONG and len(self.pieces) < self.memo:
            self.pieces[piece] = ids
        return ids

    def _found(self, pieces: list[str]) -> list[bytes]:
        get = self.pieces.get
        return [get(p) or self._piece(p) for p in pieces]

    def _merged(self, parts: list[str]) -> list[bytes]:
        """Ids of each part. Parts that a match can't cross the borders of are split together."""
        alone = [not (p.startswith(" ") and not p[-1].isspace()) for p in parts]
        out = [b"".join(self._found(self.find(p))) if a else b"" for p, a in zip(parts, alone)]
        own = np.flatnonzero(~np.array(alone, bool))
        text = "".join([parts[k] for k in own])
        pieces = self.find(text)
        ends = np.cumsum([*map(len, pieces)])
        if len(own) and (not len(ends) or ends[-1] != len(text)):  # a pattern that skips text
            return [b"".join(self._found(self.find(p))) for p in parts]
        ids = self._found(pieces)
        to = np.searchsorted(ends, np.cumsum([len(parts[k]) for k in own])) + 1
        at = 0
        for k, end in zip(own.tolist(), to.tolist()):
            out[k] = ids[at] if end == at + 1 else b"".join(ids[at:end])
            at = end
        return out

    def many(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each part; a part has no place inside where text is cut."""
        out = [*map(self.parts.get, parts)]
        new = [k for k, x in enumerate(out) if x is None]
        for k, ids in zip(new, self._merged([parts[k].decode() for k in new])):
            out[k] = ids
            if len(parts[k]) <= LONG and len(self.parts) < self.memo:
                self.parts[parts[k]] = ids
        return out

    def _batch(self, blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data, sizes = b"".join(blocks), np.array([len(x) for x in blocks])
        if not data:
            return np.zeros(0, "<u4"), np.zeros(len(blocks), np.int64)
        first = np.cumsum(sizes) - sizes
        starts = _part_starts(np.frombuffer(data, np.uint8), first[sizes > 0])
        offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        whole = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        ids, kind = self.many(whole.dictionary.to_pylist()), whole.indices.to_numpy()
        length = np.array([*map(len, ids)]) // 4
        own, begin = length[kind], (np.cumsum(length) - length)[kind]
        ends = np.cumsum(own)
        at = np.arange(ends[-1]) + np.repeat(begin - (ends - own), own)
        before = np.append(0, ends)
        counts = before[np.searchsorted(starts, first + sizes)] - before[np.searchsorted(starts, first)]
        return np.frombuffer(b"".join(ids), "<u4")[at], counts

    def encode_all(self, texts: list[bytes], batch_bytes: int = BATCH_BYTES) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one text after the other, and each text's number of ids."""
        counts, out, owners, blocks, size = np.zeros(len(texts), np.int64), [], [], [], 0

        def flush() -> None:
            nonlocal owners, blocks, size
            ids, n = self._batch(blocks)
            out.append(ids)
            np.add.at(counts, owners, n)
            owners, blocks, size = [], [], 0

        for k, text in enumerate(texts):
            for run in self.marks.split(text) if self.marks and self.marks.search(text) else [text]:
                for block in _blocks(run):
                    owners.append(k)
                    blocks.append(block)
                    size += len(block)
                    if size >= batch_bytes:
                        flush()
        if blocks:
            flush()
        return (np.concatenate(out) if out else np.zeros(0, "<u4")), counts

    def encode_each(self, texts: list[bytes], batch_bytes: int = BATCH_BYTES) -> list[np.ndarray]:
        ids, counts = self.encode_all(texts, batch_bytes)
        return np.split(ids, np.cumsum(counts)[:-1]) if len(texts) else []

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each token's byte end, first character and end character in ``data``.

        A token that holds a part of a character covers that character."""
        ends = np.cumsum(self.sizes[ids])
        char = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1  # of each byte
        starts = ends - self.sizes[ids]
        return ends, char[starts], char[ends - 1] + 1

    def splits(self, ids: np.ndarray, data: bytes) -> int:
        """Tokens that begin inside a character."""
        if data.isascii():
            return 0
        starts = np.cumsum(self.sizes[ids])[:-1]
        return int(((np.frombuffer(data, np.uint8)[starts] & 0xC0) == 0x80).sum())


_CODECS: dict[int, Codec] = {}


class Shared:
    """A codec that each Python worker builds once from the broadcast content."""

    def __init__(self, spark: SparkSession, content: str, pattern: str, memo: int = MEMO):
        self.content, self.pattern, self.memo = spark.sparkContext.broadcast(content), pattern, memo
        self.key = hash((content, pattern, memo))

    def get(self) -> Codec:
        if self.key not in _CODECS:
            _CODECS.clear()
            _CODECS[self.key] = Codec(self.content.value, self.pattern, self.memo)
        return _CODECS[self.key]
