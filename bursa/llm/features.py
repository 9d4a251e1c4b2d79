"""Text features for the quality models: byte-class trigrams, hashed n-grams, repetition."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

from bursa.llm.common import BLOCK_BYTES, word_blocks

# Byte classes: letters by case, digits, spaces, line ends, beyond ASCII, then punctuation by use.
_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c", b"\n\r",
           bytes(range(128, 256)), b".", b",", b"!", b"?", b"|", b"#*$%&<>", b"\"'`", b"-_/\\+=~^@:;()[]{}")
N_CLASSES = len(_GROUPS) + 1  # the last one: control bytes
_CLASS = np.full(256, N_CLASSES - 1, np.uint8)
for _k, _group in enumerate(_GROUPS):
    _CLASS[np.frombuffer(_group, np.uint8)] = _k


def byte_blocks(text: bytes, overlap: int) -> Iterator[np.ndarray]:
    """The text's bytes in blocks; each begins ``overlap`` bytes before the last one's end."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data), BLOCK_BYTES):
        yield data[max(0, at - overlap):at + BLOCK_BYTES]


def shape_trigrams(text: bytes) -> np.ndarray:
    """Counts of byte-class trigrams, runs of a class shortened to two."""
    out = np.zeros(N_CLASSES ** 3, np.int64)
    raw = tail = np.empty(0, np.int64)  # the last two classes so far, as they are and with runs shortened
    for block in byte_blocks(text, 0):
        c = np.concatenate((raw, _CLASS[block].astype(np.int64)))
        new = np.ones(len(c), bool)
        new[2:] = (c[2:] != c[1:-1]) | (c[1:-1] != c[:-2])
        short = np.concatenate((tail, c[len(raw):][new[len(raw):]]))
        if len(short) > 2:
            out += np.bincount((short[:-2] * N_CLASSES + short[1:-1]) * N_CLASSES + short[2:], minlength=len(out))
        raw, tail = c[-2:], short[-2:]
    return out


def hashed_ngrams(text: bytes, dims: int) -> np.ndarray:
    """Counts of hashed character trigrams (first half) and of words and word pairs (second)."""
    half = dims // 2
    out = np.zeros(dims, np.float32)
    for block in byte_blocks(text, 2):
        c = block.astype(np.uint32)
        if len(c) > 2:
            h = ((c[:-2] * np.uint32(65536) + c[1:-1] * np.uint32(256) + c[2:]) * np.uint32(2654435761)) >> np.uint32(8)
            out[:half] += np.bincount(h % half, minlength=half)
    last = np.uint32(0)
    for words in word_blocks(text):
        h = np.array(list(map(zlib.crc32, words)), np.uint32)
        pair = (np.append(last, h[:-1]) * np.uint32(31) ^ h) * np.uint32(2654435761) >> np.uint32(7)
        out[half:] += np.bincount(h % half, minlength=half) + np.bincount(pair % half, minlength=half)
        last = h[-1]
    return out


def hashed_terms(text: bytes, dims: int) -> np.ndarray:
    """Counts of hashed character trigrams (first quarter) and of words (the rest), A-Z lower-cased."""
    grams = dims // 4
    out = np.zeros(dims, np.float32)
    text = text.lower()
    for block in byte_blocks(text, 2):
        c = block.astype(np.uint32)
        if len(c) > 2:
            h = ((c[:-2] * np.uint32(65536) + c[1:-1] * np.uint32(256) + c[2:]) * np.uint32(2654435761)) >> np.uint32(8)
            out[:grams] += np.bincount(h % grams, minlength=grams)
    for words in word_blocks(text):
        h = np.array(list(map(zlib.crc32, words)), np.uint32)
        out[grams:] += np.bincount(h % (dims - grams), minlength=dims - grams)
    return out


def word_numbers(text: bytes) -> tuple[np.ndarray, int]:
    """Each word as its number by first use within the text; total bytes of the words."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    parts, size = [], 0
    for words in word_blocks(text):
        parts.append(np.array(list(map(numbers.__getitem__, words)), np.int64))
        size += sum(map(len, words))
    return (np.concatenate(parts) if parts else np.empty(0, np.int64)), size


def repeated_words(ids: np.ndarray, window: int = 5) -> int:
    """Words inside windows that occur twice or more in the text, first ones included.

    Windows are sorted by a hash; where equal hashes hide different words (next to
    never), windows are numbered exactly instead."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    h = ids[:n].astype(np.uint64)
    for k in range(1, window):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n].astype(np.uint64)
    order = np.argsort(h)
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    if not len(same):
        return 0
    one, two = order[same], order[same + 1]
    again = np.zeros(n, bool)
    if all((ids[one + k] == ids[two + k]).all() for k in range(window)):
        again[one] = again[two] = True
    else:
        base, number = int(ids.max()) + 1, ids[:n]
        for k in range(1, window):
            _, number = np.unique(number * base + ids[k:k + n], return_inverse=True)
        again = np.bincount(number)[number] > 1
    cover = np.zeros(len(ids) + 1, np.int64)
    cover[:n] += again
    cover[window:window + n] -= again
    return int((np.cumsum(cover[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines (cut at newlines) with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.split():
            seen.add(line)
    return n
