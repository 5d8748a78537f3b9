"""Word shingles of whole texts as 64-bit hashes, in numpy over concatenated bytes.

Words are maximal runs of bytes other than space and 0x09-0x0D after lower-casing A-Z only. A text's set
holds its distinct 5-word shingles; a text of one to four words has its whole sequence as its only shingle;
a text without words (null and empty included) has the empty set.

A word's hash is a sum over its pieces of eight bytes, each mixed twice with its place in between, so that neither
swapped pieces nor regular ones cancel out; it is mixed again with the word's length. (A polynomial modulo 2**64 would
not do: it cannot tell the Thue-Morse word of 1,024 letters from its letter-swapped twin.) Shingle hashes combine word
hashes at fixed odd multipliers and are mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
#: Bytes of text that are hashed in one numpy pass (a longer text makes a pass of its own).
PASS_BYTES = 1 << 21

_rng = np.random.Generator(np.random.PCG64(20240611))
_PLACE = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64)
#: Multiplied by a piece's place in its word.
_STEP = np.uint64(0x9E3779B97F4A7C15)

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser, so that every bit of a hash depends on every bit of the sum."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words data[starts:ends]; at least eight more bytes follow the last one."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    pieces = -(-lengths // 8)
    first = np.cumsum(pieces) - pieces
    place = np.arange(int(pieces.sum())) - np.repeat(first, pieces)
    at = np.repeat(starts, pieces) + 8 * place
    every = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))  # the eight bytes from each byte on
    spare = np.maximum(0, 8 - (np.repeat(ends, pieces) - at)).astype(np.uint64) * np.uint64(8)
    value = (every[at] << spare) >> spare  # bytes after the word's end are the upper ones
    return mix(np.add.reduceat(mix(mix(value) + place.astype(np.uint64) * _STEP), first) + lengths.astype(np.uint64))


def _hash_pass(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join([b"", *texts, b" " * 8]).lower(), dtype=np.uint8)
    word = _IS_WORD[data]
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    words = _word_hashes(data, starts, ends)
    # each text begins one byte after the separator before it
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = 1 + np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    first = np.searchsorted(starts, begins)
    last = np.searchsorted(starts, begins + lengths)
    runs = np.zeros(max(0, len(words) - WORDS + 1), dtype=np.uint64)
    for k in range(WORDS):
        runs += words[k:k + len(runs)] * _PLACE[k]
    runs = mix(runs)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= WORDS:
            s = np.sort(runs[a:b - WORDS + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            out.append(mix((words[a:b] * _PLACE[:b - a]).sum(keepdims=True, dtype=np.uint64) + _SHORT[b - a]))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    batch: list[bytes] = []
    held = 0
    for text in texts:
        raw = b"" if text is None else text.encode("utf-8")
        batch.append(raw)
        held += len(raw)
        if held >= PASS_BYTES:
            yield from _hash_pass(batch)
            batch, held = [], 0
    if batch:
        yield from _hash_pass(batch)
