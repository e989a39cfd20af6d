"""Sets of word shingles as 64-bit hashes, many texts at a time.

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a shingle is WIDTH
consecutive words. All of a batch's bytes are hashed at once: a word's hash is
the sum of a scrambled number for each byte and its place in the word, modulo
2**64, scrambled; a shingle's hash combines those of its words.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
#: Bytes that are hashed at a time (or one text, if longer).
CHUNK = 1 << 18

_U = np.uint64
_SEED = _U(0x2545F4914F6CDD1D)
_MIXERS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD], dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers, one to one."""
    x = (x ^ (x >> _U(30))) * _MIXERS[0]
    x = (x ^ (x >> _U(27))) * _MIXERS[1]
    return x ^ (x >> _U(31))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie in ``data`` (bytes) from ``starts`` to the next: hashes, and where each text's begin."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    low = _LOWER[data]
    space = _SPACE[low]
    first = ~space
    first[1:] &= space[:-1]
    inside = starts[:-1][starts[:-1] < n]
    first[inside] = ~space[inside]
    last = ~space
    last[:-1] &= space[1:]
    ends = inside[inside > 0] - 1
    last[ends] = ~space[ends]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    lengths = end - begin
    at = np.cumsum(lengths) - lengths
    offset = np.arange(lengths.sum(), dtype=np.int64) - np.repeat(at, lengths)
    values = mix((offset.astype(np.uint64) << _U(8) | low[~space]) + _SEED)
    return mix(np.add.reduceat(values, at)), np.searchsorted(begin, starts)


def shingle_sets(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The sorted, distinct shingle hashes of each text; a text of fewer than WIDTH words, but not none, has one."""
    hashes, at = word_hashes(data, starts)
    windows = np.zeros(0, np.uint64)
    if len(hashes) >= WIDTH:
        m = len(hashes) - WIDTH + 1
        windows = np.zeros(m, np.uint64)
        for k in range(WIDTH):
            windows += hashes[k : k + m] * _MIXERS[k]
        windows = mix(windows)
    out = []
    for i in range(len(starts) - 1):
        a, b = at[i], at[i + 1]
        if b - a >= WIDTH:
            own = np.sort(windows[a : b - WIDTH + 1])
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif b > a:
            out.append(mix(np.array([(hashes[a:b] * _MIXERS[: b - a]).sum() + _U(b - a)], np.uint64)))
        else:
            out.append(windows[:0])
    return out


def text_sets(texts) -> list[np.ndarray]:  # noqa: ANN001
    """Shingle sets of an Arrow array of strings; null reads as empty."""
    import pyarrow as pa

    out: list[np.ndarray] = []
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        out += shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j
    return out
