"""Two-stage suffix sorting and common prefixes, on arrays.

Suffixes that are smaller than their successor (the suffix one further) are
sorted directly, by eight bytes at a time and only while they tie. All others
follow by induction: bucket after bucket of first bytes, in order, each sorted
suffix puts the one before it in the next free place of that one's bucket, if
that one is greater than its successor. A bucket is scanned as a whole, and
then what it put in itself, so a scan costs a few array operations.
"""

from __future__ import annotations

import numpy as np

#: After the end of a text, below every byte: bytes are shifted up by one.
END = 0


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes of ``text`` are smaller than their successor; the last, followed by nothing, is not."""
    n = len(text)
    out = np.zeros(n, bool)
    if n < 2:
        return out
    step = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    # where neighbours are equal, the next pair that differs decides
    where = np.where(step != 0, np.arange(n - 1), n)
    decide = np.minimum.accumulate(where[::-1])[::-1]
    known = decide < n
    out[:-1][known] = step[decide[known]] > 0
    return out


def direct_sort(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` ordered by their first ``depth`` characters, ties by place; ``text`` ends in ``depth`` + 8 END at least."""
    if not len(starts):
        return starts
    padded = text.astype(np.uint8)
    word = np.zeros(len(padded) - 7, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k : k + len(word)].astype(np.uint64)
    order = np.sort(starts)
    order = order[np.argsort(word[order], kind="stable")]
    key = word[order]
    tied = np.zeros(len(order), bool)
    tied[1:] = key[1:] == key[:-1]
    for at in range(8, depth, 8):
        inside = tied.copy()
        inside[:-1] |= tied[1:]
        index = np.flatnonzero(inside)
        if not len(index):
            break
        part = order[index]
        group = np.cumsum(~tied[index])
        key = word[part + at]
        again = np.lexsort((key, group))
        part, key = part[again], key[again]
        order[index] = part
        same = np.zeros(len(part), bool)
        same[1:] = (group[1:] == group[:-1]) & (key[1:] == key[:-1])
        tied[index] = same
    return order


def suffix_array(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The ``wanted`` suffixes (a mask) of ``text`` in the order of their first ``depth`` characters.

    ``text`` has bytes shifted up by one, and ends in ``depth`` + 8 END at
    least. Suffixes whose order the wanted ones' depends on are sorted along.
    """
    n = len(text)
    small = smaller_than_next(text)
    # a wanted suffix that is not directly sorted needs its successors up to one that is, or that starts with END
    direct = small | (text == END)
    stop = np.minimum.accumulate(np.where(direct, np.arange(n), n)[::-1])[::-1]
    reach = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(wanted)
    np.add.at(reach, at, 1)
    np.add.at(reach, np.minimum(stop[at], n - 1) + 1, -1)
    needed = np.cumsum(reach[:-1]) > 0
    induced = needed & ~direct
    sorted_part = direct_sort(text, np.flatnonzero(needed & direct), depth)
    heads = text[sorted_part]
    cuts = np.searchsorted(heads, np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []
    for c in range(257):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        front = []
        while len(wave):
            front.append(wave)
            before = wave[wave > 0] - 1
            wave = before[induced[before] & (text[before] == c)]
        bucket = np.concatenate([*front, sorted_part[cuts[c] : cuts[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before]]
        first = text[before]
        later = first > c
        before, first = before[later], first[later]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        for d in np.unique(first):
            waiting[d].append(before[np.searchsorted(first, d) : np.searchsorted(first, d, "right")])
    result = np.concatenate(out)
    return result[wanted[result]]


def equal_to_previous(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefix of each suffix in ``order`` with the one before it has ``length`` characters at least."""
    same = np.zeros(len(order), bool)
    open_ = np.arange(1, len(order))
    word = np.zeros(len(text) - 7, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | text[k : k + len(word)].astype(np.uint64)
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        open_ = open_[word[order[open_] + at] == word[order[open_ - 1] + at]]
    same[open_] = True
    return same
