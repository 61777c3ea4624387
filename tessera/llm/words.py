"""Vectorised words of UTF-8 texts: bounds and 64-bit fingerprints of all words of a slice at once.

A word is a maximal run of bytes of one class; ASCII letters are lower-cased first. The fingerprint of a
word is the sum, modulo 2**64, of a pseudo-random value for each byte at each place of the word, mixed with its length: no
structure of a word makes it collide with others, as it would in a polynomial.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BASE = 0xD1342543DE82EF95
_AT_ONCE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit values fixed by the seed."""
    start = (seed * _GOLDEN) & _MASK
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLDEN) + np.uint64(start))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_NEAR = 64  # places of a word whose values are kept in a table

#: Word bytes: all but space and \t..\r.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Word bytes: all but ASCII that is neither letter nor digit.
ALNUM = np.ones(256, bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False


def _value(key: np.ndarray) -> np.ndarray:
    return mix((key.astype(np.uint64) + np.uint64(1)) * np.uint64(_GOLDEN) + np.uint64(_BASE))


_VALUES = _value(np.arange(_NEAR * 256))


def byte_values(text: np.ndarray, place: np.ndarray | int) -> np.ndarray:
    """The values of bytes at places of their words."""
    key = np.asarray(text, np.int64) + np.asarray(place, np.int64) * 256
    out = _VALUES[np.minimum(key, len(_VALUES) - 1)]
    far = np.flatnonzero(key >= len(_VALUES))
    if len(far):
        out[far] = _value(key[far])
    return out


def sealed(sums: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Fingerprints from the sums of the words' values."""
    return mix(sums ^ (np.asarray(lengths).astype(np.uint64) * np.uint64(_GOLDEN)))


@dataclass
class Words:
    """Words of the rows of a slice, in order."""

    text: np.ndarray  # lower-cased bytes
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # word offsets of the rows, one more than rows

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))

    def fingerprints(self) -> np.ndarray:
        return fingerprints(self.text, self.starts, self.ends)


def split(raw: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> Words:
    text = LOWER[raw]
    inside = word_bytes[text]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    row_start, row_end = offsets[:-1][filled], offsets[1:][filled] - 1
    first[row_start] = inside[row_start]
    last[row_end] = inside[row_end]
    starts = np.flatnonzero(first)
    return Words(text, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def fingerprints(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of stretches of a text, some at a time, so that memory goes with the longest."""
    starts, lengths = np.asarray(starts, np.int64), np.asarray(ends, np.int64) - starts
    sums, total = np.zeros(len(starts), np.uint64), np.concatenate([[0], np.cumsum(lengths)])
    at = 0
    while at < len(starts):
        stop = max(int(np.searchsorted(total, total[at] + _AT_ONCE, "right")) - 1, at + 1)
        begin = total[at : stop + 1] - total[at]
        place = np.arange(begin[-1]) - np.repeat(begin[:-1], lengths[at:stop])
        running = np.zeros(int(begin[-1]) + 1, np.uint64)
        np.cumsum(byte_values(text[np.repeat(starts[at:stop], lengths[at:stop]) + place], place), out=running[1:])
        sums[at:stop] = running[begin[1:]] - running[begin[:-1]]
        at = stop
    return sealed(sums, lengths)


def eights(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first eight bytes of stretches of a text as numbers, zeros past their ends."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(starts), np.uint64)
    for at in range(0, len(starts), _AT_ONCE >> 3):
        part = slice(at, at + (_AT_ONCE >> 3))
        out[part] = padded[starts[part][:, None] + np.arange(8)].view("<u8").ravel()
    return out & _FIRST[np.minimum(lengths, 8)]


_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def same_bytes(text: np.ndarray, starts: np.ndarray, length: np.ndarray, others: np.ndarray) -> bool:
    """Whether each stretch has the bytes of the stretch that it is taken for, eight bytes at a time."""
    if not (length == length[others]).all():
        return False
    ends = starts + length
    left = np.arange(len(starts))  # stretches that go on
    done = 0
    while len(left):
        own = eights(text, starts[left] + done, ends[left] - starts[left] - done)
        if done == 0:
            other = own[others]
        else:
            which = others[left]
            other = eights(text, starts[which] + done, ends[which] - starts[which] - done)
        if not (own == other).all():
            return False
        done += 8
        left = left[length[left] > done]
    return True


def fingerprint(words: list[bytes]) -> np.ndarray:
    """Fingerprints of given words, as in a text."""
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    return fingerprints(LOWER[raw], ends - [len(w) for w in words], ends)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the word n-grams of each row and their offsets; a row of fewer words has one, of all its words.

    They are neither sorted nor distinct.
    """
    prints = words.fingerprints()
    counts = np.diff(words.offsets)
    short = (counts > 0) & (counts < size)
    n = np.where(short, 1, np.maximum(counts - size + 1, 0))
    offsets = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(n)), n)
    at = words.offsets[:-1][row] + (np.arange(offsets[-1]) - offsets[:-1][row])
    length = np.minimum(counts[row], size)
    out = length.astype(np.uint64)
    for k in range(size):
        have = length > k
        value = prints[np.minimum(at + k, max(len(prints) - 1, 0))] if len(prints) else np.zeros(len(at), np.uint64)
        out = np.where(have, mix(out * np.uint64(_GOLDEN) + value), out)
    return out, offsets
