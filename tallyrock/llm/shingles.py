"""Sets of word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

SIZE = 5
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


class Powers:
    """Powers of BASE and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = max(count, 1 << 20)
            with np.errstate(over="ignore"):
                steps = np.full(size, BASE, np.uint64)
                back = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
                steps[0] = back[0] = 1
                self.up, self.down = np.cumprod(steps), np.cumprod(back)
        return self.up[:count], self.down[:count]


POWERS = Powers()


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(MIX[0])
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(MIX[1])
    return values ^ (values >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words of each text. Words are [^\\x20\\x09-\\x0D]+."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    white = WHITE[raw]
    before = np.append(True, white[:-1])
    starts = np.flatnonzero(before & ~white)
    ends = np.flatnonzero(white & ~before)  # the text ends in white space
    up, down = POWERS.get(len(raw) + 1)
    # A word's hash is its part of one polynomial over all bytes, moved to the power 0.
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1])])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    counts = np.diff(np.searchsorted(starts, edges))
    return hashes, counts


def shingle_sets(texts: list[str | None], size: int = SIZE) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text, A-Z in lower case.

    A text of fewer words than `size` has one shingle, all of its words; one without words has none.
    """
    with np.errstate(over="ignore"):
        raw = [(t or "").encode("utf-8").lower() for t in texts]
        words, counts = word_hashes(raw)
        rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for k in range(size):
            rolled = rolled * np.uint64(BASE) + words[k : len(words) - size + 1 + k]
        rolled = mixed(rolled)
        found, start = [], 0
        for count in counts.tolist():
            if count >= size:
                own = np.sort(rolled[start : start + count - size + 1])
                found.append(own[np.append(True, own[1:] != own[:-1])])
            elif count:
                value = np.uint64(count)
                for word in words[start : start + count]:
                    value = value * np.uint64(BASE) + word
                found.append(mixed(np.array([value], np.uint64)))
            else:
                found.append(np.zeros(0, np.uint64))
            start += count
    return found
