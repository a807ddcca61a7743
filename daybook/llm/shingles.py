"""Words, word shingles and min-hash signatures of whole texts, on numpy arrays.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r; A-Z are
lower-cased on request, nothing else. A shingle is a run of ``width`` words; a
text with fewer words is one shingle, a text without words has none. Words and
shingles stand for themselves as 64-bit hashes. Many texts are hashed at once:
every byte position gets a running polynomial hash, and a word's hash is the
difference at its ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes of text hashed at once; bounds the arrays to some MB (one text
#: is never split, so a longer one is hashed alone).
BLOCK_BYTES = 1 << 18

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.default_rng(20).integers(1, 2**63, 256, np.uint64)
_LOWER_CODES = _CODES.copy()
_LOWER_CODES[65:91] = _CODES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, BLOCK_BYTES + 2)
_DOWN = _powers(_BASE_INVERSE, BLOCK_BYTES + 2)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _STEP
    return values ^ (values >> np.uint64(29))


def blocks(texts: Sequence[str | None]) -> Iterator[list[bytes]]:
    """The texts as UTF-8, in runs of about BLOCK_BYTES."""
    run: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if run and size + len(data) >= BLOCK_BYTES:
            yield run
            run, size = [], 0
        run.append(data)
        size += len(data) + 1
    if run:
        yield run


class Words:
    """The words of a run of texts: hashes, places, and each text's first word.

    ``gap`` tells for each byte whether it parts words; the line feed must.
    """

    def __init__(self, run: list[bytes], lower: bool, gap: np.ndarray = _SPACE) -> None:
        self.bytes = data = np.frombuffer(b"\n".join([*run, b""]), np.uint8)
        space = gap[data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(data) and not space[0]:
            edge = np.r_[0, edge]
        self.starts, self.ends = edge[0::2], edge[1::2]
        up, down = _UP, _DOWN
        if len(data) + 1 > len(up):
            up, down = _powers(_BASE, len(data) + 1), _powers(_BASE_INVERSE, len(data) + 1)
        running = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_LOWER_CODES if lower else _CODES)[data] * up[: len(data)], out=running[1:])
        self.hashes = mixed((running[self.ends] - running[self.starts]) * down[self.starts])
        begins = np.cumsum([0, *(len(x) + 1 for x in run)])
        #: Words of text i are first[i]:first[i + 1].
        self.first = np.searchsorted(self.starts, begins)

    def windows(self, width: int) -> np.ndarray:
        """Hash of the ``width`` words from each word on; the last ones run past the text."""
        count = max(0, len(self.hashes) - width + 1)
        rolled = np.full(count, width, np.uint64)
        for shift in range(width):
            rolled = mixed(rolled * _MIX + self.hashes[shift : shift + count])
        return rolled


def shingle_sets(texts: Sequence[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, as uint64."""
    for run in blocks(texts):
        words = Words(run, lower=True)
        rolled = words.windows(width)
        for begin, end in zip(words.first[:-1], words.first[1:], strict=True):
            if end - begin >= width:
                yield np.unique(rolled[begin : end - width + 1])
                continue
            short = np.full(min(1, end - begin), end - begin, np.uint64)
            for at in range(begin, end):
                short = mixed(short * _MIX + words.hashes[at : at + 1])
            yield short


def set_digest(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``count`` hash functions."""
    draw = np.random.default_rng(seed)
    multipliers = draw.integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    return multipliers[:, None], draw.integers(0, 2**63, count, np.uint64)[:, None]


def signature(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray], block: int = 2048) -> np.ndarray:
    """The low 16 bits of the least hash under each function (b-bit min-wise hashing, b = 16)."""
    multipliers, offsets = functions
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), block):
        values = multipliers * shingles[start : start + block]
        values += offsets
        np.minimum(least, values.min(axis=1), out=least)
    return (mixed(least) & np.uint64(0xFFFF)).astype(np.uint16)


def overlap(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(left) > len(right):
        left, right = right, left
    if not len(left):
        return 0
    at = np.searchsorted(right, left)
    return int((right[np.minimum(at, len(right) - 1)] == left).sum())


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, in whole numbers."""
    if not len(left) or not len(right):
        return False
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    both = overlap(left, right)
    return 100 * both >= percent * (len(left) + len(right) - both)
