"""Word shingles of many texts at once, as 64-bit hashes in numpy arrays.

Words are runs of bytes other than the six ASCII white-space characters, A-Z in lower case.  A word's hash is a
polynomial over its bytes modulo 2**64, mixed; a shingle's hash mixes its words' hashes in order.  Two different
shingles share a hash with chance 2**-64.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
SEED = 0x5EED
#: Bytes of text that are shingled at once; one longer text goes alone.
STEP_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C55
_UNBASE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers under which near inputs fall far apart."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, STEP_BYTES + (1 << 16))
        for k, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``STEP_BYTES`` bytes."""
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0, np.int32)
    start, total = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > start and total + size > STEP_BYTES:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts (a string array without nulls), and where each text's words start."""
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    ends = offsets[1:] - offsets[0]
    joined = np.full(len(raw) + n, 32, np.uint8)
    byte = np.ones(len(joined), bool)
    byte[ends + np.arange(n)] = False
    joined[byte] = _LOWER[raw]
    space = _SPACE[joined]
    stop = space.copy()
    stop[1:] &= ~space[:-1]
    stop[0] = False
    starts = np.concatenate(([0], np.searchsorted(np.flatnonzero(stop), ends + np.arange(n), "right")))
    kept = joined[~space | stop]
    closes = np.flatnonzero(stop[~space | stop])
    if not len(closes):
        return np.zeros(0, np.uint64), starts
    power, unpower = powers(len(kept))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(kept * power, dtype=np.uint64)))
    opens = np.concatenate(([0], closes[:-1] + 1))
    return mix((total[closes] - total[opens]) * unpower[opens] + (closes - opens).astype(np.uint64)), starts


def combine(words: np.ndarray) -> np.ndarray:
    """Hash of each row of a matrix of word hashes."""
    out = np.full(words.shape[:-1], SEED, np.uint64)
    for k in range(words.shape[-1]):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[..., k])
    return out


def shingles(texts: pa.Array, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in order, repeats included, and where each text's start.  A text of fewer words has one
    shingle, its whole sequence of words; a text without words has none."""
    words, starts = word_hashes(texts)
    counts = np.diff(starts)
    own = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(own)))
    out = np.zeros(first[-1], np.uint64)
    if len(words) >= width:
        all_ = combine(np.lib.stride_tricks.sliding_window_view(words, width))
        text = np.repeat(np.arange(len(counts)), counts)
        inside = text[:len(all_)] == text[width - 1:]
        at = np.flatnonzero(inside)
        out[first[text[at]] + at - starts[text[at]]] = all_[at]
    for k in np.flatnonzero((counts > 0) & (counts < width)):
        out[first[k]] = combine(words[None, starts[k]:starts[k + 1]])[0]
    return out, first
