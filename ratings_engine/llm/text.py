"""Words and n-grams of whole Arrow columns as 64-bit hashes, in numpy.

A word is a run of bytes other than ASCII white space. Its hash is a polynomial of its bytes, each
replaced by a fixed random number; running sums give all words of a column at once. Slices of about
a megabyte keep the working memory small whatever the length of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20260101).integers(1, 2 ** 63, 256, dtype=np.uint64)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_SOLID = np.ones(256, bool)
_SOLID[[32, *range(9, 14)]] = False
#: ASCII letters and digits and everything beyond ASCII: words without punctuation.
LETTERS = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if texts.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(texts: pa.Array, limit: int = SLICE):
    """The column in runs of texts of about limit bytes, so that arrays over words stay small."""
    _, offsets = raw(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield texts.slice(first, last - first)
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray,
                solid: np.ndarray = _SOLID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text number) of all runs of bytes marked in solid."""
    solid = solid[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~solid[:-1]
    after[:-1] |= ~solid[1:]
    starts, ends = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """One 64-bit hash per word; A-Z count as a-z if lower."""
    table = _BYTES[_LOWER] if lower else _BYTES
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, np.searchsorted(ends, starts[first] + SLICE, "right"))
        low, high = starts[first], ends[last - 1]
        powers = np.full(high - low + 1, _PRIME, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        # Highest power first, so that a word's sum needs one factor to not depend on its place.
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[data[low:high]] * powers[:-1], out=sums[1:])
        inverse = _inverse_powers(high - low + 1)
        begin, end = starts[first:last] - low, ends[first:last] - low
        out[first:last] = (sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64)
        first = last
    return mix(out)


_known = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _known
    if len(_known) < n:
        known = np.full(max(n, SLICE + 1), np.uint64(pow(int(_PRIME), -1, 2 ** 64)), np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _known = known
    return _known


def ngrams(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of all n-grams of words that lie in one text, in order."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = len(hashes) - n + 1
    out = hashes[:count]
    for k in range(1, n):
        out = mix(out * _PRIME + hashes[k:k + count])
    inside = text[:count] == text[n - 1:]
    return out[inside], text[:count][inside]


def shingle_sets(texts: pa.Array, n: int):
    """The sorted distinct n-word shingles of each text; of shorter texts the whole sequence of words
    as one, of texts without words none."""
    for piece in pieces(texts):
        yield from _shingle_sets(piece, n)


def _shingle_sets(texts: pa.Array, n: int):
    data, offsets = raw(texts)
    starts, ends, text = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    grams, owner = ngrams(hashes, text, n)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    words = np.searchsorted(text, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        size = words[i + 1] - words[i]
        if size >= n:
            yield np.unique(grams[cuts[i]:cuts[i + 1]])
        elif size:
            whole = np.uint64(size)
            for h in hashes[words[i]:words[i + 1]]:
                whole = mix(np.array([whole], np.uint64) * _PRIME + h)[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)
