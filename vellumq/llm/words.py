"""Vectorised words, word hashes and shingle sets over Arrow batches.

Everything here works on the UTF-8 bytes of a batch of texts at once, so that the
cost a word is a few array operations instead of Python objects.  Hashes are 64 bits
wide; equal hashes are taken as equal words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of the words that the contamination index takes (0-9, A-Z, a-z, all non-ASCII).
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Bytes of words that white space (0x20, 0x09 to 0x0D) separates.
SOLID = np.ones(256, bool)
SOLID[0x20] = False
SOLID[0x09:0x0E] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_bytes = np.arange(256)
_LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 0x20, _bytes)
_SPREAD = mix(_LOWER.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(0x632BE59BD9B4E019))


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``limit`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        _, offsets = utf8(batch.column(at))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (one more at the end). Null: empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words: byte where it begins, where it ends, and for each text the index of its first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = kind[data]
    joined = np.zeros(len(data) + 1, bool)  # the byte and the one before are of one word
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[offsets] = False
    begins = np.flatnonzero(inside & ~joined[:-1])
    ends = np.flatnonzero(inside & ~joined[1:]) + 1
    return begins, ends, np.searchsorted(begins, offsets)


_CHUNK = 1 << 19
_powers: list[np.ndarray] = []


def _scales(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(max(n, _CHUNK + 1), x, np.uint64)))) for x in (_BASE, _INVERSE)]
    return _powers


def hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z taken as a-z. Bytes are gone through in chunks, so memory doesn't follow a text's length."""
    out = np.empty(len(begins), np.uint64)
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(ends, begins[i] + _CHUNK, "right")))
        low, high = int(begins[i]), int(ends[j - 1])
        powers, back = _scales(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_SPREAD[data[low:high]] * powers[: high - low], out=sums[1:])
        a, b = begins[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * back[a]
        i = j
    return mix(out + (ends - begins).astype(np.uint64))


def word_hashes(texts: pa.Array, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and for each text the index of its first word (one more at the end)."""
    data, offsets = utf8(texts)
    begins, ends, first = spans(data, offsets, kind)
    return hashes(data, begins, ends), first


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k neighbouring words (also of runs across texts, which callers leave out)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xF1357AEA2E62A9C5) + words[i : i + n]
    return mix(out + np.uint64(k))


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text its set of distinct k-word shingles, ascending; of a text with fewer words the whole sequence as one."""
    words, first = word_hashes(texts, SOLID)
    runs = shingles(words, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            own = np.sort(runs[a : b - k + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) > 1 else own
        elif b > a:
            yield shingles(words[a:b], b - a)
        else:
            yield runs[:0]
