"""Hashes of words and of word n-grams, taken over the UTF-8 bytes of whole Arrow columns.

A word is ``[^\\x20\\x09-\\x0D]+``; white space is ASCII, so words can be found in the bytes. A word's
hash is a polynomial over random byte values modulo 2**64, made position-free and mixed; equal words
have equal hashes everywhere. Work goes block by block, so memory beyond the result (8 bytes a word)
does not grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BLOCK = 1 << 17
_RADIX = 0x9E3779B97F4A7C15
_RADIX_INVERSE = pow(_RADIX, -1, 1 << 64)
_NGRAM = U64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=U64) | U64(1)
_VALUE_LOWER = _VALUE.copy()
_VALUE_LOWER[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a hash: every input bit reaches every output bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * _BLOCK)
        _powers[:] = [
            np.cumprod(np.concatenate(([U64(1)], np.full(size - 1, radix, U64))), dtype=U64)
            for radix in (_RADIX, _RADIX_INVERSE)
        ]
    return _powers


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its values; null counts as empty."""
    column = pc.cast(pc.fill_null(column, ""), pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def _blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of the bytes, cut at white space or between values."""
    pos, n = 0, len(data)
    while pos < n:
        size = _BLOCK
        while True:
            end = min(pos + size, n)
            if end == n:
                break
            cut = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            blanks = np.flatnonzero(SPACE[data[pos:end]])
            cut = max(cut, pos + int(blanks[-1]) + 1 if len(blanks) else 0)
            if cut > pos:
                end = cut
                break
            size *= 2
        yield pos, end
        pos = end


def word_hashes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and for each value the offset of its first word.

    ``lower`` takes A-Z as a-z. The second array has one entry more than the column.
    """
    data, offsets = utf8(column)
    value = _VALUE_LOWER if lower else _VALUE
    hashes, starts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for lo, hi in _blocks(data, offsets):
        block = data[lo:hi]
        word = ~SPACE[block]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        cuts = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi, "left")] - lo
        first[cuts] = word[cuts]
        last[cuts - 1] = word[cuts - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last)
        power, inverse = _tables(len(block))
        total = np.zeros(len(block) + 1, U64)
        np.cumsum(value[block] * power[: len(block)], out=total[1:])
        sums = (total[end + 1] - total[begin]) * inverse[begin]
        hashes.append(mix(sums + (end - begin + 1).astype(U64) * _NGRAM))
        starts.append(begin + lo)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; n - 1 entries fewer than ``words``."""
    if len(words) < n:
        return np.zeros(0, U64)
    count = len(words) - n + 1
    total = words[:count].copy()
    for k in range(1, n):
        total *= _NGRAM
        total += words[k : k + count]
    return mix(total)


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct n-word shingles of one text; fewer words give the whole sequence as one."""
    if len(words) == 0:
        return words
    if len(words) < n:
        return ngrams(words ^ U64(len(words)), len(words))
    return np.unique(ngrams(words, n))


def sequence_key(words: np.ndarray) -> bytes:
    """128 bits that tell sequences of words apart."""
    n = len(words)
    if not n:
        return bytes(16)
    power = _tables(n)[0][:n]
    odd = mix(words ^ U64(0x5BD1E9955BD1E995))
    both = np.array([(words * power).sum(dtype=U64), (odd * power[::-1]).sum(dtype=U64)], U64)
    return mix(both + U64(n)).tobytes()


def parts(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each, one row at least."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
    total, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
