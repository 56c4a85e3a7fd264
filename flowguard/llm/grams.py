"""Word hashes and word n-grams of whole Arrow text columns, without a Python loop over words.

Words are runs of bytes other than 0x20 and 0x09-0x0D after lower-casing A-Z. Those separators never
occur inside a multi-byte UTF-8 character, so everything works on bytes. Texts are handled in chunks
of half a MB, whatever the size of the Arrow batch; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 500_000
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def separator_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def punctuation_table() -> np.ndarray:
    """Separators and all other ASCII signs that are no letter or digit."""
    table = separator_table()
    table[[c for c in range(128) if not chr(c).isalnum()]] = True
    return table


LOWER, SEPARATOR, PUNCTUATION = lower_table(), separator_table(), punctuation_table()
LETTER_CODE = mix(np.arange(1, 257, dtype=U) * U(_BASE))
PLACE = mix(np.arange(1, 65, dtype=U)) | U(1)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            steps = np.full(n, _BASE, dtype=U)
            steps[0] = 1
            self.up = np.multiply.accumulate(steps)
            steps[1:] = U(pow(_BASE, -1, 1 << 64))
            self.down = np.multiply.accumulate(steps)
        return self.up, self.down


_powers = _Powers()


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the len+1 offsets of its values; nulls are empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8), offsets.astype(np.int64)


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``size`` bytes, one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def single_letters(b: np.ndarray) -> np.ndarray:
    """Where letters of scripts without blanks begin or end: U+0E00 to U+0E7F and U+3000 to U+9FFF, three bytes each."""
    cut = np.zeros(len(b) + 4, bool)
    lead = np.flatnonzero((b >= 0xE0) & (b <= 0xE9))
    if len(lead):
        follows = b[np.minimum(lead + 1, len(b) - 1)]
        lead = lead[((b[lead] == 0xE0) & ((follows == 0xB8) | (follows == 0xB9))) | (b[lead] >= 0xE3)]
        cut[lead] = cut[lead + 3] = True
    return cut[: len(b) + 1]


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR, singles: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, first word of every text and the total) of a chunk of texts.

    ``separator`` marks the bytes between words, ASCII only. With ``singles``, a letter of a script without blanks is a word.
    """
    b = LOWER[data[offsets[0] : offsets[-1]]]
    at = offsets - offsets[0]
    if not len(b):
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    gap = separator[b]
    before = np.empty(len(b) + 1, bool)
    before[0], before[1:] = True, gap
    before[at[:-1]] = True
    after = np.empty(len(b) + 1, bool)
    after[:-1], after[-1] = gap, True
    after[at[1:]] = True
    if singles:
        cut = single_letters(b)
        before |= cut
        after |= cut
    start = np.flatnonzero(~gap & before[:-1])
    end = np.flatnonzero(~gap & after[1:]) + 1
    up, down = _powers.upto(len(b) + 1)
    total = np.zeros(len(b) + 1, U)
    np.cumsum(LETTER_CODE[b] * up[: len(b)], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(U))
    return hashes, np.searchsorted(start, at).astype(np.int64)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions are left out."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, U)
    out = np.zeros(count, U)
    for j in range(n):
        out += hashes[j : j + count] * PLACE[j]
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-word shingles of each text; a shorter text is one shingle of all its words."""
    hashes, first = words(data, offsets)
    grams = ngrams(hashes, n)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            found = np.sort(grams[a : b - n + 1])
            if len(found) > 1:
                fresh = np.empty(len(found), bool)
                fresh[0] = True
                np.not_equal(found[1:], found[:-1], out=fresh[1:])
                found = found[fresh]
            yield found
        elif b > a:
            part = hashes[a:b] * PLACE[: b - a]
            yield mix(part.sum(dtype=U, keepdims=True) + U(b - a))
        else:
            yield np.zeros(0, U)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
