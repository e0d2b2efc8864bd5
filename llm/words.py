"""Words of Arrow string columns and their hashes, computed for many texts at once with NumPy.

Texts are UTF-8 bytes; a class of words is a table of the 256 byte values.  A word never
crosses from one text to the next.  Hashes are sums of random values times powers of an odd
number modulo 2**64, so the hash of any run of bytes or words comes from two prefix sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 2 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_values(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values, equal on every machine."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mixed(steps + np.array([seed], np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _byte_class(inside) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(inside)] = True
    return table


#: ``[^\x20\x09-\x0D]+``
BLANK_SEPARATED = _byte_class(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of texts whose A-Z are lower-cased first
ALPHANUMERIC = _byte_class(b for b in range(256) if b >= 0x80 or chr(b).isalnum())

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUES = random_values(256, 1)
_ODD = np.uint64(0x2545F4914F6CDD1D)
_ODD_INVERSE = np.uint64(pow(0x2545F4914F6CDD1D, -1, 1 << 64))
_powers = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[int(base)] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               odd: np.uint64 = _ODD) -> np.ndarray:
    """A hash of ``values[start:end]`` for each pair; equal runs have equal hashes."""
    inverse = _ODD_INVERSE if odd == _ODD else np.uint64(pow(int(odd), -1, 1 << 64))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(odd, len(values)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers(inverse, len(values) + 1)[starts]
    return _mixed(hashes + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of consecutive rows: byte spans in ``data``, and ``bounds[i]:bounds[i+1]`` of row i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words_of(texts: pa.Array, inside: np.ndarray, lower: bool = False) -> Words:
    """The words of every text (none of a null)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, raw = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    data = raw[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    word = np.zeros(len(data) + 1, dtype=bool)
    word[:-1] = inside[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edge = offsets[:-1][np.diff(offsets) > 0]
    first[edge] = word[edge]
    last = word[:-1] & (first[1:] | ~word[1:])
    starts = np.flatnonzero(first[:-1])
    ends = np.flatnonzero(last) + 1
    hashes = run_hashes(_BYTE_VALUES[data], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hashes)


def chunks(batches, text: str = "text", limit: int = CHUNK_BYTES):
    """Arrow batches cut in runs of rows whose texts together have about ``limit`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        part = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def windows(words: Words, size: int):
    """Starts of all runs of ``size`` words inside one row, and their rows."""
    n = np.diff(words.bounds) - size + 1
    rows = np.flatnonzero(n > 0)
    n = n[rows]
    total = np.concatenate([[0], np.cumsum(n)])
    starts = np.arange(total[-1]) - np.repeat(total[:-1] - words.bounds[:-1][rows], n)
    return starts, np.repeat(rows, n)
