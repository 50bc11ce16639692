"""Words of many texts as arrays: boundaries and 64-bit hashes, without an object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes that one pass over arrays takes at once; a longer single text is taken alone.
CHUNK_BYTES = 1 << 20
#: Most texts of such a pass.
CHUNK_TEXTS = 4096
#: Rows that a worker takes from a batch at once.
SLICE_ROWS = 512

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ASCII = np.arange(256)
PUNCTUATION = (_ASCII > 0x20) & (_ASCII < 0x7F) & ~np.array([chr(i).isalnum() for i in range(256)])
LOWER = np.where((_ASCII >= 65) & (_ASCII <= 90), _ASCII + 32, _ASCII).astype(np.uint8)

_RANDOM = np.random.default_rng(20240917)
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers = (tables[0], tables[1])
    return _powers


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per non-empty span of the buffer, from prefix sums of a polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverses = power_tables(max(len(data), CHUNK_BYTES))
    values = _BYTE_VALUES[data]
    values *= powers[: len(data)]
    totals = np.cumsum(values)
    sums = totals[ends - 1] - totals[starts] + values[starts]
    return mix(sums * inverses[starts] + (ends - starts).astype(np.uint64))


def hash_items(items: list[bytes]) -> np.ndarray:
    """One 64-bit hash per non-empty byte string."""
    ends = np.cumsum([len(x) for x in items], dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    return hash_spans(np.frombuffer(b"".join(items), np.uint8), starts, ends)


@dataclass
class Words:
    """Word boundaries in a joined buffer; ``first`` has the first word of each text, then the total."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        """Index of the text that each word lies in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word; equal bytes give equal hashes in any process."""
        return hash_spans(self.data, self.starts, self.ends)


def split_words(texts: list[bytes | None], separators: np.ndarray = SPACE, lower: bool = False) -> Words:
    """Words are maximal runs of bytes outside ``separators``; a null text has none."""
    texts = [t or b"" for t in texts]
    joined = b" ".join(texts) + b" "
    if lower:
        joined = joined.translate(LOWER.tobytes())
    data, gap = np.frombuffer(joined, np.uint8), np.frombuffer(joined.translate(separators.tobytes()), bool)
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    borders = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(data, starts, ends, np.searchsorted(starts, borders))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows, so that a worker turns few rows into Python objects at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def chunks(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of whole texts of about ``limit`` bytes, CHUNK_TEXTS at most."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text or b"")
        if i > begin and (size + n > limit or i - begin == CHUNK_TEXTS):
            yield slice(begin, i)
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield slice(begin, len(texts))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words; entry i starts at word i."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = mix(out + hashes[j : j + n] * np.uint64(2 * j + 3))
    return out


def free_name(name: str, taken: list[str]) -> str:
    """The name, with as many underscores before it as it takes to be new."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name
