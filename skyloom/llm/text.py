"""Words of UTF-8 texts as numpy arrays: boundaries, hashes and hashes of word windows.

A slab is a run of whole documents of one Arrow batch, about ``SLAB_BYTES`` of text. Words are
the runs of bytes other than 0x20 and 0x09-0x0D, so no text is decoded and none is cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Of the C library, where it has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

SLAB_BYTES = 1 << 20
#: For work that is shared between equal words or windows of a slab.
LARGE_SLAB_BYTES = 4 << 20
_BLOCK_BYTES = 1 << 18

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_random = np.random.default_rng(7)
_BYTE_CODES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse modulo 2**64 for i below ``n``."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, _BLOCK_BYTES, 2 * len(known[0]) if known else 0)
        made = []
        for b in (base, pow(base, -1, 2**64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers[base] = known = (made[0], made[1])
    return known[0][:n], known[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all of them (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    data: np.ndarray  # bytes of the slab
    bounds: np.ndarray  # byte bounds of its documents
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    first: np.ndarray  # word bounds of the documents, one more than documents

    @property
    def doc(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its values; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets, data = texts.buffers()[1:]
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]]
    return raw, bounds - bounds[0]


def give_back() -> None:
    """Return freed memory to the system. Workers live on from stage to stage, and share an executor with
    others and with the JVM; what their allocators hold on to is lost to these."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slabs(batches: Iterable[pa.RecordBatch], size: int | None = None, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Split batches so that each holds about ``size`` (``SLAB_BYTES``) bytes of text, or one longer
    document."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.diff(text_bytes(batch.column(column))[1])
        part = np.cumsum(lengths) // (size or SLAB_BYTES)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
        give_back()


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Word boundaries of a slab; ``lower`` maps A-Z to a-z first."""
    data, bounds = text_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = ~SEPARATOR[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    inner = bounds[1:-1]
    inner = inner[inner < len(data)]
    opens[inner] = inside[inner]  # a word never runs over from one document to the next
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    ends = np.flatnonzero(closes) + 1
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of each byte span; spans are disjoint and in order. Worked in blocks that
    stay in the processor's cache."""
    out = np.zeros(len(starts), dtype=np.uint64)
    base = _BASES[salt]
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(int(np.searchsorted(ends, low + _BLOCK_BYTES, side="right")), at + 1)
        block = data[low : ends[to - 1]]
        power, inverse = powers(len(block) + 1, base)  # an empty span may stand at the end
        sums = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[block] * power[:-1], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mix((sums[e] - sums[s]) * inverse[s])
        at = to
    return out


def word_hashes(words: Words, salt: int = 0) -> np.ndarray:
    return span_hashes(words.data, words.starts, words.ends, salt)


def window_sums(hashes: np.ndarray, first: np.ndarray, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of every run of ``n`` words inside one document, and the sum of its
    hashes, each times the weight of its place (``powers`` of the base)."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    power, inverse = powers(len(hashes), _BASES[salt])
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * power, out=sums[1:])
    whole = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])
    return whole, (sums[whole + n] - sums[whole]) * inverse[whole]


def windows(hashes: np.ndarray, first: np.ndarray, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every run of ``n`` words inside one document."""
    whole, sums = window_sums(hashes, first, n, salt)
    return whole, mix(sums)


def window_weights(n: int, salt: int = 0) -> np.ndarray:
    return powers(n, _BASES[salt])[0]
