"""Words of Arrow text columns as numpy arrays.

Texts are handled in blocks of whole texts, about ``BLOCK_BYTES`` each, so a
task's memory follows its longest text and not its partition.  A word is a
maximal run of characters other than space and ``\\t \\n \\v \\f \\r``.
Words are known by a 64-bit hash of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

# Memory of batches goes back to the system when they are done.
pa.set_memory_pool(pa.system_memory_pool())

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUE = np.random.default_rng(20240613).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        forward, back = np.full(n, _BASE), np.full(n, _INVERSE)
        forward[0] = back[0] = 1
        _powers = np.multiply.accumulate(forward), np.multiply.accumulate(back)
    return _powers


@dataclass
class Block:
    """Some whole texts: ``data`` holds their bytes, text k is ``data[offsets[k]:offsets[k + 1]]``."""

    first_row: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def prefix(self) -> np.ndarray:
        """Prefix sums of the byte polynomial; ``span_hash`` reads them."""
        forward, _ = _power_tables(len(self.data) + 1)
        out = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[self.data] * forward[: len(self.data)], out=out[1:])
        return out

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of each span."""
        _, back = _power_tables(len(self.data) + 1)
        return mix((self.prefix[ends] - self.prefix[starts]) * back[starts])

    @cached_property
    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of every word."""
        inside = ~_SPACE[self.data]
        before = np.zeros(len(inside) + 1, bool)
        before[1:] = inside
        cut = self.offsets[:-1]
        before[cut[cut <= len(inside)]] = False
        starts = np.flatnonzero(inside & ~before[:-1])
        after = np.zeros(len(inside) + 1, bool)
        after[:-1] = inside
        after[cut] = False
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        return starts, ends

    @cached_property
    def word_hash(self) -> np.ndarray:
        return self.span_hash(*self.spans)

    @cached_property
    def first_word(self) -> np.ndarray:
        """Words before each text; one entry more than texts."""
        return np.searchsorted(self.spans[0], self.offsets)

    @cached_property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), np.diff(self.first_word))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of ``size`` words on end, for every word that starts such a run, and that word's number.

        A text of fewer words has none.
        """
        n = len(self.word_hash) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        text = self.text_of_word
        at = np.flatnonzero(text[:n] == text[size - 1:])
        out = np.zeros(len(at), np.uint64)
        for k in range(size):
            out = out * _BASE + self.word_hash[at + k]
        return mix(out), at

    def count(self, table: np.ndarray) -> np.ndarray:
        """Per text, how many bytes have ``table[byte]`` set."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(table[self.data], out=sums[1:])
        return np.diff(sums[self.offsets])

    def text(self, k: int) -> str:
        return self.data[self.offsets[k]:self.offsets[k + 1]].tobytes().decode()


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks; NULL counts as an empty text."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + block_bytes, "right")) - 1
        end = max(row + 1, min(end, len(texts)))
        yield Block(row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row])
        row = end


def repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the entries whose value occurs twice or more."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def within_text(hashes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Hashes made different between texts, so that equal ones are of one text."""
    return mix(hashes ^ mix(texts.astype(np.uint64) + np.uint64(1)))


class SpanNumbers:
    """Numbers the distinct spans a worker has met, by hash; starts anew beyond ``limit``."""

    def __init__(self, limit: int):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self._hashes, self._numbers = np.empty(0, np.uint64), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self._hashes)

    @property
    def full(self) -> bool:
        return len(self._hashes) > self.limit

    def number(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of every hash, and where the new ones first stand, in the order of their numbers."""
        unique, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self._hashes, unique)
        new = np.append(self._hashes, np.uint64(0))[at] != unique
        new[at == len(self._hashes)] = True
        if new.any():
            numbers = len(self._hashes) + np.arange(int(new.sum()))
            self._hashes = np.insert(self._hashes, at[new], unique[new])
            self._numbers = np.insert(self._numbers, at[new], numbers)
            at = np.searchsorted(self._hashes, unique)
        return self._numbers[at][inverse], where[new]


class Ragged:
    """Lists of numbers on end; ``take`` puts chosen lists on end."""

    def __init__(self):
        self.first, self.values = np.zeros(1, np.int64), np.empty(0, np.int32)

    def extend(self, lists: list) -> None:
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        self.first = np.append(self.first, self.first[-1] + np.cumsum(lengths))
        self.values = np.append(self.values, np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum())))

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of the chosen lists and their values."""
        counts = self.first[numbers + 1] - self.first[numbers]
        ends = np.cumsum(counts)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.first[numbers] - ends + counts, counts)
        return counts, self.values[at]
