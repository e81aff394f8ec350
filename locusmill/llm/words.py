"""Batches of texts as numpy word codes, for the operators that run in Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


@dataclass
class Words:
    """``codes``: the words of all texts, as indices into ``names``; text i has codes[offsets[i]:offsets[i + 1]]."""

    codes: np.ndarray
    offsets: np.ndarray
    names: pa.Array

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def doc(self) -> np.ndarray:
        """The index of the text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1, dtype=np.int32), self.lengths)


def word_codes(texts: pa.Array, lower: bool = False) -> Words:
    """Words are runs of non-white-space (the six ASCII characters); ``lower`` lower-cases A-Z. Null texts have none."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, per = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    keep = full.to_numpy(zero_copy_only=False).astype(bool)
    ends = np.concatenate([[0], np.cumsum(per)])
    before = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
    coded = flat.filter(full).dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False), before[ends], coded.dictionary)


def give_back() -> None:
    """Return freed memory to the system: a worker is used again for later tasks and would keep its peak."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, mb: float = 8, gather: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each has about ``mb`` MB of text at most, or one row; ``gather``: small ones put together first."""
    for b in _gathered(batches, mb) if gather else batches:
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(size):
            continue
        at = (np.cumsum(size) - size) // int(mb * 1e6)
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(size)]
        for a, z in zip(cuts, cuts[1:]):
            yield b.slice(a, z - a)
    give_back()


def _gathered(batches: Iterator[pa.RecordBatch], mb: float) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.nbytes for x in held) >= mb * 1e6:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held and sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of each text's stretch of ``values``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[i]:starts[i] + lengths[i]] for every i, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    index = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    index += np.repeat(starts - (ends - lengths), lengths)
    return flat[index]


_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on unsigned 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(names: pa.Array) -> np.ndarray:
    """The bytes of all strings, one after the other; none is null."""
    offsets = np.frombuffer(names.buffers()[1], np.int64 if pa.types.is_large_string(names.type) or pa.types.is_large_binary(names.type) else np.int32)[names.offset : names.offset + len(names) + 1]
    return np.frombuffer(names.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]


def string_hashes(names: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string's bytes, the same in every batch: a polynomial in an odd number, then mixed."""
    if not len(names):
        return np.zeros(0, np.uint64)
    size = pc.binary_length(names).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    raw = utf8(names)
    longest = int(size.max())
    powers = np.cumprod(np.full(max(1, longest), _STEP | np.uint64(1), np.uint64))
    at = np.arange(len(raw)) - np.repeat(ends[:-1], size)
    total = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[at])])
    return mixed(total[ends[1:]] - total[ends[:-1]] + size.astype(np.uint64) * _STEP)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n neighbours: one for each start but the last n - 1."""
    out = hashes[: max(0, len(hashes) - n + 1)]
    for k in range(1, n):
        out = mixed(out * _STEP + hashes[k : len(hashes) - n + 1 + k])
    return out
