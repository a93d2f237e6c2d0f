"""Words of whole Arrow columns as numpy arrays, used inside Arrow tasks.

A word is a run of bytes other than ASCII white space, which in UTF-8 is the
same as a run of such characters.  Hashes are 64-bit polynomials computed from
prefix sums, so that no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
CHUNK = 1 << 20
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Powers:
    """Powers of an odd base and of its inverse modulo 2 ** 64, made as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.n = base, 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                steps = np.full(self.n, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up[:n], self.down[:n]


BYTE_POWERS, WORD_POWERS = Powers(BYTE_BASE), Powers(WORD_BASE)


def rolled(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for each pair."""
    up, down = powers.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


@dataclass
class Words:
    data: np.ndarray    # bytes of all texts, one after the other
    start: np.ndarray   # of each word in data
    end: np.ndarray
    first: np.ndarray   # index of the first word of each text, and the number of words

    def hashes(self) -> np.ndarray:
        h = rolled(self.data.astype(np.uint64) + np.uint64(1), self.start, self.end, BYTE_POWERS)
        return mix(h + (self.end - self.start).astype(np.uint64))

    def row(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def array(self) -> pa.Array:
        """The words as a binary column."""
        sizes = self.end - self.start
        offsets = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        inside = np.zeros(len(self.data) + 1, np.int8)
        np.add.at(inside, self.start, 1)
        np.add.at(inside, self.end, -1)
        body = self.data[np.cumsum(inside[:-1]).astype(bool)]
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))])


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, off - off[0]


def split(texts: pa.Array, lowered: bool = False) -> Words:
    """Words of every text of a column without nulls."""
    data, off = flat(texts)
    if lowered:
        data = lower(data)
    white = WHITE[data]
    begins, ends = ~white, ~white
    begins[1:] &= white[:-1]
    ends[:-1] &= white[1:]
    full = np.diff(off) > 0
    begins[off[:-1][full]] = ~white[off[:-1][full]]
    ends[off[1:][full] - 1] = ~white[off[1:][full] - 1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, off))


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``k`` words inside one text, and its start."""
    n = len(hashes)
    starts = np.arange(max(n - k + 1, 0))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = starts[row[starts] == row[starts + k - 1]] if n >= k else starts[:0]
    return mix(rolled(hashes, starts, starts + k, WORD_POWERS) + np.uint64(k)), starts


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch with at most ``limit`` bytes of text, one row at least,
    and their texts with nulls as empty."""
    texts = pc.fill_null(batch.column(batch.schema.get_field_index(text)), "")
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, "right")))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at = to


    pa.default_memory_pool().release_unused()


_held: dict = {}


def held(key, make: Callable):
    """What ``make`` gives, kept for the later tasks of this Python worker.  A
    worker keeps one such thing, since stages of many operators share it."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of values per row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
