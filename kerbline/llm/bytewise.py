"""Words of many texts at once, on the UTF-8 bytes of an Arrow column.

Everything here is a whole-array operation on a block of rows of bounded size, so
memory follows the block (or its longest text) and not the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 21  # bytes of text handled at once; a longer text is a block of its own
RUN = 1 << 18  # bytes hashed at once

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_VALUE = _VALUE[LOWER]
PLAIN_VALUE = _VALUE


def mix(x: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % (1 << 64), dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_UP, _DOWN = _powers(BASE, RUN + 1), _powers(pow(BASE, -1, 1 << 64), RUN + 1)


def lowered(data: np.ndarray) -> np.ndarray:
    """Copy with ASCII and Latin-1 capitals in lower case (the latter are two bytes, the first 0xC3)."""
    out = LOWER[data]
    second = np.flatnonzero((out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)) + 1
    out[second] += 32
    return out


@dataclass
class Block:
    """Rows ``lo`` to ``hi`` of a batch: their bytes, and where rows begin and end in them."""

    lo: int
    hi: int
    data: np.ndarray
    bounds: np.ndarray


@dataclass
class Words:
    """Word ``i`` is ``data[starts[i]:ends[i]]``; row ``r`` has words ``rows[r]:rows[r + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK) -> Iterator[Block]:
    """Runs of rows with at most ``size`` bytes, or one row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, raw = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + size, "right")) - 1)
        yield Block(lo, hi, data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo])
        lo = hi


def words(block: Block) -> Words:
    """Runs of bytes other than ASCII space characters."""
    inside = ~SPACE[block.data]
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[block.bounds] = True
    before = np.zeros(len(inside), dtype=bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(inside), dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, block.bounds))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, value: np.ndarray = LOWER_VALUE) -> np.ndarray:
    """64-bit hash of each ``data[starts:ends]``, ASCII letters in lower case unless ``value`` says otherwise.

    A polynomial of the bytes, from running sums over stretches of ``RUN`` bytes.
    Spans are in order and may overlap; a span longer than a stretch is hashed alone.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            origin = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, origin + RUN, "right")))
            stop = int(ends[i:j].max())
            up, down = (_UP, _DOWN) if stop - origin <= RUN else (_powers(BASE, stop - origin + 1), _powers(pow(BASE, -1, 1 << 64), stop - origin + 1))
            total = np.zeros(stop - origin + 1, dtype=np.uint64)
            np.cumsum(value[data[origin:stop]] * up[:stop - origin], out=total[1:])
            s, e = starts[i:j] - origin, ends[i:j] - origin
            out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
            i = j
    return mix(out)


def shingles(hashed: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, row bounds): runs of ``size`` words; a row of fewer words is one shingle, one of none has none."""
    n = np.diff(rows)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    out_rows = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(rows[:-1] - out_rows[:-1], count) + np.arange(out_rows[-1])
    out = np.zeros(len(first), dtype=np.uint64)
    length = np.repeat(np.minimum(n, size), count)
    padded = np.concatenate([hashed, np.zeros(size, dtype=np.uint64)])
    with np.errstate(over="ignore"):
        for j in range(size):
            out = np.where(j < length, out * np.uint64(0xC2B2AE3D27D4EB4F) + padded[first + j], out)
        out += length.astype(np.uint64)
    return mix(out), out_rows


def over_blocks(fn: Callable[[Block], dict[str, pa.Array]], keep: list[str],
                text: str = "text") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function for ``mapInArrow``: the kept columns of each block of rows, and the arrays that ``fn`` makes of its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(text)):
                made = fn(block)
                part = [batch.column(c).slice(block.lo, block.hi - block.lo) for c in keep]
                yield pa.RecordBatch.from_arrays([*part, *made.values()], names=[*keep, *made])
    return run
