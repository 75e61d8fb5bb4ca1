"""Texts as bytes in numpy: blocks of bounded size, tokens as ranges, distinct tokens of a block.

Used inside Arrow tasks. A block holds whole texts of BLOCK bytes together, or
one longer text, so memory is bounded by the larger of BLOCK and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK = 4 << 20
BASE = 0x9E3779B97F4A7C15  # odd, so that powers never vanish
MIX = np.uint64(0xFF51AFD7ED558CCD)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a missing text is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string()) if pa.types.is_string(column.type) else column
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts."""
    data, offsets = column_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


@lru_cache(maxsize=1)
def _powers(size: int) -> np.ndarray:
    out = np.full(size, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> np.ndarray:
    return _powers(1 << max(6, (n - 1).bit_length()))[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * MIX
    return h ^ (h >> np.uint64(29))


def token_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and length of tokens that lie end to end, and each byte's place in its token."""
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    summed = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[place], starts)
    return mixed(summed + lengths.astype(np.uint64)), lengths, place


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the first token of each kind, and each token's kind. Equal hashes are compared byte by byte."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, lengths, place = token_hashes(data, starts)
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    same = first[kind]
    if np.array_equal(lengths, lengths[same]) and np.array_equal(data, data[np.repeat(starts[same], lengths) + place]):
        return first, kind
    kinds: dict[bytes, int] = {}  # two tokens share a hash
    whole, ends = data.tobytes(), starts + lengths
    kind = np.array([kinds.setdefault(whole[a:b], len(kinds)) for a, b in zip(starts, ends, strict=True)])
    return np.unique(kind, return_index=True)[1], kind


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row in which each token starts."""
    return np.searchsorted(offsets, starts, "right") - 1


def tokens(data: np.ndarray, starts: np.ndarray, picked: np.ndarray) -> list[bytes]:
    whole, ends = data.tobytes(), np.append(starts[1:], len(data))
    return [whole[a:b] for a, b in zip(starts[picked].tolist(), ends[picked].tolist(), strict=True)]
