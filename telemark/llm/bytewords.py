"""Words of Arrow text columns as 64-bit numbers, found with whole-array byte work.

A text column's UTF-8 bytes lie in one buffer. A table of 256 entries says which
bytes belong to words (and folds A-Z), word starts and ends come from comparing
neighbouring bytes, and one running sum gives every word's hash. Bytes of 0x80 and
above always belong to words, so looking at bytes equals looking at characters.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHARD_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_MIX = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def fold_table(separators) -> np.ndarray:
    """Byte -> lower-cased byte, or 0 for the bytes that separate words."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[list(separators)] = 0
    return table


# Words are runs of a-z, 0-9 and everything beyond ASCII.
ALNUM = fold_table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
# Words are runs of anything but blanks: space and 0x09 to 0x0D. Byte 0 is kept apart as 0x01.
NONBLANK = fold_table([0x20, *range(0x09, 0x0E)])
NONBLANK[0] = 0xFF


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, SHARD_BYTES + 1)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            line = np.full(size, base, dtype=np.uint64)
            line[0] = 1
            _powers[key] = np.multiply.accumulate(line)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of a well-known hash)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


@dataclass
class Words:
    """Hashes of all words of some rows, in order; row r owns bounds[r]:bounds[r + 1]."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    total: np.ndarray

    def prefixes(self, size: int) -> np.ndarray:
        """Hashes of the first `size` bytes of every word, 0 for words of no more bytes."""
        longer = self.ends - self.starts > size
        begin = self.starts[longer]
        out = np.zeros(len(self.starts), dtype=np.uint64)
        out[longer] = mix((self.total[begin + size] - self.total[begin]) * _power(len(self.total))[1][begin] + np.uint64(size))
        return out

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def words(column, table: np.ndarray) -> Words:
    data, offsets = utf8(column)
    n = len(data)
    folded = table[data]
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = folded != 0
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | first[1:]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    up, down = _power(n + 1)
    line = _MIX[folded]
    line *= up[:n]
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(line, out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return Words(mix(h), np.searchsorted(starts, offsets).astype(np.int64), starts, ends, total)


def shards(batches, text: str, limit: int = SHARD_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of whole rows of at most `limit` text bytes (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every k-word shingle, repeats included; a row with fewer than
    k words but not none gives its whole sequence as its only one."""
    h, bounds = found.hashes, found.bounds
    counts = np.diff(bounds)
    rows = found.rows()
    left = bounds[1:][rows] - np.arange(len(h))
    at = np.flatnonzero(left >= k)
    value = np.zeros(len(at), dtype=np.uint64)
    for j in range(k):
        value = value * np.uint64(_BASE) + h[at + j]
    value = mix(value)
    out_rows, out = rows[at], value
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            have = counts[short] > j
            extra[have] = extra[have] * np.uint64(_BASE) + h[bounds[short[have]] + j]
        extra = mix(extra + counts[short].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        out_rows = np.concatenate([out_rows, short])
        out = np.concatenate([out, extra])
        order = np.argsort(out_rows, kind="stable")
        out_rows, out = out_rows[order], out[order]
    return out_rows, out


def shingle_sets(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, one after another, and their n + 1 bounds."""
    rows, value = shingles(found, k)
    n = len(found.bounds) - 1
    cut = np.searchsorted(rows, np.arange(n + 1))
    for r in range(n):
        value[cut[r]: cut[r + 1]].sort()
    keep = np.ones(len(value), dtype=bool)
    if len(value):
        keep[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    value, rows = value[keep], rows[keep]
    return value, np.searchsorted(rows, np.arange(n + 1)).astype(np.int64)
