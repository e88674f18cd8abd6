"""Columns of texts as flat arrays of bytes, so that numpy handles a batch of documents at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs

# Bytes of text that are taken up at once; a longer document is taken up alone.
PIECE_BYTES = 1 << 21
# Words are hashed over at most so many bytes at once.
HASH_BYTES = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
SECOND_BASE = U64(0xD6E8FEB86659FD93)


@dataclass
class Piece:
    """Some rows of a batch: their bytes, and where each row begins (one more offset at the end)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """The rows of a string column in pieces of bounded size; null is an empty text."""
    if len(column) == 0:
        return
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        own = offsets[first : last + 1]
        yield Piece(first, data[own[0] : own[-1]], own - own[0])
        first = last


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: U64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i up to n at least."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 2 * len(have[0]) if have else 1 << 16)
        inverse = U64(pow(int(base), -1, 1 << 64))
        have = tuple(
            np.concatenate([np.ones(1, U64), np.cumprod(np.full(size, b, U64))])
            for b in (base, inverse)
        )
        _POWERS[int(base)] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads each bit over all 64."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def span_hashes(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: U64 = BASE
) -> np.ndarray:
    """Hash of values[starts[i]:ends[i]] for each i; equal spans have equal hashes anywhere."""
    power, inverse = powers(len(values), base)
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U64))


@dataclass
class Words:
    """The words of a piece: byte spans, 64-bit hashes, and the first word of each row."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def words(piece: Piece, data: np.ndarray | None = None) -> Words:
    """Words of a piece: runs of bytes other than ASCII white space. ``data`` replaces its bytes."""
    data = piece.data if data is None else data
    inside = ~SPACES[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = piece.offsets[:-1][np.diff(piece.offsets) > 0]
    begins[edges] = inside[edges]
    stops[edges[1:] - 1] = inside[edges[1:] - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + HASH_BYTES, "right")), i + 1)
        at = starts[i]
        part = data[at : ends[j - 1]].astype(U64) + U64(1)
        hashes[i:j] = span_hashes(part, starts[i:j] - at, ends[i:j] - at)
        i = j
    return Words(starts, ends, hashes, np.searchsorted(starts, piece.offsets))


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each item, from where each row's items begin."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def long_array(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


# Schemes of one store: those of Hadoop's file systems, and what Arrow calls them.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def opened(path: str) -> pa.NativeFile:
    """A file that Spark listed, opened by a task to read any part of it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[len("file:") :].lstrip("/"))
    scheme, _, rest = path.partition("://")
    store, name = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    return store.open_input_file(name)
