"""Vectorised text helpers for code that runs inside Spark tasks (numpy over Arrow buffers).

Everything works on slices of at most ``CHUNK`` bytes (or one document, if longer), so memory is
bounded by the longest single document, never by the partition.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``. Those separators are ASCII, so splitting
the UTF-8 bytes equals splitting the characters.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvethin.session import checkpoint_dir

CHUNK = 512 << 10
NULL_ID = -(1 << 63)  # stands for a null doc_id in join keys

_SEP = np.zeros(256, bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage: written to the session's shared checkpoint folder and read back."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame) -> DataFrame:
    """As ``cut``, for large tables: written as compressed Parquet (checkpoint files are not compressed)."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FEW = 4_000_000  # rows of (at most two) 8-byte keys that may be broadcast: 64 MB


def sized(keys: DataFrame) -> DataFrame:
    """A materialised table of keys, to be broadcast if its counted size allows; else Spark shuffles for the join."""
    keys = cut(keys)
    return F.broadcast(keys) if keys.count() <= FEW else keys


def held_out(doc_id: Column | str) -> Column:
    """Rows whose labels are never learned from."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(False))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, grown by doubling and kept for the life of the worker."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, np.uint64)
        while len(have) < n:
            step = np.uint64(pow(base, len(have), 1 << 64))
            have = np.concatenate([have, have * step])
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser, so that polynomial hashes order and bucket evenly."""
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp: sum of values[i] * base**(i - start) mod 2**64 over each [start, end)."""
    inverse = pow(_BASE, -1, 1 << 64)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=total[1:])
    return (total[end] - total[start]) * _powers(inverse, len(values) + 1)[start]


class Words:
    """The words of some whole documents: byte ranges, and for each document its range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        inside = ~_SEP[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.doc = np.searchsorted(self.start, offsets)  # document i has words doc[i] .. doc[i + 1]
        self.offsets = offsets

    def counts(self) -> np.ndarray:
        return np.diff(self.doc)

    def hashes(self) -> np.ndarray:
        return mix(rolling(_BYTE[self.data], self.start, self.end))

    def windows(self, size: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First word of each window of ``size`` words inside one document, and the window's hash."""
        h = self.hashes() if hashes is None else hashes
        at = np.arange(max(0, len(h) - size + 1))
        last = np.repeat(self.doc[1:], self.counts())[: len(at)]
        at = at[at + size <= last]
        return at, mix(rolling(h, at, at + size), size)


def chunks(text: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of whole texts; null counts as empty."""
    if text.null_count:
        text = text.fill_null("")
    n = len(text)
    if not n:
        return
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    off = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)[text.offset:text.offset + n + 1].astype(np.int64)
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def by_chunk(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for each run of whole texts in the batches."""
    for batch in batches:
        for i, j, data, off in chunks(batch.column(column), size):
            yield batch.slice(i, j - i), data, off


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array with ``counts[i]`` of the values in row i."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, kind))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def keep_repeated(key: str, sure: str | None = None):
    """For mapInArrow over rows sorted by ``key``: passes on the rows whose key occurs again.

    Rows with a negative value in the column ``sure`` are known to repeat and pass whatever their neighbours are.
    Streams: holds one batch and one row, however many rows a key has.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, known = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if carry is None else [carry, batch]).combine_chunks()
            h = rows.column(key).to_numpy()
            again = np.zeros(len(h), bool)
            same = h[1:] == h[:-1]
            again[1:] |= same
            again[:-1] |= same
            again[0] |= known
            if sure:
                again |= rows.column(sure).to_numpy() < 0
            out = rows.slice(0, len(h) - 1).filter(pa.array(again[:-1]))
            yield from out.to_batches()
            carry, known = rows.slice(len(h) - 1).combine_chunks().to_batches()[0], bool(again[-1])
        if known:
            yield carry

    return run
