"""Helpers that the corpus operators share: table access, shared-folder tables, Arrow text blocks."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only separators between words.
SPACE = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir. A session in one local process that names none
    (tests) gets a folder of its own; on a cluster there is no folder to guess."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = _local_dir()
    return found.rstrip("/")


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="jobmarket-")


#: Paths of the tables that each open scratch() will remove, the innermost last.
_OPEN: list[list[str]] = []


def _write(df: DataFrame, label: str, owner: int) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if len(_OPEN) >= owner:
        _OPEN[-owner].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: lineage ends there and a lost executor
    costs no recomputation. The table stays until the scratch() around it ends, else until the folder is emptied."""
    return _write(df, label, 1)


def result(df: DataFrame, label: str) -> DataFrame:
    """As written, for what leaves the scratch() around it."""
    return _write(df, label, 2)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables written inside, once what was made of them is a result()."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: Rows of keys (a few longs each) that are small enough to send to every executor.
BROADCAST_ROWS = 500_000


def keys_of(keys: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of keys, marked for broadcast if its counted rows stay within the bound; else joined by shuffle."""
    return F.broadcast(keys) if keys.count() <= bound else keys


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys are equal; the keys of the left side stay."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"_right_{k}"]) for k in keys]
    return left.join(right, on, how).drop(*[f"_right_{k}" for k in keys])


def binary_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string or binary column as binary without nulls (null: empty)."""
    col = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_binary(col.type):
        col = col.cast(pa.binary())
    return pc.fill_null(col, b"") if col.null_count else col


def text_blocks(batch: pa.RecordBatch, name: str, max_bytes: int = 1 << 20) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Cuts a batch into runs of rows of about max_bytes: (rows, their bytes, row offsets in these bytes).
    A row longer than max_bytes is a run of its own, so memory is bounded by the longest text."""
    col = binary_column(batch, name)
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
        yield slice(i, j), data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes: each input bit reaches each output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(33))
    h = h * _M2
    return h ^ (h >> np.uint64(33))


#: An odd base, its inverse modulo 2**64, and a seed for the table of byte values.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BYTE_SEED = 20240607


class Rolling:
    """Polynomial hashes modulo 2**64 of substrings, with random byte values; all substrings of a text in a few passes."""

    def __init__(self) -> None:
        self.values = np.random.default_rng(BYTE_SEED).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 1 << 20)
            for name, base in (("power", BASE), ("inverse", BASE_INVERSE)):
                x = np.full(n, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """c with c[i] = sum of value * BASE**position before i."""
        self._grow(len(data) + 1)
        c = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[: len(data)], out=c[1:])
        return c

    def spans(self, c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (c[end] - c[start]) * self.inverse[start]

    def windows(self, c: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all windows of k bytes, by their start."""
        n = len(c) - k
        return (c[k:] - c[:n]) * self.inverse[:n] if n > 0 else np.empty(0, np.uint64)
