"""Helpers shared by the text operators: code shipping, stored
intermediates and whole-batch word hashing on Arrow buffers.

Text work runs on the UTF-8 buffer of an Arrow column, a bounded number
of bytes at a time (``CHUNK_BYTES``, or one document if that is longer),
so a task's memory does not grow with its input.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

CHUNK_BYTES = 1 << 19

#: fixed values: odd multipliers of the polynomial and mixing hashes
_R = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_R_INV = pow(_R, -1, 1 << 64)

#: ASCII white space: space and \t \n \v \f \r
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so tasks can
    import it wherever the driver was started. It stands in the archive as a
    regular package: Python finds no package in an archive by folder alone."""
    sc = spark.sparkContext
    if getattr(sc, "_paddock_llm_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="paddock-ship-"), "paddock_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        files = [os.path.join(at, f) for at, _, names in os.walk(top) for f in names if f.endswith(".py")]
        names = {os.path.join("paddock", os.path.relpath(f, top)): f for f in files}
        names.setdefault(os.path.join("paddock", "__init__.py"), None)
        for name, f in sorted(names.items()):
            z.write(f, name) if f else z.writestr(name, "")
    sc.addPyFile(path)
    sc._paddock_llm_shipped = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it
    back: cuts lineage, survives lost executors, computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; then what the task no longer uses goes back to the system,
    as a Python worker lives on beside the workers of later stages."""
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def text_table(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` (long), ``text`` (string) and the columns ``extra``; other
    columns, whatever their names, are left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with as many ``_`` behind it as make it new to ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def buffer_of(col: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
        kind = np.int32
    else:
        kind = np.int64
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, kind, n + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    buf = np.frombuffer(data, np.uint8, off[-1] - off[0], off[0])
    return buf, off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def text_chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for bounded parts of a batch."""
    buf, off = buffer_of(batch.column(batch.schema.get_field_index(column)))
    for i, j in chunks(off):
        yield slice(i, j), buf[off[i] : off[j]], off[i : j + 1] - off[i]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int, base: int, keep: dict = {}) -> np.ndarray:  # noqa: B006 (per-process table)
    have = keep.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        p[0] = 1
        keep[base] = have = np.cumprod(p)
        if n > 8 * CHUNK_BYTES:
            keep.pop(base)
    return have[:n]


def _byte_table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_R) + np.uint64(seed))


_T = {0: _byte_table(0), 1: _byte_table(0x51ED27)}


def prefix_hash(buf: np.ndarray, seed: int = 0) -> np.ndarray:
    """n + 1 prefix values from which ``span_hash`` takes any span's hash."""
    x = _T[seed][buf]
    x *= _powers(len(buf), _R)
    out = np.empty(len(buf) + 1, np.uint64)
    out[0] = 0
    np.cumsum(x, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each [start, end); depends on content only."""
    h = prefix[ends] - prefix[starts]
    h *= _powers(len(prefix), _R_INV)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(_R))


class Words:
    """The words of a chunk: byte spans, the row of each, hashes, and
    ``first`` (n + 1): the words of row r are first[r] .. first[r + 1]."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, fold: bool = False, delim: np.ndarray = SPACE, cut: np.ndarray | None = None):
        """fold: A-Z as a-z; cut: places where a word ends and the next begins."""
        if fold:
            buf = FOLD[buf]
        self.buf, self.off = buf, off
        n = len(buf)
        inside = ~delim[buf]
        begin = inside.copy()
        end = inside.copy()
        if n:
            begin[1:] &= ~inside[:-1]
            end[:-1] &= ~inside[1:]
            if cut is not None:
                begin |= cut & inside
                end[:-1] |= cut[1:] & inside[:-1]
            edge = off[:-1][off[:-1] < off[1:]]
            begin[edge] = inside[edge]
            edge = edge[edge > 0] - 1
            end[edge] = inside[edge]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, off)
        self.row = np.repeat(np.arange(len(off) - 1), np.diff(self.first))
        self.prefix = prefix_hash(buf)
        self.h = span_hash(self.prefix, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values (len(h) - size + 1)."""
    m = len(h) - size + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    mult = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_R)) | np.uint64(1)
    out = np.zeros(m, np.uint64)
    for k in range(size):
        out += h[k : k + m] * mult[k]
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
