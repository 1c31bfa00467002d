"""Shared helpers: written intermediate tables and vectorised word hashing.

Text is processed as Arrow batches inside Spark tasks. Words are runs of
non-separator bytes; every separator of the word classes used here is ASCII,
so byte runs and code-point runs agree in UTF-8. A word (or any byte span)
is identified by a 64-bit hash: a seeded random value per byte, summed with
the powers of an odd base and finalised with the length. Work memory is a
fixed number of bytes per block of text, whatever the text's length.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

BLOCK = 1 << 20          # bytes hashed at a time
SLICE_BYTES = 4 << 20    # text bytes handed to one vectorised step
WORD_SLICE_BYTES = 1 << 20  # the same for steps whose arrays of words take many bytes a byte of text
BATCH_BYTES = 16 << 20   # Arrow batch bound between JVM and Python
BATCH_ROWS = 2000

_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
MASK = (1 << 64) - 1


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors once per application (``addPyFile``: the driver
    serves the archive), so that tasks can import it wherever the driver was started."""
    sc = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if getattr(sc, "_occurlens_shipped", False) or not os.path.isdir(package):
        return
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="occurlens-")), "occurlens-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._occurlens_shipped = True


def bound_batches(spark: SparkSession) -> None:
    """Called before any Python stage: ships the package, and bounds the Arrow batches sent to
    Python by rows and bytes, so that a run of very long texts cannot fill a worker's memory."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared work folder and read it back:
    lineage ends there, and what it holds (row numbers included) is fixed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame) -> DataFrame:
    """A row number column; fixed only once the frame has been written."""
    return df.withColumn("row_id", F.monotonically_increasing_id())


FILTER_WORDS = 18  # log2 of the 64-bit words of a row filter


def split_by(rows: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose ``on`` columns certainly do not occur in ``keys``, and the
    others (all that occur, few that do not). A join with ``keys`` then needs the second part only,
    so wide rows that have no partner are not shuffled. The one-hash filter has a fixed size:
    at most 2 ** FILTER_WORDS words are broadcast, whatever the input; once it is full, the
    second part is all rows and the join is as exact as before."""
    h = F.xxhash64(*on)
    place = F.shiftright(h, 6).bitwiseAND((1 << FILTER_WORDS) - 1).cast("int")
    bit = h.bitwiseAND(63).cast("int")
    words = keys.groupBy(place.alias("__at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("__bits"))
    marked = (rows.withColumn("__place", place).join(F.broadcast(words), F.col("__place") == F.col("__at"), "left")
              .withColumn("__maybe", F.coalesce(F.call_function("shiftright", F.col("__bits"), bit).bitwiseAND(1) == 1, F.lit(False))))
    out = [F.col(f"`{c}`") for c in rows.columns]
    return marked.filter(~F.col("__maybe")).select(*out), marked.filter("__maybe").select(*out)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_PW = _powers(BASE, BLOCK + 1)
_IPW = _powers(BASE_INV, BLOCK + 1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans ``[starts, ends)`` of ``data``; both sorted,
    spans do not overlap. Worked off in blocks, so memory is bounded."""
    g_start = np.zeros(len(starts), np.uint64)
    g_end = np.zeros(len(ends), np.uint64)
    inv = np.zeros(len(starts), np.uint64)
    carry, scale, iscale = 0, 1, 1
    for lo in range(0, max(len(data), 1), BLOCK):
        part = data[lo:lo + BLOCK]
        n = len(part)
        prefix = np.empty(n + 1, np.uint64)
        prefix[0] = 0
        np.cumsum(BYTE_VALUES[part] * _PW[:n], out=prefix[1:])
        a, b = np.searchsorted(starts, [lo, lo + BLOCK])
        rel = starts[a:b] - lo
        g_start[a:b] = np.uint64(carry) + np.uint64(scale) * prefix[rel]
        inv[a:b] = np.uint64(iscale) * _IPW[rel]
        a, b = np.searchsorted(ends, [lo + 1, lo + BLOCK + 1])
        g_end[a:b] = np.uint64(carry) + np.uint64(scale) * prefix[ends[a:b] - lo]
        carry = (carry + scale * int(prefix[n])) & MASK
        scale = scale * pow(BASE, BLOCK, 1 << 64) & MASK
        iscale = iscale * pow(BASE_INV, BLOCK, 1 << 64) & MASK
    length = (ends - starts).astype(np.uint64)
    return mix((g_end - g_start) * inv + length * np.uint64(0x2545F4914F6CDD1D))


def sequence_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries (order-sensitive)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = np.full(n, (k * 0xD6E8FEB86659FD93) & MASK, np.uint64)
    for j in range(k):
        g = (g ^ hashes[j:j + n]) * np.uint64(BASE)
        g ^= g >> np.uint64(29)
    return mix(g)


def byte_classes(separators: bytes, lower: bool) -> np.ndarray:
    """Per byte: 0 for a separator, else the byte (A-Z lowered on request)."""
    lut = np.arange(256, dtype=np.uint8)
    if lower:
        lut[65:91] += 32
    lut[list(separators)] = 0
    return lut


SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])
#: words ``[^\x20\x09-\x0D]+``; byte 0 is a word byte here, so it maps to 1's class by itself
PLAIN = byte_classes(SPACE_BYTES, lower=False)
LOWER = byte_classes(SPACE_BYTES, lower=True)
PLAIN[0] = LOWER[0] = 0xFF  # byte 0xFF never occurs in UTF-8
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lowering A-Z: ASCII letters, digits, non-ASCII
ALNUM = byte_classes(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)


class Texts:
    """The bytes of a slice of texts (null counts as empty)."""

    def __init__(self, column: pa.Array):
        arr = pc.fill_null(column.cast(pa.large_string()), "")
        off = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, arr.offset * 8) if len(arr) else np.zeros(1, np.int64)
        buf = arr.buffers()[2]
        raw = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
        self.data = raw[off[0]:off[-1]]
        self.offsets = off - off[0]
        self.n = len(arr)


class Words:
    """Words of a slice of texts: byte spans, hashes, first word of each text."""

    def __init__(self, texts: Texts, classes: np.ndarray):
        data = classes[texts.data]
        inside = data != 0
        edge = np.zeros(len(data) + 1, bool)  # a text starts here
        edge[texts.offsets] = True
        before = np.concatenate(([False], inside))
        after = np.concatenate((inside, [False]))
        self.starts = np.flatnonzero(after & (~before | edge))
        self.ends = np.flatnonzero(before & (~after | edge))
        self.hashes = span_hashes(data, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, texts.offsets)  # n + 1 entries
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(texts.n), self.counts)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(start word, hash) of every run of k words inside one text."""
        g = sequence_hash(self.hashes, k)
        if not len(g):
            return np.zeros(0, np.int64), g
        at = np.flatnonzero(self.doc[:len(g)] == self.doc[k - 1:])
        return at, g[at]


def text_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A text column, or a field of a struct column (``struct.field``)."""
    outer, _, field = column.partition(".")
    return pc.struct_field(batch.column(outer), [field]) if field else batch.column(outer)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``limit`` text bytes (a single
    longer text comes alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(text_of(batch, column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(size, dtype=np.int64) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def list_array(values: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    """A list column from flat values and the length of each list."""
    off = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), values if isinstance(values, pa.Array) else pa.array(values))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def vector_rows(vector: np.ndarray, parts: int) -> pa.RecordBatch:
    """A vector of sums as ``parts`` rows (part, packed float64 slice)."""
    cut = [s.astype(np.float64).tobytes() for s in np.array_split(vector.ravel(), parts)]
    return pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array(cut, pa.binary())], names=["part", "data"])


def sum_vectors(rows: DataFrame, parts: int) -> np.ndarray | None:
    """Sum of the vectors that tasks emitted with ``vector_rows``: each slice is summed in a
    task of its own, one row at a time; only the one summed vector reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
                v = np.frombuffer(data, np.float64)
                total[part] = total[part] + v if part in total else v
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                         names=["part", "data"])

    got = {r["part"]: r["data"] for r in rows.repartition(parts, "part").mapInArrow(run, "part int, data binary").collect()}
    return np.concatenate([np.frombuffer(got[p], np.float64) for p in range(parts)]) if got else None
