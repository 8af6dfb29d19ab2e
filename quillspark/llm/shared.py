"""Helpers shared by the operators: staged blocks of a table, blobs of sorted integers, words.

Several operators read every text more than once and need, for each part of the input, a small
answer computed from the whole input.  They stage the input once as Parquet files in the shared
checkpoint folder; each file is a *block*.  Tasks read their block with pyarrow, and only compact
side data (sorted integers, counts) is shuffled.  A lost executor costs a re-read of its blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.session import scratch_dir

#: Java form of "white space" in word definitions: space and \t..\r only.
SPACES = r"[\x20\x09-\x0D]+"
#: Texts are taken from Arrow in batches of this many rows, so that a batch of long texts fits.
ROWS = 512


def word_array(text):
    """Column: the words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def ascii_lower(text):
    """Column: A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder or file of the shared storage."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def stage(df: DataFrame, name: str, compression: str | None = None) -> str:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir``; returns the folder."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lineage cut that outlives executors."""
    path = stage(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(df: DataFrame, name: str, compression: str | None = None) -> Iterator[DataFrame]:
    """``df`` written and read back as ``cut`` does, for the steps inside only: its files go at the end."""
    path = stage(df, name, compression)
    yield df.sparkSession.read.schema(df.schema).parquet(path)
    where, folder = filesystem(path)
    where.delete_dir(folder)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, what a write shuffled leaves the executors' disks as the write ends, not with the driver's
    next garbage collection."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row ``block`` (the file's path) for each staged file."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return found.select(F.col("path").alias("block"))


def read_block(block: str, columns: list[str]) -> Iterator[dict[str, list]]:
    """The rows of a staged file, as columns of Python values, a few rows at a time."""
    where, path = filesystem(block)
    with where.open_input_file(path) as f:
        for batch in pq.ParquetFile(f, pre_buffer=False, buffer_size=1 << 20).iter_batches(ROWS, columns=columns):
            yield {c: batch.column(c).to_pylist() for c in columns}


def planes(values: np.ndarray) -> bytes:
    """64-bit integers as byte planes, low ones first, without the high planes that are all zero."""
    values = np.ascontiguousarray(values, np.uint64)
    used = (int(values.max(initial=0)).bit_length() + 7) // 8
    return len(values).to_bytes(8, "little") + np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :used].T).tobytes()


def unplanes(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    out = np.zeros((n, 8), np.uint8)
    if n:
        found = np.frombuffer(blob, np.uint8, offset=8).reshape(-1, n)
        out[:, : len(found)] = found.T
    return out.view(np.uint64).ravel()


def pack(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as byte planes of their differences."""
    values = np.ascontiguousarray(values, np.uint64)
    if not len(values):
        return planes(values)
    # The first value travels apart: it would need planes that the differences don't.
    return int(values[0]).to_bytes(8, "little") + planes(np.diff(values))


def unpack(blob: bytes) -> np.ndarray:
    if len(blob) == 8:
        return np.zeros(0, np.uint64)
    steps = np.concatenate([np.frombuffer(blob, np.uint64, 1), unplanes(blob[8:])])
    return np.cumsum(steps, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x9E3779B97F4A7C15
_SEGMENT = 1 << 20
LONG_WORD = 256
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n (base is odd)."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = 1 << max(16, n.bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS[base] = (both[0], both[1])
    return _POWERS[base]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of the words of a text, by prefix sums over its bytes; words of over
    ``LONG_WORD`` bytes, for which sums modulo 2**64 can be made to agree, by a hash of their bytes.

    The text is taken in segments that end at white space, so memory does not follow its length."""
    whole = np.frombuffer(data, np.uint8)
    values = mix(np.arange(1, 257, dtype=np.uint64))
    starts, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(whole):
        to = min(len(whole), at + _SEGMENT)
        while to < len(whole) and not _SPACE[whole[to]]:
            to += 1
        part = whole[at:to]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = ~_SPACE[part]
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = powers(_BASE, len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * up[: len(part)], dtype=np.uint64, out=sums[1:])
        starts.append(start + at)
        own = mix((sums[end] - sums[start]) * down[start])
        for i in np.flatnonzero(end - start > LONG_WORD).tolist():
            own[i] = xxhash.xxh3_64_intdigest(part[start[i] : end[i]].tobytes())
        hashes.append(own)
        at = to
    return np.concatenate(starts), np.concatenate(hashes)


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` for a generator over rows: ``function`` gets dicts of Python values."""
    from pyspark.sql.types import StructType

    target = StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(target)

    def run(batches):
        def rows():
            for batch in batches:
                names = batch.schema.names
                for i in range(batch.num_rows):
                    yield {n: batch.column(n)[i].as_py() for n in names}

        pending, weight = [], 0
        for row in function(rows()):
            pending.append(row)
            weight += 64 + sum(len(v) for v in row if isinstance(v, (bytes, str, list)))
            if weight > 4 << 20 or len(pending) >= 4096:
                yield _batch(pending, arrow_schema)
                pending, weight = [], 0
        if pending:
            yield _batch(pending, arrow_schema)

    return df.mapInArrow(run, target)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def split_ranges(values: np.ndarray, ranges: int) -> list[tuple[int, int, int]]:
    """(range, from, to) of ascending 64-bit ``values``, by their leading bits; ranges is 2**k."""
    if ranges == 1:
        return [(0, 0, len(values))] if len(values) else []
    step = np.uint64((1 << 64) // ranges)
    edges = np.searchsorted(values, np.arange(1, ranges, dtype=np.uint64) * step).tolist()
    return [(r, a, b) for r, (a, b) in enumerate(zip([0, *edges], [*edges, len(values)])) if b > a]


def gather(df: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """One row for each group, its rows as the list ``found`` (a block's or a range's small parts)."""
    return df.groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias("found"))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    at = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
    return keys[at], np.add.reduceat(counts, at)
