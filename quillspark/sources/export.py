"""Own sources and sinks as Spark data sources (survey §2.10, W2, K9).

``landed_export`` reads and writes a folder of Parquet files in a shared store, landing by landing:

* as a batch source, one partition for each file;
* as a stream, whose offset is the path of the last file taken in: files land in the order of their
  paths (``landing=0001/...``), so a run that starts anew goes on after the offset kept in its
  checkpoint (W2), whatever was read before;
* as a sink, each task writes one file of the landing that the option ``landing`` names, in row groups
  bounded in bytes, so that a task that reads it holds a bounded part; the
  commit writes ``_summary.json`` beside them (K9): what was written, from the tasks' own counts.  A
  run that fails leaves no file of its landing.

Register it with ``spark.dataSource.register(LandedExport)``; options: ``path``, and ``landing`` to write.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.types import StructType

SUMMARY = "_summary.json"
#: Bytes of a row group as it is written, and of a batch as it is read.
GROUP = 8 << 20


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def landed_files(path: str) -> list[str]:
    """Paths of the data files below ``path``, relative to it and in order."""
    store, root = _store(path)
    found = store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    names = [posixpath.relpath(f.path, root) for f in found if f.type == pafs.FileType.File and f.path.endswith(".parquet")]
    return sorted(n for n in names if not any(part.startswith(("_", ".")) for part in n.split("/")))


@dataclass
class ExportFile(InputPartition):
    path: str
    name: str


def _read(partition: ExportFile, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    store, root = _store(partition.path)
    with store.open_input_file(f"{root}/{partition.name}") as f:
        file = pq.ParquetFile(f, buffer_size=1 << 20, pre_buffer=False)
        for i in range(file.num_row_groups):
            group = file.metadata.row_group(i)
            rows = max(1, min(4096, group.num_rows * GROUP // max(1, group.total_byte_size)))
            for batch in file.iter_batches(rows, row_groups=[i], columns=schema.names, use_threads=False):
                yield batch.cast(schema) if batch.schema != schema else batch


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of at most ``GROUP`` bytes, or of one row."""
    if batch.num_rows < 2 or batch.nbytes <= GROUP:
        yield batch
        return
    half = batch.num_rows // 2
    yield from _parts(batch.slice(0, half))
    yield from _parts(batch.slice(half))


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: pa.Schema):
        self.path, self.schema = path, schema

    def partitions(self) -> list[InputPartition]:
        return [ExportFile(self.path, name) for name in landed_files(self.path)]

    def read(self, partition: ExportFile) -> Iterator[pa.RecordBatch]:
        return _read(partition, self.schema) if partition is not None else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: pa.Schema):
        self.path, self.schema = path, schema

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        names = landed_files(self.path)
        return {"after": names[-1] if names else ""}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [ExportFile(self.path, n) for n in landed_files(self.path) if start["after"] < n <= end["after"]]

    def read(self, partition: ExportFile) -> Iterator[pa.RecordBatch]:
        return _read(partition, self.schema) if partition is not None else iter(())


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, landing: str, overwrite: bool):
        self.path, self.landing, self.overwrite = path, landing, overwrite
        if overwrite:
            raise ValueError("an export is appended to, landing by landing")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _store(self.path)
        name, rows, out = f"{self.landing}/part-{uuid.uuid4().hex}.parquet", 0, None
        store.create_dir(f"{root}/{self.landing}", recursive=True)
        hidden = f"{root}/{posixpath.dirname(name)}/_{posixpath.basename(name)}"  # not a data file before the commit
        for batch in iterator:
            out = out or pq.ParquetWriter(hidden, batch.schema, filesystem=store)
            for part in _parts(batch):
                out.write_batch(part)
            rows += batch.num_rows
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        done = [m for m in messages if m is not None and m.name]
        for m in done:
            store.move(f"{root}/{posixpath.dirname(m.name)}/_{posixpath.basename(m.name)}", f"{root}/{m.name}")
        summary = {"destination_format": "PARQUET", "landing": self.landing, "files": len(done),
                   "records_synced_this_run": sum(m.rows for m in done), "status": "success"}
        store.create_dir(f"{root}/{self.landing}", recursive=True)
        with store.open_output_stream(f"{root}/{self.landing}/{SUMMARY}") as f:
            f.write(json.dumps(summary).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        for m in messages:
            if m is not None and m.name:
                store.delete_file(f"{root}/{posixpath.dirname(m.name)}/_{posixpath.basename(m.name)}")


class LandedExport(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_export"

    def schema(self) -> StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        names = landed_files(self.options["path"])
        if not names:
            raise ValueError(f"{self.options['path']} holds no files: give the schema")
        store, root = _store(self.options["path"])
        with store.open_input_file(f"{root}/{names[0]}") as f:
            return from_arrow_schema(pq.read_schema(f), prefer_timestamp_ntz=False)

    def _arrow(self, schema: StructType) -> pa.Schema:
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self._arrow(schema))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"], self._arrow(schema))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options.get("landing", "landing"), overwrite)


def read_summary(path: str, landing: str) -> dict:
    """K9 of one landing."""
    store, root = _store(path)
    with store.open_input_stream(f"{root}/{landing}/{SUMMARY}") as f:
        return json.loads(f.read())
