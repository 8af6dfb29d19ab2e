"""The export's tasks hold parts bounded in bytes, whatever the rows' length."""

import os

import pyarrow as pa
import pyarrow.parquet as pq

from quillspark.sources.export import GROUP, ExportFile, _read, _Writer


def batch(n, size):
    return pa.record_batch({"id": list(range(n)), "text": [os.urandom(size // 2).hex() for _ in range(n)]})


def test_row_groups_are_bounded_in_bytes(tmp_path):
    given = batch(50, GROUP // 16)
    done = _Writer(str(tmp_path), "landing=0001", False)
    message = done.write(iter([given, batch(1, 2 * GROUP)]))
    done.commit([message])
    meta = pq.ParquetFile(tmp_path / message.name).metadata
    sizes = [(meta.row_group(i).num_rows, meta.row_group(i).total_byte_size) for i in range(meta.num_row_groups)]
    assert message.rows == sum(n for n, _ in sizes) == 51
    assert all(n == 1 or size <= 1.1 * GROUP for n, size in sizes) and len(sizes) > 4
    back = pa.Table.from_batches(_read(ExportFile(str(tmp_path), message.name), given.schema))
    assert back.slice(0, 50).to_pydict() == given.to_pydict()


def test_a_large_row_group_is_read_in_bounded_batches(tmp_path):
    given = batch(64, GROUP // 16)
    pq.write_table(pa.Table.from_batches([given]), tmp_path / "one.parquet")
    got = list(_read(ExportFile(str(tmp_path), "one.parquet"), given.schema))
    assert len(got) >= 4 and max(b.nbytes for b in got) <= 1.1 * GROUP
    assert pa.Table.from_batches(got).to_pydict() == given.to_pydict()
