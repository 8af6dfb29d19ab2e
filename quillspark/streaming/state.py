"""Sync state that a stream carries (survey W3, J4, I1-I3).

A run over landed files needs to know what earlier runs saw.  As a stream, that knowledge is keyed state
in the stream's checkpoint: it is there again after a restart, and it goes by itself when its time is
over, so it grows with the keys alive and not with the history.

* ``unseen``: rows whose key was not seen before (commit shas); built in, on the JVM.
* ``lookups``: each row gets the state entry of its key and writes it anew with a lifetime; the answer
  is whether the entry was there and not expired.  Time is the rows' own, so a run gives the same
  answers whenever it is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillspark.operators.state import DEFAULT_TTL_SECONDS


def unseen(stream: DataFrame, key: str, event_time: str, remembered: str = "365 days") -> DataFrame:
    """W3 / J4 on a stream: the first row of each key.  A key is remembered until the stream's time is
    ``remembered`` past it; rows that come later than that are dropped as late."""
    return stream.withWatermark(event_time, remembered).dropDuplicatesWithinWatermark([key])


def lookups(stream: DataFrame, key: str, event_time: str, row_id: str, ttl_seconds: float = DEFAULT_TTL_SECONDS,
            late: str = "1 minute") -> DataFrame:
    """I1-I3 on a stream: (key, row_id, hit) of each row.  The row reads its key's entry (``hit``: there
    is one with ``time < expires_at``, strictly), then writes it with ``expires_at = time + ttl``.

    Rows of a key are taken by time, then id, within a micro-batch; files should arrive in the order
    of time, with rows up to ``late`` behind.  An entry whose time is over is removed by the stream's
    clock.  Rows without a key or time are dropped.  A key's rows of one micro-batch are held as two
    whole numbers each; ``maxFilesPerTrigger`` of the source bounds them."""
    ttl = int(ttl_seconds * 1_000_000)
    timed = stream.where(F.col(key).isNotNull() & F.col(event_time).isNotNull()).withWatermark(event_time, late)
    rows = timed.select(F.col(key).cast("string").alias("key"), F.col(row_id).cast("bigint").alias("id"),
                        F.unix_micros(event_time).alias("t"), event_time)

    def answer(found: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        mine = pd.concat([b[["t", "id"]] for b in batches]).sort_values(["t", "id"], kind="stable")
        expires: Any = state.get[0] if state.exists else None
        hits = []
        for t in mine["t"].tolist():
            hits.append(expires is not None and t < expires)
            expires = max(t + ttl, expires or 0)
        state.update((expires,))
        # Removed once no row that may still come can find it alive; the clock only moves past now.
        state.setTimeoutTimestamp(max(expires // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": found[0], "id": mine["id"].to_numpy(), "hit": hits})

    return rows.groupBy("key").applyInPandasWithState(answer, "key string, id bigint, hit boolean", "expires_at bigint",
                                                      "append", GroupStateTimeout.EventTimeTimeout)


def run_available(result: DataFrame, out: str, checkpoint: str) -> None:
    """Take in what has landed since the last run, append the result to ``out`` and stop."""
    writer = result.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
