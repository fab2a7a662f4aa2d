"""Topics to an archive."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from relayframe.operators.archive import CHUNK_OFFSETS, to_archive_rows
from relayframe.sources.archive_commits import ArchiveLog
from relayframe.sources.archive_files import write_archive
from relayframe.streaming.triggers import every


@dataclass
class ArchiveSink:
    """Writes log batches to an archive; call it from ``foreachBatch`` or directly.

    Buckets come from record times, so late records join their own old bucket as new chunks; there
    is no watermark. A retried batch fills the same chunk directories and replaces them. The driver
    moves those one by one, so for batches of very many chunks ``replace=False`` is faster; a retry
    then leaves copies, which restoring and compacting remove. With ``commits`` the root is an
    ``ArchiveLog``: a batch counts once it is committed, once, and nothing is moved.
    """

    root: str
    interval: str | int | timedelta = "1h"
    chunk_offsets: int = CHUNK_OFFSETS
    partitions: int | None = None
    binary: str = "text"
    keep_nulls: bool = False
    keep_timestamp: bool = False
    replace: bool = True
    commits: bool = False

    def __call__(self, batch: DataFrame, batch_id: int = 0, run: str | None = None) -> None:
        rows = to_archive_rows(batch, self.interval, self.binary, self.keep_nulls, self.keep_timestamp)
        if self.commits:
            run = run or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
            ArchiveLog(self.root).append(rows, run, batch_id, self.chunk_offsets, self.partitions)
            return
        write_archive(rows, self.root, self.chunk_offsets, self.partitions, self.replace)


def start_archive_sink(
    log: DataFrame, sink: ArchiveSink, checkpoint: str, timeout: str | None = "5s"
) -> StreamingQuery:
    return (
        log.writeStream.foreachBatch(lambda batch, batch_id: sink(batch, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**every(timeout))
        .start()
    )
