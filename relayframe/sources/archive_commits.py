"""Archives whose writes count as a whole: a folder of data for each attempt, and a log that names those that hold.

``data/attempt=/topic=/bucket=/...`` holds the chunks in the layout of ``archive_files``, ``commits/attempt=`` one
small file for each write that ended. Nothing is renamed, replaced or deleted: a retry, a killed writer, a reader
and a compaction that run at the same time do not meet, as each writes to folders of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe.functions import times
from relayframe.operators import archive
from relayframe.operators.compaction import MERGE_LIMIT
from relayframe.session import checkpointed
from relayframe.sources import archive_files as files

# What an attempt holds of a topic.
_PART = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("first_bucket", T.StringType()),
        T.StructField("last_bucket", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)
COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("parts", T.ArrayType(_PART)),
        # Attempts whose records this one holds instead.
        T.StructField("replaced", T.ArrayType(T.StringType())),
        T.StructField("attempt", T.StringType()),
    ]
)


@dataclass(frozen=True)
class ArchiveLog:
    """An archive under ``root``, changed by commits alone.

    A commit is one file, so a reader sees a write whole or not at all; what a reader has resolved stays as it is,
    since no file is ever replaced. Of several attempts at one batch of a run that have all been committed, as by two
    drivers that both believe to run a stream, the first by version and name holds. A commit names topics and
    buckets, so a restore from a date on lists only folders that reach into it. One compaction runs at a time, next to
    any number of sinks. Folders that no commit names, and those that a compaction replaced, are left
    in place for readers that still use them; delete them when those have ended.

    The log has a row for each batch; the driver resolves it to folder names, fewer than the files below them that
    Spark lists there anyhow.
    """

    root: str

    @property
    def data(self) -> str:
        return f"{self.root.rstrip('/')}/data"

    def commits(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """All commits, up to a version if one is given."""
        path = f"{self.root.rstrip('/')}/commits"
        try:
            found = spark.read.schema(COMMIT).option("basePath", path).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], COMMIT)
        return found if version is None else found.where(F.col("version") <= version)

    def live(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The commits that hold: one for each batch, without those that a compaction replaced."""
        known = self.commits(spark, version)
        first = known.groupBy("run", "batch_id").agg(F.min(F.struct("version", "attempt")).alias("first"))
        holding = known.join(first.select(F.col("first.attempt").alias("attempt")), "attempt", "left_semi")
        replaced = holding.select(F.explode("replaced").alias("attempt"))
        return holding.join(replaced, "attempt", "left_anti")

    def version(self, spark: SparkSession) -> int:
        """The last version; 0 before the first."""
        return self.commits(spark).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def folders(
        self,
        spark: SparkSession,
        topics: Sequence[str] | None = None,
        since: str | datetime | None = None,
        until: str | datetime | None = None,
        version: int | None = None,
    ) -> list[str]:
        """Folders to read for some topics and buckets, as ``folders`` of the functions that read an archive."""
        return self._folders(self.live(spark, version), topics, since, until)

    def _folders(self, live: DataFrame, topics=None, since=None, until=None) -> list[str]:
        parts = archive.of_topics(live.select("attempt", F.inline("parts")), topics)
        if since is not None:
            parts = parts.where(F.col("last_bucket") >= times.bucket_bound(since))
        if until is not None:
            parts = parts.where(F.col("first_bucket") <= times.bucket_bound(until))
        found = parts.select("attempt", "topic").distinct().orderBy("attempt", "topic").collect()
        return [f"{self.data}/attempt={row['attempt']}/topic={row['topic']}" for row in found]

    def is_committed(self, spark: SparkSession, run: str, batch_id: int) -> bool:
        return not self.commits(spark).where((F.col("run") == run) & (F.col("batch_id") == batch_id)).isEmpty()

    def append(
        self,
        rows: DataFrame,
        run: str,
        batch_id: int,
        chunk_offsets: int = archive.CHUNK_OFFSETS,
        partitions: int | None = None,
    ) -> bool:
        """Add archive rows as one batch of a run; a batch that is there already is left alone (gives False)."""
        spark = rows.sparkSession
        if self.is_committed(spark, run, batch_id):
            return False
        attempt = self._write(archive.by_offset_range(rows, chunk_offsets, partitions))
        self._commit(spark, attempt, run, batch_id, [])
        return True

    def compact(self, spark: SparkSession, limit: int = MERGE_LIMIT, partitions: int | None = None) -> bool:
        """Merge the small chunks of what is committed now; what sinks commit meanwhile stays beside it.

        Gives False if there is nothing to do: no commit, or one that a compaction wrote. A compaction whose
        commits another one has replaced in the meantime fails, and its folder is never read.
        """
        live = checkpointed(self.live(spark))
        held = {row["attempt"] for row in live.select("attempt").collect()}
        if not held or (len(held) == 1 and not live.where(F.size("replaced") > 0).isEmpty()):
            return False
        folders = self._folders(live)
        attempt = self._write(files.merged_chunks(spark, self.data, limit=limit, partitions=partitions, folders=folders))
        if held - {row["attempt"] for row in self.live(spark).select("attempt").collect()}:
            raise RuntimeError("another compaction has replaced what this one merged")
        self._commit(spark, attempt, f"compaction-{attempt}", 0, sorted(held))
        return True

    def _write(self, labelled: DataFrame) -> str:
        attempt = f"a{uuid.uuid4().hex}"
        files.write_attempt(labelled, f"{self.data}/attempt={attempt}")
        return attempt

    def _commit(self, spark: SparkSession, attempt: str, run: str, batch_id: int, replaced: list[str]) -> None:
        # From names of directories alone; a batch without records has none.
        folder = f"{self.data}/attempt={attempt}"
        has_records = "topic" in spark.read.format("binaryFile").load(folder).columns
        listed = files.list_archive(spark, self.data, folders=[folder] if has_records else [])
        part = listed.groupBy("topic").agg(
            F.min("bucket").alias("first_bucket"), F.max("bucket").alias("last_bucket"), F.sum("n_rows").alias("n_rows")
        )
        commit = part.agg(F.collect_list(F.struct(*_PART.names)).alias("parts")).select(
            F.lit(self.version(spark) + 1).cast("bigint").alias("version"),
            F.lit(run).alias("run"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            "parts",
            F.array(*map(F.lit, replaced)).cast("array<string>").alias("replaced"),
        )
        commit.coalesce(1).write.mode("errorifexists").parquet(f"{self.root.rstrip('/')}/commits/attempt={attempt}")
