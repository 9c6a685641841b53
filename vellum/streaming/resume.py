"""Incremental correction: committed work is never done again, however often a run stops."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable
from datetime import datetime, timezone
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vellum.sources.storage import Storage

Stage = Callable[[DataFrame], DataFrame]


def apply_stages(df: DataFrame, stages: list[tuple[str, Stage]]) -> DataFrame:
    """Run stages in order, with the length of the text before the first."""
    df = df.withColumn("original_len", F.length("text"))
    for _, stage in stages:
        df = stage(df)
    return df


def start(
    spark: SparkSession, source: str, schema: str, progress: str, checkpoint: str, stages: list[tuple[str, Stage]],
    files_per_batch: int = 1, interval: str | None = None, sink: SnapshotSink | None = None,
) -> StreamingQuery:
    """Correct rows as files of ``source`` (Parquet) arrive, and append them to ``progress``.

    A batch is written to a folder of its own number and replaces what a broken-off attempt left
    there, so a restart repeats no row and loses none. Without an interval the run ends when all
    that is there has been corrected.
    """

    def commit(batch: DataFrame, number: int) -> None:
        apply_stages(batch, stages).write.mode("overwrite").parquet(f"{progress}/batch={number}")
        if sink is not None:
            sink.push(progress)

    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    writer = reader.parquet(source).writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def committed(spark: SparkSession, progress: str) -> DataFrame:
    """What has been corrected: the last batch wins where a key occurs twice."""
    rows = spark.read.option("basePath", progress).parquet(progress)
    latest = F.max_by(F.struct(*(c for c in rows.columns if c != "row_idx")), "batch")
    return rows.groupBy("row_idx").agg(latest.alias("r")).select("row_idx", "r.*")


def late_tolerant_counts(events: DataFrame, ts: str, every: str = "12 hours", lateness: str = "1 hour") -> DataFrame:
    """Commits for each snapshot interval of a stream, with late rows up to a bound."""
    return events.withWatermark(ts, lateness).groupBy(F.window(ts, every)).count()


class RunState:
    """The manifest of a run: progress counts only while its settings stay the same.

    It lies beside the progress, on the file system that the folder's path names.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.storage, self.folder = Storage(spark), folder.rstrip("/")
        self.path = f"{self.folder}/state.json"

    def save(self, config_hash: str, total_rows: int, row_start: int, row_end: int | None) -> None:
        state = {
            "config_hash": config_hash,
            "total_rows": total_rows,
            "row_start": row_start,
            "row_end": row_end,
            "last_updated": datetime.now(timezone.utc).isoformat(),
        }
        self.storage.write(self.path, json.dumps(state))

    def valid(self, config_hash: str) -> bool:
        """Whether progress may be used; progress of other settings, or without a readable state,
        is wiped."""
        try:
            same = json.loads(self.storage.read(self.path))["config_hash"] == config_hash if self.storage.exists(self.path) else False
        except (ValueError, KeyError, TypeError):
            same = False
        if not same:
            self.cleanup()
        return same

    def cleanup(self) -> None:
        self.storage.delete(self.folder)


class SnapshotSink(Protocol):
    def push(self, output: str) -> bool: ...


class FolderSnapshots:
    """Versioned copies in a folder of any file system: what stands in for a snapshot hub."""

    def __init__(self, spark: SparkSession, target: str, clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)):
        self.storage, self.target, self.clock, self.messages = Storage(spark), target.rstrip("/"), clock, []

    def push(self, output: str) -> bool:
        """Copy the output; a missing output is skipped, and a failure is noted, not raised."""
        try:
            if not self.storage.exists(output):
                return False
            number = len([n for n in self.storage.names(self.target) if n.startswith("v")])
            self.storage.copy(output, f"{self.target}/v{number:06d}")
            self.messages.append(f"Snapshot {self.clock():%Y-%m-%d %H:%M} UTC")
            return True
        except Exception as e:  # a snapshot must never end the run that it is taken of
            self.messages.append(f"failed: {e}")
            return False


class HubSnapshots:
    """Pushes of the output to a dataset repository, whose history is the row of snapshots.

    ``api`` makes repositories and takes files as the client of the public hub does; without one
    that client is looked for when the first snapshot is due.
    """

    def __init__(self, spark: SparkSession, repository: str, token: str, api=None, clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)):
        if not token:
            raise ValueError("a hub token is needed")
        self.storage, self.repository, self.token, self.api = Storage(spark), repository, token, api
        self.clock, self.messages = clock, []

    def push(self, output: str) -> bool:
        """Upload the data files, one at a time; a missing output is skipped, a failure noted."""
        try:
            if not self.storage.exists(output):
                return False
            if self.api is None:
                self.api = importlib.import_module("huggingface_hub").HfApi(token=self.token)
            self.api.create_repo(repo_id=self.repository, repo_type="dataset", exist_ok=True)
            message = f"Snapshot {self.clock():%Y-%m-%d %H:%M} UTC"
            name = output.rstrip("/").rsplit("/", 1)[-1]
            for number, part in enumerate(self.storage.parts(output)):
                self.api.upload_file(
                    path_or_fileobj=self.storage.read_bytes(part),
                    path_in_repo=name if part == output else f"{name}/part-{number:05d}.csv",
                    repo_id=self.repository,
                    repo_type="dataset",
                    commit_message=message,
                )
            self.messages.append(message)
            return True
        except Exception as e:  # as above
            self.messages.append(f"failed: {e}")
            return False


class SnapshotSchedule:
    """Pushes after each interval, and once more at the end. Time comes from outside."""

    def __init__(self, sink: SnapshotSink, output: str, hours: float = 12.0):
        self.sink, self.output, self.every = sink, output, hours * 3600
        self.due: float | None = None

    def tick(self, now: float) -> bool:
        if self.due is None:
            self.due = now + self.every
        if now < self.due:
            return False
        self.due = now + self.every
        return self.sink.push(self.output)

    def stop(self) -> bool:
        return self.sink.push(self.output)
