"""The run ledger: events of files, and the commits that make them count.

An event says that a file was started (``A``), done (``I``) or refused by the
header gate (``R``). Nothing is updated in place: the state of a file follows
from its latest events. A file is a path with a length and a modification time,
so a new delivery under an old name is a new file.

Events are written to a folder of their own and count once a commit names it
(:mod:`martweave.sinks.commits`). The commit that marks files as done also names
the folders of the marts that hold them, so both become visible at once, and it
is refused when another run has committed since its base was read. Checkpoints
merge the event folders; reading the ledger is one checkpoint and the tail.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.contract import DONE, REFUSED, STARTED
from martweave.sinks.commits import CommitLog, Put, State, put_if_absent

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("file_location", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)
# As stored: with the version of the file.
STORED_SCHEMA = T.StructType(
    [*EVENT_SCHEMA.fields, T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType())]
)

log = logging.getLogger(__name__)


class UnfinishedRunError(RuntimeError):
    """Files of an earlier run are still marked as started."""


def file_states(events: DataFrame) -> DataFrame:
    """``(file_name, status, started, done)``: the current state of each file.

    A file is done when its last ``I`` is not older than its last ``A``. One hash
    aggregate; many events of one file are combined before the shuffle.
    """
    at = F.col("event_time")
    return (
        events.where(F.col("status").isin(STARTED, DONE))
        .groupBy("file_name")
        .agg(
            F.max(F.when(F.col("status") == STARTED, at)).alias("started"),
            F.max(F.when(F.col("status") == DONE, at)).alias("done"),
        )
        .withColumn(
            "status",
            F.when(F.col("started").isNull() | (F.col("done") >= F.col("started")), DONE).otherwise(STARTED),
        )
        .select("file_name", "status", "started", "done")
    )


def ledger_rows(events: DataFrame) -> DataFrame:
    """One row per started file and run: ``file_name, file_location, created_date, updated_date, status``.

    Marking a file as done closes all its earlier rows, so a row is done when
    the file's last ``I`` is not older than the row.
    """
    started = (
        events.where(F.col("status") == STARTED)
        .groupBy("file_name", "file_location", "run_id")
        .agg(F.min("event_time").alias("created_date"))
    )
    done = events.where(F.col("status") == DONE).groupBy("file_name").agg(F.max("event_time").alias("done"))
    closed = F.col("done") >= F.col("created_date")
    return started.join(done, "file_name", "left").select(
        "file_name",
        "file_location",
        "created_date",
        F.when(closed, F.col("done")).alias("updated_date"),
        F.when(closed, DONE).otherwise(STARTED).alias("status"),
    )


def unfinished(events: DataFrame, landed: DataFrame) -> DataFrame:
    """Names of ``landed(file_name)`` that a run has started and not finished."""
    open_files = file_states(events).where(F.col("status") == STARTED).select("file_name")
    return open_files.join(landed, "file_name", "left_semi")


class Ledger:
    """The events of all runs and the published state, kept below ``path``."""

    def __init__(self, spark: SparkSession, path: str, put: Put = put_if_absent, checkpoint_every: int = 20):
        self.spark = spark
        self.log = CommitLog(spark, path, put, checkpoint_every)

    def state(self, version: int | None = None) -> State:
        return self.log.state(version)

    def events(self, state: State | None = None) -> DataFrame:
        folders = list((state or self.state()).events)
        if not folders:
            return self.spark.createDataFrame([], STORED_SCHEMA)
        return self.spark.read.schema(STORED_SCHEMA).parquet(*folders)

    def _written(self, files: DataFrame, status: str, run_id: str) -> str:
        """A folder with one event per file of ``files(path, file_name)``, with its ``length`` and ``modified`` if given."""
        version = [F.col(c) if c in files.columns else F.lit(None) for c in ("length", "modified")]
        folder = f"{self.log.path}/events/{uuid.uuid4().hex}"
        files.select(
            "file_name",
            F.col("path").alias("file_location"),
            F.lit(run_id).alias("run_id"),
            F.lit(status).alias("status"),
            F.current_timestamp().alias("event_time"),
            version[0].cast("bigint").alias("length"),
            version[1].cast("timestamp").alias("modified"),
        ).write.parquet(folder)
        return folder

    def mark(self, files: DataFrame, status: str, run_id: str) -> State:
        """Commits one event per file, after whatever other runs have committed."""
        commit = {"run_id": run_id, "events": [self._written(files, status, run_id)], "finishes": status == DONE}
        return self._kept(self.log.commit(commit))

    def finish(
        self, base: State, files: DataFrame | None, run_id: str, change: Mapping[str, Mapping], finishes: bool = True
    ) -> State | None:
        """Marks ``files`` as done and publishes ``change`` in one commit after ``base``; None when that place is taken.

        ``change`` gives ``tables``, the folder of each part that is new (None: the part goes), their ``schemas``, and
        ``without``, for a new folder the folder that lists files whose rows in it do not count.
        """
        events = [] if files is None else [self._written(files, DONE, run_id)]
        commit = {"run_id": run_id, "events": events, "finishes": finishes, **change}
        return self._kept(base.after(commit)) if self.log.try_commit(base, commit) else None

    def _kept(self, state: State) -> State:
        self.log.compact(state, self._merge)
        return state

    def _merge(self, folders: tuple[str, ...], target: str) -> None:
        """Event folders as one: equal events of a run once, at their first and last time, near each other by path."""
        found = self.spark.read.schema(STORED_SCHEMA).parquet(*folders)
        keys = [c for c in STORED_SCHEMA.names if c != "event_time"]
        times = found.groupBy(*keys).agg(F.array_distinct(F.array(F.min("event_time"), F.max("event_time"))).alias("times"))
        events = times.select(*keys, F.explode("times").alias("event_time")).select(*STORED_SCHEMA.names)
        events.repartitionByRange("file_location").sortWithinPartitions("file_location").write.parquet(target)

    def compact(self) -> None:
        """Writes a checkpoint of the present state."""
        self.log.compact(self.state(), self._merge, force=True)

    def not_done(self, files: DataFrame, state: State | None = None) -> DataFrame:
        """Files whose present version no run has finished or refused.

        Without ``length`` and ``modified`` in ``files``, any version of the path counts.
        """
        seen = self.events(state).where(F.col("status").isin(DONE, REFUSED)).select(
            F.col("file_location").alias("seen_path"),
            F.col("length").alias("seen_length"),
            F.col("modified").alias("seen_modified"),
        )
        same = F.col("path") == F.col("seen_path")
        if "length" in files.columns:
            same &= F.col("length").eqNullSafe(F.col("seen_length")) & F.col("modified").eqNullSafe(F.col("seen_modified"))
        return files.join(seen, same, "left_anti")

    def earlier_versions(self, files: DataFrame, state: State) -> DataFrame:
        """``(run_id, path)``: the runs that finished another version of a file's path and still hold it."""
        done = self.events(state).where(F.col("status") == DONE).select("run_id", F.col("file_location").alias("path"))
        return done.join(files.select("path").distinct(), "path", "left_semi").select("run_id", "path").distinct()

    def done_files(self, run_id: str, state: State) -> DataFrame:
        """``(path)`` of the files that the run has marked as done."""
        done = self.events(state).where((F.col("status") == DONE) & (F.col("run_id") == run_id))
        return done.select(F.col("file_location").alias("path")).distinct()

    def is_finished(self, run_id: str, state: State | None = None) -> bool:
        """Whether the run has marked files as done."""
        return run_id in (state or self.state()).finished

    def finished_runs(self) -> DataFrame:
        """``(run_id)`` of the runs that marked files as done."""
        return self.spark.createDataFrame([(r,) for r in sorted(self.state().finished)], "run_id string")

    def check(self, landed: DataFrame, on_unfinished: str = "warn") -> None:
        """Warns of unfinished files, or raises with ``on_unfinished="fail"``."""
        names = sorted(r[0] for r in unfinished(self.events(), landed).collect())
        if not names:
            return
        text = f"an earlier run did not finish {len(names)} files: {names}"
        if on_unfinished == "fail":
            raise UnfinishedRunError(text)
        log.warning(text)
