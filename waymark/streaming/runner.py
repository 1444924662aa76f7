"""Streaming results as tables.

Any batch operator that Structured Streaming supports can be the query; this
module starts it, keeps its result as a table and reads that table back.

* append: rows never change. The native Parquet sink writes them, or, where a batch is
  refined, fanned out or shown as a view, each batch is written once under its id.
* update: each micro-batch holds the groups that changed, written under its batch
  id. Every ``COMPACT_EVERY`` batches the latest revision of each group is folded
  into a base folder; a reader takes the newest base and the revisions after it.
* complete: each micro-batch holds the whole result, written under its batch id.
* fold: the query keeps no state; each batch is merged with the result so far into the
  whole new result, written under its batch id. For results of bounded size.

A batch counts once its marker, an empty file written last, is there; so a reader never
takes half a batch, and an empty result is read as empty. Batches come in order, so all
up to the newest marker are done. A micro-batch that is replayed after a failure
overwrites what it wrote before, and folds into the result that it folded into before.
Markers, and folders of results that the newest marker makes needless, are removed
``LAG`` markers later, so a DataFrame read from an older result keeps its files for that
long; rows of append mode are never removed. State and progress live in the checkpoint
folder next to the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..session import child_names, fresh_dir, remove_path, touch

BATCH = "batch_id"
MODES = ("append", "update", "complete", "fold")
DRAIN = {"availableNow": True}
POLL_SECONDS = 0.2
COMPACT_EVERY = 20
LAG = 3


@dataclass(frozen=True)
class StreamTable:
    """Where one streaming query keeps its result, and how to read it.

    ``native`` append tables are written by Spark's own sink, others by ``write_batch``.
    ``partition_by`` names columns whose values become folders. With ``counted``, the
    column of an update table that counts a group's rows, each batch also stores how
    many rows it has added.
    """

    path: str
    schema: StructType
    mode: str
    keys: tuple[str, ...] = ()
    compact_every: int = COMPACT_EVERY
    native: bool = False
    partition_by: tuple[str, ...] = ()
    counted: str | None = None

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if self.mode == "update" and not self.keys:
            raise ValueError("update mode needs the keys that identify a row")
        if self.counted and self.mode != "update":
            raise ValueError("rows are counted in update mode only")

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    @property
    def base(self) -> str:
        return f"{self.path}/base"

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    def read(self, spark: SparkSession) -> DataFrame:
        """The result so far, as a batch table."""
        return self._read(spark, None)

    def _read(self, spark: SparkSession, before: int | None) -> DataFrame:
        """The result of the finished batches, or of those before one."""
        columns = self.schema.names
        if self.native:
            return self._stored(spark, self.data, self.schema).select(*columns)
        done = [i for i in self._marked(spark, "data") if before is None or i < before]
        if self.mode == "append":
            stored = self._stored(spark, self.data, self._dated)
            return stored.where(F.col(BATCH) <= (done[-1] if done else -1)).select(*columns)
        if self.mode == "update":
            return self._latest(spark, done, before).select(*columns)
        folder = f"{self.data}/{BATCH}={done[-1]}" if done else f"{self.data}/{BATCH}=none"
        return self._stored(spark, folder, self.schema).select(*columns)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.counted:
            self._count(batch, batch_id)
        batch.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{self.data}/{BATCH}={batch_id}")
        self._mark(spark, "data", batch_id)
        old = [i for i in self._marked(spark, "data") if i <= batch_id - LAG]
        if self.mode == "append":
            self._drop_marks(spark, "data", old)
        elif self.mode != "update":
            self._drop(spark, "data", old)
        elif (batch_id + 1) % self.compact_every == 0:
            self._compact(spark, batch_id)

    def fold_batch(self, batch: DataFrame, batch_id: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Write the batch merged with the result of the batches before it."""
        self.write_batch(merge(self._read(batch.sparkSession, batch_id), batch), batch_id)

    @property
    def _dated(self) -> StructType:
        return StructType([*self.schema.fields, StructField(BATCH, LongType())])

    def _count(self, batch: DataFrame, batch_id: int) -> None:
        """Store how many rows the batch has added to its groups."""
        spark = batch.sparkSession
        keys = [F.col(k).alias(f"own_{k}") for k in self.keys]
        same = [F.col(k).eqNullSafe(F.col(f"own_{k}")) for k in self.keys]
        before = self._read(spark, batch_id).join(batch.select(*keys), same, "left_semi")
        signed = batch.select(F.col(self.counted).alias("n")).union(before.select(-F.col(self.counted)))
        added = signed.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("kept_rows"))
        added.write.mode("overwrite").parquet(f"{self.path}/counts/{BATCH}={batch_id}")

    def row_counts(self, spark: SparkSession, queries: Sequence[StreamingQuery]) -> DataFrame:
        """batch_id, input_rows, kept_rows, dropped_rows and watermark of every batch of these runs.

        Input rows and watermarks come from the runs' progress (Spark keeps the last 100
        batches of a run by default). What isn't kept was dropped: as late, or, where the
        query filters its input, by the filter.
        """
        rows = [
            (p.batchId, p.numInputRows, p.eventTime.get("watermark"))
            for query in queries
            for p in query.recentProgress
            if p.numInputRows
        ]
        batches = spark.createDataFrame(rows, f"{BATCH} BIGINT, input_rows BIGINT, watermark STRING")
        schema = StructType([StructField("kept_rows", LongType()), StructField(BATCH, LongType())])
        joined = batches.join(self._stored(spark, f"{self.path}/counts", schema), BATCH, "left")
        kept = F.coalesce("kept_rows", F.lit(0)).cast("bigint")
        dropped = (F.col("input_rows") - kept).alias("dropped_rows")
        return joined.select(BATCH, "input_rows", kept.alias("kept_rows"), dropped, F.to_timestamp("watermark").alias("watermark"))

    def _latest(self, spark: SparkSession, revisions: list[int], before: int | None = None) -> DataFrame:
        """Each group's newest revision, with its batch id; ``before`` leaves out later bases."""
        bases = [i for i in self._marked(spark, "base") if before is None or i < before]
        stored = self._stored(spark, self.data, self._dated)
        if bases:
            newest = self._stored(spark, f"{self.base}/folded={bases[-1]}", self._dated)
            stored = newest.unionByName(stored.where(F.col(BATCH) > bases[-1]))
        last = revisions[-1] if revisions else -1
        values = [c for c in self.schema.names if c not in self.keys]
        newest = [F.max_by(c, BATCH).alias(c) for c in values]
        return stored.where(F.col(BATCH) <= last).groupBy(*self.keys).agg(*newest, F.max(BATCH).alias(BATCH))

    def _compact(self, spark: SparkSession, batch_id: int) -> None:
        """Fold all revisions so far into a base; a replay folds the same ones again."""
        revisions = [i for i in self._marked(spark, "data") if i <= batch_id]
        folded = self._latest(spark, revisions, before=batch_id)
        folded.write.mode("overwrite").parquet(f"{self.base}/folded={batch_id}")
        self._mark(spark, "base", batch_id)
        old = [i for i in self._marked(spark, "base") if i < batch_id]
        if old:  # what the base before this one holds is needed for its replay only
            self._drop(spark, "data", [i for i in revisions if i <= old[-1]])
            self._drop(spark, "base", old[:-LAG])

    def _mark(self, spark: SparkSession, kind: str, batch_id: int) -> None:
        touch(spark, f"{self.path}/marks/{kind}/mark={batch_id}")

    def _marked(self, spark: SparkSession, kind: str) -> list[int]:
        """Ids of finished batches or bases; old ones lose their markers, so there are few."""
        names = child_names(spark, f"{self.path}/marks/{kind}")
        return sorted(int(name.removeprefix("mark=")) for name in names if name.startswith("mark="))

    def _drop_marks(self, spark: SparkSession, kind: str, ids: list[int]) -> None:
        for i in ids:
            remove_path(spark, f"{self.path}/marks/{kind}/mark={i}")

    def _drop(self, spark: SparkSession, kind: str, ids: list[int]) -> None:
        folder, name = (self.data, BATCH) if kind == "data" else (self.base, "folded")
        self._drop_marks(spark, kind, ids)
        for i in ids:
            remove_path(spark, f"{folder}/{name}={i}")

    def _stored(self, spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)  # no micro-batch has run yet


@dataclass(frozen=True)
class StreamJob:
    """A streaming query to run: what to compute, how to emit it, what keys a row.

    ``refine`` is applied to each result batch before it is written and keeps its
    columns; it may use the batch several times, as a streaming plan cannot
    without reading the source and keeping the state once per use. ``merge`` makes the
    new result from the old one and a batch, in fold mode; ``schema`` is the result's.
    ``view`` names a temporary view that always shows the last finished batch.
    ``partition_by`` and ``counted`` are those of the table.
    """

    df: DataFrame
    mode: str
    keys: Sequence[str] = ()
    name: str | None = None
    refine: Callable[[DataFrame], DataFrame] | None = None
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    schema: StructType | None = None
    view: str | None = None
    partition_by: Sequence[str] = ()
    counted: str | None = None

    def __post_init__(self):
        if (self.mode == "fold") != (self.merge is not None):
            raise ValueError("fold mode, and only it, needs a merge")

    def table(self, path: str) -> StreamTable:
        native = self.mode == "append" and self.refine is None and self.view is None
        return StreamTable(
            path,
            self.schema or self.df.schema,
            self.mode,
            tuple(self.keys),
            native=native,
            partition_by=tuple(self.partition_by),
            counted=self.counted,
        )


def start_stream(
    job: StreamJob, path: str | None = None, trigger: dict | None = None
) -> tuple[StreamTable, StreamingQuery]:
    """Start one query. The same path resumes it; the default is a fresh one.

    The default trigger takes all data there is now and then stops; pass, for
    example, ``{"processingTime": "1 minute"}`` to keep running.
    """
    spark = job.df.sparkSession
    table = job.table(path or fresh_dir(spark, job.name or "stream"))
    if job.view:
        table.read(spark).createOrReplaceTempView(job.view)
    writer = _writer(job.df, table.checkpoint, "append" if job.mode == "fold" else job.mode, job.name, trigger)
    if table.native:
        return table, writer.partitionBy(*table.partition_by).format("parquet").start(table.data)

    def write(batch: DataFrame, batch_id: int) -> None:
        _write(job, table, batch, batch_id)
        if job.view:  # in the session of the caller; a batch has its own
            table.read(spark).createOrReplaceTempView(job.view)

    return table, writer.foreachBatch(write).start()


def _writer(df: DataFrame, checkpoint: str, mode: str, name: str | None, trigger: dict | None):
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or DRAIN)).outputMode(mode)
    return writer.queryName(name) if name else writer


def _write(job: StreamJob, table: StreamTable, batch: DataFrame, batch_id: int) -> None:
    if job.refine is None and job.merge is None and job.counted is None:
        table.write_batch(batch, batch_id)
        return
    batch.persist()
    try:
        rows = job.refine(batch) if job.refine else batch
        if job.merge:
            table.fold_batch(rows, batch_id, job.merge)
        else:
            table.write_batch(rows, batch_id)
    finally:
        batch.unpersist()


@dataclass(frozen=True)
class Output:
    """One result of a fanned-out stream: what it takes from a batch, and how batches add up.

    ``take`` makes rows from a batch. Without ``merge`` they are appended; with it they
    are folded into a result of ``schema``.
    """

    take: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    schema: StructType | None = None


def start_fan_out(
    df: DataFrame, outputs: dict[str, Output], path: str | None = None, trigger: dict | None = None
) -> tuple[dict[str, StreamTable], StreamingQuery]:
    """Read a stream of rows once and write several results of each batch.

    Every output has its own table and markers. A batch that fails between two outputs is
    replayed for all of them, which overwrite what they wrote.
    """
    path = path or fresh_dir(df.sparkSession, "fan-out")
    jobs = {}
    for name, out in outputs.items():
        mode = "fold" if out.merge else "append"
        jobs[name] = StreamJob(df, mode, merge=out.merge, schema=out.schema or out.take(df).schema)
    tables = {name: replace(job.table(f"{path}/{name}"), native=False) for name, job in jobs.items()}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, table in tables.items():
                rows = outputs[name].take(batch)
                if outputs[name].merge:
                    table.fold_batch(rows, batch_id, outputs[name].merge)
                else:
                    table.write_batch(rows, batch_id)
        finally:
            batch.unpersist()

    writer = _writer(df, f"{path}/checkpoint", "append", None, trigger)
    return tables, writer.foreachBatch(write).start()


def run_fan_out(df: DataFrame, outputs: dict[str, Output]) -> dict[str, DataFrame]:
    """Drain a stream once and give each output's result as a batch table."""
    tables, query = start_fan_out(df, outputs)
    await_streams([query])
    return {name: table.read(df.sparkSession) for name, table in tables.items()}


def run_stream(
    df: DataFrame, mode: str, keys: Sequence[str] = (), name: str | None = None
) -> DataFrame:
    """Drain one streaming query and give its result as a batch table."""
    return run_streams({"result": StreamJob(df, mode, keys, name)})["result"]


def run_streams(jobs: dict[str, StreamJob]) -> dict[str, DataFrame]:
    """Drain several queries side by side, each with its own state and checkpoint.

    If one fails the others are stopped and its error is raised at once.
    """
    started = {label: start_stream(job) for label, job in jobs.items()}
    await_streams([query for _, query in started.values()])
    return {
        label: table.read(jobs[label].df.sparkSession) for label, (table, _) in started.items()
    }


def await_streams(queries: Sequence[StreamingQuery]) -> None:
    """Wait until all queries have ended; stop the others as soon as one fails."""
    running = list(queries)
    try:
        while running:
            running = [q for q in running if not q.awaitTermination(POLL_SECONDS)]
    finally:
        for query in running:
            query.stop()


def stream_snapshot(df: DataFrame, view: str) -> DataFrame:
    """Drain a stream of rows into a table that SQL text can query by name.

    To query it while the stream runs, start a ``StreamJob`` with ``view``.
    """
    rows = run_stream(df, "append")
    rows.createOrReplaceTempView(view)
    return rows
