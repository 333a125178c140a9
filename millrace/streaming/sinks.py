"""Stream sinks and how a query is run.

Results go to files under a path given by the caller.  Each micro-batch has its own
folder, overwritten when the batch is repeated after a failure, so a restart from the
checkpoint neither loses nor doubles rows.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow.fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from millrace.sources.jdbc import Database, sink_jdbc

STATE_SETTING = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# A batch uploads what it changed, and no key is looked up just to count the rows of the state.
ON_DISK = {
    STATE_SETTING: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
IDLE_SETTING = "spark.sql.streaming.noDataMicroBatches.enabled"

BatchFunction = Callable[[DataFrame, int], DataFrame | None]


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query to end and raise what stopped it."""
    query.awaitTermination()
    return query


@contextmanager
def _state_on_disk(spark: SparkSession, idle: bool = True) -> Iterator[None]:
    """Let queries started inside keep their state in RocksDB, which overflows to disk.

    The default provider holds all state in memory.  What is named in the session
    stays; a query reads the settings once, when it starts.
    """
    wanted = {} if spark.conf.get(STATE_SETTING, None) else dict(ON_DISK)
    if not idle:
        wanted[IDLE_SETTING] = "false"
    added = {name: value for name, value in wanted.items() if spark.conf.get(name, None) is None}
    for name, value in added.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in added:
            spark.conf.unset(name)


def start(
    df: DataFrame,
    path: str,
    mode: str,
    trigger: dict | None,
    sink: Callable[[DataStreamWriter], DataStreamWriter],
    idle: bool = True,
) -> StreamingQuery:
    """Start a query with its checkpoint beside ``path``; by default over all input there is.

    Without ``idle`` there are no batches without input: state that the watermark has passed goes with the
    next input.  That is for queries that emit nothing when state goes, such as inner joins.
    """
    writer = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{path}-checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
    )
    with _state_on_disk(df.sparkSession, idle):
        return sink(writer).start()


def to_files(
    df: DataFrame,
    path: str,
    source: str = "parquet",
    trigger: dict | None = None,
    partition_by: Sequence[str] = (),
    idle: bool = True,
) -> StreamingQuery:
    """Append a stream to files; each batch is committed once, by a log beside the files."""

    def files(writer: DataStreamWriter) -> DataStreamWriter:
        return writer.format(source).option("path", path).partitionBy(*partition_by)

    return start(df, path, "append", trigger, files, idle)


def per_batch(
    df: DataFrame,
    path: str,
    transform: BatchFunction | None = None,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write what a batch operation makes of every micro-batch to ``path/batch=N``.

    Inside the operation anything allowed on a table is allowed: windows, exact
    distinct counts, sorting, SQL.  An operation that returns nothing writes nothing.
    In complete mode a batch holds the whole result, so the one before it is removed.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        result = batch if transform is None else transform(batch, batch_id)
        if result is not None:
            result.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            if mode == "complete" and batch_id:
                remove(batch.sparkSession, f"{path}/batch={batch_id - 1}")

    return start(df, path, mode, trigger, lambda writer: writer.foreachBatch(run))


def _hadoop_path(spark: SparkSession, path: str):
    """A path with the scheme of its file system, Spark's default one if it names none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files, files.makeQualified(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of a sink, on Spark's own file system."""
    files, place = _hadoop_path(spark, path)
    files.delete(place, True)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches written by :func:`per_batch`, with their number in ``batch``."""
    typed = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(typed).option("basePath", path).parquet(path)


def latest_complete(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The result after the last batch of a query in complete mode."""
    batches = read_batches(spark, path, schema)
    last = batches.agg(F.max("batch")).scalar()
    return batches.filter(F.col("batch") == last).drop("batch")


def latest_by_key(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """The newest row of every key of a query in update mode."""
    others = [n for n in schema.fieldNames() if n not in keys]
    newest = F.max_by(F.struct(*others), F.col("batch")).alias("_row")
    batches = read_batches(spark, path, schema)
    return batches.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def run_append(df: DataFrame, path: str, idle: bool = True) -> DataFrame:
    """Run a query over all available input in append mode and read its output."""
    finish(to_files(df, path, idle=idle))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_batches(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a query over all available input, one folder a batch, and read all its batches."""
    finish(per_batch(df, path, mode=mode))
    return read_batches(df.sparkSession, path, df.schema)


def run_complete(df: DataFrame, path: str) -> DataFrame:
    """Run a query over all available input in complete mode and read the last result."""
    finish(per_batch(df, path, mode="complete"))
    return latest_complete(df.sparkSession, path, df.schema)


def run_update(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Run a query over all available input in update mode and read the newest rows."""
    finish(per_batch(df, path, mode="update"))
    return latest_by_key(df.sparkSession, path, df.schema, keys)


class RowFileWriter:
    """A ``foreach`` writer: one JSON-lines file per task and batch.

    ``open`` declines a (partition, batch) whose file is already in place, so a
    repeated batch is not written twice.  A file gets its name only when complete.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.files, root = _file_system(self.path)
        self.target = f"{root}/batch={epoch_id}/part-{partition_id:05d}.json"
        if self.files.get_file_info(self.target).type != pyarrow.fs.FileType.NotFound:
            return False
        self.files.create_dir(self.target.rsplit("/", 1)[0], recursive=True)
        self.partial = f"{root}/batch={epoch_id}/_part-{partition_id:05d}"
        self.out = self.files.open_output_stream(self.partial)
        return True

    def process(self, row: Row) -> None:
        self.out.write((json.dumps(row.asDict(), default=str) + "\n").encode())

    def close(self, error: Exception | None) -> None:
        if getattr(self, "out", None) is None:
            return
        self.out.close()
        if error is None:
            self.files.move(self.partial, self.target)


def _file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path; HDFS needs its client library on the workers."""
    if path.startswith("file:"):
        path = path[len("file:"):]
    if "://" not in path:
        return pyarrow.fs.LocalFileSystem(), "/" + path.lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def to_foreach(df: DataFrame, path: str, trigger: dict | None = None) -> StreamingQuery:
    """Write rows one by one through :class:`RowFileWriter`, on Spark's own file system."""
    target = str(_hadoop_path(df.sparkSession, path)[1].toString())
    return start(df, path, "append", trigger, lambda writer: writer.foreach(RowFileWriter(target)))


def to_memory(df: DataFrame, name: str, path: str, mode: str = "complete") -> StreamingQuery:
    """Keep a result as an in-memory table of the driver; for small results and tests."""
    return start(df, path, mode, None, lambda writer: writer.format("memory").queryName(name))


def to_console(df: DataFrame, path: str, mode: str = "append", rows: int = 20) -> StreamingQuery:
    """Print every batch; for trials."""
    return start(
        df, path, mode, None, lambda writer: writer.format("console").option("numRows", rows)
    )


def to_jdbc(
    df: DataFrame,
    database: Database,
    table: str,
    path: str,
    mode: str = "complete",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write a stream's result to a database so that repeated batches do no harm.

    In complete mode every batch replaces the table.  In other modes every batch
    replaces a table of its own, ``<table>_<batch>``, for the database to merge.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        target = table if mode == "complete" else f"{table}_{batch_id}"
        sink_jdbc(batch, database, target, mode="overwrite")

    return start(df, path, mode, trigger, lambda writer: writer.foreachBatch(run))


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of every batch of the queries that run inside it.

    A query itself remembers its last hundred batches only.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.rows: list[tuple] = []
        self.ended: set[str] = set()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((str(p.id), str(p.runId), p.name, int(p.batchId), int(p.numInputRows)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def frame(self, query: StreamingQuery, patience: float = 30.0) -> DataFrame:
        """One row for each batch of an ended query; events may come a little after its end."""
        until = time.monotonic() + patience
        while str(query.runId) not in self.ended and time.monotonic() < until:
            time.sleep(0.05)
        own = [r for r in self.rows if r[1] == str(query.runId)]
        schema = "id string, run_id string, name string, batch long, input_rows long"
        return self.spark.createDataFrame(own, schema)
