"""Running Structured Streaming jobs over file sources (SRC-11/12, SNK-2, STR-10).

A job is a streaming DataFrame built by the caller; ``run_to_table`` drives it
into a Parquet sink with a checkpoint under the shared checkpoint folder, then returns the
sink as a batch DataFrame; ``run_to_tables`` does so with several tables.
Restarting on the same checkpoint continues where the last run stopped.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import scratch_path
from quern.sources.readers import read_stream, table_path


@dataclass
class StreamRun:
    """Where a stream run keeps its sink and checkpoint."""
    sink: str
    checkpoint: str
    # End-of-input markers still to be written: (directory, schema, row values).
    ends: list = field(default_factory=list)
    # State is kept off the JVM's heap and written in fewer calls, whatever the session's settings.
    large_state: bool = False


def new_run(spark: SparkSession, name: str, large_state: bool = False) -> StreamRun:
    base = scratch_path(spark, f"stream-{name}")
    return StreamRun(sink=f"{base}/sink", checkpoint=f"{base}/checkpoint", large_state=large_state)


def state_buckets(spark: SparkSession, run: StreamRun, per_partition: int = 4) -> int:
    """State buckets of a run: set at its first start from the shuffle parallelism, stored
    beside the checkpoint, and read from there whenever the run starts again."""
    path = f"{run.checkpoint}-buckets"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        n = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")) * per_partition)
        spark.range(n, n + 1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).first()[0]


def fixture_stream(spark: SparkSession, sf: str, table: str,
                   files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over one fixture table, a folder of part files or a single file
    (its directory + glob). The schema comes from the file footer; timestamps are cast
    from NTZ to TIMESTAMP by the caller."""
    path = table_path(sf, table)
    schema = spark.read.parquet(path).schema
    if _is_directory(spark, path):
        return read_stream(spark, path, schema, files_per_trigger=files_per_trigger)
    directory = path.rsplit("/", 1)[0]
    return read_stream(spark, directory, schema, file_glob=path.rsplit("/", 1)[1],
                       files_per_trigger=files_per_trigger)


def _is_directory(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def sentinel_stream(spark: SparkSession, run: StreamRun, schema: T.StructType,
                    row: dict, tag: str = "sentinel") -> DataFrame:
    """A one-row end-of-input marker as its own file stream.

    Its far-future event time moves the watermark past every real window, so
    append-mode windows and outer-join rows of the last hour are emitted. The folder
    starts empty: ``run_to_table`` writes the marker only after the real input is
    drained, whatever the number of micro-batches. Callers filter the marker's key
    out of the result.
    """
    directory = f"{run.sink.rsplit('/', 1)[0]}/{tag}"
    values = [row.get(f.name) for f in schema.fields]
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(directory)
    run.ends.append((directory, schema, tuple(values)))
    return read_stream(spark, directory, schema)


def start_stream(stream: DataFrame, run: StreamRun, output_mode: str = "append",
                 fmt: str = "parquet", processing_time: str | None = None,
                 query_name: str | None = None):
    """SNK-2 / STR-10: start a long-running query and return its handle.

    ``fmt`` is ``parquet`` (sink path of the run), ``memory`` (table named
    ``query_name``) or ``console``. ``processing_time`` (e.g. ``"10 seconds"``,
    the reference's checkpoint interval) sets a micro-batch trigger; without it
    the query drains what is available and stops. The checkpoint stays after
    ``stop()``, so a restart resumes from it.
    """
    writer = (stream.writeStream.format(fmt).outputMode(output_mode)
              .option("checkpointLocation", run.checkpoint))
    if fmt == "parquet":
        writer = writer.option("path", run.sink)
    return _start(stream, writer, processing_time, query_name, run.large_state)


# State variables with timers live in Spark's RocksDB provider only.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# A stream-stream join keeps one store a partition, not four that load and commit one by one; rows of the state are not
# counted, which takes one more read for each row written or removed. A checkpoint of another layout is read on in its own.
_LARGE_STATE = {_PROVIDER: _ROCKSDB, "spark.sql.streaming.join.stateFormatVersion": "3",
                "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def _start(stream: DataFrame, writer, processing_time: str | None = None, query_name: str | None = None,
           large_state: bool = False):
    """Start a writer; a query takes the session's settings with it, so those of its state are set for this one only."""
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(processingTime=processing_time) if processing_time \
        else writer.trigger(availableNow=True)
    conf, settings = stream.sparkSession.conf, {}
    if large_state:
        settings = _LARGE_STATE
    elif "TransformWithState" in stream._jdf.queryExecution().analyzed().toString():
        settings = {_PROVIDER: _ROCKSDB}
    before = {k: conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            conf.set(k, v) if v is not None else conf.unset(k)


def run_to_table(spark: SparkSession, stream: DataFrame, run: StreamRun,
                 output_mode: str = "append", query_name: str | None = None,
                 timeout_s: int | None = None) -> DataFrame:
    """Drive ``stream`` into Parquet until its input is drained; return the sink table.

    With markers in the run, the query stays up when the input is drained, the markers are
    written, and it goes on until they have closed the last state. With ``timeout_s`` a run that takes longer raises
    ``TimeoutError``; a half-written sink is never returned.
    """
    _run(spark, stream, run, lambda continuous: start_stream(
        stream, run, output_mode, "parquet", "0 seconds" if continuous else None, query_name), query_name, timeout_s)
    return spark.read.parquet(run.sink)


def run_to_tables(spark: SparkSession, stream: DataFrame, run: StreamRun, tables: dict[str, Column],
                  timeout_s: int | None = None) -> dict[str, DataFrame]:
    """STR-8 / SNK-2: drive ``stream`` into one table per condition (side outputs), as ``run_to_table`` does.

    Every micro-batch writes its rows of each table to a folder named by the batch's number and
    replaces what is there. A batch that is repeated after a fault, between two tables
    or inside one, has the number and the rows it had, so no row is lost or stored twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist() if len(tables) > 1 else batch
        try:
            for name, condition in tables.items():
                held.where(condition).write.mode("overwrite").parquet(f"{run.sink}/{name}/batch_id={batch_id}")
        finally:
            if len(tables) > 1:
                held.unpersist()

    def start(continuous: bool):
        writer = stream.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", run.checkpoint)
        return _start(stream, writer, "0 seconds" if continuous else None, large_state=run.large_state)

    _run(spark, stream, run, start, "", timeout_s)
    return {name: spark.read.parquet(f"{run.sink}/{name}").drop("batch_id") for name in tables}


def drain(stream: DataFrame, run: StreamRun, output_mode: str = "append", query_name: str | None = None,
          timeout_s: int | None = None) -> None:
    """STR-10: run what is available into the sink; a later call goes on from the checkpoint."""
    _await(start_stream(stream, run, output_mode, "parquet", None, query_name), query_name, timeout_s)


def _run(spark: SparkSession, stream: DataFrame, run: StreamRun, start, query_name: str | None, timeout_s: int | None) -> None:
    if not run.ends:
        _await(start(False), query_name, timeout_s)
        return
    q, late = start(True), []
    timer = threading.Timer(timeout_s, lambda: (late.append(True), q.stop())) if timeout_s is not None else None
    try:
        if timer:
            timer.start()
        q.processAllAvailable()
        if not late:
            for directory, schema, row in run.ends:
                spark.createDataFrame([row], schema).write.mode("append").parquet(directory)
            run.ends.clear()
            q.processAllAvailable()
    except StreamingQueryException as e:
        raise RuntimeError(f"stream {query_name or ''} failed: {e}") from e
    finally:
        if timer:
            timer.cancel()
        q.stop()
    if late:
        raise TimeoutError(f"stream {query_name or ''} took more than {timeout_s} s")


def _await(q, query_name: str | None, timeout_s: int | None) -> None:
    try:
        ended = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination() or True
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(f"stream {query_name or ''} failed: {q.exception()}")
    if not ended:
        raise TimeoutError(f"stream {query_name or ''} took more than {timeout_s} s")
