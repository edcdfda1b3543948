"""Structured Streaming forms of fan-out (T1) and publish-new.

Both use ``foreachBatch``: every micro-batch runs the batch operator and
writes into its own ``batch_id=N`` folder with overwrite, so a batch that is
retried after a failure replaces its own output instead of adding to it.
Progress lives in the query's checkpoint location (a shared folder).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..sinks.published import BUCKETS, KeyIndex, _files, _touch, publish_indexed
from ..sinks.writers import Sink, fan_out, publish_new, read_file, replace_file


def table_stream(spark: SparkSession, folder: str, file_glob: str = "*.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over the Parquet files of ``folder`` matching a glob.
    The schema is taken from the files once (streams need it up front)."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)


def line_stream(spark: SparkSession, folder: str, file_glob: str = "*",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of text lines (one ``value`` row per line) from the files
    of ``folder``, such as a build log growing file by file."""
    reader = spark.readStream.format("text").option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)


def _start(stream: DataFrame, fn, checkpoint: str, available_now: bool,
           processing_time: str | None) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def stream_fan_out(stream: DataFrame, sink_roots: Sequence[str], checkpoint: str,
                   fmt: str = "parquet", available_now: bool = True,
                   processing_time: str | None = None) -> StreamingQuery:
    """Every micro-batch to all sinks, computed once per batch.

    At-least-once per sink; because each batch overwrites
    ``<sink>/batch_id=<N>``, a replayed batch leaves no duplicates."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, [Sink(os.path.join(root, f"batch_id={batch_id}"), fmt=fmt, mode="overwrite")
                        for root in sink_roots])

    return _start(stream, write_batch, checkpoint, available_now, processing_time)


# Names the newest micro-batch that all sinks have.
COMMITTED = "_committed_batch"


def stream_fan_out_committed(stream: DataFrame, sink_roots: Sequence[str], log: str, checkpoint: str,
                             fmt: str = "parquet", available_now: bool = True,
                             processing_time: str | None = None) -> StreamingQuery:
    """T1 with one commit for all sinks: when the last sink has a micro-batch,
    its number replaces the one in a file of the folder ``log``. Micro-batches
    follow one another, so that number says which batches are whole.
    :func:`read_committed` shows those only: a batch appears in all sinks at
    once, or, if a sink fails, in none."""
    spark = stream.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, [Sink(os.path.join(root, f"batch_id={batch_id}"), fmt=fmt, mode="overwrite")
                        for root in sink_roots])
        replace_file(spark, f"{log.rstrip('/')}/{COMMITTED}", str(batch_id))

    return _start(stream, write_batch, checkpoint, available_now, processing_time)


def read_committed(spark: SparkSession, sink_root: str, log: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The rows of one sink that belong to committed micro-batches, with their
    ``batch_id``. The filter is on the folder, so others are not opened."""
    with_batch = StructType([*schema.fields, StructField("batch_id", LongType())])
    newest = read_file(spark, f"{log.rstrip('/')}/{COMMITTED}")
    if newest is None:
        return spark.createDataFrame([], with_batch)
    return spark.read.schema(with_batch).format(fmt).load(sink_root).where(f"batch_id <= {int(newest)}")


def stream_publish_new(stream: DataFrame, target: str, keys: str | Sequence[str], checkpoint: str,
                       fmt: str = "parquet", available_now: bool = True,
                       processing_time: str | None = None,
                       key_buckets: int | None = None) -> StreamingQuery:
    """``publish_new`` per micro-batch. The anti join reads the target
    without the batch's own folder, so a retry does not drop its own rows;
    no state store is needed because the target is the state."""
    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        publish_new(batch, target, keys, fmt=fmt,
                    exclude_from_target=f"batch_id = {int(batch_id)}",
                    mode="overwrite", path=os.path.join(target, f"batch_id={batch_id}"),
                    key_buckets=key_buckets)

    return _start(stream, publish_batch, checkpoint, available_now, processing_time)


# Spark's provider that keeps state outside the heap and saves changes only.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _seed(spark: SparkSession, checkpoint: str, newest: int) -> tuple[int, str]:
    """(last publish before this stream's first, the stream's name), decided at
    its first start and kept beside its checkpoint."""
    note = f"{checkpoint.rstrip('/')}.publishes"
    made = _files(spark, f"{note}/*")
    if not made:
        made = [f"{newest}.stream-{uuid.uuid4().hex}"]
        _touch(spark, f"{note}/{made[0]}")
    seed, writer = made[0].split(".", 1)
    return int(seed), writer


def stream_publish_indexed(stream: DataFrame, target: str, keys: str | Sequence[str], checkpoint: str,
                           index: str | None = None, buckets: int = BUCKETS, fmt: str = "parquet",
                           available_now: bool = True, processing_time: str | None = None,
                           state_store: str | None = ROCKSDB, state_partitions: int | None = None) -> StreamingQuery:
    """T2 with state: publishes each key of a stream once, into a target with
    a key index (``sinks.published``).

    Keys the stream has seen are in Spark's state store (``dropDuplicates``), so
    a micro-batch reads nothing that an earlier one wrote. Keys published before
    the stream's first start are looked up in the index up to that publish. Of
    several rows of a key, the first micro-batch's is published.

    Micro-batch ``b`` is publish ``seed + 1 + b``: replayed after a failure, it
    overwrites what it left, or is skipped if it was committed. A restart from
    the checkpoint therefore publishes nothing twice. Another writer that took
    one of these numbers is an error.

    ``state_partitions`` (the session's shuffle partitions unless given) is fixed
    by the first start: choose it for the keys there will be, not for a batch."""
    spark = stream.sparkSession
    ks = [keys] if isinstance(keys, str) else list(keys)
    book = KeyIndex(spark, index or f"{target.rstrip('/')}.keys", [stream.schema[k] for k in ks], buckets)
    seed, writer = _seed(spark, checkpoint, book.last())

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        publish_indexed(batch, target, ks, index=book.path, buckets=buckets, fmt=fmt, number=seed + 1 + batch_id,
                        writer=writer, known_upto=seed, distinct_keys=True)

    wanted = {"spark.sql.streaming.stateStore.providerClass": state_store,
              "spark.sql.shuffle.partitions": str(state_partitions) if state_partitions else None}
    wanted = {k: v for k, v in wanted.items() if v}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:  # a query takes its settings when it starts
        return _start(stream.dropDuplicates(ks), publish_batch, checkpoint, available_now, processing_time)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
