"""Triggered (``availableNow``) runs of streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
# Names of partition folders made from zoned times do not depend on the session's zone.
FOLDER_ZONE = {"timeZone": "UTC"}


def run_available(stream: DataFrame, checkpoint: str, foreach_batch: Callable | None = None,
                  sink_path: str | None = None, output_mode: str = "append",
                  partition_by: list[str] | None = None, state_partitions: int | None = None) -> None:
    """Process everything new since the last run, then stop. The checkpoint
    records which files and batches are done, so a rerun with no new files
    runs no batch, and a batch cut short by a failure is replayed.

    ``state_partitions`` sets the shuffle partitions of the query, and so the
    number of its state stores, for state that stays small whatever is read.
    It counts when the checkpoint is made; later runs keep that number."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format("parquet").options(path=sink_path, **FOLDER_ZONE)
        if partition_by:
            w = w.partitionBy(*partition_by)
    q = _start(w.trigger(availableNow=True), stream.sparkSession, state_partitions)
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"streaming run failed: {err}")


def _start(writer: DataStreamWriter, spark: SparkSession, state_partitions: int | None) -> StreamingQuery:
    """A query takes a copy of the session's settings as it starts; the
    session gets its own back."""
    if state_partitions is None:
        return writer.start()
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    spark.conf.set(SHUFFLE_PARTITIONS, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)
