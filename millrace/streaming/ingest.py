"""Structured Streaming forms of the incremental feed.

Spark's own watermark is one bound for the whole stream. The feed's rule is one
bound per author, so each micro-batch is compared with a stored watermark table
and adds its own rows to it. Both writes go to a folder named after the batch
and the run, and replace it, so a batch that is run again leaves the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.keys import after_watermark, dedup_first, watermark_by
from millrace.storage import land


def read_landing(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    fmt: str = "json",
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a landing folder, each once; the checkpoint remembers them."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(directory)


def batches(spark: SparkSession, path: str, schema: T.StructType, of: Column | None = None) -> DataFrame:
    """Rows written by the batches that ``of`` picks by run_id and batch_id; an empty frame if there are none."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if of is not None:
        stored = stored.filter(of)
    return stored.select(*schema.names)


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id kept with a checkpoint; a new checkpoint gets a new one. Batch
    numbers count within a run, so a run never writes over another."""
    path = f"{checkpoint}/run-id"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
    run = uuid.uuid4().hex
    spark.createDataFrame([(run,)], "value string").coalesce(1).write.text(path)
    return run


def _write_batch(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/run_id={run}/batch_id={batch_id}")


def ingest_batch(
    batch: DataFrame,
    run: str,
    batch_id: int,
    target: str,
    marks: str,
    key: str,
    content: str,
    ts: str,
    order: Sequence[Column],
) -> None:
    """One micro-batch: first copy per (key, content), newer than the key's mark.

    Marks of all runs count, but not those of this batch itself, which is run
    again after a crash. The rows are written before their marks: a crash between
    the two leaves rows that the repeated batch replaces.
    """
    spark = batch.sparkSession
    mark_schema = T.StructType([batch.schema[key], T.StructField("max_created_ts", batch.schema[ts].dataType)])
    known = batches(spark, marks, mark_schema, ~((F.col("run_id") == run) & (F.col("batch_id") >= batch_id)))
    current = land(known.groupBy(key).agg(F.max("max_created_ts").alias("max_created_ts")), "marks")
    fresh = dedup_first(after_watermark(batch, current, key, ts), [key, content], order)
    _write_batch(fresh, target, run, batch_id)
    written = spark.read.schema(batch.schema).parquet(f"{target}/run_id={run}/batch_id={batch_id}")
    _write_batch(watermark_by(written, key, ts), marks, run, batch_id)


def stream_ingest(
    stream: DataFrame,
    target: str,
    marks: str,
    checkpoint: str,
    key: str,
    content: str,
    ts: str,
    order: Sequence[Column],
) -> StreamingQuery:
    """Ingest what is new and stop. A row at or below its key's mark is dropped
    for good, also when it arrives late."""
    run = _run_of(stream.sparkSession, checkpoint)

    def one(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, run, batch_id, target, marks, key, content, ts, order)

    return (
        stream.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` in event time.

    The event-time column must be an instant; a timestamp without zone is read
    as UTC here.
    """
    if stream.schema[ts].dataType.typeName() == "timestamp_ntz":
        stream = stream.withColumn(ts, F.to_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone()))
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_append(
    stream: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Append a stream to Parquet; the file sink's log makes each batch count once."""
    out = transform(stream) if transform else stream
    return (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
