"""Structured Streaming: append-only results without repeats, resumable extraction, a quality decision per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import monitor


def result_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """JSON lines that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def without_repeats(stream: DataFrame, key: str = "uid", time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The first row of each key; keys are forgotten when the watermark has passed, so state is bounded."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def append_json(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("json").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def for_each_batch(stream: DataFrame, act: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(act).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def guarded_append(stream: DataFrame, path: str, checkpoint: str, thresholds=None) -> StreamingQuery:
    """Records appended batch by batch into a folder a batch; a batch with impossible values is set aside under _stopped instead."""

    def act(batch: DataFrame, number: int) -> None:
        decision = monitor.monitor(batch, thresholds or monitor.FILL_THRESHOLDS).first()["decision"]
        where = "_stopped" if decision == "STOP" else "accepted"
        batch.write.mode("overwrite").parquet(f"{path}/{where}/batch={number}")

    return for_each_batch(stream, act, checkpoint)


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 day", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Rows a window and value; late rows beyond the delay are dropped."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, delay).groupBy(window.alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n")
