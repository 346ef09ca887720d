"""Order-event streams: replays dropped, late rows kept as revisions."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronotape.functions.instants import timestamp_from_ns


def dedupe_order_event_stream(events: DataFrame, *, within: str = "1 day", time: str = "event_time_ns") -> DataFrame:
    """A replayed broker event inside the watermark delay is a no-op; state expires after the delay."""
    return (
        events.withColumn("__at", timestamp_from_ns(time))
        .withWatermark("__at", within)
        .dropDuplicatesWithinWatermark(["account_id", "broker_event_id"])
        .drop("__at")
    )


def split_late_rows(
    events: DataFrame, folder: str, checkpoint: str, *, delay_ns: int, time: str = "event_time", available_now: bool = True
) -> StreamingQuery:
    """Route each micro-batch: rows in time to ``ontime``, rows behind the high-water mark to ``revisions``.

    Late rows are never dropped and never overwrite; they append with the mark that made them late
    as ``revision_time``, for :func:`chronotape.operators.history.as_known` to resolve. Each batch
    owns its output and progress folders, so a replayed batch rewrites exactly the same rows.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        progress = f"{folder}/progress"
        # a batch's mark covers all batches before it, so only its predecessor's is read
        high = spark.read.schema("high bigint").parquet(f"{progress}/batch={batch_id - 1}").first()[0] if batch_id > 0 else None
        mark = F.lit(high).cast("bigint")
        is_late = F.coalesce(F.col(time) < mark - delay_ns, F.lit(False))
        batch = batch.persist(StorageLevel.DISK_ONLY)  # read three times; lost blocks are computed again
        batch.where(~is_late).write.mode("overwrite").parquet(f"{folder}/ontime/batch={batch_id}")
        late = batch.where(is_late).withColumn("revision_time", mark)
        late.write.mode("overwrite").parquet(f"{folder}/revisions/batch={batch_id}")
        reached = batch.agg(F.greatest(F.max(time), mark).alias("high"))
        reached.write.mode("overwrite").parquet(f"{folder}/progress/batch={batch_id}")
        batch.unpersist()

    writer = events.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
