"""Provisional bars: every micro-batch shows the windows it touched, the watermark closes them.

Spark's streaming aggregate holds one row per instrument and open window. It shows the windows that a
micro-batch touched and drops closed ones silently, so the writer keeps the last version of every open
window beside the versions and shows it a last time, complete, when the watermark passes its end. Both
follow the open windows and not the length of the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronotape.contracts import vocab
from chronotape.functions.instants import floor_div
from chronotape.operators.bars import bar_aggregates, vwap
from chronotape.streaming.bars import in_sessions, session_windows

#: A state store whose open windows need not fit a worker's memory.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

PROVISIONAL = (
    "instrument_id bigint, event_time bigint, knowledge_time bigint, window_ns bigint, open_nano bigint, high_nano bigint, low_nano bigint,"
    " close_nano bigint, volume_shares bigint, vwap_nano bigint, trade_count int, is_complete boolean"
)


def provisional_bars(
    prints: DataFrame,
    calendar: DataFrame,
    *,
    window_ns: int = vocab.DEFAULT_WINDOW_NS,
    lag_ns: int = vocab.DEFAULT_PUBLICATION_LAG_NS,
    order: Sequence[str] = vocab.ORDER_KEY,
    ineligible: Sequence[str] = vocab.INELIGIBLE_CONDITIONS,
) -> DataFrame:
    """Versions of the bars of a streaming ``prints``, for update mode and :func:`write_versions`.

    What a micro-batch touched is shown as it stands, not complete; :func:`write_versions` adds complete
    versions. The last version of a window is its bar; a window without volume has a null price. Prints
    of closed windows, as :func:`chronotape.streaming.bars.session_windows` says, are dropped.
    """
    windows = session_windows(in_sessions(prints, calendar), window_ns=window_ns, lag_ns=lag_ns, ineligible=ineligible)
    bars = windows.groupBy("instrument_id", "window_end", "window_start").agg(*bar_aggregates(order))
    return bars.select(
        "instrument_id",
        F.col("window_start").alias("event_time"),
        (F.col("window_start") + window_ns + lag_ns).alias("knowledge_time"),
        F.lit(window_ns).cast("bigint").alias("window_ns"),
        "open_nano", "high_nano", "low_nano", "close_nano", "volume_shares",
        vwap("null").alias("vwap_nano"),
        "trade_count",
        F.lit(False).alias("is_complete"),
    )


def write_versions(bars: DataFrame, folder: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Keep every version under its batch; a replayed batch rewrites exactly its own folders.

    A version is complete exactly if the watermark of its batch had passed the window's end. That watermark
    follows from the newest window of the batches before, which is kept with the windows still open.
    """
    spark, open_versions = bars.sparkSession, f"{checkpoint.rstrip('/')}-open"
    held_schema = f"{PROVISIONAL}, newest bigint"
    names = [part.split()[0] for part in PROVISIONAL.split(",")]

    def keep(batch: DataFrame, batch_id: int) -> None:
        # a batch's open windows cover all batches before it, so only its predecessor's are read
        session = batch.sparkSession
        held = session.read.schema(held_schema).parquet(f"{open_versions}/batch={batch_id - 1}") if batch_id else session.createDataFrame([], held_schema)
        newest = held.agg(F.max("newest")).first()[0]
        batch.write.mode("overwrite").parquet(f"{open_versions}/touched-{batch_id}")  # the aggregate runs once
        touched = session.read.schema(PROVISIONAL).parquet(f"{open_versions}/touched-{batch_id}")
        end, lag = F.col("event_time") + F.col("window_ns"), F.col("knowledge_time") - F.col("event_time") - F.col("window_ns")
        untouched = held.join(touched, ["instrument_id", "event_time"], "left_anti").select(*names)
        now = touched.select(*names).unionByName(untouched)
        # the watermark in whole milliseconds, as session_windows asks for it
        delay = floor_div(F.col("window_ns"), 1_000_000) - floor_div(-lag, 1_000_000)
        closed = F.lit(False) if newest is None else floor_div(end, 1_000_000) <= F.lit(newest // 1_000_000) - delay
        ends = now.where(closed).withColumn("is_complete", F.lit(True))
        touched.select(*names).unionByName(ends).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        # the newest window of all is open as long as nothing newer comes, so what is open always tells it
        reached = touched.agg(F.greatest(F.max(end), F.lit(newest).cast("bigint"))).first()[0]
        still = now.where(~closed).withColumn("newest", F.lit(reached).cast("bigint"))
        still.write.mode("overwrite").parquet(f"{open_versions}/batch={batch_id}")

    writer = bars.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    conf, (name, provider) = spark.conf, STATE_STORE
    before = conf.get(name)
    conf.set(name, provider)
    try:  # a query keeps the settings it started with
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        conf.set(name, before)


def latest_versions(versions: DataFrame) -> DataFrame:
    """The last version of every window of what :func:`write_versions` kept (it has the batch as a column)."""
    columns = [c for c in versions.columns if c != "batch"]
    # a batch closes windows after it updates them, so of its two versions the complete one is later
    newest = F.max_by(F.struct(*columns), F.struct("batch", "is_complete")).alias("bar")
    return versions.groupBy("instrument_id", "event_time").agg(newest).select("bar.*")
