"""Bars over a stream of prints: session-anchored tumbling windows under a watermark.

:func:`stream_bars` cuts windows from one constant origin. :func:`session_stream_bars` lets every session
of a calendar have its own: the window's end is a column of ours, and the watermark is on that column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronotape.contracts import vocab
from chronotape.functions.instants import floor_div, in_session, timestamp_from_ns, window_start
from chronotape.operators.bars import bar_aggregates, is_bar_eligible, vwap
from chronotape.operators.sizing import broadcast_if_small
from chronotape.sources.ndjson import RAW_SUFFIX, WireField, parse


def raw_print_stream(
    spark: SparkSession, directory: str, wire: Sequence[WireField], suffix: str = RAW_SUFFIX
) -> DataFrame:
    """Raw records as they land, with a receive time; live capture knows a row on receipt.

    ``defect`` marks refused records. There is no ``ingest_index``: a position is a property of a
    finished raw partition, never of arrival order.
    """
    lines = spark.readStream.option("pathGlobFilter", f"*{suffix}").text(directory)
    received = F.unix_micros(F.current_timestamp()) * 1_000
    return parse(lines.where(F.col("value").rlike(r"\S")), tuple(wire)).withColumn("receive_time", received)


def stream_bars(
    prints: DataFrame,
    *,
    window_ns: int = vocab.DEFAULT_WINDOW_NS,
    origin_ns: int = 0,
    lag_ns: int = vocab.DEFAULT_PUBLICATION_LAG_NS,
    order: Sequence[str] = vocab.ORDER_KEY,
    ineligible: Sequence[str] = vocab.INELIGIBLE_CONDITIONS,
    complete: bool = True,
    zero_volume: str = "raise",
) -> DataFrame:
    """Bars of a streaming ``prints``; group state is one row per instrument and open window.

    In append mode a window comes out once the newest print is a publication lag (in whole
    milliseconds, Spark's watermark unit) past its end, so every emitted bar is complete. For
    update mode pass ``complete=False``: the partial bars it emits must not look closed.

    Microsecond windows hold the same prints as nanosecond ones because both window and origin must
    be whole microseconds. Order inside a window still uses the nanosecond key.
    """
    if window_ns % 1_000 or origin_ns % 1_000:
        raise ValueError("streaming windows need a window and an origin in whole microseconds")
    width, shift = (f"{ns // 1_000} microseconds" for ns in (window_ns, origin_ns % window_ns))
    windows = (
        prints.withColumn("__at", timestamp_from_ns("event_time"))
        .withWatermark("__at", f"{-(-lag_ns // 1_000_000)} milliseconds")
        .where(is_bar_eligible(ineligible=ineligible))
    )
    window = F.window("__at", width, startTime=shift)
    bars = windows.groupBy("instrument_id", window.alias("__window")).agg(*bar_aggregates(order))
    bars = bars.withColumn("__start", F.unix_micros("__window.start") * 1_000)
    return bars.select(
        F.col("__start").alias("event_time"),
        (F.col("__start") + window_ns + lag_ns).alias("knowledge_time"),
        "instrument_id",
        F.lit(window_ns).cast("bigint").alias("window_ns"),
        "open_nano", "high_nano", "low_nano", "close_nano", "volume_shares",
        vwap(zero_volume).alias("vwap_nano"),
        "trade_count",
        F.lit(complete).alias("is_complete"),
    )


def in_sessions(prints: DataFrame, calendar: DataFrame) -> DataFrame:
    """Streaming ``prints`` of a regular session, with ``origin_ns``: the open of the session they fall in.

    The calendar is the static side of the join, one row per session and UTC day that it touches, so a
    session may cross midnight. Prints outside every session are left out.
    """
    first, last = floor_div(F.col("regular_open_ns"), vocab.NS_PER_DAY), floor_div(F.col("regular_close_ns") - 1, vocab.NS_PER_DAY)
    days = calendar.where("regular_open_ns < regular_close_ns").select(
        F.explode(F.sequence(first, last)).alias("__day"), F.col("regular_open_ns").alias("origin_ns"), F.col("regular_close_ns").alias("__until")
    )
    dated = prints.withColumn("__day", floor_div(F.col("event_time"), vocab.NS_PER_DAY))
    return dated.join(broadcast_if_small(days), "__day").where(in_session("event_time", "origin_ns", "__until")).drop("__day", "__until")


def session_windows(
    prints: DataFrame, *, window_ns: int, lag_ns: int, origin_ns: int | str = "origin_ns",
    ineligible: Sequence[str] = vocab.INELIGIBLE_CONDITIONS,
) -> DataFrame:
    """Eligible ``prints`` with ``window_start`` (ns) and ``window_end`` (timestamp), watermarked on the end.

    A window is closed once a print of a window that ends a window and a lag later has been seen: that
    print is at least a lag younger than anything the closed window holds, whatever the session's origin.
    """
    if window_ns % 1_000_000:
        raise ValueError("streaming windows need a width in whole milliseconds, Spark's watermark unit")
    origin = F.col(origin_ns) if isinstance(origin_ns, str) else origin_ns
    delay = window_ns // 1_000_000 + -(-lag_ns // 1_000_000)
    started = prints.where(is_bar_eligible(ineligible=ineligible)).withColumn("window_start", window_start("event_time", window_ns, origin))
    return started.withColumn("window_end", timestamp_from_ns(F.col("window_start") + window_ns)).withWatermark("window_end", f"{delay} milliseconds")


def session_stream_bars(
    prints: DataFrame,
    calendar: DataFrame,
    *,
    window_ns: int = vocab.DEFAULT_WINDOW_NS,
    lag_ns: int = vocab.DEFAULT_PUBLICATION_LAG_NS,
    order: Sequence[str] = vocab.ORDER_KEY,
    ineligible: Sequence[str] = vocab.INELIGIBLE_CONDITIONS,
    zero_volume: str = "raise",
) -> DataFrame:
    """Closed bars of a streaming ``prints``, each session's windows starting at its own open.

    Append mode: a bar comes out once, when its window is closed as :func:`session_windows` says, so it
    is complete. State is one row per instrument and open window, combined before the shuffle.
    """
    windows = session_windows(in_sessions(prints, calendar), window_ns=window_ns, lag_ns=lag_ns, ineligible=ineligible)
    bars = windows.groupBy("instrument_id", "window_end", "window_start").agg(*bar_aggregates(order))
    return bars.select(
        F.col("window_start").alias("event_time"),
        (F.col("window_start") + window_ns + lag_ns).alias("knowledge_time"),
        "instrument_id",
        F.lit(window_ns).cast("bigint").alias("window_ns"),
        "open_nano", "high_nano", "low_nano", "close_nano", "volume_shares",
        vwap(zero_volume).alias("vwap_nano"),
        "trade_count",
        F.lit(True).alias("is_complete"),
    )


def write_stream(stream: DataFrame, path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Append a stream to Parquet exactly once; ``available_now`` drains what is there and stops."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
