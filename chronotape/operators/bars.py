"""Session-anchored OHLCV/VWAP bars built from prints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.functions import money
from chronotape.functions.instants import window_start
from chronotape.operators import scan


def is_bar_eligible(conditions: str = "conditions", ineligible: Sequence[str] = vocab.INELIGIBLE_CONDITIONS) -> Column:
    """No condition of the print is in the ineligible set; a print without conditions is eligible."""
    banned = F.array(*[F.lit(code) for code in ineligible])
    return ~F.coalesce(F.arrays_overlap(F.col(conditions), banned), F.lit(False))


def bar_aggregates(order: Sequence[str] = vocab.ORDER_KEY) -> list[Column]:
    """Aggregates of one window; all of them combine map-side, so a hot window shuffles as one row."""
    key = F.struct(*[F.col(c) for c in order])
    return [
        F.min_by("price_nano", key).alias("open_nano"),
        F.max("price_nano").alias("high_nano"),
        F.min("price_nano").alias("low_nano"),
        F.max_by("price_nano", key).alias("close_nano"),
        F.sum("size_shares").alias("volume_shares"),
        F.sum(money.notional("price_nano", "size_shares")).alias("notional"),
        F.count("*").cast("int").alias("trade_count"),
    ]


def vwap(zero_volume: str = "raise") -> Column:
    """notional / volume toward zero. An all-zero-size window has no price: fail, or NULL on request."""
    if zero_volume not in ("raise", "null"):
        raise ValueError(f"zero_volume must be raise or null, got {zero_volume!r}")
    empty = F.col("volume_shares") == 0
    instead = F.raise_error(F.lit("vwap of a window with zero volume")) if zero_volume == "raise" else F.lit(None)
    price = F.call_function("div", F.col("notional"), F.when(~empty, F.col("volume_shares")))
    return F.when(empty, instead.cast("bigint")).otherwise(price)


def build_bars(
    prints: DataFrame,
    *,
    window_ns: int = vocab.DEFAULT_WINDOW_NS,
    origin_ns: int | str = 0,
    as_of: int,
    knowledge_lag_ns: int = vocab.DEFAULT_PUBLICATION_LAG_NS,
    receive_time: int = 0,
    process_time: int = 0,
    order: Sequence[str] = vocab.ORDER_KEY,
    keep: Sequence[str] = (),
    ineligible: Sequence[str] = vocab.INELIGIBLE_CONDITIONS,
    zero_volume: str = "raise",
) -> DataFrame:
    """One row per instrument and non-empty window; half-open windows anchored at ``origin_ns``.

    ``origin_ns`` is a constant or the name of a column such as a session open. ``keep`` carries
    constant-per-window columns (a session date) through as extra grouping keys. A window is
    complete when it ended by ``as_of``; it is knowable one publication lag after its end.
    """
    origin = F.col(origin_ns) if isinstance(origin_ns, str) else origin_ns
    windows = prints.where(is_bar_eligible(ineligible=ineligible)).withColumn(
        "__start", window_start("event_time", window_ns, origin)
    )
    bars = windows.groupBy(*keep, "instrument_id", "__start").agg(*bar_aggregates(order))
    end = F.col("__start") + window_ns
    known = end + knowledge_lag_ns
    return bars.select(
        *keep,
        F.col("__start").alias("event_time"),
        F.greatest(F.lit(receive_time).cast("bigint"), known).alias("receive_time"),
        F.greatest(F.lit(process_time).cast("bigint"), known).alias("process_time"),
        known.alias("knowledge_time"),
        F.lit(None).cast("bigint").alias("revision_time"),
        F.lit(vocab.BAR).alias("source_rank"),
        F.lit(vocab.MISSING_SEQUENCE).cast("bigint").alias("vendor_sequence"),
        F.lit(vocab.MISSING_SEQUENCE).cast("bigint").alias("venue_sequence"),
        "instrument_id",
        F.lit(window_ns).cast("bigint").alias("window_ns"),
        "open_nano", "high_nano", "low_nano", "close_nano", "volume_shares",
        vwap(zero_volume).alias("vwap_nano"),
        "trade_count",
        (end <= as_of).alias("is_complete"),
    )


def with_bar_positions(bars: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``ingest_index``: position in (window, instrument) order.

    A chunk is one window, which holds at most one bar per instrument, so no cell can be hot.
    """
    order = ["event_time", "instrument_id"]
    return scan.positions(bars, order, F.col("event_time"), "ingest_index", by, max_cell_rows=None)
