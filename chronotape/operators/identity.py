"""Symbols to permanent instrument ids, as of the event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotape.functions.instants import covers
from chronotape.operators.sizing import broadcast_if_small


def _sweep(keys: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def holder_segments(history: DataFrame) -> DataFrame:
    """Ticker history as disjoint half-open segments: ``ticker, start, end, holders, instrument_id``.

    Overlapping rows of one instrument merge first, so repeats of the same assignment are harmless.
    A sweep over interval edges then counts distinct holders; ``instrument_id`` is set only where
    there is exactly one. Segments never overlap, so joining events to them adds no rows.
    """
    valid = history.where(F.col("end_time").isNull() | (F.col("end_time") > F.col("effective_time")))
    both_ends = F.array(
        F.struct(F.col("effective_time").alias("at"), F.lit(1).alias("step")),
        F.struct(F.col("end_time").alias("at"), F.lit(-1).alias("step")),
    )
    edges = valid.select("ticker", "instrument_id", F.inline(both_ends)).where("at IS NOT NULL")
    per_instrument = ["ticker", "instrument_id"]
    depth = (
        edges.groupBy(*per_instrument, "at").agg(F.sum("step").alias("step"))
        .withColumn("depth", F.sum("step").over(_sweep(per_instrument)))
        .withColumn(
            "change",
            (F.col("depth") > 0).cast("int") - ((F.col("depth") - F.col("step")) > 0).cast("int"),
        )
        .where("change <> 0")
    )
    changes = depth.groupBy("ticker", "at").agg(
        F.sum("change").alias("change"),
        F.sum(F.col("change") * F.col("instrument_id").cast("decimal(20,0)")).alias("id_change"),
    )
    along = _sweep(["ticker"])
    holders = F.sum("change").over(along)
    id_sum = F.sum("id_change").over(along)
    return changes.select(
        "ticker",
        F.col("at").alias("start"),
        F.lead("at").over(Window.partitionBy("ticker").orderBy("at")).alias("end"),
        holders.cast("int").alias("holders"),
        F.when(holders == 1, id_sum.cast("bigint")).alias("instrument_id"),
    ).where("holders > 0")


def resolve_tickers(events: DataFrame, history: DataFrame, *, symbol: str = "symbol", at: str = "event_time") -> DataFrame:
    """Add ``instrument_id`` and ``holders`` (0 none, 1 resolved, more = ambiguous); every row kept."""
    edges = history.select("end_time").unionByName(history.select("end_time"))  # two per row at most
    segments = broadcast_if_small(holder_segments(history), sized_by=edges).alias("seg")
    match = (F.col("seg.ticker") == F.col(f"ev.{symbol}")) & covers(f"ev.{at}", "seg.start", "seg.end")
    return events.alias("ev").join(segments, match, "left").select(
        "ev.*", F.col("seg.instrument_id"), F.coalesce("seg.holders", F.lit(0)).alias("holders")
    )


def require_instrument(symbol: str = "symbol", at: str = "event_time") -> Column:
    """The resolved id, or a task failure for an unknown or ambiguous symbol."""
    where = F.concat(F.col(symbol), F.lit(" at "), F.col(at).cast("string"))
    return (
        F.when(F.col("holders") == 1, F.col("instrument_id"))
        .when(F.col("holders") == 0, F.raise_error(F.concat(F.lit("no instrument held "), where)).cast("bigint"))
        .otherwise(
            F.raise_error(
                F.concat(where, F.lit(" resolves to "), F.col("holders").cast("string"), F.lit(" instruments"))
            ).cast("bigint")
        )
    )


def overlapping_assignments(history: DataFrame) -> DataFrame:
    """Segments during which one ticker had several holders: defects to fix before any resolution."""
    return holder_segments(history).where("holders > 1").select("ticker", "start", "end", "holders")
