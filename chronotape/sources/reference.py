"""The reference bundle beside a raw partition: instrument, ticker history, calendar session."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotape.functions.instants import ns_from_rfc3339

# Fixed value: layout of the bundle document.
BUNDLE_SCHEMA = """
    instrument struct<instrument_id bigint, primary_exchange string, security_type string,
                      lot_size int, is_tradable boolean, effective_time string>,
    ticker_history array<struct<instrument_id bigint, ticker string, effective_time string, end_time string>>,
    calendar struct<session_date string, is_trading_day boolean, regular_open_ns bigint, regular_close_ns bigint,
                    is_early_close boolean, opening_auction_ns bigint, closing_auction_ns bigint>
"""


@dataclass(frozen=True)
class Reference:
    instruments: DataFrame
    ticker_history: DataFrame
    calendar: DataFrame


def _instant(name: str):
    """Parsed instant; malformed text fails instead of becoming NULL."""
    raw = F.col(name)
    value = ns_from_rfc3339(raw)
    bad = F.raise_error(F.concat(F.lit(f"{name}: "), raw, F.lit(" is not an instant"))).cast("bigint")
    return F.when(raw.isNull() | (raw == ""), None).otherwise(F.coalesce(value, bad)).alias(name)


def load_reference(spark: SparkSession, path: str) -> Reference:
    """Read one bundle, or a directory or glob of bundles."""
    bundle = spark.read.schema(BUNDLE_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    instruments = bundle.select("instrument.*").select(
        "instrument_id", "primary_exchange", "security_type", "lot_size", "is_tradable", _instant("effective_time")
    )
    history = bundle.select(F.inline("ticker_history")).select(
        "instrument_id", "ticker", _instant("effective_time"), _instant("end_time")
    )
    calendar = bundle.select("calendar.*").withColumn("session_date", F.to_date("session_date"))
    return Reference(instruments, history, calendar)
