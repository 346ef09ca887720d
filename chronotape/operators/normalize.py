"""Raw vendor records to contract rows: clocks, provenance, identity, exact prices."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.contracts import contract, vocab
from chronotape.contracts.model import Contract, ContractError
from chronotape.functions import money
from chronotape.functions.ordering import order_key
from chronotape.operators.identity import require_instrument, resolve_tickers


@dataclass(frozen=True)
class Clocks:
    """Everything a run needs that is not in the raw bytes; nothing is read from a clock.

    ``receive_time`` may name a column instead of holding an instant, which is what live capture has.
    """

    receive_time: int | str
    process_time: int | str
    raw_partition_id: str
    event_time_source: str
    venue_coverage: str = "sip"
    publication_lag_ns: int = vocab.DEFAULT_PUBLICATION_LAG_NS
    knowledge_policy: str = vocab.BACKFILL

    def __post_init__(self) -> None:
        if self.knowledge_policy not in vocab.KNOWLEDGE_POLICIES:
            raise ContractError(f"unknown knowledge policy {self.knowledge_policy!r}")

    @staticmethod
    def _instant(value: int | str) -> Column:
        return F.col(value) if isinstance(value, str) else F.lit(value).cast("bigint")

    def received(self) -> Column:
        return self._instant(self.receive_time)

    def processed(self) -> Column:
        return self._instant(self.process_time)


def knowledge_time(clocks: Clocks, event_time: str = "event_time") -> Column:
    """Live capture knows a row on receipt; anything else one publication lag after the event."""
    if clocks.knowledge_policy == vocab.LIVE_CAPTURE:
        return clocks.received()
    return F.col(event_time) + clocks.publication_lag_ns


def time_columns(clocks: Clocks) -> dict[str, Column]:
    return {
        "receive_time": clocks.received(),
        "process_time": clocks.processed(),
        "knowledge_time": knowledge_time(clocks),
        "revision_time": F.lit(None).cast("bigint"),
    }


def provenance_columns(clocks: Clocks, source_rank: int) -> dict[str, Column]:
    return {
        "source_rank": F.lit(source_rank),
        "venue_sequence": F.lit(vocab.MISSING_SEQUENCE).cast("bigint"),
        "raw_partition_id": F.lit(clocks.raw_partition_id),
        "event_time_source": F.lit(clocks.event_time_source),
    }


def to_contract(df: DataFrame, shape: Contract, extra: Sequence[str] = ()) -> DataFrame:
    """Contract columns in contract order with contract types and metadata, then ``extra`` ones."""
    return df.select(
        *[F.col(f.name).cast(f.data_type).alias(f.name, metadata=f.struct_field().metadata) for f in shape.fields],
        *extra,
    )


def normalize_trades(raw: DataFrame, history: DataFrame, clocks: Clocks) -> DataFrame:
    """Parsed trades to ``normalized.trade``. One narrow projection after a broadcast identity join."""
    resolved = resolve_tickers(raw, history)
    return to_contract(
        resolved.withColumns(
            {
                "instrument_id": require_instrument(),
                "price_nano": money.nano_from_dollars("price", "price"),
                "is_cancelled": F.lit(False),
                **time_columns(clocks),
                **provenance_columns(clocks, vocab.TRADE),
            }
        ),
        contract("normalized.trade"),
    )


def normalize_quotes(raw: DataFrame, history: DataFrame, clocks: Clocks) -> DataFrame:
    """Parsed quotes to ``normalized.quote``, stamped with the feed's venue coverage."""
    resolved = resolve_tickers(raw, history)
    return to_contract(
        resolved.withColumns(
            {
                "instrument_id": require_instrument(),
                "bid_price_nano": money.nano_from_dollars("bid_price", "bid_price"),
                "ask_price_nano": money.nano_from_dollars("ask_price", "ask_price"),
                "venue_coverage": F.lit(clocks.venue_coverage),
                **time_columns(clocks),
                **provenance_columns(clocks, vocab.QUOTE),
            }
        ),
        contract("normalized.quote"),
    )


def quote_metrics(quotes: DataFrame) -> DataFrame:
    """Mid with its half-nano remainder, spread, and locked/crossed flags; no quote is discarded."""
    bid, ask = F.col("bid_price_nano"), F.col("ask_price_nano")
    mid = money.mid_price(bid, ask)
    return quotes.withColumns(
        {
            "mid_nano": mid["value"],
            "mid_half_nano": mid["remainder"],
            "spread_nano": ask - bid,
            "is_locked": bid == ask,
            "is_crossed": bid > ask,
        }
    )


def sort_total(df: DataFrame, partitions: int | None = None, before: tuple[str, ...] = ()) -> DataFrame:
    """Total order by range partitioning on the full key: a hot instrument or instant still splits."""
    columns = [*before, *vocab.ORDER_KEY]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def merge_streams(*streams: DataFrame) -> DataFrame:
    """Trades, quotes, statuses and bars as one stream; order it with :func:`sort_total`."""
    merged = streams[0]
    for stream in streams[1:]:
        merged = merged.unionByName(stream, allowMissingColumns=True)
    return merged


def after_key(df: DataFrame, key: Column) -> DataFrame:
    """Rows strictly after a position in the total order."""
    return df.where(order_key() > key)
