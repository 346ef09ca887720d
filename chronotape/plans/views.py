"""The driver's tables seen as market data, each view as a DataFrame and as the same SQL text.

Ticks are ``events``: the user is the instrument, ``value`` holds exact cents, ``props.k`` sizes the
print. Fills are ``lineitem``: the part is the instrument. Everything else is derived from those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.functions import money
from chronotape.functions.instants import ns_from_timestamp_ntz

JAN_1 = 1_704_067_200 * vocab.NS_PER_SECOND  # 2024-01-01T00:00:00Z, before every tick
DAY, HOUR = vocab.NS_PER_DAY, vocab.NS_PER_HOUR
LAG = vocab.DEFAULT_PUBLICATION_LAG_NS
NANOS_PER_CENT = 10_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade-shaped ticks with their ordering columns."""
    return shape_ticks(table(spark, sf_dir, "events"))


def shape_ticks(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("user_id").alias("instrument_id"),
        ns_from_timestamp_ntz("ts").alias("event_time"),
        F.lit(vocab.TRADE).alias("source_rank"),
        F.col("event_id").alias("vendor_sequence"),
        F.lit(vocab.MISSING_SEQUENCE).cast("bigint").alias("venue_sequence"),
        F.col("event_id").alias("ingest_index"),
        F.expr(f"{_cents('value')} * {NANOS_PER_CENT}").alias("price_nano"),
        (F.get_json_object("props", "$.k").cast("bigint") + 1).alias("size_shares"),
        F.array("event_type").alias("conditions"),
        "event_type",
    )


TICKS_SQL = f"""ticks AS (
    SELECT event_id, user_id AS instrument_id, epoch_us(ts) * 1000 AS event_time, event_type,
           {_cents('value')} * {NANOS_PER_CENT} AS price_nano,
           CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS size_shares
    FROM events)"""

# Prints of this type do not reach bars, as form-T prints would not.
INELIGIBLE_TYPES = ("error",)


def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Execution-shaped fills; fees are a rational rate of notional rounded against us."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("instrument_id"),
        F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy").alias("side"),
        F.col("l_quantity").cast("bigint").alias("quantity_shares"),
        F.expr(f"{_cents('l_extendedprice')} * {NANOS_PER_CENT}").alias("value_nano"),
        F.expr(_cents("l_tax")).cast("int").alias("tax_percent"),
        F.expr(_cents("l_discount")).cast("int").alias("discount_percent"),
        ns_from_timestamp_ntz("l_shipdate").alias("event_time"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus",
    )
    priced = lines.withColumn("price_nano", F.call_function("div", F.col("value_nano"), F.col("quantity_shares")))
    return priced.withColumns(
        {
            "commission_nano": F.col("quantity_shares") * 5_000_000,
            "regulatory_fees_nano": money.apply_rate("value_nano", F.col("tax_percent"), 100)["value"],
            "arrival_price_nano": F.call_function(
                "div", F.col("price_nano") * (100 - F.col("discount_percent")), F.lit(100)
            ),
        }
    )


FILLS_SQL = f"""lines AS (
    SELECT l_partkey AS instrument_id, CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS side,
           CAST(l_quantity AS BIGINT) AS quantity_shares, {_cents('l_extendedprice')} * {NANOS_PER_CENT} AS value_nano,
           {_cents('l_tax')} AS tax_percent, {_cents('l_discount')} AS discount_percent,
           epoch_us(l_shipdate) * 1000 AS event_time,
           l_orderkey, l_linenumber, l_suppkey, l_returnflag, l_linestatus
    FROM lineitem),
fills AS (
    SELECT *, CAST(value_nano // quantity_shares AS BIGINT) AS price_nano,
           quantity_shares * 5000000 AS commission_nano,
           CAST((value_nano * tax_percent + 99) // 100 AS BIGINT) AS regulatory_fees_nano,
           CAST((value_nano // quantity_shares) * (100 - discount_percent) // 100 AS BIGINT) AS arrival_price_nano
    FROM lines)"""


def ticker_history(spark: SparkSession, sf_dir: str, *, overlap: bool = False, gaps: bool = False) -> DataFrame:
    """Three consecutive users share a ticker, each for ten days; the last keeps it.

    ``overlap`` lets every seventh user hold on five days too long; ``gaps`` drops every fifth user.
    """
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("instrument_id")).distinct()
    era = F.col("instrument_id") % 3
    end = F.when(era < 2, F.lit(JAN_1) + (era + 1) * 10 * DAY)
    if overlap:
        end = end + F.when(F.col("instrument_id") % 7 == 0, 5 * DAY).otherwise(0)
    history = users.select(
        "instrument_id",
        F.concat(F.lit("SYM"), F.call_function("div", F.col("instrument_id"), F.lit(3)).cast("string")).alias("ticker"),
        (F.lit(JAN_1) + era * 10 * DAY).alias("effective_time"),
        end.alias("end_time"),
    )
    return history.where("instrument_id % 5 <> 0") if gaps else history


def history_sql(*, overlap: bool = False, gaps: bool = False) -> str:
    late = f" + CASE WHEN user_id % 7 = 0 THEN {5 * DAY} ELSE 0 END" if overlap else ""
    return f"""history AS (
    SELECT user_id AS instrument_id, 'SYM' || CAST(user_id // 3 AS VARCHAR) AS ticker,
           {JAN_1} + (user_id % 3) * {10 * DAY} AS effective_time,
           CASE WHEN user_id % 3 < 2 THEN {JAN_1} + (user_id % 3 + 1) * {10 * DAY}{late} END AS end_time
    FROM (SELECT DISTINCT user_id FROM events) {"WHERE user_id % 5 <> 0" if gaps else ""})"""


def named_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks that carry a symbol instead of an instrument."""
    symbol = F.concat(F.lit("SYM"), F.call_function("div", F.col("instrument_id"), F.lit(3)).cast("string"))
    return ticks(spark, sf_dir).withColumn("symbol", symbol).drop("instrument_id")


NAMED_SQL = f"""{TICKS_SQL},
named AS (SELECT * EXCLUDE (instrument_id), 'SYM' || CAST(instrument_id // 3 AS VARCHAR) AS symbol FROM ticks)"""

OPEN_OFFSET, CLOSE_OFFSET = 13 * HOUR + HOUR // 2, 20 * HOUR


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 13:30 to 20:00 session on every day that has ticks."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("session_date")).distinct()
    midnight = F.unix_date("session_date").cast("bigint") * DAY
    return days.select(
        "session_date",
        (midnight + OPEN_OFFSET).alias("regular_open_ns"),
        (midnight + CLOSE_OFFSET).alias("regular_close_ns"),
    )


CALENDAR_SQL = f"""calendar AS (
    SELECT session_date, epoch_us(CAST(session_date AS TIMESTAMP)) * 1000 + {OPEN_OFFSET} AS regular_open_ns,
           epoch_us(CAST(session_date AS TIMESTAMP)) * 1000 + {CLOSE_OFFSET} AS regular_close_ns
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS session_date FROM events))"""


UNEVEN_STEP = 17 * vocab.NS_PER_MINUTE


def uneven_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same days with opens that differ from day to day, so windows of two days never line up."""
    later = F.pmod(F.unix_date("session_date"), F.lit(3)).cast("bigint") * UNEVEN_STEP
    return calendar(spark, sf_dir).withColumn("regular_open_ns", F.col("regular_open_ns") + later)


UNEVEN_SQL = f"""{CALENDAR_SQL}, uneven AS (
    SELECT * REPLACE (regular_open_ns + (CAST(session_date AS DATE) - DATE '1970-01-01') % 3 * {UNEVEN_STEP} AS regular_open_ns) FROM calendar)"""


def known_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with a knowledge time one minute per share after the event."""
    return ticks(spark, sf_dir).withColumn(
        "knowledge_time", F.col("event_time") + F.col("size_shares") * vocab.NS_PER_MINUTE
    )


KNOWN_SQL = f"""{TICKS_SQL},
known AS (SELECT *, event_time + size_shares * {vocab.NS_PER_MINUTE} AS knowledge_time FROM ticks),
decisions AS (SELECT * FROM known WHERE event_type = 'purchase'),
quotes AS (SELECT * FROM known WHERE event_type = 'view')"""


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A broker event log from ``lineitem``, with the defects its columns happen to hold."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT))").alias("event_id"),
        F.expr("concat('acct-', l_suppkey % 5)").alias("account_id"),
        F.expr("concat_ws('-', l_orderkey, l_linenumber)").alias("broker_event_id"),
        F.expr("CASE WHEN l_returnflag <> 'N' THEN concat_ws('-', 'x', l_orderkey, l_linenumber) END").alias("execution_id"),
        F.expr(f"CASE WHEN {_cents('l_discount')} > 5 THEN l_orderkey * 10 + l_linenumber END").alias("broker_sequence"),
        F.expr("CASE WHEN l_linestatus = 'F' THEN 'fill' ELSE 'ack' END").alias("event_type"),
        ns_from_timestamp_ntz("l_shipdate").alias("event_time_ns"),
        (ns_from_timestamp_ntz("l_shipdate") + (F.col("l_quantity").cast("bigint") - 3) * vocab.NS_PER_SECOND).alias(
            "knowledge_time_ns"
        ),
    ).withColumn("receive_time_ns", F.greatest("knowledge_time_ns", "event_time_ns"))


ORDER_EVENTS_SQL = f"""order_events AS (
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT)) AS event_id,
           'acct-' || CAST(l_suppkey % 5 AS VARCHAR) AS account_id,
           concat_ws('-', l_orderkey, l_linenumber) AS broker_event_id,
           CASE WHEN l_returnflag <> 'N' THEN concat_ws('-', 'x', l_orderkey, l_linenumber) END AS execution_id,
           CASE WHEN {_cents('l_discount')} > 5 THEN l_orderkey * 10 + l_linenumber END AS broker_sequence,
           CASE WHEN l_linestatus = 'F' THEN 'fill' ELSE 'ack' END AS event_type,
           epoch_us(l_shipdate) * 1000 AS event_time_ns,
           epoch_us(l_shipdate) * 1000 + (CAST(l_quantity AS BIGINT) - 3) * {vocab.NS_PER_SECOND} AS knowledge_time_ns
    FROM lineitem)"""


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An experiment registry from ``orders``: the customer is the family, status P is not a known one."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("experiment_id"),
        F.concat(F.lit("fam-"), F.col("o_custkey").cast("string")).alias("family_id"),
        (F.col("o_orderkey") % 64).cast("int").alias("trial_index"),
        F.expr(
            "CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'succeeded' ELSE 'paused' END"
        ).alias("status"),
    )


EXPERIMENTS_SQL = """experiments AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS experiment_id, 'fam-' || CAST(o_custkey AS VARCHAR) AS family_id,
           CAST(o_orderkey % 64 AS INTEGER) AS trial_index,
           CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'succeeded' ELSE 'paused' END AS status
    FROM orders)"""
