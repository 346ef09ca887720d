"""Queries over time: as-of joins, revisions, splits, fees, state logs, latency, streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.operators import accounts, asof, audits, history, scan
from chronotape.operators.history import FeeComponent, FeeSchedule
from chronotape.plans import views as v
from chronotape.plans.catalogue import query

def _or_none(column: str) -> Column:
    """An absent match shows as -1."""
    return F.coalesce(column, F.lit(-1).cast("bigint")).alias(column)


def _decisions_and_quotes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    known = v.known_ticks(spark, sf)
    decisions = known.where(F.col("event_type") == "purchase").select(
        "event_id", "instrument_id", "event_time", "price_nano", *vocab.ORDER_KEY[1:]
    )
    quotes = known.where(F.col("event_type") == "view").select(
        "event_id", "instrument_id", "event_time", "knowledge_time", "price_nano", *vocab.ORDER_KEY[1:]
    )
    return decisions, quotes


def _matched(joined: DataFrame) -> DataFrame:
    return joined.select(
        "event_id", _or_none("quote_event_id"), _or_none("quote_price_nano")
    )


_LATEST_SQL = """SELECT d.event_id, coalesce(q.event_id, -1) AS quote_event_id, coalesce(q.price_nano, -1) AS quote_price_nano
    FROM decisions d ASOF LEFT JOIN quotes q ON d.instrument_id = q.instrument_id AND d.event_time {op} q.event_time"""


@query("pit_asof", f"WITH {v.KNOWN_SQL} {_LATEST_SQL.format(op='>=')}")
def pit_asof(spark: SparkSession, sf: str) -> DataFrame:
    decisions, quotes = _decisions_and_quotes(spark, sf)
    return _matched(
        asof.asof_join(
            decisions, quotes, by=["instrument_id"], left_on=["event_time"], right_on=["event_time"],
            payload=["event_id", "price_nano"], right_tie=["event_id"], prefix="quote_",
        )
    )


@query("pit_asof_strict", f"WITH {v.KNOWN_SQL} {_LATEST_SQL.format(op='>')}")
def pit_asof_strict(spark: SparkSession, sf: str) -> DataFrame:
    """The last quote strictly before the order in the five-column total order."""
    decisions, quotes = _decisions_and_quotes(spark, sf)
    return _matched(asof.quote_before_order(decisions, quotes, payload=["event_id", "price_nano"]))


@query("pit_violations", f"""WITH {v.KNOWN_SQL},
    j AS (SELECT d.event_time, q.knowledge_time FROM decisions d ASOF LEFT JOIN quotes q
          ON d.instrument_id = q.instrument_id AND d.event_time >= q.event_time)
    SELECT count(*) AS decisions, count(*) FILTER (WHERE knowledge_time > event_time) AS look_ahead_rows FROM j""")
def pit_violations(spark: SparkSession, sf: str) -> DataFrame:
    decisions, quotes = _decisions_and_quotes(spark, sf)
    flagged = asof.usable_asof_join(
        decisions, quotes, by=["instrument_id"], decision="event_time", payload=["price_nano"],
        right_tie=["event_id"], look_ahead="flag", prefix="quote_",
    )
    return asof.look_ahead_report(flagged)


@query("pit_known", f"""WITH {v.KNOWN_SQL},
    j AS (SELECT d.event_id, q.event_id AS quote_event_id, q.price_nano AS quote_price_nano,
                 row_number() OVER (PARTITION BY d.event_id ORDER BY q.event_time DESC, q.event_id DESC) AS r
          FROM decisions d LEFT JOIN quotes q ON d.instrument_id = q.instrument_id AND q.knowledge_time <= d.event_time)
    SELECT event_id, coalesce(quote_event_id, -1) AS quote_event_id, coalesce(quote_price_nano, -1) AS quote_price_nano
    FROM j WHERE r = 1""")
def pit_known(spark: SparkSession, sf: str) -> DataFrame:
    decisions, quotes = _decisions_and_quotes(spark, sf)
    return _matched(
        asof.usable_asof_join(
            decisions, quotes, by=["instrument_id"], decision="event_time", payload=["event_id", "price_nano"],
            right_tie=["event_id"], look_ahead="known", prefix="quote_",
        )
    )


@query("halt_decisions", f"""WITH {v.TICKS_SQL},
    market AS (SELECT *, instrument_id % 10 AS venue FROM ticks),
    st AS (SELECT venue, event_id, event_time, CASE event_type WHEN 'error' THEN 'halted' ELSE 'resumed' END AS status,
                  price_nano - price_nano // 4 AS lo, price_nano + price_nano // 4 AS hi
           FROM market WHERE event_type IN ('error', 'signup')),
    o AS (SELECT m.event_id, m.price_nano, st.status, st.lo, st.hi FROM (SELECT * FROM market WHERE event_type = 'purchase') m
          ASOF LEFT JOIN st ON m.venue = st.venue AND m.event_time >= st.event_time)
    SELECT event_id, CASE WHEN status = 'halted' THEN 'symbol_halted' WHEN price_nano < lo OR price_nano > hi
           THEN 'outside_luld_band' ELSE 'approved' END AS risk_reason FROM o""")
def halt_decisions(spark: SparkSession, sf: str) -> DataFrame:
    market = v.ticks(spark, sf).withColumn("instrument_id", F.col("instrument_id") % 10)
    price, quarter = F.col("price_nano"), F.call_function("div", F.col("price_nano"), F.lit(4))
    statuses = market.where(F.col("event_type").isin("error", "signup")).withColumns(
        {
            "status": F.when(F.col("event_type") == "error", "halted").otherwise("resumed"),
            "luld_lower_nano": price - quarter,
            "luld_upper_nano": price + quarter,
        }
    )
    orders = market.where(F.col("event_type") == "purchase").select("event_id", "instrument_id", "event_time", "price_nano")
    return asof.with_halt_decision(orders, statuses).select("event_id", "risk_reason")


@query("borrow_decisions", f"""WITH {v.KNOWN_SQL},
    borrow AS (SELECT * FROM known WHERE event_type = 'click'),
    j AS (SELECT d.event_id, d.size_shares AS wanted, b.event_id AS b_id, b.size_shares AS available,
                 row_number() OVER (PARTITION BY d.event_id ORDER BY b.event_time DESC, b.event_id DESC) AS r
          FROM decisions d LEFT JOIN borrow b ON d.instrument_id = b.instrument_id AND b.knowledge_time <= d.event_time)
    SELECT event_id, CASE WHEN b_id % 3 <> 0 AND available >= wanted THEN 'approved' ELSE 'short_not_supported' END AS risk_reason
    FROM j WHERE r = 1""")
def borrow_decisions(spark: SparkSession, sf: str) -> DataFrame:
    known = v.known_ticks(spark, sf)
    borrow = known.where(F.col("event_type") == "click").select(
        "instrument_id", F.col("event_time").alias("effective_time"), "knowledge_time",
        (F.col("event_id") % 3 != 0).alias("is_shortable"), F.col("size_shares").alias("available_shares"),
    )
    shorts = known.where(F.col("event_type") == "purchase").select(
        "event_id", "instrument_id", F.col("event_time").alias("decision_time"), F.col("size_shares").alias("quantity_shares")
    )
    return asof.with_borrow_decision(shorts, borrow).select("event_id", "risk_reason")


_REVISION_AS_OF = v.JAN_1 + 20 * v.DAY


@query("revisions_asof", f"""WITH {v.KNOWN_SQL},
    r AS (SELECT *, row_number() OVER (PARTITION BY instrument_id, event_type ORDER BY event_time DESC, event_id DESC) AS r
          FROM known WHERE knowledge_time <= {_REVISION_AS_OF})
    SELECT instrument_id, event_type, event_id AS trade_id, price_nano, event_id % 10 = 0 AS is_cancelled FROM r WHERE r = 1""")
def revisions_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks as revisions of one row per instrument and type; a cancel flips a flag and stays."""
    revised = v.known_ticks(spark, sf).select(
        "instrument_id", "event_type", F.col("event_id").alias("trade_id"), "price_nano", "knowledge_time", "ingest_index",
        F.col("event_time").alias("revision_time"), (F.col("event_id") % 10 == 0).alias("is_cancelled"),
    )
    latest = history.as_known(revised, ["instrument_id", "event_type"], _REVISION_AS_OF)
    return latest.select("instrument_id", "event_type", "trade_id", "price_nano", "is_cancelled")


_SPLIT_1, _SPLIT_2 = 852_076_800 * vocab.NS_PER_SECOND, 915_148_800 * vocab.NS_PER_SECOND  # 1997, 1999
_SPLIT_DECISION = 946_684_800 * vocab.NS_PER_SECOND


@query("split_adjust", f"""WITH {v.FILLS_SQL},
    f AS (SELECT *, CASE WHEN instrument_id % 7 = 0 AND event_time >= {_SPLIT_1} THEN 2 ELSE 1 END
                  * CASE WHEN instrument_id % 11 = 0 AND event_time >= {_SPLIT_2} THEN 3 ELSE 1 END AS num,
                  CASE WHEN instrument_id % 11 = 0 AND event_time >= {_SPLIT_2} THEN 2 ELSE 1 END AS den FROM fills)
    SELECT instrument_id, event_time, l_orderkey, l_linenumber, l_suppkey,
           CAST(CAST(price_nano AS HUGEINT) * num // den AS BIGINT) AS adjusted_price_nano,
           CAST(CAST(quantity_shares AS HUGEINT) * den // num AS BIGINT) AS adjusted_size_shares FROM f""")
def split_adjust(spark: SparkSession, sf: str) -> DataFrame:
    """2-for-1 and 3-for-2 splits of some parts; a third kind is announced too late to count."""
    parts = v.table(spark, sf, "part").select(F.col("p_partkey").alias("instrument_id"))

    def split(divisor: int, at: int, num: int, den: int, announced: int) -> DataFrame:
        return parts.where(F.col("instrument_id") % divisor == 0).select(
            "instrument_id", F.lit("split").alias("action_type"), F.lit(announced).alias("announcement_time"),
            F.lit(at).alias("effective_time"), F.lit(num).alias("split_numerator"), F.lit(den).alias("split_denominator"),
        )

    actions = (
        split(7, _SPLIT_1, 2, 1, _SPLIT_1 - 30 * v.DAY)
        .unionByName(split(11, _SPLIT_2, 3, 2, _SPLIT_2 - 30 * v.DAY))
        .unionByName(split(5, _SPLIT_2, 9, 1, _SPLIT_DECISION + 1))
    )
    prints = v.fills(spark, sf).withColumnRenamed("quantity_shares", "size_shares").select(
        "instrument_id", "event_time", "l_orderkey", "l_linenumber", "l_suppkey", "price_nano", "size_shares"
    )
    return history.split_adjusted(prints, actions, _SPLIT_DECISION).drop("price_nano", "size_shares")


_FEE_CHANGE = _SPLIT_1
SCHEDULE = FeeSchedule(
    (
        FeeComponent("commission", 5_100, 1, "per_share", 0),
        FeeComponent("commission", 10_000_001, 3_000, "per_share", _FEE_CHANGE),
        FeeComponent("regulatory", 229, 10_000_000, "per_notional", _FEE_CHANGE),
        FeeComponent("ticket", 250_000_000, 1, "per_order", 0),
    )
)


@query("fee_asof", f"""WITH {v.FILLS_SQL}
    SELECT l_orderkey, l_linenumber, l_suppkey, instrument_id, quantity_shares,
           CASE WHEN event_time >= {_FEE_CHANGE} THEN CAST((CAST(quantity_shares AS HUGEINT) * 10000001 + 2999) // 3000 AS BIGINT)
                ELSE quantity_shares * 5100 END AS commission_nano,
           CASE WHEN event_time >= {_FEE_CHANGE} THEN
                CAST((CAST(price_nano AS HUGEINT) * quantity_shares * 229 + 9999999) // 10000000 AS BIGINT) END AS regulatory_nano,
           CAST(250000000 AS BIGINT) AS ticket_nano FROM fills""")
def fee_asof(spark: SparkSession, sf: str) -> DataFrame:
    fills = v.fills(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "instrument_id", "quantity_shares", "price_nano", "event_time"
    )
    return history.with_fees(fills, SCHEDULE).drop("price_nano", "event_time")


STATE_OF_TYPE = {"view": "research", "click": "shadow", "signup": "paper", "purchase": "safe", "error": "off"}
_STATE_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{s}'" for k, s in STATE_OF_TYPE.items()) + " END"
_MOVES_SQL = ", ".join(f"'{a}>{b}'" for a, targets in vocab.STATE_MOVES.items() for b in targets)


@query("state_transitions", f"""WITH {v.TICKS_SQL},
    log AS (SELECT instrument_id, event_id, {_STATE_CASE} AS state,
            lag({_STATE_CASE}) OVER (PARTITION BY instrument_id ORDER BY event_time, event_id) AS previous_state FROM ticks)
    SELECT instrument_id, event_id, previous_state, state FROM log
    WHERE previous_state IS NOT NULL AND state <> previous_state AND state <> 'safe'
      AND previous_state || '>' || state NOT IN ({_MOVES_SQL})""")
def state_transitions(spark: SparkSession, sf: str) -> DataFrame:
    log = v.ticks(spark, sf).select("instrument_id", "event_id", "event_time", F.expr(_STATE_CASE).alias("state"))
    illegal = audits.illegal_moves(log, ["instrument_id"], ["event_time", "event_id"], scan.time_chunk("event_time", v.DAY))
    return illegal.select("instrument_id", "event_id", "previous_state", "state")


_CAPITAL_CASE = "CASE event_type WHEN 'purchase' THEN 'live' WHEN 'signup' THEN 'canary' ELSE 'paper' END"


@query("capital_at_risk", f"""WITH {v.TICKS_SQL}, s AS (SELECT instrument_id, {_CAPITAL_CASE} AS state FROM ticks)
    SELECT instrument_id, count(*) FILTER (WHERE state IN ('canary', 'live')) AS capital_events, count(*) AS events
    FROM s GROUP BY instrument_id""")
def capital_at_risk(spark: SparkSession, sf: str) -> DataFrame:
    states = v.ticks(spark, sf).select("instrument_id", F.expr(_CAPITAL_CASE).alias("state"))
    return states.groupBy("instrument_id").agg(
        F.count_if(audits.is_capital_at_risk()).alias("capital_events"), F.count("*").alias("events")
    )


_ORDER_CASE = "CASE event_type WHEN 'purchase' THEN 'filled' WHEN 'click' THEN 'partially_filled' ELSE 'acknowledged' END"


@query("terminal_violations", f"""WITH {v.TICKS_SQL},
    log AS (SELECT instrument_id, event_id, {_ORDER_CASE} AS state,
            max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY instrument_id
                ORDER BY event_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended FROM ticks)
    SELECT instrument_id, event_id, state FROM log WHERE ended = 1""")
def terminal_violations(spark: SparkSession, sf: str) -> DataFrame:
    log = v.ticks(spark, sf).select("instrument_id", "event_id", "event_time", F.expr(_ORDER_CASE).alias("state"))
    late = audits.events_after_terminal(
        log, ["instrument_id"], ["event_time", "event_id"], scan.time_chunk("event_time", v.DAY)
    )
    return late.select("instrument_id", "event_id", "state")


_PERCENTILES = (50, 95, 99)


@query("latency_percentiles", f"""WITH {v.KNOWN_SQL},
    l AS (SELECT event_type, knowledge_time - event_time AS lag FROM known),
    r AS (SELECT event_type, lag, row_number() OVER (PARTITION BY event_type ORDER BY lag) AS k,
                 count(*) OVER (PARTITION BY event_type) AS n FROM l)
    SELECT event_type, max(n) AS rows, {", ".join(f"min(lag) FILTER (WHERE k * 100 >= n * {p}) AS p{p}" for p in _PERCENTILES)}
    FROM r GROUP BY event_type""")
def latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    lag = F.col("knowledge_time") - F.col("event_time")
    return accounts.percentile_lags(v.known_ticks(spark, sf), ["event_type"], lag, _PERCENTILES, chunk_ns=v.HOUR)


@query("gap_percentiles", f"""WITH {v.TICKS_SQL},
    l AS (SELECT event_type, event_time - lag(event_time) OVER (PARTITION BY instrument_id ORDER BY event_time, event_id) AS lag FROM ticks),
    r AS (SELECT event_type, lag, row_number() OVER (PARTITION BY event_type ORDER BY lag) AS k,
                 count(*) OVER (PARTITION BY event_type) AS n FROM l WHERE lag IS NOT NULL)
    SELECT event_type, max(n) AS rows, {", ".join(f"min(lag) FILTER (WHERE k * 100 >= n * {p}) AS p{p}" for p in _PERCENTILES)}
    FROM r GROUP BY event_type""")
def gap_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Silence between ticks of one instrument, by the type that ended it: a stale-feed measure."""
    ticks = v.ticks(spark, sf).select("instrument_id", "event_id", "event_time", "event_type")
    gaps = scan.running(
        ticks, ["instrument_id"], ["event_time", "event_id"], scan.time_chunk("event_time", v.DAY),
        [scan.Running("previous", "last", F.col("event_time"))],
    ).where("previous IS NOT NULL")
    lag = F.col("event_time") - F.col("previous")
    return accounts.percentile_lags(gaps, ["event_type"], lag, _PERCENTILES, chunk_ns=v.HOUR)
