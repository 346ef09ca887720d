"""Queries over ticks: normalisation, identity, sessions, bars, scalar conversions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.functions import encoding, instants, money
from chronotape.functions.ordering import sentinel
from chronotape.operators import bars, identity, normalize, scan
from chronotape.operators.sizing import broadcast_if_small
from chronotape.plans import views as v
from chronotape.plans.catalogue import query

AS_OF = v.JAN_1 + 15 * v.DAY
BAR_COLUMNS = (
    "instrument_id", "event_time", "knowledge_time", "open_nano", "high_nano", "low_nano", "close_nano",
    "volume_shares", "vwap_nano", "trade_count", "is_complete",
)


def bars_sql(window: int, origin: str = str(v.JAN_1), source: str = "ticks", as_of: int = AS_OF) -> str:
    start = f"event_time - (event_time - {origin}) % {window}"
    return f"""
    SELECT instrument_id, {start} AS event_time, {start} + {window + v.LAG} AS knowledge_time,
           first(price_nano ORDER BY event_time, event_id) AS open_nano, max(price_nano) AS high_nano,
           min(price_nano) AS low_nano, last(price_nano ORDER BY event_time, event_id) AS close_nano,
           CAST(sum(size_shares) AS BIGINT) AS volume_shares,
           CAST(sum(CAST(price_nano AS HUGEINT) * size_shares) // sum(size_shares) AS BIGINT) AS vwap_nano,
           CAST(count(*) AS INTEGER) AS trade_count, {start} + {window} <= {as_of} AS is_complete
    FROM {source} WHERE event_type NOT IN ('error') GROUP BY 1, 2, 3, {start}"""


def tick_bars(ticks: DataFrame, window_ns: int, **options) -> DataFrame:
    built = bars.build_bars(
        ticks, window_ns=window_ns, as_of=AS_OF, ineligible=v.INELIGIBLE_TYPES, **{"origin_ns": v.JAN_1, **options}
    )
    return built.select(*BAR_COLUMNS)


@query("bars_hourly", f"WITH {v.TICKS_SQL} {bars_sql(v.HOUR)}")
def bars_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return tick_bars(v.ticks(spark, sf), v.HOUR)


@query("bars_daily", f"WITH {v.TICKS_SQL} {bars_sql(v.DAY)}")
def bars_daily(spark: SparkSession, sf: str) -> DataFrame:
    return tick_bars(v.ticks(spark, sf), v.DAY)


@query("bars_daily_complete", f"WITH {v.TICKS_SQL}, b AS ({bars_sql(v.DAY)}) SELECT * FROM b WHERE is_complete")
def bars_daily_complete(spark: SparkSession, sf: str) -> DataFrame:
    return tick_bars(v.ticks(spark, sf), v.DAY).where("is_complete")


@query("bars_zero_volume", f"""WITH {v.TICKS_SQL}, z AS (SELECT * REPLACE (size_shares - 1 AS size_shares) FROM ticks)
    SELECT instrument_id, event_time - (event_time - {v.JAN_1}) % {v.HOUR} AS event_time,
           CAST(sum(size_shares) AS BIGINT) AS volume_shares,
           CASE WHEN sum(size_shares) = 0 THEN -1 ELSE
               CAST(sum(CAST(price_nano AS HUGEINT) * size_shares) // sum(size_shares) AS BIGINT) END AS vwap_nano
    FROM z WHERE event_type <> 'error' GROUP BY 1, 2""")
def bars_zero_volume(spark: SparkSession, sf: str) -> DataFrame:
    """Windows without volume have no price; here that shows as -1."""
    unsized = v.ticks(spark, sf).withColumn("size_shares", F.col("size_shares") - 1)
    built = tick_bars(unsized, v.HOUR, zero_volume="null")
    return built.select("instrument_id", "event_time", "volume_shares", F.coalesce("vwap_nano", F.lit(-1).cast("bigint")).alias("vwap_nano"))


@query("bar_positions", f"""WITH {v.TICKS_SQL}, b AS ({bars_sql(v.HOUR)})
    SELECT instrument_id, event_time, row_number() OVER (ORDER BY event_time, instrument_id) - 1 AS ingest_index FROM b""")
def bar_positions(spark: SparkSession, sf: str) -> DataFrame:
    built = tick_bars(v.ticks(spark, sf), v.HOUR)
    return bars.with_bar_positions(built).select("instrument_id", "event_time", "ingest_index")


@query("session_filter", f"""WITH {v.TICKS_SQL}, {v.CALENDAR_SQL}
    SELECT event_id, CAST(session_date AS VARCHAR) AS session_date, event_time - regular_open_ns AS since_open_ns
    FROM ticks JOIN calendar ON event_time >= regular_open_ns AND event_time < regular_close_ns""")
def session_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _in_session(spark, sf).select(
        "event_id", F.col("session_date").cast("string").alias("session_date"),
        (F.col("event_time") - F.col("regular_open_ns")).alias("since_open_ns"),
    )


def _in_session(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks of the regular session; the day is an equi key, so the range test is only a residual."""
    day = F.date_from_unix_date(instants.floor_div(F.col("event_time"), v.DAY).cast("int"))
    dated = v.ticks(spark, sf).withColumn("session_date", day)
    joined = dated.join(broadcast_if_small(v.calendar(spark, sf)), "session_date")
    return joined.where(instants.in_session("event_time", "regular_open_ns", "regular_close_ns"))


@query("session_bars", f"""WITH {v.TICKS_SQL}, {v.CALENDAR_SQL}, s AS (
    SELECT * FROM ticks JOIN calendar ON event_time >= regular_open_ns AND event_time < regular_close_ns)
    {bars_sql(v.HOUR, 'regular_open_ns', 's')}""")
def session_bars(spark: SparkSession, sf: str) -> DataFrame:
    return tick_bars(_in_session(spark, sf), v.HOUR, origin_ns="regular_open_ns")


CLOCKS = normalize.Clocks(
    receive_time=v.JAN_1 + 60 * v.DAY, process_time=v.JAN_1 + 60 * v.DAY + v.HOUR,
    raw_partition_id="ticks/000", event_time_source="sip",
)


@query("tick_normalize", f"""WITH {v.TICKS_SQL}
    SELECT event_time, CAST({CLOCKS.receive_time} AS BIGINT) AS receive_time, CAST({CLOCKS.process_time} AS BIGINT) AS process_time,
           event_time + {v.LAG} AS knowledge_time, 5 AS source_rank, event_id AS vendor_sequence,
           CAST(-1 AS BIGINT) AS venue_sequence, event_id AS ingest_index, 'ticks/000' AS raw_partition_id,
           'sip' AS event_time_source, instrument_id, price_nano, size_shares, event_type AS conditions,
           FALSE AS is_cancelled FROM ticks""")
def tick_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """Clocks, provenance and exact prices from decimal dollars, in the total order."""
    raw = v.ticks(spark, sf).drop("price_nano", "source_rank", "venue_sequence")
    dollars = v.table(spark, sf, "events").select("event_id", F.round("value", 2).cast("decimal(38,18)").alias("price"))
    stamped = raw.join(dollars, "event_id").withColumns(
        {
            "price_nano": money.nano_from_dollars("price"),
            "is_cancelled": F.lit(False),
            **normalize.time_columns(CLOCKS),
            **normalize.provenance_columns(CLOCKS, vocab.TRADE),
        }
    )
    return normalize.sort_total(stamped).select(
        "event_time", "receive_time", "process_time", "knowledge_time", "source_rank", "vendor_sequence",
        "venue_sequence", "ingest_index", "raw_partition_id", "event_time_source", "instrument_id", "price_nano",
        "size_shares", F.array_join("conditions", ",").alias("conditions"), "is_cancelled",
    )


_RESOLVED_SQL = """resolved AS (
    SELECT n.event_id, n.symbol, n.event_time, count(DISTINCT h.instrument_id) AS holders,
           CASE WHEN count(DISTINCT h.instrument_id) = 1 THEN min(h.instrument_id) ELSE -1 END AS instrument_id
    FROM named n LEFT JOIN history h ON h.ticker = n.symbol AND n.event_time >= h.effective_time
         AND (h.end_time IS NULL OR n.event_time < h.end_time)
    GROUP BY n.event_id, n.symbol, n.event_time)"""


@query("ticker_resolve", f"""WITH {v.NAMED_SQL}, {v.history_sql()}, {_RESOLVED_SQL}
    SELECT event_id, symbol, event_time, instrument_id FROM resolved""")
def ticker_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Strict form: an unknown or ambiguous symbol would fail the job."""
    resolved = identity.resolve_tickers(v.named_ticks(spark, sf), v.ticker_history(spark, sf))
    return resolved.select("event_id", "symbol", "event_time", identity.require_instrument().alias("instrument_id"))


@query("ticker_unresolved", f"""WITH {v.NAMED_SQL}, {v.history_sql(overlap=True, gaps=True)}, {_RESOLVED_SQL}
    SELECT symbol, count(*) FILTER (WHERE holders = 0) AS unknown_ticks,
           count(*) FILTER (WHERE holders > 1) AS ambiguous_ticks, count(*) AS ticks
    FROM resolved GROUP BY symbol""")
def ticker_unresolved(spark: SparkSession, sf: str) -> DataFrame:
    history = v.ticker_history(spark, sf, overlap=True, gaps=True)
    resolved = identity.resolve_tickers(v.named_ticks(spark, sf), history)
    return resolved.groupBy("symbol").agg(
        F.count_if(F.col("holders") == 0).alias("unknown_ticks"),
        F.count_if(F.col("holders") > 1).alias("ambiguous_ticks"),
        F.count("*").alias("ticks"),
    )


@query("ticker_overlap_audit", f"""WITH {v.history_sql(overlap=True)},
    edges AS (SELECT DISTINCT ticker, e AS start FROM (SELECT ticker, effective_time AS e FROM history
              UNION ALL SELECT ticker, end_time FROM history WHERE end_time IS NOT NULL)),
    cuts AS (SELECT *, lead(start) OVER (PARTITION BY ticker ORDER BY start) AS "end" FROM edges)
    SELECT c.ticker, c.start, c."end", CAST(count(DISTINCT h.instrument_id) AS INTEGER) AS holders
    FROM cuts c JOIN history h ON h.ticker = c.ticker AND c.start >= h.effective_time
         AND (h.end_time IS NULL OR c.start < h.end_time)
    GROUP BY ALL HAVING count(DISTINCT h.instrument_id) > 1""")
def ticker_overlap_audit(spark: SparkSession, sf: str) -> DataFrame:
    return identity.overlapping_assignments(v.ticker_history(spark, sf, overlap=True))


@query("merged_stream_order", f"""WITH {v.TICKS_SQL},
    ranked AS (SELECT event_id, event_time - event_time % {v.DAY} AS event_time,
               CASE event_type WHEN 'view' THEN 4 WHEN 'error' THEN 1 ELSE 5 END AS source_rank FROM ticks)
    SELECT event_id, event_time, source_rank,
           row_number() OVER (ORDER BY event_time, source_rank, event_id) - 1 AS dispatch_position FROM ranked""")
def merged_stream_order(spark: SparkSession, sf: str) -> DataFrame:
    """Statuses before quotes before trades at one instant; instants are cut to days to force ties."""
    base = v.ticks(spark, sf).withColumn("event_time", instants.window_start("event_time", v.DAY, 0))
    streams = [
        base.where(F.col("event_type") == "view").withColumn("source_rank", F.lit(vocab.QUOTE)),
        base.where(F.col("event_type") == "error").withColumn("source_rank", F.lit(vocab.STATUS)),
        base.where(~F.col("event_type").isin("view", "error")),
    ]
    merged = normalize.merge_streams(*streams)
    # Several chunks per instant: the dispatch order refines time by rank, then by sequence.
    chunk = F.struct("event_time", "source_rank", instants.floor_div(F.col("vendor_sequence"), 100_000).alias("block"))
    placed = scan.positions(merged, vocab.ORDER_KEY, chunk, "dispatch_position")
    return placed.select("event_id", "event_time", "source_rank", "dispatch_position")


_PIVOT = v.JAN_1 + 15 * v.DAY


@query("after_key", f"""WITH {v.TICKS_SQL} SELECT event_id, event_time FROM ticks
    WHERE event_time > {_PIVOT} OR (event_time = {_PIVOT} AND (5, event_id, -1, event_id) > (5, 100, -1, 100))""")
def after_key(spark: SparkSession, sf: str) -> DataFrame:
    key = sentinel((_PIVOT, vocab.TRADE, 100, vocab.MISSING_SEQUENCE, 100))
    return normalize.after_key(v.ticks(spark, sf), key).select("event_id", "event_time")


@query("plausible_band", f"""WITH {v.TICKS_SQL}, c AS (SELECT event_id, event_time * (event_id % 4) AS instant FROM ticks)
    SELECT event_id, instant FROM c WHERE instant BETWEEN {vocab.PLAUSIBLE_MIN_NS} AND {vocab.PLAUSIBLE_MAX_NS}""")
def plausible_band(spark: SparkSession, sf: str) -> DataFrame:
    candidates = v.ticks(spark, sf).select("event_id", (F.col("event_time") * (F.col("event_id") % 4)).alias("instant"))
    return candidates.where(instants.is_plausible("instant"))


@query("rfc3339_roundtrip", f"""WITH {v.TICKS_SQL},
    t AS (SELECT event_id, event_time, strftime(make_timestamp(event_time // 1000), '%Y-%m-%dT%H:%M:%S.%f') || '000' AS text FROM ticks)
    SELECT event_id, text || 'Z' AS text, event_time AS parsed_ns, event_time - {11 * v.HOUR // 2} AS parsed_with_offset_ns FROM t""")
def rfc3339_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    text = v.ticks(spark, sf).select("event_id", instants.rfc3339_from_ns("event_time").alias("text"))
    local = F.concat(F.expr("left(text, length(text) - 1)"), F.lit("+05:30"))
    return text.select(
        "event_id", "text", instants.ns_from_rfc3339("text").alias("parsed_ns"),
        instants.ns_from_rfc3339(local).alias("parsed_with_offset_ns"),
    )


@query("quote_metrics", f"""WITH {v.TICKS_SQL}, q AS (
    SELECT event_id, price_nano - 1 AS bid, price_nano + size_shares - 20 AS ask FROM ticks)
    SELECT event_id, CAST((CAST(bid AS HUGEINT) + ask) // 2 AS BIGINT) AS mid_nano,
           CAST((CAST(bid AS HUGEINT) + ask) % 2 AS BIGINT) AS mid_half_nano, ask - bid AS spread_nano,
           bid = ask AS is_locked, bid > ask AS is_crossed FROM q""")
def quote_metrics(spark: SparkSession, sf: str) -> DataFrame:
    quotes = v.ticks(spark, sf).select(
        "event_id", (F.col("price_nano") - 1).alias("bid_price_nano"),
        (F.col("price_nano") + F.col("size_shares") - 20).alias("ask_price_nano"),
    )
    return normalize.quote_metrics(quotes).drop("bid_price_nano", "ask_price_nano")


@query("usd_text", f"""WITH {v.TICKS_SQL} SELECT event_id,
    format('{{:,}}', price_nano // 1000000000) || '.' || lpad(CAST(price_nano % 1000000000 AS VARCHAR), 9, '0') AS price_usd
    FROM ticks""")
def usd_text(spark: SparkSession, sf: str) -> DataFrame:
    return v.ticks(spark, sf).select("event_id", money.format_usd("price_nano").alias("price_usd"))


@query("intent_ids", f"""WITH {v.TICKS_SQL}
    SELECT event_id, sha256('{{"strategy_version":"s1","instrument_id":' || instrument_id || ',"decision_time":' || event_time ||
           ',"intent_hash":"' || event_type || '"}}') AS client_order_id,
           CASE WHEN event_id % 2 = 0 THEN 'b-' || event_id ELSE sha256(event_type || ':' || event_id) END AS broker_event_id
    FROM ticks""")
def intent_ids(spark: SparkSession, sf: str) -> DataFrame:
    intents = v.ticks(spark, sf).select(
        "event_id", F.lit("s1").alias("strategy_version"), "instrument_id", F.col("event_time").alias("decision_time"),
        F.col("event_type").alias("intent_hash"),
    )
    given = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("b-"), F.col("event_id").cast("string")))
    payload = F.concat_ws(":", "intent_hash", F.col("event_id").cast("string"))
    return intents.select(
        "event_id",
        encoding.client_order_id("strategy_version", "instrument_id", "decision_time", "intent_hash").alias("client_order_id"),
        encoding.derived_event_id(given, payload).alias("broker_event_id"),
    )


@query("stable_sample", """SELECT doc_id, draw FROM (
    SELECT doc_id, CAST('0x' || substr(sha256('7|documents.sample|' || doc_id), 1, 13) AS BIGINT) AS draw FROM documents)
    WHERE draw < 1125899906842624""")
def stable_sample(spark: SparkSession, sf: str) -> DataFrame:
    documents = v.table(spark, sf, "documents").select("doc_id")
    sampled = encoding.stable_sample(documents, 0.25, 7, "documents.sample", "doc_id")
    return sampled.select("doc_id", encoding.draw(7, "documents.sample", "doc_id").alias("draw"))


@query("canonical_text", "SELECT doc_id, sha256(nfc_normalize(text)) AS text_sha256 FROM documents")
def canonical_text(spark: SparkSession, sf: str) -> DataFrame:
    documents = v.table(spark, sf, "documents").select("doc_id", "text")
    return encoding.normalize_text(documents, ["text"]).select("doc_id", F.sha2("text", 256).alias("text_sha256"))
