"""The raw-to-snapshot job: the whole feed as one raw partition, normalized, sealed and read back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotape.plans import day
from chronotape.plans import snapshot as snap
from chronotape.plans import views as v
from chronotape.plans.catalogue import query
from chronotape.plans.market_queries import AS_OF, BAR_COLUMNS, CLOCKS, bars_sql
from chronotape.sources.files import work_folder

#: The session: it opens before every tick, off the hour, and lasts over all of them.
DATE, OPEN_NS, CLOSE_NS = "2024-01-01", v.JAN_1 - 43 * v.HOUR // 60, v.JAN_1 + 400 * v.DAY
#: Users share this many symbols, each an instrument of its own, so the bundle is one small document.
SYMBOLS = 97

_FEED = f"WITH {v.TICKS_SQL}, feed AS (SELECT * REPLACE (instrument_id % {SYMBOLS} AS instrument_id) FROM ticks)"


def _dollars(nanos: str) -> str:
    return f"concat({nanos} DIV 1000000000, '.', lpad({nanos} % 1000000000, 9, '0'))"


def _bundle() -> str:
    history = [{"instrument_id": k, "ticker": f"SYM{k}", "effective_time": "2020-01-01T00:00:00Z", "end_time": None} for k in range(SYMBOLS)]
    session = {
        "session_date": DATE, "is_trading_day": True, "regular_open_ns": OPEN_NS, "regular_close_ns": CLOSE_NS, "is_early_close": False,
        "opening_auction_ns": OPEN_NS, "closing_auction_ns": CLOSE_NS,
    }
    instrument = {"instrument_id": 0, "primary_exchange": "V", "security_type": "common", "lot_size": 100, "is_tradable": True, "effective_time": "2020-01-01T00:00:00Z"}
    return json.dumps({"instrument": instrument, "ticker_history": history, "calendar": session})


def _sealed_day(spark: SparkSession, sf: str, purpose: str) -> snap.Sealed:
    """Write the feed as vendor NDJSON with its bundle, run the job, and open what it sealed."""
    folder = work_folder(spark, purpose)
    moment = "concat(date_format(to_utc_timestamp(timestamp_micros(event_time DIV 1000), current_timezone()), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '000Z')"
    begins = f"""concat('{{"S":"SYM', instrument_id % {SYMBOLS}, '","t":"', {moment}, '","q":', event_id"""
    lines = {
        "trades": f"""{begins}, ',"p":', {_dollars('price_nano')}, ',"s":', size_shares, ',"x":"V","i":"tr-', event_id, '","c":["', if(event_type = 'error', 'T', '@'), '"]}}')""",
        "quotes": f"""{begins}, ',"bp":', {_dollars('price_nano')}, ',"bs":', size_shares, ',"ap":', {_dollars('(price_nano + 1)')}, ',"as":', size_shares, '}}')""",
    }
    # A tick carries its number, so the order of the lines decides nothing; dealt out, as the table may be a file or two.
    ticks = v.shape_ticks(v.table(spark, sf, "events").repartition(spark.sparkContext.defaultParallelism))
    for name, line in lines.items():
        ticks.select(F.expr(line).alias("value")).write.text(folder.at(f"raw/{name}"))
    folder.write_text("reference.json", _bundle())
    day.run(spark, folder.at("raw"), folder.at("reference.json"), folder.at("out"), CLOCKS, as_of=AS_OF, window_ns=v.HOUR, suffix=".txt")
    return snap.Sealed(spark, folder.at("out"))


@query("day_bars", f"""{_FEED}, b AS ({bars_sql(v.HOUR, str(OPEN_NS), 'feed')})
    SELECT {', '.join(BAR_COLUMNS)}, row_number() OVER (ORDER BY event_time, instrument_id) - 1 AS ingest_index, '{DATE}' AS date FROM b""")
def day_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Raw trades and quotes to sealed tables in one call, and their bars; windows start at the session's open."""
    bars = _sealed_day(spark, sf, "day-bars").table("normalized.bar")
    return bars.select(*BAR_COLUMNS, "ingest_index", F.col("date").cast("string").alias("date"))
