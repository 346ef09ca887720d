"""Streams whose windows follow a calendar: closed bars in append mode, provisional ones in update mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronotape.plans import views as v
from chronotape.plans.catalogue import query
from chronotape.plans.market_queries import AS_OF, BAR_COLUMNS, bars_sql
from chronotape.sources.files import work_folder
from chronotape.streaming import latest_versions, provisional_bars, session_stream_bars, write_stream, write_versions
from chronotape.streaming.provisional import PROVISIONAL

#: Where the feed is cut into arrivals: inside a session and inside a window.
CUTS = (v.JAN_1 + 9 * v.DAY + 15 * v.HOUR + 7 * v.HOUR // 60, AS_OF + 16 * v.HOUR)

#: A window is closed once a print of a window that ends a window and a lag (a whole millisecond) later came.
_SESSION_BARS = f"""WITH {v.TICKS_SQL}, {v.UNEVEN_SQL}, s AS (
        SELECT * FROM ticks JOIN uneven ON event_time >= regular_open_ns AND event_time < regular_close_ns),
    b AS ({bars_sql(v.HOUR, 'regular_open_ns', 's')}),
    seen AS (SELECT max(event_time) + {v.HOUR} AS newest FROM b)"""
_CLOSED = f"event_time + {v.HOUR} <= newest - {v.HOUR} - 1000000"


@query("stream_session_bars", f"{_SESSION_BARS} SELECT b.* REPLACE (TRUE AS is_complete) FROM b, seen WHERE {_CLOSED}")
def stream_session_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars from a file stream over days with different opens; windows start at each day's own."""
    folder = work_folder(spark, "stream-session-bars")
    schema = v.table(spark, sf, "events").schema
    prints = v.shape_ticks(spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/event[s].parquet"))
    closed = session_stream_bars(prints, v.uneven_calendar(spark, sf), window_ns=v.HOUR, lag_ns=v.LAG, ineligible=v.INELIGIBLE_TYPES)
    write_stream(closed, folder.at("bars"), folder.at("state")).awaitTermination()
    return spark.read.schema(closed.schema).parquet(folder.at("bars")).select(*BAR_COLUMNS)


@query("stream_provisional_bars", f"{_SESSION_BARS} SELECT b.* REPLACE ({_CLOSED} AS is_complete) FROM b, seen")
def stream_provisional_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Three arrivals of the feed in update mode: the last version of every window, complete or still open."""
    folder = work_folder(spark, "stream-provisional")
    ticks = v.ticks(spark, sf)
    edges = (None, *CUTS, None)
    for low, high in zip(edges, edges[1:], strict=False):
        arrived = ticks if low is None else ticks.where(ticks.event_time >= low)
        arrived = arrived if high is None else arrived.where(arrived.event_time < high)
        arrived.write.mode("append").parquet(folder.at("feed"))
        feed = spark.readStream.schema(ticks.schema).parquet(folder.at("feed"))
        bars = provisional_bars(feed, v.uneven_calendar(spark, sf), window_ns=v.HOUR, lag_ns=v.LAG, ineligible=v.INELIGIBLE_TYPES)
        write_versions(bars, folder.at("versions"), folder.at("state")).awaitTermination()
    versions = spark.read.schema(f"{PROVISIONAL}, batch bigint").parquet(folder.at("versions"))
    return latest_versions(versions).select(*BAR_COLUMNS)
