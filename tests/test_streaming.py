"""Streams over files, drained with the available-now trigger."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from chronotape.operators import bars
from chronotape.operators.history import as_known
from chronotape.sources import ndjson
from chronotape.streaming import (
    dedupe_order_event_stream,
    latest_versions,
    provisional_bars,
    raw_print_stream,
    session_stream_bars,
    split_late_rows,
    stream_bars,
    write_stream,
    write_versions,
)
from chronotape.streaming.provisional import PROVISIONAL
from tests.test_operators import PRINTS, prints

MS = 1_000_000


def drain(query):
    query.awaitTermination(120)
    assert not query.isActive and query.exception() is None


def test_stream_bars_equal_batch_bars_for_closed_windows(spark, tmp_path):
    window, origin, lag = 10 * MS, 5 * MS, MS
    rows = [(i % 3, origin + (i * 37 % 200) * MS // 2 + i, i, 100 + i * 7 % 13, 1 + i % 4, ["T" if i % 9 == 0 else "@"]) for i in range(300)]
    source = str(tmp_path / "in")
    prints(spark, rows).write.parquet(source)
    stream = stream_bars(spark.readStream.schema(PRINTS).parquet(source), window_ns=window, origin_ns=origin, lag_ns=lag)
    drain(write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")))
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    batch = bars.build_bars(prints(spark, rows), window_ns=window, origin_ns=origin, as_of=0, knowledge_lag_ns=lag)
    newest = max(t for _, t, _, _, _, c in rows if c != ["T"]) // MS * MS
    closed = batch.where(F.col("event_time") + window <= newest - lag).withColumn("is_complete", F.lit(True)).select(*got.columns)
    assert 0 < closed.count() < batch.count()
    assert got.exceptAll(closed).isEmpty() and closed.exceptAll(got).isEmpty()


def test_update_mode_bars_are_marked_partial(spark, tmp_path):
    source = str(tmp_path / "in")
    prints(spark, [(1, 5 * MS, 1, 10, 1, ["@"])]).write.parquet(source)
    stream = stream_bars(spark.readStream.schema(PRINTS).parquet(source), window_ns=10 * MS, complete=False)
    query = stream.writeStream.outputMode("update").format("memory").queryName("partial_bars").trigger(availableNow=True).start()
    drain(query)
    assert [r.is_complete for r in spark.table("partial_bars").collect()] == [False]


def test_a_replayed_event_is_a_no_op_across_batches(spark, tmp_path):
    schema = "account_id string, broker_event_id string, event_time_ns bigint"
    source = tmp_path / "in"

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))

    def step():
        events = dedupe_order_event_stream(spark.readStream.schema(schema).parquet(str(source)), within="1 hour")
        drain(write_stream(events, str(tmp_path / "out"), str(tmp_path / "state")))

    land([("p", "a", 10**9), ("p", "b", 10**9), ("p", "a", 10**9)])
    step()
    land([("p", "a", 10**9 + 5), ("q", "a", 10**9)])
    step()
    out = spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()
    assert sorted((r.account_id, r.broker_event_id) for r in out) == [("p", "a"), ("p", "b"), ("q", "a")]


def test_late_rows_become_revisions_and_none_is_lost(spark, tmp_path):
    schema = "trade_id string, event_time bigint, knowledge_time bigint, ingest_index bigint, price bigint"
    source = tmp_path / "in"

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        drain(split_late_rows(stream, str(tmp_path / "out"), str(tmp_path / "state"), delay_ns=10))

    land([("a", 100, 100, 0, 1), ("b", 95, 95, 1, 2)])
    land([("a", 89, 120, 2, 3), ("c", 90, 121, 3, 4)])  # 89 is behind 100 - 10, 90 is not
    ontime = spark.read.schema(schema).parquet(str(tmp_path / "out" / "ontime"))
    late = spark.read.schema(schema + ", revision_time bigint").parquet(str(tmp_path / "out" / "revisions"))
    assert {(r.trade_id, r.event_time) for r in ontime.collect()} == {("a", 100), ("b", 95), ("c", 90)}
    assert [tuple(r) for r in late.drop("batch").collect()] == [("a", 89, 120, 2, 3, 100)]
    both = ontime.withColumn("revision_time", F.lit(None).cast("bigint")).unionByName(late)
    assert {r.trade_id: r.price for r in as_known(both, ["trade_id"], 200).collect()} == {"a": 3, "b": 2, "c": 4}


def test_raw_stream_parses_and_stamps_receipt(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    good = {"S": "Z", "t": "2026-09-18T13:30:00Z", "p": 1.5, "s": 2, "x": "V", "i": "1"}
    (source / "0000.ndjson").write_text(json.dumps(good) + "\n\n{\n")
    stream = raw_print_stream(spark, str(source), ndjson.TRADE_WIRE)
    kept = stream.select("symbol", "event_time", "receive_time", "defect")
    drain(write_stream(kept, str(tmp_path / "out"), str(tmp_path / "state")))
    rows = spark.read.schema(kept.schema).parquet(str(tmp_path / "out")).collect()
    assert sorted(str(r.defect) for r in rows) == ["None", "not a JSON object"]
    assert all(r.receive_time > 1_700_000_000 * 10**9 for r in rows)


HOUR, DAY, MINUTE = 3_600 * 10**9, 86_400 * 10**9, 60 * 10**9
#: An early open, a late one, and a session over midnight.
SESSIONS = [(9 * HOUR, 12 * HOUR), (DAY + 9 * HOUR + 20 * MINUTE, DAY + 11 * HOUR), (2 * DAY + 22 * HOUR + 5 * MINUTE, 3 * DAY + 2 * HOUR), (8 * DAY, 8 * DAY)]


def calendar(spark):
    return spark.createDataFrame(SESSIONS, "regular_open_ns bigint, regular_close_ns bigint")


def session_rows():
    """Prints in and out of sessions, on their edges, some ineligible, in no order within a day."""
    rows = [(i % 4, (i * 1_037 % 5_000) * MINUTE + i, i, 100 + i * 7 % 13, 1 + i % 4, ["T" if i % 9 == 0 else "@"]) for i in range(2_000)]
    edges = [at for pair in SESSIONS for at in (pair[0] - 1, pair[0], pair[1] - 1, pair[1])]
    return rows + [(7, at, 9_000 + k, 50, 2, ["@"]) for k, at in enumerate(edges)]


def batch_bars(spark, rows, window, lag):
    anchored = prints(spark, rows).join(F.broadcast(calendar(spark)), F.expr("event_time >= regular_open_ns AND event_time < regular_close_ns"))
    return bars.build_bars(anchored, window_ns=window, origin_ns="regular_open_ns", as_of=0, knowledge_lag_ns=lag)


def test_session_windows_start_at_each_open(spark, tmp_path):
    window, lag, rows = 30 * MINUTE, MS, session_rows()
    prints(spark, rows).write.parquet(str(tmp_path / "in"))
    stream = session_stream_bars(spark.readStream.schema(PRINTS).parquet(str(tmp_path / "in")), calendar(spark), window_ns=window, lag_ns=lag)
    drain(write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")))
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    want = batch_bars(spark, rows, window, lag)
    newest = want.agg(F.max("event_time")).first()[0] + window
    closed = want.where(F.col("event_time") + 2 * window + lag <= newest).withColumn("is_complete", F.lit(True)).select(*got.columns)
    assert 0 < closed.count() < want.count()
    assert got.exceptAll(closed).isEmpty() and closed.exceptAll(got).isEmpty()
    opens = {(r.event_time - SESSIONS[2][0]) % window for r in got.where(F.col("event_time") >= 2 * DAY + 12 * HOUR).collect()}
    assert opens == {0}


def test_provisional_bars_end_as_the_batch_bars(spark, tmp_path):
    window, lag, rows = HOUR, MS, session_rows()
    cuts = [-1, 9 * HOUR + 20 * MINUTE, 9 * HOUR + 40 * MINUTE, DAY + 10 * HOUR, 9 * DAY]  # twice inside one window
    for low, high in zip(cuts, cuts[1:], strict=False):
        prints(spark, [r for r in rows if low <= r[1] < high]).coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
        stream = provisional_bars(spark.readStream.schema(PRINTS).parquet(str(tmp_path / "in")), calendar(spark), window_ns=window, lag_ns=lag)
        drain(write_versions(stream, str(tmp_path / "out"), str(tmp_path / "state")))
    versions = spark.read.schema(f"{PROVISIONAL}, batch bigint").parquet(str(tmp_path / "out"))
    want = batch_bars(spark, rows, window, lag)
    newest = want.agg(F.max("event_time")).first()[0] + window
    want = want.withColumn("is_complete", F.col("event_time") + 2 * window + lag <= newest)
    got = latest_versions(versions)
    want = want.select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert {r.is_complete for r in got.collect()} == {True, False}
    # a window is complete once at most, and nothing follows its complete version
    per = versions.groupBy("instrument_id", "event_time").agg(
        F.count_if("is_complete").alias("ends"), F.max("batch").alias("last"), F.max(F.when(F.col("is_complete"), F.col("batch"))).alias("ended"), F.count("*").alias("n")
    ).collect()
    assert max(r.ends for r in per) == 1 and all(r.ended == r.last for r in per if r.ends) and max(r.n for r in per) >= 3


def test_a_print_of_a_closed_window_changes_nothing(spark, tmp_path):
    window, at = 30 * MINUTE, SESSIONS[0][0]

    def land(rows):
        prints(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = provisional_bars(spark.readStream.schema(PRINTS).parquet(str(tmp_path / "in")), calendar(spark), window_ns=window, lag_ns=MS)
        drain(write_versions(stream, str(tmp_path / "out"), str(tmp_path / "state")))
        return latest_versions(spark.read.schema(f"{PROVISIONAL}, batch bigint").parquet(str(tmp_path / "out"))).orderBy("event_time").collect()

    first = land([(1, at, 1, 10, 1, ["@"]), (1, at + 3 * window, 2, 20, 0, ["@"])])
    assert [(r.close_nano, r.is_complete, r.vwap_nano) for r in first] == [(10, True, 10), (20, False, None)]
    assert land([(1, at + 5, 3, 99, 1, ["@"]), (1, at + 3 * window + 1, 4, 30, 2, ["@"])])[0] == first[0]


def test_a_feed_without_prints_has_no_versions(spark, tmp_path):
    prints(spark, []).write.parquet(str(tmp_path / "in"))
    stream = provisional_bars(spark.readStream.schema(PRINTS).parquet(str(tmp_path / "in")), calendar(spark), window_ns=HOUR, lag_ns=MS)
    drain(write_versions(stream, str(tmp_path / "out"), str(tmp_path / "state")))
    assert not (tmp_path / "out").exists() or spark.read.schema(f"{PROVISIONAL}, batch bigint").parquet(str(tmp_path / "out")).isEmpty()


def test_provisional_bars_are_combined_before_the_shuffle(spark, tmp_path):
    prints(spark, []).write.parquet(str(tmp_path / "in"))
    stream = provisional_bars(spark.readStream.schema(PRINTS).parquet(str(tmp_path / "in")), calendar(spark), window_ns=HOUR, lag_ns=MS)
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan  # no Python call for every window
