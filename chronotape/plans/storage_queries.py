"""Queries that go through storage: raw files, contract tables, snapshots, streams."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotape.contracts import contract, vocab
from chronotape.operators import bars, normalize
from chronotape.plans import snapshot as snap
from chronotape.plans import views as v
from chronotape.plans.catalogue import query
from chronotape.plans.market_queries import AS_OF, BAR_COLUMNS, CLOCKS, bars_sql, tick_bars
from chronotape.sources import ndjson, tables
from chronotape.sources.files import Folder, work_folder
from chronotape.streaming import (
    dedupe_order_event_stream,
    raw_print_stream,
    split_late_rows,
    stream_bars,
    write_stream,
)


def _decimal_text(nanos: str) -> str:
    return f"concat({nanos} DIV 1000000000, '.', lpad({nanos} % 1000000000, 9, '0'))"


_INSTANT = "concat(date_format(to_utc_timestamp(ts, current_timezone()), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '000Z')"


def _write_raw(lines: DataFrame, order: str, folder: Folder) -> str:
    """Raw text files whose name order is the order of ``order``: a range write, one file per task."""
    lines.repartitionByRange(order).sortWithinPartitions(order).select("value").write.text(folder.root)
    return folder.root


def _raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks with what their raw lines say, from one read of the events."""
    ticks = v.ticks(spark, sf)
    moment = F.expr("timestamp_micros(event_time DIV 1000)").alias("ts")
    return ticks.select("event_id", "event_type", "price_nano", "size_shares", moment, F.expr("concat('SYM', instrument_id DIV 3)").alias("symbol"))


_RESOLVED_TICKS = f"""WITH {v.TICKS_SQL}, {v.history_sql()},
    resolved AS (SELECT t.* EXCLUDE (instrument_id), h.instrument_id FROM ticks t JOIN history h
        ON h.ticker = 'SYM' || CAST(t.instrument_id // 3 AS VARCHAR) AND t.event_time >= h.effective_time
        AND (h.end_time IS NULL OR t.event_time < h.end_time))"""


@query("raw_trades", f"""{_RESOLVED_TICKS}
    SELECT event_time, event_time + {v.LAG} AS knowledge_time, 5 AS source_rank,
           CASE WHEN event_id % 4 = 0 THEN -1 ELSE 1789738202523646945 + event_id END AS vendor_sequence,
           row_number() OVER (ORDER BY event_id) - 1 AS ingest_index, instrument_id, price_nano, size_shares,
           'V' AS exchange, CASE WHEN event_id % 5 = 0 THEN '' ELSE event_type END AS conditions, 'tr-' || event_id AS trade_id,
           CASE WHEN event_id % 6 = 0 THEN '' ELSE 'C' END AS tape FROM resolved""")
def raw_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as vendor NDJSON, read back, positioned, resolved and normalized.

    Optional keys are left out of some records, blank lines are mixed in, sequences have nineteen
    digits, and some records repeat the price key or hold it in nested objects and texts as well.
    """
    record = f"""concat('{{"T":"t",',
        CASE event_id % 7 WHEN 1 THEN '"m":{{"p":1.25}},' WHEN 2 THEN '"p":2.5,' WHEN 3 THEN '"n":[{{"p":3}}],"note":"{{\\\\"p\\\\":4}}",' ELSE '' END,
        '"S":"', symbol, '","t":"', {_INSTANT}, '","p":', {_decimal_text('price_nano')},
        ',"s":', size_shares, ',"x":"V","i":"tr-', event_id, '"',
        CASE WHEN event_id % 5 = 0 THEN '' ELSE concat(',"c":["', event_type, '"]') END,
        CASE WHEN event_id % 6 = 0 THEN '' ELSE ',"z":"C"' END,
        CASE WHEN event_id % 4 = 0 THEN '' ELSE concat(',"q":', 1789738202523646945 + event_id) END,
        CASE event_id % 11 WHEN 5 THEN ',"meta":{{"p":7.5,"s":{{"p":8}}}}' ELSE '' END, '}}',
        CASE WHEN event_id % 9 = 0 THEN '\\n   ' ELSE '' END) AS value"""
    lines = _raw_events(spark, sf).select("event_id", F.expr(record))
    raw = _write_raw(lines, "event_id", work_folder(spark, "raw-trades"))
    parsed = ndjson.read_trades(spark, raw, suffix=".txt")
    return normalize.normalize_trades(parsed, v.ticker_history(spark, sf), CLOCKS).select(
        "event_time", "knowledge_time", "source_rank", "vendor_sequence", "ingest_index", "instrument_id", "price_nano",
        "size_shares", "exchange", F.array_join("conditions", ",").alias("conditions"), "trade_id", "tape",
    )


@query("raw_quotes", f"""{_RESOLVED_TICKS}
    SELECT event_time, 4 AS source_rank, event_id AS vendor_sequence, row_number() OVER (ORDER BY event_id) - 1 AS ingest_index,
           instrument_id, price_nano AS bid_price_nano, size_shares AS bid_size_shares, '' AS bid_exchange,
           price_nano + 1 AS ask_price_nano, size_shares + 1 AS ask_size_shares, 'V' AS ask_exchange, 'sip' AS venue_coverage FROM resolved""")
def raw_quotes(spark: SparkSession, sf: str) -> DataFrame:
    record = f"""concat('{{"S":"', symbol, '","t":"', {_INSTANT}, '","bp":', {_decimal_text('price_nano')}, ',"bs":', size_shares,
        ',"ap":', {_decimal_text('(price_nano + 1)')}, ',"as":', size_shares + 1, ',"ax":"V","q":', event_id, '}}') AS value"""
    lines = _raw_events(spark, sf).select("event_id", F.expr(record))
    raw = _write_raw(lines, "event_id", work_folder(spark, "raw-quotes"))
    parsed = ndjson.read_quotes(spark, raw, suffix=".txt")
    return normalize.normalize_quotes(parsed, v.ticker_history(spark, sf), CLOCKS).select(
        "event_time", "source_rank", "vendor_sequence", "ingest_index", "instrument_id", "bid_price_nano", "bid_size_shares",
        "bid_exchange", "ask_price_nano", "ask_size_shares", "ask_exchange", "venue_coverage",
    )


@query("raw_quarantine", f"""WITH {v.TICKS_SQL}, d AS (SELECT CASE event_id % 40
        WHEN 1 THEN 'p is missing' WHEN 2 THEN 'p is not a decimal number' WHEN 3 THEN 'p has sub-nano-dollar precision'
        WHEN 4 THEN 's is not a whole number' WHEN 5 THEN 't is not an instant with an offset' WHEN 6 THEN 'not a JSON object'
        WHEN 7 THEN 'i is missing' WHEN 8 THEN 'p exceeds the storable range' WHEN 9 THEN 'p is not a decimal number'
        WHEN 10 THEN 'p is not a decimal number' WHEN 11 THEN 'q is not a whole number' END AS defect, event_id FROM ticks)
    SELECT defect, count(*) AS records, min(event_id) AS first_index FROM d WHERE defect IS NOT NULL GROUP BY 1""")
def raw_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Malformed records are refused with a reason and keep their position."""
    record = f"""CASE event_id % 40 WHEN 6 THEN 'not json' ELSE concat('{{"S":"', symbol, '","t":"', {_INSTANT},
        CASE event_id % 40 WHEN 5 THEN ' ' ELSE '' END, '"',
        CASE event_id % 40 WHEN 1 THEN '' WHEN 2 THEN ',"p":"50.03"' WHEN 3 THEN ',"p":1.00000000010000000001'
             WHEN 8 THEN ',"p":4611686019' WHEN 9 THEN ',"p":"oops","meta":{{"p":7.5}}' WHEN 10 THEN ',"p":1.5,"p":"late"' ELSE concat(',"p":', {_decimal_text('price_nano')}) END,
        ',"s":', size_shares, CASE event_id % 40 WHEN 4 THEN '.5' ELSE '' END, ',"x":"V"',
        CASE event_id % 40 WHEN 7 THEN '' ELSE concat(',"i":"tr-', event_id, '"') END,
        CASE event_id % 40 WHEN 11 THEN ',"q":99999999999999999999' ELSE '' END, '}}') END AS value"""
    lines = _raw_events(spark, sf).select("event_id", F.expr(record))
    raw = _write_raw(lines, "event_id", work_folder(spark, "raw-flawed"))
    refused = ndjson.quarantine(ndjson.read_trades(spark, raw, suffix=".txt", on_defect="keep"))
    return refused.groupBy("defect").agg(F.count("*").alias("records"), F.min("ingest_index").alias("first_index"))


def _bar_table(spark: SparkSession, sf: str, folder: Folder) -> tables.Written:
    """Hourly bars of every tick as a written contract table, partitioned by day."""
    day = F.date_from_unix_date(F.call_function("div", F.col("event_time"), F.lit(v.DAY)).cast("int")).cast("string")
    built = bars.build_bars(
        v.ticks(spark, sf).withColumn("date", day), window_ns=v.HOUR, origin_ns=v.JAN_1, as_of=AS_OF,
        ineligible=v.INELIGIBLE_TYPES, keep=["date"],
    )
    stamped = bars.with_bar_positions(built, ["date"]).withColumns(
        {"raw_partition_id": F.lit("ticks/000"), "event_time_source": F.lit("sip")}
    )
    shape = contract("normalized.bar")
    return tables.write_contract_table(normalize.to_contract(stamped, shape, ["date"]), shape, folder.root)


def _sealed(spark: SparkSession, sf: str, purpose: str) -> tuple[str, snap.Manifest]:
    folder = work_folder(spark, purpose)
    manifest = snap.seal(spark, [_bar_table(spark, sf, folder)], folder.root, calendar_version="ticks_v1")
    snap.save_manifest(spark, manifest, folder.root)
    return folder.root, manifest


_BARS_BY_DAY = f"""WITH {v.TICKS_SQL}, b AS ({bars_sql(v.HOUR)}),
    d AS (SELECT *, CAST(CAST(make_timestamp(event_time // 1000) AS DATE) AS VARCHAR) AS day FROM b)"""


@query("contract_table", f"""{_BARS_BY_DAY} SELECT {', '.join(BAR_COLUMNS)}, day AS date,
    row_number() OVER (PARTITION BY day ORDER BY event_time, instrument_id) - 1 AS ingest_index FROM d""")
def contract_table(spark: SparkSession, sf: str) -> DataFrame:
    """Bars through the gated sink and back through the refusing source."""
    written = _bar_table(spark, sf, work_folder(spark, "table"))
    stored = tables.read_written(spark, written, contract("normalized.bar"))
    return stored.select(*BAR_COLUMNS, F.col("date").cast("string").alias("date"), "ingest_index")


@query("snapshot_build", f"""{_BARS_BY_DAY} SELECT 'normalized/bar/date=' || day AS path, count(*) AS row_count,
    'normalized.bar' AS contract, 1 AS contract_version FROM d GROUP BY day""")
def snapshot_build(spark: SparkSession, sf: str) -> DataFrame:
    """Identity entries of a sealed snapshot."""
    _, manifest = _sealed(spark, sf, "snapshot")
    rows = [(e.path, e.row_count, e.contract, e.contract_version) for e in manifest.files]
    return spark.createDataFrame(rows, "path string, row_count bigint, contract string, contract_version int")


@query("snapshot_verify", f"""{_BARS_BY_DAY} SELECT 'findings' AS measure, CAST(0 AS BIGINT) AS amount
    UNION ALL SELECT 'readable rows', count(*) FROM d""")
def snapshot_verify(spark: SparkSession, sf: str) -> DataFrame:
    """A clean snapshot has no findings, and its bounded reader returns every bar."""
    root, _ = _sealed(spark, sf, "verified")
    sealed = snap.Sealed(spark, root)

    def counted(df: DataFrame, measure: str) -> DataFrame:
        return df.agg(F.lit(measure).alias("measure"), F.count("*").alias("amount"))

    findings = counted(sealed.file_findings(), "findings").unionByName(counted(sealed.row_findings("normalized.bar"), "findings"))
    total = findings.groupBy("measure").agg(F.sum("amount").alias("amount"))
    return total.unionByName(counted(sealed.table("normalized.bar"), "readable rows"))


@query("snapshot_damage", f"""{_BARS_BY_DAY}, p AS (SELECT 'normalized/bar/date=' || day AS path, day FROM d)
    SELECT path AS partition, 'missing' AS finding FROM p WHERE day = (SELECT min(day) FROM d) GROUP BY 1
    UNION ALL SELECT path, 'changed' FROM p WHERE day = (SELECT max(day) FROM d) GROUP BY 1""")
def snapshot_damage(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the first day deleted, one of the last day overwritten, one added that nobody sealed."""
    root, manifest = _sealed(spark, sf, "damaged")
    folder, first, last = Folder(spark, root), manifest.files[0].path, manifest.files[-1].path
    sealed = snap.Sealed(spark, root)
    one = sealed.files.where(F.col("partition") == last).agg(F.min("path")).first()[0]
    folder.remove(first)
    folder.write_text(one, "not what was sealed")
    folder.write_text(f"{last}/extra.parquet", "never sealed")
    return sealed.file_findings().select("partition", "finding").distinct()


@query("snapshot_miscount", f"""{_BARS_BY_DAY} SELECT 'normalized/bar/date=' || day AS path, count(*) + 1 AS sealed_rows, count(*) AS held_rows
    FROM d WHERE day = (SELECT max(day) FROM d) GROUP BY day""")
def snapshot_miscount(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest that promises one row more on the last day."""
    root, manifest = _sealed(spark, sf, "miscounted")
    *others, last = manifest.files
    wrong = replace(manifest, files=(*others, replace(last, row_count=last.row_count + 1)))
    return snap.Sealed(spark, root, wrong).row_findings("normalized.bar")


@query("snapshot_identity", f"""{_BARS_BY_DAY} SELECT 'normalized/bar/date=' || day AS path, TRUE AS same_content, TRUE AS same_snapshot FROM d GROUP BY day""")
def snapshot_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the same rows, in different files, have one identity; manifests are read back from storage."""
    entries, ids = [], set()
    for purpose in ("first", "second"):
        root, _ = _sealed(spark, sf, purpose)
        manifest = snap.open_manifest(spark, root)
        ids.add(manifest.snapshot_id())
        entries.append(spark.createDataFrame([(e.path, e.content_sha256) for e in manifest.files], f"path string, {purpose} string"))
    same = F.col("first") == F.col("second")
    return entries[0].join(entries[1], "path").select("path", same.alias("same_content"), F.lit(len(ids) == 1).alias("same_snapshot"))


_LANE_SQL = ", ".join(f"sum(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS HUGEINT)) AS l{i}" for i in range(4))


@query("content_digest", f"""WITH h AS (SELECT c_nationkey, sha256('{{"c_custkey":' || c_custkey || ',"c_name":"' || c_name ||
        '","c_nationkey":' || c_nationkey || ',"c_mktsegment":"' || c_mktsegment ||
        '","cents":' || CAST(round(c_acctbal * 100) AS BIGINT) || '}}') AS h FROM customer),
    s AS (SELECT c_nationkey, count(*) AS rows, {_LANE_SQL} FROM h GROUP BY 1)
    SELECT c_nationkey, rows, sha256(concat_ws(',', rows, l0, l1, l2, l3)) AS content_sha256 FROM s""")
def content_digest(spark: SparkSession, sf: str) -> DataFrame:
    customers = v.table(spark, sf, "customer").withColumn("cents", F.expr("CAST(round(c_acctbal * 100) AS BIGINT)"))
    return snap.content_digest(customers, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "cents"], ["c_nationkey"])


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = v.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/event[s].parquet")


@query("stream_bars", f"""WITH {v.TICKS_SQL}, b AS ({bars_sql(v.HOUR)})
    SELECT * REPLACE (TRUE AS is_complete) FROM b
    WHERE event_time + {v.HOUR} <= ((SELECT max(event_time) FROM ticks WHERE event_type <> 'error') // 1000000 - 1) * 1000000""")
def stream_bars_query(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars from a file stream in append mode: closed windows come out, open ones are withheld."""
    folder = work_folder(spark, "stream-bars")
    prints = v.shape_ticks(_event_stream(spark, sf))
    closed = stream_bars(prints, window_ns=v.HOUR, origin_ns=v.JAN_1, lag_ns=v.LAG, ineligible=v.INELIGIBLE_TYPES)
    write_stream(closed, folder.at("bars"), folder.at("state")).awaitTermination()
    return spark.read.schema(closed.schema).parquet(folder.at("bars")).select(*BAR_COLUMNS)


@query("stream_dedupe", """SELECT DISTINCT 'acct-' || CAST(user_id % 5 AS VARCHAR) AS account_id, event_type || '-' || user_id AS broker_event_id
    FROM events""")
def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Replays of one broker event are dropped; the watermark delay spans the whole feed."""
    folder = work_folder(spark, "stream-dedupe")
    events = v.shape_ticks(_event_stream(spark, sf)).select(
        F.expr("concat('acct-', instrument_id % 5)").alias("account_id"),
        F.expr("concat(event_type, '-', instrument_id)").alias("broker_event_id"),
        F.col("event_time").alias("event_time_ns"),
    )
    once = dedupe_order_event_stream(events, within="60 days").select("account_id", "broker_event_id")
    write_stream(once, folder.at("events"), folder.at("state")).awaitTermination()
    return spark.read.schema(once.schema).parquet(folder.at("events"))


_LATE_DELAY = 5 * v.DAY


@query("stream_late_rows", f"""WITH {v.TICKS_SQL},
    first_batch AS (SELECT max(event_time) AS high FROM ticks WHERE event_id % 2 = 0),
    r AS (SELECT event_id, event_time, event_id % 2 = 1 AND event_time < high - {_LATE_DELAY} AS is_late, high FROM ticks, first_batch)
    SELECT event_id, event_time, is_late, CASE WHEN is_late THEN high ELSE -1 END AS revision_time FROM r""")
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals of the feed: what comes behind the high-water mark turns into revisions."""
    folder = work_folder(spark, "stream-late")
    ticks = v.ticks(spark, sf).select("event_id", "event_time")
    for remainder in (0, 1):
        # The second half lands after the stream has seen the first.
        ticks.where(F.col("event_id") % 2 == remainder).write.mode("append").parquet(folder.at("feed"))
        feed = spark.readStream.schema(ticks.schema).parquet(folder.at("feed"))
        split_late_rows(feed, folder.at("out"), folder.at("state"), delay_ns=_LATE_DELAY).awaitTermination()
    columns = "event_id bigint, event_time bigint, revision_time bigint"
    parts = [
        spark.read.schema(columns).parquet(folder.at(f"out/{name}")).select(
            "event_id", "event_time", F.lit(late).alias("is_late"),
            F.coalesce("revision_time", F.lit(-1).cast("bigint")).alias("revision_time"),
        )
        for name, late in (("ontime", False), ("revisions", True))
    ]
    return parts[0].unionByName(parts[1])


@query("stream_capture", f"""{_RESOLVED_TICKS}
    SELECT event_time, instrument_id, price_nano, size_shares, 'tr-' || event_id AS trade_id, TRUE AS known_on_receipt FROM resolved""")
def stream_capture(spark: SparkSession, sf: str) -> DataFrame:
    """Live capture: raw lines parsed and resolved as they land; a row is known when it is received."""
    record = f"""concat('{{"S":"', symbol, '","t":"', {_INSTANT}, '","p":', {_decimal_text('price_nano')},
        ',"s":', size_shares, ',"x":"V","i":"tr-', event_id, '"}}') AS value"""
    raw = _write_raw(_raw_events(spark, sf).select("event_id", F.expr(record)), "event_id", work_folder(spark, "capture-raw"))
    clocks = normalize.Clocks("receive_time", "receive_time", "live/000", "sip", knowledge_policy=vocab.LIVE_CAPTURE)
    landed = raw_print_stream(spark, raw, ndjson.TRADE_WIRE, suffix=".txt").withColumn(
        "ingest_index", F.lit(vocab.MISSING_SEQUENCE).cast("bigint")
    )
    rows = normalize.normalize_trades(landed, v.ticker_history(spark, sf), clocks).select(
        "event_time", "instrument_id", "price_nano", "size_shares", "trade_id",
        (F.col("knowledge_time") == F.col("receive_time")).alias("known_on_receipt"),
    )
    folder = work_folder(spark, "capture")
    write_stream(rows, folder.at("trades"), folder.at("state")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(folder.at("trades"))
