"""Queries that count broken rules over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotape.contracts import contract, vocab
from chronotape.functions.instants import ns_from_timestamp_ntz
from chronotape.operators import audits
from chronotape.operators.normalize import to_contract
from chronotape.plans import views as v
from chronotape.plans.catalogue import query


def _counts(report: DataFrame) -> DataFrame:
    return report.select("rule", "violations")


# Each clock is shifted on some rows, so every rule has something to find.
_FLAWED = """SELECT event_id, event_time, CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_time + 250000 END AS receive_time,
    event_time + CASE WHEN event_id % 103 = 0 THEN 0 ELSE 500000 END AS process_time,
    CASE WHEN event_id % 107 = 0 THEN 0 WHEN event_id % 109 = 0 THEN event_time + 7 ELSE event_time + 250000 END AS knowledge_time,
    CASE WHEN event_id % 113 = 0 THEN 4611686018427387905 ELSE price_nano END AS price_nano,
    CASE WHEN event_id % 127 = 0 THEN event_id - event_id % 2 ELSE event_id END AS sequence,
    instrument_id, size_shares, event_type"""


def _trades_with_flaws(spark: SparkSession, sf: str) -> DataFrame:
    ticks = v.ticks(spark, sf)
    flawed = ticks.select(
        "event_id", "instrument_id", "size_shares", "conditions", "event_time",
        *[F.expr(e) for e in (
            "CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_time + 250000 END AS receive_time",
            "event_time + CASE WHEN event_id % 103 = 0 THEN 0 ELSE 500000 END AS process_time",
            "CASE WHEN event_id % 107 = 0 THEN 0 WHEN event_id % 109 = 0 THEN event_time + 7 ELSE event_time + 250000 END AS knowledge_time",
            "CASE WHEN event_id % 113 = 0 THEN 4611686018427387905 ELSE price_nano END AS price_nano",
        )],
    )
    return to_contract(
        flawed.withColumns(
            {
                "revision_time": F.lit(None).cast("bigint"), "source_rank": F.lit(vocab.TRADE),
                "vendor_sequence": F.lit(-1), "venue_sequence": F.lit(-1), "ingest_index": F.lit(0),
                "event_time": F.when(F.col("event_id") % 127 == 0, F.lit(v.JAN_1)).otherwise(F.col("event_time")),
                "raw_partition_id": F.lit("ticks/000"), "event_time_source": F.lit("sip"), "exchange": F.lit("V"),
                "trade_id": F.col("event_id").cast("string"), "tape": F.lit("C"), "is_cancelled": F.lit(False),
            }
        ),
        contract("normalized.trade"),
    )


def _contract_sql() -> str:
    shape = contract("normalized.trade")
    always_set = [c for c in shape.required_columns if c != "receive_time"]
    rules = [(f"null {c}", "FALSE") for c in always_set] + [
        ("null receive_time", "receive_time IS NULL"),
        ("knowledge_time outside the plausible band", f"knowledge_time NOT BETWEEN {vocab.PLAUSIBLE_MIN_NS} AND {vocab.PLAUSIBLE_MAX_NS}"),
        ("knowledge_time precedes event_time", "knowledge_time < event_time"),
        ("receive_time precedes event_time", "receive_time < event_time"),
        ("process_time precedes receive_time", "process_time < receive_time"),
        ("live_capture knowledge_time differs from receive_time", "knowledge_time <> receive_time"),
        ("price_nano outside the storable range", f"price_nano NOT BETWEEN {-2**62} AND {2**62}"),
    ]
    parts = [f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {condition}) AS violations FROM t" for rule, condition in rules]
    parts.append(
        "SELECT 'ordering keys are not strictly increasing: repeated key', CAST(coalesce(sum(n - 1), 0) AS BIGINT) "
        "FROM (SELECT count(*) AS n FROM t GROUP BY event_time HAVING count(*) > 1)"
    )
    return f"""WITH {v.TICKS_SQL}, f AS ({_FLAWED} FROM ticks),
    t AS (SELECT * REPLACE (CASE WHEN event_id % 127 = 0 THEN {v.JAN_1} ELSE event_time END AS event_time) FROM f)
    {" UNION ALL ".join(parts)}"""


@query("contract_audit", _contract_sql())
def contract_audit(spark: SparkSession, sf: str) -> DataFrame:
    report = audits.contract_violations(_trades_with_flaws(spark, sf), contract("normalized.trade"), vocab.LIVE_CAPTURE)
    return _counts(report)


@query("dup_key_audit", """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_key_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audits.duplicate_keys(v.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("ordering_audit", """WITH o AS (SELECT o_orderkey, epoch_us(o_orderdate) * 1000 AS event_time, o_custkey FROM orders),
    p AS (SELECT *, lag(event_time) OVER w AS pt, lag(o_custkey) OVER w AS pc FROM o WINDOW w AS (ORDER BY o_orderkey))
    SELECT o_orderkey, event_time, o_custkey FROM p WHERE pt > event_time OR (pt = event_time AND pc >= o_custkey)""")
def ordering_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Orders logged by key whose (date, customer) key does not increase; compared block by block."""
    orders = v.table(spark, sf, "orders").select(
        "o_orderkey", ns_from_timestamp_ntz("o_orderdate").alias("event_time"), "o_custkey"
    )
    return audits.unsorted_rows(orders, [], "o_orderkey", ["event_time", "o_custkey"], block=4_096)


@query("order_events_unique", f"""WITH {v.ORDER_EVENTS_SQL}
    SELECT 'fill without execution_id' AS rule, count(*) FILTER (WHERE event_type = 'fill' AND execution_id IS NULL) AS violations FROM order_events
    UNION ALL SELECT 'knowledge_time precedes event_time', count(*) FILTER (WHERE knowledge_time_ns < event_time_ns) FROM order_events
    UNION ALL SELECT 'repeated account_id, broker_event_id', CAST(count(*) - count(DISTINCT (account_id, broker_event_id)) AS BIGINT) FROM order_events
    UNION ALL SELECT 'repeated account_id, execution_id', CAST(count(*) - count(DISTINCT (account_id, execution_id)) AS BIGINT)
        FROM order_events WHERE execution_id IS NOT NULL
    UNION ALL SELECT 'repeated account_id, broker_sequence', CAST(count(*) - count(DISTINCT (account_id, broker_sequence)) AS BIGINT)
        FROM order_events WHERE broker_sequence IS NOT NULL""")
def order_events_unique(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(audits.order_event_violations(v.order_events(spark, sf)))


@query("order_events_dedupe", f"""WITH {v.ORDER_EVENTS_SQL},
    r AS (SELECT *, row_number() OVER (PARTITION BY account_id, broker_event_id ORDER BY knowledge_time_ns, event_id) AS r FROM order_events)
    SELECT account_id, broker_event_id, event_id, event_type, event_time_ns, knowledge_time_ns FROM r WHERE r = 1""")
def order_events_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    kept = audits.deduplicate_order_events(v.order_events(spark, sf))
    return kept.select("account_id", "broker_event_id", "event_id", "event_type", "event_time_ns", "knowledge_time_ns")


@query("order_events_readable", f"""WITH {v.ORDER_EVENTS_SQL}
    SELECT event_id, event_time_ns, event_time_ns // 1000 AS event_time_us, knowledge_time_ns // 1000 AS knowledge_time_us FROM order_events""")
def order_events_readable(spark: SparkSession, sf: str) -> DataFrame:
    readable = audits.readable_order_events(v.order_events(spark, sf))
    return readable.select(
        "event_id", "event_time_ns", F.unix_micros("event_time").alias("event_time_us"),
        F.unix_micros("knowledge_time").alias("knowledge_time_us"),
    )


@query("fk_audit", """SELECT l_orderkey, count(*) AS orphan_lines FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') GROUP BY 1""")
def fk_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Lines whose order is missing once pending orders are set aside."""
    parents = v.table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    lines = v.table(spark, sf, "lineitem").select("l_orderkey")
    return audits.orphans(lines, "l_orderkey", parents, "o_orderkey").groupBy("l_orderkey").agg(
        F.count("*").alias("orphan_lines")
    )


@query("status_audit", f"""WITH {v.EXPERIMENTS_SQL}
    SELECT 'unknown status' AS rule, count(*) FILTER (WHERE status NOT IN ('created', 'queued', 'running', 'succeeded', 'failed', 'cancelled')) AS violations FROM experiments
    UNION ALL SELECT 'repeated family_id, trial_index', CAST(count(*) - count(DISTINCT (family_id, trial_index)) AS BIGINT) FROM experiments""")
def status_audit(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(audits.experiment_violations(v.experiments(spark, sf)))


@query("trial_counts", f"""WITH {v.EXPERIMENTS_SQL}
    SELECT family_id, count(*) AS trials, min(trial_index) AS first_index, max(trial_index) AS last_index,
           max(trial_index) - min(trial_index) + 1 = count(*) AND count(DISTINCT trial_index) = count(*) AS is_dense
    FROM experiments GROUP BY 1""")
def trial_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audits.trial_counts(v.experiments(spark, sf))


@query("holdout_accesses", f"""WITH {v.EXPERIMENTS_SQL}
    SELECT family_id, count(*) AS accesses FROM experiments WHERE status = 'succeeded' GROUP BY 1""")
def holdout_accesses(spark: SparkSession, sf: str) -> DataFrame:
    return audits.holdout_accesses(v.experiments(spark, sf).where("status = 'succeeded'"))


@query("feature_audit", f"""WITH {v.KNOWN_SQL},
    f AS (SELECT *, CASE WHEN event_id % 31 = 0 THEN NULL ELSE price_nano // 10000000 END AS value,
                 event_time + 30 * {vocab.NS_PER_MINUTE} AS decision_time FROM known)
    SELECT 'feature without a spec' AS rule, count(*) FILTER (WHERE event_type = 'signup') AS violations FROM f
    UNION ALL SELECT 'knowledge_time after decision_time', count(*) FILTER (WHERE knowledge_time > decision_time) FROM f
    UNION ALL SELECT 'value outside its valid range', count(*) FILTER (WHERE event_type <> 'signup' AND (value < 100 OR value > 20000)) FROM f
    UNION ALL SELECT 'null value where the policy forbids it', count(*) FILTER (WHERE value IS NULL AND event_type = 'view') FROM f""")
def feature_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Tick cents as feature values; signups have no spec, views must not be null."""
    known = v.known_ticks(spark, sf)
    cents = F.call_function("div", F.col("price_nano"), F.lit(v.NANOS_PER_CENT)).cast("double")
    values = known.select(
        F.col("event_type").alias("feature_id"), F.lit(1).alias("feature_version"), "instrument_id", "knowledge_time",
        (F.col("event_time") + 30 * vocab.NS_PER_MINUTE).alias("decision_time"),
        F.when(F.col("event_id") % 31 != 0, cents).alias("value"),
    )
    specs = known.where("event_type <> 'signup'").select(F.col("event_type").alias("feature_id")).distinct().select(
        "feature_id", F.lit(1).alias("feature_version"),
        F.when(F.col("feature_id") == "view", "forbid").otherwise("null").alias("missing_policy"),
        F.lit(100.0).alias("valid_low"), F.lit(20_000.0).alias("valid_high"),
    )
    return _counts(audits.feature_violations(values, specs))


@query("coverage_gate", f"""WITH {v.TICKS_SQL}, q AS (SELECT CASE WHEN event_type = 'click' THEN 'iex_only' ELSE 'sip' END AS venue_coverage FROM ticks)
    SELECT venue_coverage, count(*) AS quotes, count(*) FILTER (WHERE venue_coverage = 'iex_only') AS refused FROM q GROUP BY 1""")
def coverage_gate(spark: SparkSession, sf: str) -> DataFrame:
    coverage = F.when(F.col("event_type") == "click", "iex_only").otherwise("sip")
    return audits.coverage_report(v.ticks(spark, sf).withColumn("venue_coverage", coverage))


@query("promotion_gate", f"""WITH {v.TICKS_SQL}
    SELECT count(*) AS rows, count(*) FILTER (WHERE event_type = 'error') AS unknown_source_rows,
           count(*) FILTER (WHERE event_type = 'error') = 0 AS promotable FROM ticks""")
def promotion_gate(spark: SparkSession, sf: str) -> DataFrame:
    source = F.when(F.col("event_type") == "error", "vendor_unknown").otherwise("sip")
    return audits.promotion_report(v.ticks(spark, sf).withColumn("event_time_source", source))


@query("duplicate_paths", "SELECT split_part(url, '/', 3) AS path, count(*) AS copies FROM pages GROUP BY 1 HAVING count(*) > 1")
def duplicate_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts of page addresses stand in for manifest paths, which must be unique."""
    return audits.duplicate_paths(v.table(spark, sf, "pages").select(F.split_part("url", F.lit("/"), F.lit(3)).alias("path")))
