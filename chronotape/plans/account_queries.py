"""Queries over fills: exact money, positions, exposure, costs, limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.functions import money, ordering
from chronotape.operators import accounts, scan
from chronotape.plans import views as v
from chronotape.plans.catalogue import query

_SIGNED = "CASE WHEN side = 'buy' THEN quantity_shares ELSE -quantity_shares END"
_VALUE = "CAST(price_nano AS HUGEINT) * quantity_shares"


@query("notional_by_part", f"""WITH {v.FILLS_SQL}
    SELECT instrument_id, CAST(sum({_VALUE}) AS VARCHAR) AS notional_nano FROM fills GROUP BY 1""")
def notional_by_part(spark: SparkSession, sf: str) -> DataFrame:
    value = money.notional("price_nano", "quantity_shares")
    return v.fills(spark, sf).groupBy("instrument_id").agg(F.sum(value).cast("string").alias("notional_nano"))


def _rate_query(spark: SparkSession, sf: str, credit: bool) -> DataFrame:
    """value_nano at tax_percent / 700: never a whole nano-dollar by construction of the divisor."""
    fee = money.apply_rate("value_nano", F.col("tax_percent"), 700, credit=credit)
    keys = ["l_orderkey", "l_linenumber", "l_suppkey", "instrument_id"]
    return v.fills(spark, sf).select(*keys, "quantity_shares", fee["value"].alias("fee_nano"), fee["remainder"].alias("fee_remainder"))


def _rate_sql(value: str) -> str:
    return f"""WITH {v.FILLS_SQL}, e AS (SELECT *, CAST(value_nano AS HUGEINT) * tax_percent AS num FROM fills),
    r AS (SELECT *, {value} AS fee FROM e)
    SELECT l_orderkey, l_linenumber, l_suppkey, instrument_id, quantity_shares, CAST(fee AS BIGINT) AS fee_nano,
           CAST(num - fee * 700 AS BIGINT) AS fee_remainder FROM r"""


@query("apply_rate_cost", _rate_sql("(num + 699) // 700"))
def apply_rate_cost(spark: SparkSession, sf: str) -> DataFrame:
    return _rate_query(spark, sf, credit=False)


@query("apply_rate_credit", _rate_sql("num // 700"))
def apply_rate_credit(spark: SparkSession, sf: str) -> DataFrame:
    return _rate_query(spark, sf, credit=True)


@query("rounding_ledger", f"""WITH {v.FILLS_SQL}, e AS (SELECT instrument_id, CAST(value_nano AS HUGEINT) * tax_percent AS num FROM fills)
    SELECT instrument_id, CAST(sum((num + 699) // 700) AS VARCHAR) AS rounded_total,
           CAST(sum(num - ((num + 699) // 700) * 700) AS VARCHAR) AS remainder_total,
           CAST(sum(num) AS VARCHAR) AS exact_numerator, TRUE AS reconciles
    FROM e GROUP BY 1""")
def rounding_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Rounded fees plus their remainders give back the exact total of every part."""
    fees = v.fills(spark, sf).select(
        "instrument_id", money.apply_rate("value_nano", F.col("tax_percent"), 700).alias("fee"),
        (F.col("value_nano").cast("decimal(28,0)") * F.col("tax_percent")).cast(money.WIDE).alias("exact"),
    )
    totals = fees.groupBy("instrument_id").agg(*money.ledger_total("fee"), F.sum("exact").alias("exact_numerator"))
    rebuilt = (F.col("rounded_total").cast("decimal(30,0)") * 700).cast(money.WIDE) + F.col("remainder_total")
    return totals.select(
        "instrument_id",
        *[F.col(c).cast("string").alias(c) for c in ("rounded_total", "remainder_total", "exact_numerator")],
        (rebuilt == F.col("exact_numerator")).alias("reconciles"),
    )


@query("borrow_accrual", f"""WITH {v.FILLS_SQL}, e AS (SELECT *, {_VALUE} * (discount_percent * 25) AS num FROM fills WHERE side = 'sell')
    SELECT instrument_id, CAST(sum((num + 3599999) // 3600000) AS VARCHAR) AS accrued_nano FROM e GROUP BY 1""")
def borrow_accrual(spark: SparkSession, sf: str) -> DataFrame:
    """One day of borrow on every short sale at discount * 25 basis points a year."""
    shorts = v.fills(spark, sf).where(F.col("side") == "sell")
    fee_bps = money.rational_bps(F.col("discount_percent") * F.lit(25.0), 1)
    accrued = money.borrow_accrual("price_nano", "quantity_shares", fee_bps)["value"]
    return shorts.groupBy("instrument_id").agg(F.sum(accrued.cast(money.WIDE)).cast("string").alias("accrued_nano"))


_FILL_ORDER = ("event_time", "l_orderkey", "l_linenumber", "l_suppkey", "side", "quantity_shares", "price_nano")
# Average cost fill by fill: a recursion over each part's fills in order.
_POSITION_SQL = f"""numbered AS (
    SELECT instrument_id, row_number() OVER (PARTITION BY instrument_id ORDER BY {', '.join(_FILL_ORDER)}) AS k,
           CAST({_SIGNED} AS HUGEINT) AS move, CAST(price_nano AS HUGEINT) AS price FROM fills),
walk AS (
    SELECT instrument_id, k, move AS held, price AS cost FROM numbered WHERE k = 1
    UNION ALL
    SELECT n.instrument_id, n.k, w.held + n.move,
           CASE WHEN w.held = 0 THEN n.price
                WHEN (w.held > 0) = (n.move > 0) THEN (w.cost * abs(w.held) + n.price * abs(n.move)) // abs(w.held + n.move)
                WHEN abs(n.move) > abs(w.held) THEN n.price WHEN n.move = -w.held THEN 0 ELSE w.cost END
    FROM walk w JOIN numbered n ON n.instrument_id = w.instrument_id AND n.k = w.k + 1),
positions AS (
    SELECT f.*, CAST(w.cost AS BIGINT) AS average_cost_nano FROM (
        SELECT instrument_id, CAST(sum({_SIGNED}) AS BIGINT) AS quantity_shares,
               sum(CASE WHEN side = 'buy' THEN -({_VALUE}) ELSE {_VALUE} END) AS cash_nano, count(*) AS fills
        FROM fills GROUP BY 1) f JOIN walk w ON w.instrument_id = f.instrument_id AND w.k = f.fills)"""


@query("positions", f"""WITH RECURSIVE {v.FILLS_SQL}, {_POSITION_SQL}
    SELECT instrument_id, quantity_shares, CAST(cash_nano AS VARCHAR) AS cash_nano, average_cost_nano, fills FROM positions""")
def positions(spark: SparkSession, sf: str) -> DataFrame:
    held = accounts.positions_from_fills(v.fills(spark, sf), _FILL_ORDER)
    return held.withColumn("cash_nano", F.col("cash_nano").cast("string"))


_MARK_AT = 978_307_200 * vocab.NS_PER_SECOND  # 2001-01-01


@query("position_profit", f"""WITH RECURSIVE {v.FILLS_SQL}, {_POSITION_SQL},
    marks AS (SELECT instrument_id, last(price_nano ORDER BY event_time, l_orderkey, l_linenumber, l_suppkey, price_nano) AS mark
              FROM fills WHERE event_time + {v.LAG} <= {_MARK_AT} GROUP BY 1)
    SELECT p.instrument_id, coalesce(mark, -1) AS mark_price_nano,
           coalesce(CAST(cash_nano + CAST(mark AS HUGEINT) * quantity_shares
                - (CAST(mark AS HUGEINT) - average_cost_nano) * quantity_shares AS VARCHAR), '') AS realized_pnl_nano,
           coalesce(CAST((CAST(mark AS HUGEINT) - average_cost_nano) * quantity_shares AS VARCHAR), '') AS unrealized_pnl_nano
    FROM positions p LEFT JOIN marks m USING (instrument_id)""")
def position_profit(spark: SparkSession, sf: str) -> DataFrame:
    """Positions marked at the last fill price knowable at the mark instant."""
    fills = v.fills(spark, sf)
    prices = fills.select(
        "instrument_id", "event_time", (F.col("event_time") + v.LAG).alias("knowledge_time"), "price_nano",
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("price_nano").alias("tie_price"),
    )
    marked = accounts.mark_positions(
        accounts.positions_from_fills(fills, _FILL_ORDER), prices, _MARK_AT,
        right_tie=["l_orderkey", "l_linenumber", "l_suppkey", "tie_price"],
    )
    return marked.select(
        "instrument_id", F.coalesce("mark_price_nano", F.lit(-1).cast("bigint")).alias("mark_price_nano"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("realized_pnl_nano", "unrealized_pnl_nano")],
    )


@query("running_position", f"""WITH {v.FILLS_SQL}
    SELECT instrument_id, event_time, l_orderkey, l_linenumber, l_suppkey,
           CAST(sum({_SIGNED}) OVER w AS BIGINT) AS position_shares,
           CAST(sum(CASE WHEN side = 'buy' THEN -({_VALUE}) ELSE {_VALUE} END) OVER w AS VARCHAR) AS cash_nano
    FROM fills WINDOW w AS (PARTITION BY instrument_id ORDER BY {', '.join(_FILL_ORDER)}
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_position(spark: SparkSession, sf: str) -> DataFrame:
    run = accounts.running_position(v.fills(spark, sf), _FILL_ORDER, scan.time_chunk("event_time", 365 * v.DAY))
    return run.select(
        "instrument_id", "event_time", "l_orderkey", "l_linenumber", "l_suppkey", "position_shares",
        F.col("cash_nano").cast("string").alias("cash_nano"),
    )


def _marked_by_supplier(spark: SparkSession, sf: str) -> DataFrame:
    """Positions per supplier (the account) and part, marked at the highest fill price seen."""
    return v.fills(spark, sf).groupBy("l_suppkey", "instrument_id").agg(
        F.sum(accounts.signed_quantity()).alias("quantity_shares"), F.max("price_nano").alias("mark_price_nano")
    )


_MARKED_SQL = f"""held AS (
    SELECT l_suppkey, instrument_id, sum({_SIGNED}) AS quantity_shares, max(price_nano) AS mark_price_nano FROM fills GROUP BY 1, 2),
valued AS (SELECT *, CAST(mark_price_nano AS HUGEINT) * quantity_shares AS value FROM held),
exposed AS (SELECT l_suppkey, sum(abs(value)) AS gross, sum(value) AS net, count(*) AS positions FROM valued GROUP BY 1)"""


@query("exposure", f"""WITH {v.FILLS_SQL}, {_MARKED_SQL}
    SELECT l_suppkey, CAST(gross AS VARCHAR) AS gross_exposure_nano, CAST(net AS VARCHAR) AS net_exposure_nano, positions FROM exposed""")
def exposure(spark: SparkSession, sf: str) -> DataFrame:
    totals = accounts.exposure(_marked_by_supplier(spark, sf), ["l_suppkey"])
    return totals.withColumns({c: F.col(c).cast("string") for c in ("gross_exposure_nano", "net_exposure_nano")})


@query("limit_audit", f"""WITH {v.FILLS_SQL}, {_MARKED_SQL},
    e AS (SELECT x.*, CAST(round(s_acctbal * 100) AS BIGINT) * 10000000 * 20000 AS nav FROM exposed x JOIN supplier ON s_suppkey = l_suppkey)
    SELECT l_suppkey, CASE WHEN gross * 10000 > CAST(nav AS HUGEINT) * 5000 THEN 'gross_exposure_limit'
           WHEN abs(net) * 10000 > CAST(nav AS HUGEINT) * 2000 THEN 'net_exposure_limit' ELSE 'approved' END AS risk_reason FROM e""")
def limit_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier balances, scaled, stand in for equity."""
    equity = v.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        (F.expr("CAST(round(s_acctbal * 100) AS BIGINT)") * 10_000_000 * 20_000).alias("equity_nano"),
    )
    accounts_now = accounts.exposure(_marked_by_supplier(spark, sf), ["l_suppkey"]).join(equity, "l_suppkey")
    return accounts.exposure_limit_decision(accounts_now).select("l_suppkey", "risk_reason")


@query("risk_reasons", f"""WITH {v.FILLS_SQL}, {_MARKED_SQL},
    p AS (SELECT CASE WHEN abs(value) * 10000 > CAST(4000000000000000 AS HUGEINT) * 200 THEN 'position_limit' ELSE 'approved' END AS risk_reason
          FROM valued)
    SELECT risk_reason, count(*) AS events FROM p GROUP BY 1""")
def risk_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Position limits against a fixed equity, counted by reason code."""
    held = _marked_by_supplier(spark, sf).withColumn("equity_nano", F.lit(4_000_000_000_000_000))
    return accounts.risk_reason_counts(accounts.position_limit_decision(held))


@query("cost_breakdown", f"""WITH {v.FILLS_SQL}
    SELECT l_suppkey, CAST(sum(commission_nano) AS VARCHAR) AS commission_nano,
           CAST(sum(regulatory_fees_nano) AS VARCHAR) AS regulatory_fees_nano,
           CAST(sum(CAST(price_nano - arrival_price_nano AS HUGEINT) * {_SIGNED}) AS VARCHAR) AS shortfall_nano,
           count(*) AS fills FROM fills GROUP BY 1""")
def cost_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    costs = accounts.cost_breakdown(v.fills(spark, sf), ["l_suppkey"])
    return costs.withColumns({c: F.col(c).cast("string") for c in ("commission_nano", "regulatory_fees_nano", "shortfall_nano")})


@query("narrow_shares", f"""WITH {v.FILLS_SQL}
    SELECT instrument_id, CAST(sum(value_nano) AS BIGINT) AS value_nano, CAST(sum(quantity_shares) AS BIGINT) AS shares FROM fills GROUP BY 1""")
def narrow_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Wide sums brought back to storable money, and fractional-typed quantities to whole shares."""
    fills = v.fills(spark, sf).select("instrument_id", "value_nano", F.col("quantity_shares").cast("double").alias("quantity"))
    whole = fills.withColumn("shares", money.require_whole_shares("quantity"))
    sums = whole.groupBy("instrument_id").agg(F.sum(F.col("value_nano").cast(money.WIDE)).alias("wide"), F.sum("shares").alias("shares"))
    return sums.select("instrument_id", money.narrow("wide").alias("value_nano"), "shares")


@query("sentinel_bounds", f"""WITH {v.TICKS_SQL} SELECT event_type, count(*) AS rows, count(*) AS after_first, count(*) AS before_last FROM ticks GROUP BY 1""")
def sentinel_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Every order key lies strictly between the two sentinels, which are keys themselves."""
    key = F.struct(*[F.col(c) for c in vocab.ORDER_KEY])
    marked = v.ticks(spark, sf).select(
        "event_type", ordering.strictly_after(key, ordering.before_everything()).alias("first"),
        ordering.strictly_after(ordering.after_everything(), key).alias("last"),
    )
    return marked.groupBy("event_type").agg(F.count("*").alias("rows"), F.count_if("first").alias("after_first"), F.count_if("last").alias("before_last"))
