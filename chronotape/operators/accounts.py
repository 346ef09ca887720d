"""Positions, costs, exposure and limits, reconciled exactly from fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.functions import money
from chronotape.operators.asof import usable_asof_join
from chronotape.operators.scan import Running, running, written_copy

#: Fills of one open position that are folded at once.
FILLS_PER_ROUND = 100_000


def signed_quantity(quantity: str = "quantity_shares", side: str = "side") -> Column:
    return F.when(F.col(side) == "buy", F.col(quantity)).otherwise(-F.col(quantity))


def _wide_sum(value: Column) -> Column:
    return F.sum(value.cast(money.WIDE))


def positions_from_fills(
    fills: DataFrame, order: Sequence[str], by: Sequence[str] = ("instrument_id",), per_round: int = FILLS_PER_ROUND
) -> DataFrame:
    """Signed quantity, cash flow, fill count and average cost per instrument.

    ``average_cost_nano`` is that of the open position: a fill that opens or adds moves it to the
    share-weighted mean, toward zero; one that reduces leaves it; one that crosses flat starts again at
    its own price; a flat position has none. ``order`` orders an instrument's fills.
    """
    is_buy = F.col("side") == "buy"
    value = money.notional("price_nano", "quantity_shares")
    totals = fills.groupBy(*by).agg(
        F.sum(signed_quantity()).alias("quantity_shares"),
        _wide_sum(F.when(is_buy, -value).otherwise(value)).alias("cash_nano"),
        F.count("*").alias("fills"),
    )
    costs = _average_costs(fills, order, by, per_round).withColumnsRenamed({c: f"__k{i}" for i, c in enumerate(by)})
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(by)]
    return totals.join(costs, same).drop(*[f"__k{i}" for i in range(len(by))])


def _average_costs(fills: DataFrame, order: Sequence[str], by: Sequence[str], per_round: int) -> DataFrame:
    """Cost of each open position, folded over the fills since it was opened.

    A fill that finds the position flat, or takes it through flat, starts the cost afresh, so nothing
    before an instrument's last such fill matters. Running quantities find that fill in parallel, also
    for a hot instrument, and the fills before it are never gathered. Since each rounded mean depends on
    the one before, the rest are folded in order, ``per_round`` at a time; only a position that stays
    open over more fills goes through further rounds, which receive the state the one before left.
    """
    by = list(by)
    moves = fills.select(*by, *[c for c in order if c not in by], signed_quantity().alias("__move"), F.col("price_nano").alias("__price"))
    running_values = [Running("__at", "sum", F.lit(1).cast("bigint")), Running("__held", "sum", F.col("__move"))]
    before = {n: F.coalesce(n, F.lit(0)).cast("bigint") for n in ("__at", "__held")}
    placed = running(moves, by, list(order), F.lit(0), running_values).withColumns(before)
    placed = written_copy(placed.select(*by, "__at", "__held", "__move", "__price"), "fill-places")

    def on_keys(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        named = right.withColumnsRenamed({c: f"__r{i}" for i, c in enumerate(by)})
        return left.join(named, [F.col(c).eqNullSafe(F.col(f"__r{i}")) for i, c in enumerate(by)], how).drop(*[f"__r{i}" for i in range(len(by))])

    opens = (F.col("__held") == 0) | (F.signum("__held") * F.signum(F.col("__held") + F.col("__move")) < 0)
    opened = placed.groupBy(*by).agg(F.max(F.when(opens, F.struct("__at", "__held"))).alias("__opened"), F.max("__at").alias("__last"))
    since = F.col("__at") - F.col("__opened.__at")
    live = on_keys(placed.select(*by, "__at", "__move", "__price"), opened).where(since >= 0)
    packed = live.withColumn("__round", F.call_function("div", since, F.lit(per_round))).groupBy(*by, "__round").agg(
        F.sort_array(F.collect_list(F.struct("__at", "__move", "__price"))).alias("__moves"), F.first("__opened").alias("__opened")
    )
    # what the opening fill finds is held at any cost: it leaves its own price
    fold = """aggregate(__moves, coalesce(__state, named_struct('held', __opened.__held, 'cost', 0L)), (s, m) -> named_struct(
        'held', s.held + m.__move,
        'cost', CASE
            WHEN s.held = 0 OR signum(s.held) = signum(m.__move) THEN CAST(
                (CAST(s.cost AS DECIMAL(19,0)) * CAST(abs(s.held) AS DECIMAL(18,0)) + CAST(m.__price AS DECIMAL(19,0)) * CAST(abs(m.__move) AS DECIMAL(18,0)))
                div CAST(greatest(abs(s.held) + abs(m.__move), 1) AS DECIMAL(19,0)) AS BIGINT)
            WHEN abs(m.__move) < abs(s.held) THEN s.cost
            WHEN abs(m.__move) = abs(s.held) THEN 0L
            ELSE m.__price END))"""
    nothing = F.lit(None).cast("struct<held:bigint,cost:bigint>")
    longest = opened.agg(F.max(F.col("__last") - F.col("__opened.__at"))).first()[0]  # one number
    if longest is None or longest < per_round:
        return packed.withColumn("__state", nothing).withColumn("__state", F.expr(fold)).select(*by, F.col("__state.cost").alias("average_cost_nano"))
    packed = written_copy(packed, "fill-rounds")
    state = written_copy(packed.select(*by).distinct().withColumn("__state", nothing), "fill-state")
    for round_ in range(longest // per_round + 1):
        met = on_keys(state, packed.where(F.col("__round") == round_), "left")
        folded = F.when(F.col("__moves").isNull(), F.col("__state")).otherwise(F.expr(fold))
        state = written_copy(met.withColumn("__state", folded).select(*by, "__state"), "fill-state")
    return state.select(*by, F.col("__state.cost").alias("average_cost_nano"))


def with_profit(positions: DataFrame, mark: str = "mark_price_nano") -> DataFrame:
    """Realized and unrealized profit at a causal mark; their sum is exactly cash + quantity * mark."""
    unrealized = (
        (F.col(mark).cast("decimal(19,0)") - F.col("average_cost_nano").cast("decimal(19,0)"))
        * F.col("quantity_shares").cast("decimal(17,0)")
    ).cast(money.WIDE)
    total = (F.col("cash_nano") + money.notional(mark, "quantity_shares")).cast(money.WIDE)
    return positions.withColumns(
        {"realized_pnl_nano": (total - unrealized).cast(money.WIDE), "unrealized_pnl_nano": unrealized}
    )


def mark_positions(
    positions: DataFrame, prices: DataFrame, at: int, *, price: str = "price_nano", right_tie: Sequence[str] = (),
) -> DataFrame:
    """Attach the last price knowable at ``at`` and the profit split at that mark."""
    dated = positions.withColumn("decision_time", F.lit(at).cast("bigint"))
    marked = usable_asof_join(
        dated, prices.withColumnRenamed(price, "mark_price_nano"), by=["instrument_id"], decision="decision_time",
        payload=["mark_price_nano"], right_tie=right_tie, look_ahead="known",
    )
    return with_profit(marked)


def running_position(
    fills: DataFrame, order: Sequence[str], chunk: Column, by: Sequence[str] = ("instrument_id",)
) -> DataFrame:
    """Position and cash after every fill, as a chunked running sum that survives a hot instrument."""
    value = money.notional("price_nano", "quantity_shares")
    cash = F.when(F.col("side") == "buy", -value).otherwise(value)
    return running(
        fills, by, order, chunk,
        [
            Running("position_shares", "sum", signed_quantity(), inclusive=True),
            Running("cash_nano", "sum", cash, inclusive=True),
        ],
    )


def exposure(positions: DataFrame, by: Sequence[str] = (), mark: str = "mark_price_nano") -> DataFrame:
    """Gross and net exposure: sums of absolute and signed position notionals."""
    value = money.notional(mark, "quantity_shares")
    return positions.groupBy(*by).agg(
        _wide_sum(F.abs(value)).alias("gross_exposure_nano"),
        _wide_sum(value).alias("net_exposure_nano"),
        F.count("*").alias("positions"),
    )


def cost_breakdown(fills: DataFrame, by: Sequence[str]) -> DataFrame:
    """Commission, regulatory fees and shortfall against arrival price, never blended into one figure."""
    slip = F.col("price_nano").cast("decimal(19,0)") - F.col("arrival_price_nano").cast("decimal(19,0)")
    shortfall = (slip * signed_quantity().cast("decimal(17,0)")).cast(money.WIDE)
    return fills.groupBy(*by).agg(
        _wide_sum(F.col("commission_nano")).alias("commission_nano"),
        _wide_sum(F.col("regulatory_fees_nano")).alias("regulatory_fees_nano"),
        _wide_sum(shortfall).alias("shortfall_nano"),
        F.count("*").alias("fills"),
    )


def _beyond(value: Column, nav: Column, bps: int) -> Column:
    """|value| > nav * bps / 10,000 without dividing."""
    return F.abs(value).cast("decimal(33,0)") * 10_000 > nav.cast("decimal(33,0)") * bps


def position_limit_decision(
    positions: DataFrame, nav: str = "equity_nano", mark: str = "mark_price_nano", bps: int = vocab.POSITION_LIMIT_BPS
) -> DataFrame:
    """Reason code per position against its share of net asset value."""
    over = _beyond(money.notional(mark, "quantity_shares"), F.col(nav), bps)
    return positions.withColumn("risk_reason", F.when(over, "position_limit").otherwise("approved"))


def exposure_limit_decision(
    accounts: DataFrame,
    nav: str = "equity_nano",
    gross_bps: int = vocab.GROSS_LIMIT_BPS,
    net_bps: int = vocab.NET_LIMIT_BPS,
) -> DataFrame:
    """First breached limit per account: gross before net."""
    return accounts.withColumn(
        "risk_reason",
        F.when(_beyond(F.col("gross_exposure_nano"), F.col(nav), gross_bps), "gross_exposure_limit")
        .when(_beyond(F.col("net_exposure_nano"), F.col(nav), net_bps), "net_exposure_limit")
        .otherwise("approved"),
    )


def risk_reason_counts(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return events.groupBy(*by, "risk_reason").agg(F.count("*").alias("events"))


def percentile_lags(df: DataFrame, by: Sequence[str], lag: Column, percentiles: Sequence[int], chunk_ns: int = vocab.NS_PER_SECOND) -> DataFrame:
    """Exact nearest-rank percentiles of an integer lag per group, one column ``p<NN>`` each.

    The lags become a histogram first (map-side combined), then ranks come from a chunked running
    count over distinct lags. Nothing holds a whole group's values, as ``percentile`` would.
    """
    if not by:
        everything = percentile_lags(df.withColumn("__all", F.lit(1)), ["__all"], lag, percentiles, chunk_ns)
        return everything.drop("__all")
    histogram = df.groupBy(*by, lag.alias("__lag")).agg(F.count("*").alias("__n"))
    ranked = running(
        histogram, by, ["__lag"], F.call_function("div", F.col("__lag"), F.lit(chunk_ns)),
        [Running("__upto", "sum", F.col("__n"), inclusive=True)],
    )
    totals = histogram.groupBy(*by).agg(F.sum("__n").alias("__total"))
    return ranked.join(totals, list(by)).groupBy(*by).agg(
        F.max("__total").alias("rows"),
        *[
            F.min(F.when(F.col("__upto") * 100 >= F.col("__total") * p, F.col("__lag"))).alias(f"p{p}")
            for p in percentiles
        ],
    )
