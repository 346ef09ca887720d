"""Effective-dated state: corrected rows as of an instant, split factors, fee schedules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotape.contracts.model import ContractError
from chronotape.functions import money
from chronotape.functions.instants import covers
from chronotape.operators.sizing import broadcast_if_small


def as_known(df: DataFrame, identity: Sequence[str], as_of: int | Column, tie: Sequence[str] = ("ingest_index",)) -> DataFrame:
    """Each row's latest revision known by ``as_of``; cancelled rows stay, with their flag set.

    A grouped maximum rather than a ranking window: revisions collapse map-side, so one row with a
    huge number of revisions does not gather in a task. Unrevised originals rank lowest.
    """
    limit = F.lit(as_of) if isinstance(as_of, int) else as_of
    rest = [c for c in df.columns if c not in identity]
    rank = F.struct(F.coalesce("revision_time", F.lit(-(2**63))).alias("r"), *[F.col(c) for c in tie])
    latest = (
        df.where(F.col("knowledge_time") <= limit)
        .groupBy(*identity)
        .agg(F.max_by(F.struct(*rest), rank).alias("latest"))
    )
    return latest.select(*identity, "latest.*").select(*df.columns)


def split_segments(actions: DataFrame, decision_time: int) -> DataFrame:
    """Cumulative split ratio per instrument as disjoint segments, from splits announced by then.

    Ratios multiply as exact decimals and are never reduced: a product past 27 digits fails
    instead of rounding, which also bounds how many splits one instrument can usefully carry.
    """
    splits = actions.where(
        (F.col("action_type") == "split") & (F.col("announcement_time") <= decision_time)
        & F.col("split_numerator").isNotNull() & F.col("split_denominator").isNotNull()
    ).select(
        "instrument_id", "effective_time", "split_numerator", "split_denominator"
    ).distinct()
    so_far = (
        Window.partitionBy("instrument_id").orderBy("effective_time")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def product(column: str) -> Column:
        values = F.collect_list(F.col(column)).over(so_far)
        return F.aggregate(
            values,
            F.lit(1).cast("decimal(27,0)"),
            lambda acc, x: (acc * x.cast("decimal(10,0)")).cast("decimal(27,0)"),
        )

    running = splits.select(
        "instrument_id", F.col("effective_time").alias("start"),
        product("split_numerator").alias("factor_num"), product("split_denominator").alias("factor_den"),
    ).distinct()
    following = F.lead("start").over(Window.partitionBy("instrument_id").orderBy("start"))
    return running.withColumn("end", following)


def split_adjusted(
    prints: DataFrame, actions: DataFrame, decision_time: int, *, price: str = "price_nano", size: str = "size_shares",
) -> DataFrame:
    """Prices and sizes on the share basis before any split, using only what was announced.

    A print at or after a 2-for-1 split has its price doubled and its size halved, both truncated.
    """
    segments = broadcast_if_small(split_segments(actions, decision_time)).alias("s")
    on = (F.col("p.instrument_id") == F.col("s.instrument_id")) & covers("p.event_time", "s.start", "s.end")
    num = F.coalesce("s.factor_num", F.lit(1).cast("decimal(27,0)"))
    den = F.coalesce("s.factor_den", F.lit(1).cast("decimal(27,0)"))

    small_num, small_den = num.try_cast("bigint"), den.try_cast("bigint")

    def scaled(column: str, up: Column, down: Column, small_up: Column, small_down: Column) -> Column:
        """value * up / down, in 64 bits wherever the product fits."""
        value = F.col(f"p.{column}")
        product = F.when(small_down.isNotNull(), F.try_multiply(value, small_up))
        exact = F.call_function("div", (value.cast("decimal(19,0)") * up).cast(money.WIDE), down)
        return F.when(product.isNotNull(), F.call_function("div", product, small_down)).otherwise(exact)

    return prints.alias("p").join(segments, on, "left").select(
        "p.*",
        scaled(price, num, den, small_num, small_den).alias("adjusted_price_nano"),
        scaled(size, den, num, small_den, small_num).alias("adjusted_size_shares"),
    )



@dataclass(frozen=True)
class FeeComponent:
    """One effective-dated rate, an exact ratio. ``basis`` is per_share, per_notional or per_order."""

    name: str
    rate_numerator: int
    rate_denominator: int = 1
    basis: str = "per_share"
    effective_from_ns: int = 0


@dataclass(frozen=True)
class FeeSchedule:
    """A published schedule: a short configuration document, compiled into column expressions.

    Looking up the rate in force is a CASE over its few effective dates, so no join or shuffle of
    the fills is needed.
    """

    components: tuple[FeeComponent, ...]

    @property
    def names(self) -> list[str]:
        return list(dict.fromkeys(c.name for c in self.components))

    def cost(self, name: str, *, price: str, quantity: str, at: str = "event_time", part_of: str = "value") -> Column:
        """Fee of one component per fill, rounded against us; NULL before its first effective date.

        ``part_of`` picks the ledger field to compute: ``value``, ``remainder`` or ``denominator``.
        """
        factors = {"per_share": [quantity], "per_notional": [price, quantity], "per_order": [F.lit(1)]}
        dated = [c for c in self.components if c.name == name]
        if not dated:
            raise ContractError(f"the schedule has no component {name!r}")
        fee: Column | None = None
        for part in sorted(dated, key=lambda c: c.effective_from_ns, reverse=True):
            in_force = F.col(at) >= part.effective_from_ns
            amount = money.apply_rate(factors[part.basis], part.rate_numerator, part.rate_denominator)[part_of]
            fee = F.when(in_force, amount) if fee is None else fee.when(in_force, amount)
        return fee


def with_fees(fills: DataFrame, schedule: FeeSchedule, *, price: str = "price_nano", quantity: str = "quantity_shares", at: str = "event_time") -> DataFrame:
    """One ``<name>_nano`` column per schedule component; NULL before its first effective date, as no rate is known."""
    return fills.withColumns({f"{name}_nano": schedule.cost(name, price=price, quantity=quantity, at=at) for name in schedule.names})
