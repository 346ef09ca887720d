"""Exact money: nano-dollar integers, decimal accumulators, directed rounding with remainders."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronotape.contracts.vocab import NANO, STORABLE_LIMIT

WIDE = "decimal(38,0)"  # accumulator type: sums of price * size outgrow 64 bits


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _div(numerator: Column, denominator: Column | int) -> Column:
    by = F.lit(denominator) if isinstance(denominator, int) else denominator
    return F.call_function("div", numerator, by)


def is_storable_dollars(dollars: Column | str) -> Column:
    """Whether decimal dollars stay within the storable nano-dollar range."""
    edge = Decimal(STORABLE_LIMIT).scaleb(-9)
    return _col(dollars).between(F.lit(-edge), F.lit(edge))


def is_storable(nanos: Column | str) -> Column:
    return _col(nanos).between(-STORABLE_LIMIT, STORABLE_LIMIT)


def nano_from_dollars(dollars: Column | str, field: str = "price") -> Column:
    """Exact decimal dollars to a 64-bit nano-dollar count, or a task failure naming the field."""
    dollars = _col(dollars)
    exact = dollars.try_cast("decimal(19,9)")  # rounds, so a difference shows sub-nano digits
    nanos = (exact * F.lit(NANO).cast("decimal(10,0)")).cast("bigint")
    storable = is_storable_dollars(dollars)
    reason = F.when(storable, " has sub-nano-dollar precision").otherwise(" exceeds the storable range")
    failure = F.raise_error(F.concat(F.lit(f"{field}="), dollars.cast("string"), reason)).cast("bigint")
    return F.when(dollars.isNull() | (storable & (exact == dollars)), nanos).otherwise(failure)


def narrow(value: Column | str, field: str = "value") -> Column:
    """Accumulator to storable 64-bit money, refusing anything beyond 2^62 in magnitude."""
    value = _col(value)
    message = F.concat(F.lit(f"{field}="), value.cast("string"), F.lit(" exceeds the storable range"))
    return F.when(value.isNull() | is_storable(value), value.cast("bigint")).otherwise(
        F.raise_error(message).cast("bigint")
    )


def require_whole_shares(count: Column | str, field: str = "shares") -> Column:
    """A decimal or double share count as a 64-bit integer; fractions fail."""
    count = _col(count)
    whole = count.cast("bigint")
    return F.when(count.isNull() | (count == whole), whole).otherwise(
        F.raise_error(F.concat(F.lit(f"{field}="), count.cast("string"), F.lit(" is not a whole share count"))).cast(
            "bigint"
        )
    )


def notional(price_nano: Column | str, quantity: Column | str) -> Column:
    """price * quantity, exact and unbounded by 64 bits."""
    return (_col(price_nano).cast("decimal(19,0)") * _col(quantity).cast("decimal(19,0)")).cast(WIDE)


def _as_column(value: Column | str | int) -> Column:
    return F.lit(value) if isinstance(value, int) else _col(value)


def exact_product(*factors: Column | str | int) -> tuple[Column, Column]:
    """The product of integer factors twice over: 64-bit (NULL when it overflows) and decimal.

    Nearly every product fits 64 bits, where arithmetic is an order of magnitude cheaper; the
    decimal form is only evaluated for rows where it does not.
    """
    columns = [_as_column(f) for f in factors]
    narrow_product, wide_product = columns[0].cast("bigint"), columns[0].cast("decimal(19,0)")
    for factor in columns[1:]:
        narrow_product = F.try_multiply(narrow_product, factor.cast("bigint"))
        wide_product = (wide_product * factor.cast("decimal(19,0)")).cast(WIDE)
    return narrow_product, wide_product


def _round_exact(numerator: Column, denominator: Column, away_from_zero: bool) -> tuple[Column, Column]:
    """(rounded value, remainder numerator) of numerator / denominator; ``denominator`` positive."""
    value, rest = _div(numerator, denominator), numerator % denominator
    if not away_from_zero:
        return value, rest
    step = F.signum(rest).cast("bigint")  # the remainder is small: its sign survives the double
    return value + step, rest - step * denominator


def _rounded(product: tuple[Column, Column], denominator: Column | str | int, away_from_zero: bool) -> Column:
    """struct(value, remainder, denominator) with value + remainder / denominator exact, always."""
    narrow_product, wide_product = product
    by = _as_column(denominator).cast("bigint")
    fast = _round_exact(narrow_product, by, away_from_zero)
    slow = _round_exact(wide_product, by, away_from_zero)
    fits = narrow_product.isNotNull()
    value, remainder = (
        F.when(fits, f).otherwise(s.cast("bigint")) for f, s in zip(fast, slow, strict=True)
    )
    return F.struct(value.alias("value"), remainder.alias("remainder"), by.alias("denominator"))


def _from_numerator(numerator: Column | str) -> tuple[Column, Column]:
    numerator = _col(numerator)
    return numerator.try_cast("bigint"), numerator.cast(WIDE)


def round_credit(numerator: Column | str, denominator: Column | int) -> Column:
    """Money received: toward zero. Returns struct(value, remainder, denominator)."""
    return _rounded(_from_numerator(numerator), denominator, away_from_zero=False)


round_statistic = round_credit  # a descriptive figure has no paying side: toward zero as well


def round_cost(numerator: Column | str, denominator: Column | int) -> Column:
    """Money paid: away from zero, exact values untouched. ``denominator`` must be positive."""
    return _rounded(_from_numerator(numerator), denominator, away_from_zero=True)


def apply_rate(
    base: Column | str | Sequence[Column | str | int], rate_num: Column | int, rate_den: Column | int, *, credit: bool = False
) -> Column:
    """A rational rate on an exact base, rounded against us; struct(value, remainder, denominator).

    ``base`` is a 64-bit amount, or factors such as price and quantity whose product need not fit.
    """
    factors = [base] if isinstance(base, (str, Column)) else list(base)
    return _rounded(exact_product(*factors, rate_num), rate_den, away_from_zero=not credit)


def ledger_total(ledger: str) -> list[Column]:
    """Aggregates that recover the exact total of one denominator's ledger entries."""
    entry = F.col(ledger)
    rounded = F.sum(entry["value"].cast(WIDE))
    remainder = F.sum(entry["remainder"].cast(WIDE))
    return [rounded.alias("rounded_total"), remainder.alias("remainder_total")]


def borrow_accrual(
    price_nano: Column | str, quantity: Column | str, fee_bps_num: Column | int, fee_bps_den: Column | int = 1
) -> Column:
    """One day of borrow cost: notional * bps / 10,000 / 360, rounded as a cost."""
    year = F.lit(10_000 * 360).cast("bigint") * _as_column(fee_bps_den)
    return apply_rate([price_nano, quantity], fee_bps_num, year)


def rational_bps(fee_bps: Column | str, scale: int = 1_000_000) -> Column:
    """The one sanctioned double-to-rational step for fee rates: the nearest 1/scale basis point."""
    return F.round(_col(fee_bps) * scale).cast("bigint")


def mid_price(bid_nano: Column | str, ask_nano: Column | str) -> Column:
    """(bid + ask) / 2 toward zero with its half-nano remainder kept."""
    bid, ask = _col(bid_nano), _col(ask_nano)
    total = (F.try_add(bid, ask), (bid.cast("decimal(19,0)") + ask.cast("decimal(19,0)")).cast(WIDE))
    return _rounded(total, 2, away_from_zero=False)


def format_usd(nanos: Column | str) -> Column:
    """Nano-dollars as grouped dollars with nine decimals, for display only."""
    return F.format_number((_col(nanos).cast("decimal(19,0)") / F.lit(NANO)).cast("decimal(28,9)"), 9)
