"""The total order of events: five columns compared left to right."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronotape.contracts.vocab import AFTER_EVERYTHING, BEFORE_EVERYTHING, ORDER_KEY


def order_key(prefix: str = "", columns: tuple[str, ...] = ORDER_KEY) -> Column:
    """Struct of the ordering columns; Spark compares structs field by field."""
    return F.struct(*[F.col(prefix + name).alias(name) for name in columns])


def sentinel(values: tuple[int, ...]) -> Column:
    types = ("bigint", "int", "bigint", "bigint", "bigint")
    return F.struct(
        *[F.lit(v).cast(kind).alias(name) for v, kind, name in zip(values, types, ORDER_KEY, strict=True)]
    )


def before_everything() -> Column:
    return sentinel(BEFORE_EVERYTHING)


def after_everything() -> Column:
    return sentinel(AFTER_EVERYTHING)


def strictly_after(candidate: Column, reference: Column) -> Column:
    """True only when the candidate comes later; an equal key is not later."""
    return candidate > reference
