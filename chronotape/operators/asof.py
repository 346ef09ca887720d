"""Point-in-time joins: the latest right row usable at a left row's decision instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from chronotape.contracts import vocab
from chronotape.operators.scan import MAX_CELL_ROWS, Running, running, time_chunk

_MATCH = "__match"


def _row_hash(df: DataFrame) -> Column:
    """A hash that tells rows of one instant apart; maps cannot be hashed and are left out."""
    return F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    left_on: Sequence[str],
    right_on: Sequence[str],
    payload: Sequence[str],
    right_tie: Sequence[str] = (),
    allow_exact: bool = True,
    prefix: str = "",
    chunk_ns: int = vocab.NS_PER_DAY,
    max_cell_rows: int = MAX_CELL_ROWS,
) -> DataFrame:
    """Left outer as-of join: every left row, with the last right row at or before it.

    ``left_on`` and ``right_on`` pair up and compare left to right; the first pair is the instant.
    ``allow_exact=False`` asks for a strictly earlier right row. ``right_tie`` makes right rows with
    equal keys a total order. Both sides share one union and one row shuffle; see
    :func:`chronotape.operators.scan.running` for hot keys. Left rows of one instant are told apart by a hash, so that even a hot instant can be split.
    """
    keys = [f"__on{i}" for i in range(len(left_on))]
    ties = [f"__tie{i}" for i in range(len(right_tie))]
    right_side, left_side = (0, 1) if allow_exact else (1, 0)

    def keyed(df: DataFrame, on: Sequence[str], side: int) -> dict[str, Column]:
        return {**{k: F.col(c) for k, c in zip(keys, on, strict=True)}, "__side": F.lit(side)}

    lefts = left.withColumns(
        {**keyed(left, left_on, left_side), "__is_left": F.lit(True), "__spread": _row_hash(left)}
    )
    tie_columns = [F.col(c).alias(t) for c, t in zip(right_tie, ties, strict=True)]
    rights = right.where(F.col(right_on[0]).isNotNull()).select(
        *by,
        *[c.alias(name) for name, c in keyed(right, right_on, right_side).items()],
        *tie_columns,
        F.struct(*[F.col(c) for c in payload]).alias(_MATCH),
        F.lit(False).alias("__is_left"),
    )
    both = lefts.unionByName(rights, allowMissingColumns=True)
    matched = running(
        both,
        by,
        [*keys, "__side", *ties, "__spread"],
        time_chunk(keys[0], chunk_ns),
        [Running("__found", "last", F.col(_MATCH), inclusive=True)],
        max_cell_rows,
    ).where("__is_left")
    return matched.select(
        *left.columns, *[F.col("__found")[c].alias(prefix + c) for c in payload]
    )


def usable_asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    decision: str,
    payload: Sequence[str],
    event_time: str = "event_time",
    knowledge_time: str = "knowledge_time",
    right_tie: Sequence[str] = (),
    look_ahead: str = "raise",
    allow_exact: bool = True,
    prefix: str = "",
    chunk_ns: int = vocab.NS_PER_DAY,
    max_cell_rows: int = MAX_CELL_ROWS,
) -> DataFrame:
    """As-of join guarded against look-ahead.

    The candidate is the latest right row by event time. If it was not yet known at the decision
    instant the row is a defect: ``raise`` fails the task that meets the row, ``flag`` adds a
    boolean ``look_ahead`` column. ``known`` is the explicit filtering option: it considers only
    rows already known and takes the latest of those by event time.
    """
    if look_ahead == "known":
        return _known_asof_join(
            left, right, by=by, decision=decision, payload=payload, event_time=event_time,
            knowledge_time=knowledge_time, right_tie=right_tie, allow_exact=allow_exact,
            prefix=prefix, chunk_ns=chunk_ns, max_cell_rows=max_cell_rows,
        )
    if look_ahead not in ("raise", "flag"):
        raise ValueError(f"look_ahead must be raise, flag or known, got {look_ahead!r}")

    guarded = right.withColumn("__known_at", F.col(knowledge_time))
    joined = asof_join(
        left, guarded, by=by, left_on=[decision], right_on=[event_time],
        payload=[*payload, "__known_at"], right_tie=right_tie, allow_exact=allow_exact,
        prefix=prefix, chunk_ns=chunk_ns, max_cell_rows=max_cell_rows,
    )
    leaked = F.coalesce(F.col(prefix + "__known_at") > F.col(decision), F.lit(False))
    if look_ahead == "flag":
        return joined.withColumn("look_ahead", leaked).drop(prefix + "__known_at")
    message = F.concat(
        F.lit("look-ahead: matched row known at "), F.col(prefix + "__known_at").cast("string"),
        F.lit(" after decision "), F.col(decision).cast("string"),
    )
    # a row filter, so that no choice of columns leaves the check out
    sound = F.when(leaked, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return joined.where(sound).drop(prefix + "__known_at")


def _known_asof_join(
    left: DataFrame, right: DataFrame, *, by: Sequence[str], decision: str, payload: Sequence[str],
    event_time: str, knowledge_time: str, right_tie: Sequence[str], allow_exact: bool, prefix: str,
    chunk_ns: int, max_cell_rows: int,
) -> DataFrame:
    """Running maximum by event order over a time line laid out by knowledge time.

    A right row becomes usable once it has both happened and become known; with
    ``allow_exact=False`` that must be strictly before the decision.
    """
    right_side, left_side = (0, 1) if allow_exact else (1, 0)
    candidate = F.struct(
        F.col(event_time).alias("__event"),
        *[F.col(c).alias(f"__tie{i}") for i, c in enumerate(right_tie)],
        *[F.col(c).alias(f"__value_{c}") for c in payload],
    )
    both = left.withColumns(
        {
            "__at": F.col(decision), "__side": F.lit(left_side), "__is_left": F.lit(True),
            "__spread": _row_hash(left),
        }
    ).unionByName(
        right.select(
            *by, F.greatest(F.col(knowledge_time), F.col(event_time)).alias("__at"),
            F.lit(right_side).alias("__side"), candidate.alias(_MATCH), F.lit(False).alias("__is_left"),
            F.xxhash64(event_time, *right_tie).alias("__spread"),
        ),
        allowMissingColumns=True,
    )
    matched = running(
        both, by, ["__at", "__side", "__spread"], time_chunk("__at", chunk_ns),
        [Running("__found", "max", F.col(_MATCH), inclusive=True)],
        max_cell_rows,
    ).where("__is_left")
    return matched.select(
        *left.columns, *[F.col("__found")[f"__value_{c}"].alias(prefix + c) for c in payload]
    )


def look_ahead_report(joined: DataFrame) -> DataFrame:
    """Counts for the ``flag`` form: how many matches leaked."""
    return joined.agg(
        F.count("*").alias("decisions"), F.count_if(F.col("look_ahead")).alias("look_ahead_rows")
    )


# Statuses under which no order may execute.
STOPPED_STATUSES = ("halted", "paused")


def with_halt_decision(
    orders: DataFrame, statuses: DataFrame, *, at: str = "event_time", price: str = "price_nano",
    chunk_ns: int = vocab.NS_PER_DAY,
) -> DataFrame:
    """Reason code per order from the trading status and price band in force at its instant."""
    tie = [c for c in vocab.ORDER_KEY[1:] if c in statuses.columns]
    joined = asof_join(
        orders, statuses, by=["instrument_id"], left_on=[at], right_on=["event_time"],
        payload=["status", "luld_lower_nano", "luld_upper_nano"], right_tie=tie, prefix="in_force_",
        chunk_ns=chunk_ns,
    )
    outside = (F.col(price) < F.col("in_force_luld_lower_nano")) | (F.col(price) > F.col("in_force_luld_upper_nano"))
    return joined.withColumn(
        "risk_reason",
        F.when(F.col("in_force_status").isin(*STOPPED_STATUSES), "symbol_halted")
        .when(outside, "outside_luld_band")
        .otherwise("approved"),
    )


def with_borrow_decision(
    shorts: DataFrame, borrow: DataFrame, *, decision: str = "decision_time", quantity: str = "quantity_shares",
    chunk_ns: int = vocab.NS_PER_DAY,
) -> DataFrame:
    """Accept a short only where borrow was known, reported shortable and large enough at decision."""
    joined = usable_asof_join(
        shorts, borrow, by=["instrument_id"], decision=decision, event_time="effective_time",
        payload=["is_shortable", "available_shares"], look_ahead="known", prefix="borrow_",
        chunk_ns=chunk_ns,
    )
    enough = F.coalesce(F.col("borrow_available_shares") >= F.col(quantity), F.lit(True))
    accepted = F.coalesce(F.col("borrow_is_shortable"), F.lit(False)) & enough
    return joined.withColumn("risk_reason", F.when(accepted, "approved").otherwise("short_not_supported"))


def quote_before_order(
    orders: DataFrame, quotes: DataFrame, *, payload: Sequence[str], order_columns: Sequence[str] = vocab.ORDER_KEY,
    chunk_ns: int = vocab.NS_PER_DAY,
) -> DataFrame:
    """The last quote strictly before an order in the total order; an equal key never qualifies."""
    return asof_join(
        orders, quotes, by=["instrument_id"], left_on=list(order_columns), right_on=list(order_columns),
        payload=list(payload), allow_exact=False, prefix="quote_", chunk_ns=chunk_ns,
    )
