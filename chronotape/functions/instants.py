"""Integer nanosecond instants: text conversion, session-anchored windows, plausibility."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronotape.contracts import vocab

# Fixed value: accepted instant text, offset mandatory, one to nine fraction digits, a real month.
INSTANT_PATTERN = (
    r"^(?!0000)[0-9]{4}-(0[1-9]|1[0-2])-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}"
    r"(\.[0-9]{1,9})?([Zz]|[+-][0-9]{2}:[0-9]{2})\z"
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def floor_div(value: Column, divisor: int | Column) -> Column:
    """Integer division rounding down. Spark's ``div`` truncates, which is wrong below zero."""
    by = F.lit(divisor) if isinstance(divisor, int) else divisor
    return F.call_function("div", value - F.pmod(value, by), by)


def _div(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor))


def ns_from_rfc3339(text: Column | str) -> Column:
    """Lossless RFC-3339 text to nanoseconds; NULL when malformed or without an offset.

    One regular expression decides validity; all digits then sit at fixed positions. A malformed
    text is NULL from there on, and NULL carries through. The day counts from the first of its
    month, so second 60 and day 31 of a short month roll over.
    """
    text = _col(text)
    text = F.when(text.rlike(INSTANT_PATTERN), text)
    length = F.length(text)

    def digits(part: Column) -> Column:
        return F.translate(part, ":", "").try_cast("bigint")

    first_of_month = F.concat(F.substring(text, 1, 8), F.lit("01")).try_cast("date")
    days = F.unix_date(first_of_month) + digits(F.substring(text, 9, 2)) - 1
    hms = digits(F.substring(text, 12, 8))  # as the number hhmmss
    seconds = days * 86_400 + hms - _div(hms, 100) * 40 - _div(hms, 10_000) * 2_400

    zulu = F.upper(F.substr(text, length, F.lit(1))) == "Z"
    width = length - F.when(zulu, F.lit(21)).otherwise(F.lit(26))
    nanos = digits(F.rpad(F.substr(text, F.lit(21), F.greatest(width, F.lit(0))), 9, "0"))
    zone = digits(F.substr(text, length - 4, F.lit(5)))  # as the number hhmm, where there is one
    minutes = zone - _div(zone, 100) * 40
    ahead = F.when(F.substr(text, length - 5, F.lit(1)) == "-", -minutes).otherwise(minutes)
    offset = F.when(zulu, F.lit(0).cast("bigint")).otherwise(ahead * 60)
    return (seconds - offset) * vocab.NS_PER_SECOND + nanos


def rfc3339_from_ns(ns: Column | str) -> Column:
    """Nanoseconds as UTC text with nine fraction digits. Uses dates only, so no session zone leaks."""
    ns = _col(ns)
    day = floor_div(ns, vocab.NS_PER_DAY)
    in_day = F.pmod(ns, F.lit(vocab.NS_PER_DAY))

    def part(unit: int, size: int, width: int = 2) -> Column:
        amount = F.pmod(_div(in_day, unit), F.lit(size))
        return F.lpad(amount.cast("string"), width, "0")

    date = F.date_add(F.to_date(F.lit("1970-01-01")), day.cast("int")).cast("string")
    return F.concat(
        date, F.lit("T"),
        part(vocab.NS_PER_HOUR, 24), F.lit(":"),
        part(vocab.NS_PER_MINUTE, 60), F.lit(":"),
        part(vocab.NS_PER_SECOND, 60), F.lit("."),
        part(1, vocab.NS_PER_SECOND, 9), F.lit("Z"),
    )


def ns_from_timestamp_ntz(ts: Column | str) -> Column:
    """Zone-free timestamp column to nanoseconds.

    Built from its parts, because differences of zone-free timestamps pass through the session
    zone, where a clock change swallows an hour.
    """
    ts = _col(ts)
    second = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")  # decimal, microseconds kept
    minutes = (F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    return (minutes * 60_000_000 + second) * 1_000


def timestamp_from_ns(ns: Column | str) -> Column:
    """Microsecond timestamp for display and watermarks; never join or order on it."""
    return F.timestamp_micros(_div(_col(ns), 1_000))


def window_start(event_time: Column | str, window_ns: int, origin_ns: int | Column) -> Column:
    """Start of the half-open window holding an instant, anchored at ``origin_ns``, floor semantics."""
    event_time = _col(event_time)
    origin = F.lit(origin_ns) if isinstance(origin_ns, int) else origin_ns
    return event_time - F.pmod(event_time - origin, F.lit(window_ns))


def is_plausible(ns: Column | str) -> Column:
    return _col(ns).between(vocab.PLAUSIBLE_MIN_NS, vocab.PLAUSIBLE_MAX_NS)


def require_plausible(ns: Column | str, field: str) -> Column:
    """The instant itself, or a task failure naming ``field``."""
    ns = _col(ns)
    message = F.concat(F.lit(f"{field}="), ns.cast("string"), F.lit(" is outside the plausible band"))
    return F.when(is_plausible(ns), ns).otherwise(F.raise_error(message).cast("bigint"))


def in_session(at: Column | str, open_ns: Column | str, close_ns: Column | str) -> Column:
    """Half-open session containment."""
    at = _col(at)
    return (at >= _col(open_ns)) & (at < _col(close_ns))


def covers(at: Column | str, start: Column | str, end: Column | str) -> Column:
    """Half-open interval cover; a NULL end never closes."""
    at, end = _col(at), _col(end)
    return (at >= _col(start)) & (end.isNull() | (at < end))
