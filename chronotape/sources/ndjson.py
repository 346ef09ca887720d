"""Newline-delimited JSON prints and quotes: exact decimals, byte-order positions, quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.contracts.model import ContractError
from chronotape.functions import money
from chronotape.functions.instants import ns_from_rfc3339
from chronotape.operators.scan import written_copy
from chronotape.operators.sizing import broadcast_if_small
from chronotape.sources.files import Folder
from chronotape.sources.ranges import byte_ranges, listed, numbered_lines

RAW_SUFFIX = ".ndjson"
#: Bytes of a raw range, and how many of them a core gets at least where the feed is large enough.
LEAST_RANGE, MOST_RANGE, RANGES_PER_CORE = 1 << 20, 32 << 20, 3
EXACT_DOLLARS = "decimal(38,18)"  # one digit past nano is kept, so sub-nano input is seen, not rounded


@dataclass(frozen=True)
class WireField:
    """One vendor key: target column, kind, and the default of an optional key."""

    key: str
    column: str
    kind: str = "text"  # text | instant | price | whole | codes
    default: str | int | None = None
    required: bool = True


# Vendor wire keys of a print and of a quote, with defaults of the optional ones.
TRADE_WIRE = (
    WireField("S", "symbol"),
    WireField("t", "event_time", "instant"),
    WireField("p", "price", "price"),
    WireField("s", "size_shares", "whole"),
    WireField("x", "exchange"),
    WireField("c", "conditions", "codes", required=False),
    WireField("i", "trade_id"),
    WireField("z", "tape", default="", required=False),
    WireField("q", "vendor_sequence", "whole", vocab.MISSING_SEQUENCE, required=False),
)
QUOTE_WIRE = (
    WireField("S", "symbol"),
    WireField("t", "event_time", "instant"),
    WireField("bp", "bid_price", "price"),
    WireField("bs", "bid_size_shares", "whole"),
    WireField("bx", "bid_exchange", default="", required=False),
    WireField("ap", "ask_price", "price"),
    WireField("as", "ask_size_shares", "whole"),
    WireField("ax", "ask_exchange", default="", required=False),
    WireField("c", "conditions", "codes", required=False),
    WireField("z", "tape", default="", required=False),
    WireField("q", "vendor_sequence", "whole", vocab.MISSING_SEQUENCE, required=False),
)


def partition_files(spark: SparkSession, directory: str, suffix: str = RAW_SUFFIX) -> list[str]:
    """Raw file names of a partition in lexicographic order; an empty partition is an error."""
    names = Folder(spark, directory).names(suffix)
    if not names:
        raise ContractError(f"no {suffix} partition files in {directory}")
    return names


def _ranges(spark: SparkSession, directory: str, suffix: str) -> DataFrame:
    """The raw files as byte ranges, planned once, now: a few for every core, none beyond the session's split size.

    A line costs far more to parse than to read, so even one short file is dealt to all cores.
    """
    partition_files(spark, directory, suffix)
    split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    files = listed(spark, [directory], f"*{suffix}")
    total = files.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]  # one number, from the listing alone
    share = total // (RANGES_PER_CORE * spark.sparkContext.defaultParallelism)
    return byte_ranges(files, min(int(split), max(LEAST_RANGE, min(share, MOST_RANGE))))


def read_lines(spark: SparkSession, directory: str, suffix: str = RAW_SUFFIX) -> DataFrame:
    """Non-blank raw lines with file, byte range and number within the range."""
    return numbered_lines(_ranges(spark, directory, suffix))


def _number_token(key: str) -> Column:
    """The literal text of a numeric member of the record itself; empty when it is quoted, nested or absent.

    ``from_json`` passes numbers through binary doubles when asked for text, and rounds when asked
    for decimals, so exactness is judged on the literal. A key that stands once in a line with one
    brace can only be the record's own. In any other line the last member counts that is left once other
    texts and nested values are blanked; only one nested deeper than :data:`_NESTED` is read token by token.
    """
    member = rf'"{key}"\s*:'
    plain = (F.regexp_count("value", F.lit(member)) <= 1) & (F.length(F.replace("value", F.lit("{"))) >= F.length("value") - 1)
    first = F.regexp_extract("value", member + r"\s*(-?[0-9][0-9.eE+-]*)", 1)
    own = F.regexp_replace(F.regexp_replace("value", rf'({member})|{_TEXT}', "$1"), _NESTED, "!")
    last = F.regexp_extract(F.regexp_extract(own, rf'(?s).*{member}\s*+([^\s{{}}\[\]:,"]*)', 1), "^-?[0-9][0-9.eE+-]*$", 0)
    return F.when(plain, first).when(~own.rlike(r"[{\[](?s:.*)[{\[]"), last).otherwise(F.expr(_walk(key)))


def _containers(depth: int) -> str:
    """Pattern of a JSON object or array without texts that holds others up to ``depth`` levels."""
    rest = r"[^{}\[\]]*+"
    held = rf"(?:{_containers(depth - 1)}{rest})*+" if depth else ""
    return rf"[{{\[]{rest}{held}[}}\]]"


#: A JSON text, and values of the record that hold others: any object or array but the one the line begins with.
_TEXT, _NESTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', rf"(?<=[:,\[])\s*+{_containers(3)}"


#: Strings, punctuation, and everything else of a JSON text.
_JSON_TOKENS = r'"(?:[^"\\\\]|\\\\.)*"|[{}\\[\\]:,]|[^\\s{}\\[\\]:,"]+'


def _walk(key: str) -> str:
    """SQL: the number given to ``key`` at depth one of the line's JSON object, or the empty text."""
    return f"""aggregate(
        regexp_extract_all(value, '{_JSON_TOKENS}', 0),
        named_struct('depth', 0, 'last', '', 'wanted', false, 'found', ''),
        (s, t) -> CASE
            WHEN t IN ('{{', '[') THEN named_struct('depth', s.depth + 1, 'last', '', 'wanted', false, 'found', if(s.wanted, '', s.found))
            WHEN t IN ('}}', ']') THEN named_struct('depth', s.depth - 1, 'last', '', 'wanted', false, 'found', s.found)
            WHEN t = ':' THEN named_struct('depth', s.depth, 'last', s.last, 'wanted', s.depth = 1 AND s.last = '"{key}"', 'found', s.found)
            WHEN t = ',' THEN named_struct('depth', s.depth, 'last', '', 'wanted', false, 'found', s.found)
            ELSE named_struct('depth', s.depth, 'last', t, 'wanted', false, 'found', if(s.wanted, t, s.found)) END,
        s -> if(s.found RLIKE '^-?[0-9][0-9.eE+-]*$', s.found, ''))"""


def _fraction_digits(token: Column) -> Column:
    """Significant digits after the decimal point, exponent applied."""
    mantissa = F.regexp_extract(token, r"\.([0-9]*?)0*(?:[eE]|$)", 1)
    exponent = F.regexp_extract(token, r"[eE]([+-]?[0-9]+)$", 1).try_cast("int")
    return F.length(mantissa) - F.coalesce(exponent, F.lit(0))


def parse(lines: DataFrame, wire: tuple[WireField, ...]) -> DataFrame:
    """Typed wire columns plus ``defect``: NULL for a good record, otherwise why it is refused.

    A record that cannot be mapped is never defaulted; only keys declared optional have defaults.
    """
    types = ["array<string>" if w.kind == "codes" else "string" for w in wire]
    schema = ", ".join(f"`{w.key}` {t}" for w, t in zip(wire, types, strict=True))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    # Wire keys differ only by case (S, s), so fields are renamed by position before use.
    renamed = ", ".join(f"{w.column}: {t}" for w, t in zip(wire, types, strict=True))
    record = F.from_json("value", f"{schema}, _bad string", options).cast(f"struct<{renamed}, _bad: string>")
    parsed = lines.withColumn("__r", record)

    # Literals, then values, then defects, each in its own step: a step that is used more than once
    # is computed once instead of being copied into every expression that reads it.
    # Defaults come last, so that a defect only asks whether a value is there: the JVM does not compile
    # the loop of a step whose expressions outgrow 8 kB.
    literals = {f"__{w.column}": _number_token(w.key) for w in wire if w.kind == "price"}
    values = {w.column: _value(w) for w in wire}
    defaults = {w.column: F.coalesce(w.column, F.array().cast("array<string>") if w.kind == "codes" else F.lit(w.default)) for w in wire if w.kind == "codes" or w.default is not None}
    defects = [F.when(F.col("__r").isNull() | F.col("__r._bad").isNotNull(), F.lit("not a JSON object"))]
    for w in wire:
        defects += _defects(w)
    typed = parsed.withColumns(literals).withColumns(values)
    return typed.withColumns({"defect": F.coalesce(*defects), **defaults}).drop("__r", *literals)


def _value(w: WireField) -> Column:
    raw = F.col(f"__r.{w.column}")
    if w.kind == "instant":
        return ns_from_rfc3339(raw)
    if w.kind == "price":
        return F.col(f"__{w.column}").try_cast(EXACT_DOLLARS)
    return F.when(raw.rlike(r"^-?[0-9]+$"), raw.try_cast("bigint")) if w.kind == "whole" else raw


def _defects(w: WireField) -> list[Column]:
    raw, value = F.col(f"__r.{w.column}"), F.col(w.column)

    def when(condition: Column, reason: str) -> Column:
        return F.when(condition, F.lit(f"{w.key} {reason}"))

    found = [when(raw.isNull(), "is missing")] if w.required else []
    if w.kind == "instant":
        found.append(when(value.isNull(), "is not an instant with an offset"))
    elif w.kind == "price":
        found.append(when(value.isNull(), "is not a decimal number"))
        literal = F.col(f"__{w.column}")
        # a plain literal has its digits where they are; only an exponent moves them
        fine = F.when(literal.rlike("[eE]"), _fraction_digits(literal) > 9).otherwise(literal.rlike(r"\.[0-9]{9}[0-9]*[1-9]"))
        found.append(when(fine, "has sub-nano-dollar precision"))
        found.append(when(~money.is_storable_dollars(value), "exceeds the storable range"))
    elif w.kind == "whole":
        found.append(when(raw.isNotNull() & value.isNull(), "is not a whole number"))
    return found


def with_ingest_index(records: DataFrame, counts: DataFrame) -> DataFrame:
    """``ingest_index``: 0-based position over the concatenation of files in name order.

    A row knows its byte range and its number among that range's lines. Where a range starts comes from
    a running sum over ``counts`` (raw_file, raw_block, lines), one narrow row per range. That table is
    stored once and joined; records are neither sorted nor shuffled. Ranges are a grid of byte offsets, so
    neither the packing of files into tasks nor the order of lines in the plan matters; a range that is
    not counted fails rather than guesses.
    """
    name = F.element_at(F.split("raw_file", "/"), -1)
    before = Window.orderBy(name, "raw_file", "raw_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("raw_file", "raw_block", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("__base"))
    placed = records.join(broadcast_if_small(written_copy(bases, "range-bases")), ["raw_file", "raw_block"], "left")
    astray = F.raise_error(F.concat(F.lit("no base for a range of "), F.col("raw_file"))).cast("bigint")
    index = F.coalesce(F.col("__base") + F.col("raw_line"), astray)
    return placed.withColumn("ingest_index", index.cast("bigint")).drop("__base", "raw_line")


def _require_defect_free(df: DataFrame) -> DataFrame:
    """Fail the task that meets a refused record, naming its file and text.

    The check is a row filter: no choice of columns, not even a bare count, can leave it out.
    """
    message = F.concat(
        F.col("raw_file"), F.lit(" split "), F.col("raw_block").cast("string"), F.lit(": "), F.col("defect"),
        F.lit(": "), F.substring("value", 1, 120),
    )
    return df.where(F.when(F.col("defect").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def read_raw(
    spark: SparkSession, directory: str, wire: tuple[WireField, ...], *, on_defect: str = "raise", suffix: str = RAW_SUFFIX
) -> DataFrame:
    """Parsed records of a raw partition with ``ingest_index``.

    ``on_defect``: ``raise`` fails on the first refused record, ``keep`` returns every record with
    its ``defect`` so the caller can route refused ones to :func:`quarantine`. Refused records keep
    their position, so the index does not depend on the choice.
    """
    if on_defect not in ("raise", "keep"):
        raise ValueError(f"on_defect must be raise or keep, got {on_defect!r}")
    parsed = parse(read_lines(spark, directory, suffix), wire)
    if on_defect == "raise":
        parsed = parsed.withColumn("value", F.when(F.col("defect").isNotNull(), F.col("value")))
    # Lines are parsed once, into a stored copy. A filter or projection above it would otherwise be pushed
    # down with the whole parser inside, and every range sort above it would parse once more for its sample.
    parsed = written_copy(parsed, "parsed")
    records = with_ingest_index(parsed, parsed.groupBy("raw_file", "raw_block").agg(F.count("*").alias("lines")))
    if on_defect == "raise":
        return _require_defect_free(records).drop("value", "defect", "raw_file", "raw_block")
    return records


def read_trades(
    spark: SparkSession, directory: str, *, on_defect: str = "raise", suffix: str = RAW_SUFFIX
) -> DataFrame:
    return read_raw(spark, directory, TRADE_WIRE, on_defect=on_defect, suffix=suffix)


def read_quotes(
    spark: SparkSession, directory: str, *, on_defect: str = "raise", suffix: str = RAW_SUFFIX
) -> DataFrame:
    return read_raw(spark, directory, QUOTE_WIRE, on_defect=on_defect, suffix=suffix)


def accepted(records: DataFrame) -> DataFrame:
    return records.where("defect IS NULL").drop("value", "defect", "raw_file", "raw_block")


def quarantine(records: DataFrame) -> DataFrame:
    """Refused records with file, position and reason."""
    return records.where("defect IS NOT NULL").select("raw_file", "ingest_index", "defect", "value")
