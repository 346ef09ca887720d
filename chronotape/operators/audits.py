"""Audits: each rule becomes a counted violation, and gates refuse when any count is not zero."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotape.contracts import vocab
from chronotape.contracts.model import Contract, ContractError
from chronotape.functions.instants import is_plausible, timestamp_from_ns
from chronotape.functions.money import is_storable
from chronotape.operators.scan import Running, running, written_copy
from chronotape.operators.sizing import broadcast_if_small


def check_shape(df: DataFrame, shape: Contract) -> None:
    """Refuse a table that is not column for column the contract's; nullability, which Parquet drops, aside."""
    wanted = {f.name: f.data_type.simpleString() for f in shape.fields}
    held = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if list(wanted) != df.columns:
        lacking, extra = [n for n in wanted if n not in held], [n for n in held if n not in wanted]
        what = f"lacks {lacking}, adds {extra}" if lacking or extra else f"has the order {df.columns}"
        raise ContractError(f"{shape.name}: the table's columns are not the contract's: it {what}")
    other = [f"{n} is {held[n]} where {t} is due" for n, t in wanted.items() if held[n] != t]
    if other:
        raise ContractError(f"{shape.name}: {', '.join(other)}; tables are never converted silently")


def row_rules(shape: Contract, policy: str = vocab.BACKFILL) -> dict[str, Column]:
    """Rule name to the condition that marks a bad row."""
    rules: dict[str, Column] = {f"null {c}": F.col(c).isNull() for c in shape.required_columns}
    event, receive, process, known = (
        F.col(c) for c in ("event_time", "receive_time", "process_time", "knowledge_time")
    )
    rules["knowledge_time outside the plausible band"] = ~is_plausible(known)
    rules["knowledge_time precedes event_time"] = known < event
    rules["receive_time precedes event_time"] = receive < event
    rules["process_time precedes receive_time"] = process < receive
    if policy == vocab.LIVE_CAPTURE:
        rules["live_capture knowledge_time differs from receive_time"] = known != receive
    for column in shape.money_columns:
        rules[f"{column} outside the storable range"] = ~is_storable(column)
    return rules


def count_violations(df: DataFrame, rules: Mapping[str, Column], label: Column) -> DataFrame:
    """All rules in one pass and one row, then one output row per rule: ``rule, violations, example``."""
    names = list(rules)
    counts = df.agg(
        *[F.count_if(rules[n]).alias(f"n{i}") for i, n in enumerate(names)],
        *[F.min(F.when(rules[n], label)).alias(f"x{i}") for i, n in enumerate(names)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(n).alias("rule"), F.col(f"n{i}").alias("violations"),
                F.coalesce(f"x{i}", F.lit("")).alias("example"),
            )
            for i, n in enumerate(names)
        ]
    )
    return counts.select(F.inline(entries))


def duplicate_keys(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once, with their counts; copies combine before the shuffle."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_count(df: DataFrame, keys: Sequence[str], rule: str, where: Column | None = None) -> DataFrame:
    """Surplus rows over a unique key, in the shape of a violation row."""
    label = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    return duplicate_keys(df, keys, where).agg(
        F.lit(rule).alias("rule"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("violations"),
        F.coalesce(F.min(label), F.lit("")).alias("example"),
    )


def keyed_violations(df: DataFrame, rules: Mapping[str, Column], label: Column, unique: Sequence[Sequence[str]]) -> DataFrame:
    """Row rules and partial unique keys in one scan: ``rule, violations, example``.

    Every row becomes an entry for each rule it breaks, under its label, and for each key it has:
    ``unique`` lists keys whose last column must be present for the key to count. One grouped count of
    (rule, key), combined before the shuffle, then tells broken rules from surplus copies.
    """
    width = max(len(keys) for keys in unique)
    entries = [F.when(broken, _entry(rule, [label], width)) for rule, broken in rules.items()]
    repeats = {f"repeated {', '.join(keys)}": list(keys) for keys in unique}
    for rule, keys in repeats.items():
        entries.append(F.when(F.col(keys[-1]).isNotNull(), _entry(rule, [F.col(k).cast("string") for k in keys], width)))
    found = df.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").groupBy("e.rule", "e.key").count()
    surplus = F.col("rule").isin(*repeats)
    bad = found.where(~surplus | (F.col("count") > 1)).select(
        "rule", (F.col("count") - surplus.cast("int")).alias("violations"), F.concat_ws("/", *[f"key.k{i}" for i in range(width)]).alias("example")
    )
    # a rule that nothing breaks is reported too
    named = df.sparkSession.createDataFrame([(rule, 0, None) for rule in (*rules, *repeats)], "rule string, violations bigint, example string")
    return bad.unionByName(named).groupBy("rule").agg(F.sum("violations").alias("violations"), F.coalesce(F.min("example"), F.lit("")).alias("example"))


def _entry(rule: str, key: Sequence[Column], width: int) -> Column:
    parts = [*key, *[F.lit(None).cast("string")] * (width - len(key))]
    return F.struct(F.lit(rule).alias("rule"), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(parts)]).alias("key"))


def contract_violations(
    df: DataFrame, shape: Contract, policy: str = vocab.BACKFILL, *, unique_keys: bool = True
) -> DataFrame:
    """Content audit of a contract table: null, clock, policy, money and key-uniqueness rules."""
    if policy not in vocab.KNOWLEDGE_POLICIES:
        raise ContractError(f"unknown knowledge policy {policy!r}")
    label = F.concat(F.lit("event_time="), F.coalesce(F.col("event_time").cast("string"), F.lit("null")))
    report = count_violations(df, row_rules(shape, policy), label)
    if shape.is_ordered and unique_keys:
        report = report.unionByName(
            duplicate_count(df, vocab.ORDER_KEY, "ordering keys are not strictly increasing: repeated key")
        )
    return report


def require_clean(report: DataFrame, subject: str) -> None:
    """Fail with every broken rule. A report has one row per rule, so collecting it is bounded."""
    broken = report.where("violations > 0").collect()
    if broken:
        details = "; ".join(f"{r['rule']} ({r['violations']} rows, first {r['example']})" for r in broken)
        raise ContractError(f"{subject}: {details}")


def _unsorted_by_blocks(
    df: DataFrame,
    within: Sequence[str],
    position: str,
    key: Sequence[str],
    block: int,
) -> DataFrame:
    """The rows of :func:`unsorted_rows`, by a shuffle of all rows.

    Rows are compared inside blocks of ``block`` positions, so no task sorts a whole file. Into each
    block comes the last row present in the nearest block before it that has any, as a predecessor only.
    """
    rows = df.select(
        *within, F.col(position).alias("__pos"), F.struct(*key).alias("__key"),
        F.call_function("div", F.col(position), F.lit(block)).alias("__cell"),
    )
    # one row per block from here to the join
    ends = rows.groupBy(*within, "__cell").agg(F.max("__pos").alias("__last"))
    following = F.lead("__cell").over(Window.partitionBy(*within).orderBy("__cell"))
    carried = ends.withColumn("__next", following).where("__next IS NOT NULL").drop("__cell")
    marks = [F.col(c).eqNullSafe(F.col(f"__w{i}")) for i, c in enumerate(within)] + [F.col("__pos") == F.col("__last")]
    named = carried.withColumnsRenamed({c: f"__w{i}" for i, c in enumerate(within)})
    entering = rows.join(broadcast_if_small(named), marks).select(*within, "__pos", "__key", F.col("__next").alias("__cell"), F.lit(False).alias("__own"))
    order = Window.partitionBy(*within, "__cell").orderBy("__pos")
    compared = rows.withColumn("__own", F.lit(True)).unionByName(entering).withColumn("__previous", F.lag("__key").over(order))
    return compared.where(F.col("__own") & (F.col("__previous") >= F.col("__key"))).select(
        *within, F.col("__pos").alias(position), "__key.*"
    )


#: Row is out of order; a run of rows with rising positions starts, or ends, at the row.
_BROKEN, _START, _END = 0, 1, 2
#: Beyond this many runs the rows were not read in order of their positions.
MAX_RUNS = 2_000_000


def _walked(rows: DataFrame, within: Sequence[str], position: str, key: Sequence[str]) -> DataFrame:
    """Each task compares its rows with their predecessors as they arrive, without a shuffle.

    Returns the rows out of order, and the first and last row of each run of rising positions, with
    ``__kind``. Rows read from ordered files make one run per file range.
    """
    schema = rows.withColumn("__kind", F.lit(_BROKEN)).schema

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if before is None:
                yield from _marked(table.slice(0, 1), _START)
            else:
                table = pa.concat_tables([before, table])
            one, two = table.slice(0, table.num_rows - 1), table.slice(1)
            follows = np.ones(one.num_rows, dtype=bool)
            for name in within:
                for x, y in zip(_comparable(one[name]), _comparable(two[name]), strict=True):
                    follows &= x == y
            (_, x), (_, y) = _comparable(one[position]), _comparable(two[position])
            follows &= x < y
            broken = follows & _not_below(one, two, key)
            yield from _marked(two.filter(pa.array(broken)), _BROKEN)
            yield from _marked(one.filter(pa.array(~follows)), _END)
            yield from _marked(two.filter(pa.array(~follows)), _START)
            before = table.slice(table.num_rows - 1)
        if before is not None:
            yield from _marked(before, _END)

    return rows.mapInArrow(walk, schema)


def _marked(table: pa.Table, kind: int) -> Iterator[pa.RecordBatch]:
    yield from table.append_column("__kind", pa.array([kind] * table.num_rows, pa.int32())).combine_chunks().to_batches()


def _comparable(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Whether values are present, and the values, absent ones replaced by any."""
    kind = column.type
    if pa.types.is_temporal(kind):
        column = column.cast(pa.int32() if pa.types.is_date32(kind) else pa.int64())
    present = column.is_valid().to_numpy()
    if column.null_count:
        if column.null_count == len(column):
            return present, np.zeros(len(column), dtype=np.int64)
        column = column.fill_null(column.drop_null()[0])
    return present, column.to_numpy()


def _not_below(one: pa.Table, two: pa.Table, key: Sequence[str]) -> np.ndarray:
    """Row by row whether the key of ``one`` is at or above that of ``two``; an absent value is below all others."""
    out = np.ones(one.num_rows, dtype=bool)
    for name in reversed(key):
        both = pa.chunked_array([*one[name].chunks, *two[name].chunks], one[name].type)  # absent values filled alike
        present, values = _comparable(both)
        n = one.num_rows
        equal = values[:n] == values[n:]
        equal |= ~present[:n] & ~present[n:]
        equal &= present[:n] == present[n:]
        above = present[:n] & (~present[n:] | (values[:n] > values[n:]))
        out = above | (equal & out)
    return out


def unsorted_rows(
    df: DataFrame,
    within: Sequence[str],
    position: str,
    key: Sequence[str] = vocab.ORDER_KEY,
    block: int = 1_000_000,
) -> DataFrame:
    """Rows whose key does not exceed that of the physically preceding row; positions may have gaps.

    Rows read in order of their positions are compared where they are read, and only the ends of the
    runs, two rows for each file range, are brought together. Where runs overlap or are very many, the
    rows did not arrive in order and are compared in blocks of ``block`` positions, by a shuffle; so are
    floating-point keys. Positions must be present and unique within ``within``.
    """
    rows = df.select(*within, position, *key)
    if any(isinstance(rows.schema[k].dataType, (T.FloatType, T.DoubleType)) for k in (*within, *key)):
        return _unsorted_by_blocks(df, within, position, key, block)
    marks = written_copy(_walked(rows, within, position, key), "order-runs")
    order = Window.partitionBy(*within).orderBy(position, "__kind")
    ends = marks.where(F.col("__kind") != _BROKEN)
    if ends.count() > 2 * MAX_RUNS:
        return _unsorted_by_blocks(df, within, position, key, block)
    paired = ends.withColumn("__before", F.lag(F.struct("__kind", F.struct(*key).alias("key"))).over(order)).where(F.col("__kind") == _START)
    if not paired.where(F.col("__before.__kind") == _START).isEmpty():
        return _unsorted_by_blocks(df, within, position, key, block)
    first = paired.where(F.col("__before.key") >= F.struct(*key))
    return marks.where(F.col("__kind") == _BROKEN).unionByName(first.drop("__before")).select(*within, position, *key)


def file_order_violations(df: DataFrame, key: Sequence[str] = vocab.ORDER_KEY) -> DataFrame:
    """Physical-order audit of a Parquet table: rows within a file, then files against each other.

    Returns ``file, position`` of rows that do not exceed their predecessor and of files that
    begin at or below the end of the file before them. An empty result proves the keys unique.
    """
    located = df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("position"), *key
    )
    within = unsorted_rows(located, ["file"], "position", key).select("file", "position")
    folder = F.regexp_replace("file", r"/[^/]*$", "")
    ends = located.groupBy("file").agg(F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high"))
    before = Window.partitionBy("folder").orderBy("low")
    between = ends.withColumn("folder", folder).withColumn("previous", F.lag("high").over(before)).where("previous >= low")
    return within.unionByName(between.select("file", F.lit(0).cast("bigint").alias("position")))


def allowed_move(previous: Column, current: Column) -> Column:
    """Whether the operating-state machine permits ``previous -> current``."""
    pairs = [f"{a}>{b}" for a, targets in vocab.STATE_MOVES.items() for b in targets]
    listed = F.concat(previous, F.lit(">"), current).isin(*pairs)
    enters_capital = current.isin(*vocab.CAPITAL_STATES)
    return (previous == current) | (current == "safe") | (listed & ~enters_capital)


def is_capital_at_risk(state: str = "state") -> Column:
    return F.col(state).isin(*vocab.CAPITAL_STATES)


def illegal_moves(
    log: DataFrame, by: Sequence[str], order: Sequence[str], chunk: Column, state: str = "state"
) -> DataFrame:
    """Log rows whose state could not follow the entity's previous state."""
    moves = running(log, by, order, chunk, [Running("previous_state", "last", F.col(state))])
    return moves.where(F.col("previous_state").isNotNull() & ~allowed_move(F.col("previous_state"), F.col(state)))


def events_after_terminal(
    log: DataFrame, by: Sequence[str], order: Sequence[str], chunk: Column, state: str = "state",
    terminal: Sequence[str] = vocab.TERMINAL_ORDER_STATES,
) -> DataFrame:
    """Events of an order that had already reached a terminal state."""
    ended = F.col(state).isin(*terminal).cast("int")
    flagged = running(log, by, order, chunk, [Running("__ended", "max", ended)])
    return flagged.where("__ended = 1").drop("__ended")


def order_event_violations(events: DataFrame) -> DataFrame:
    """Constraints of the order-event log. Partial unique keys look at non-null values only."""
    label = F.coalesce(F.col("event_id").cast("string"), F.lit("null"))
    rules = {
        "fill without execution_id": (F.col("event_type") == "fill") & F.col("execution_id").isNull(),
        "knowledge_time precedes event_time": F.col("knowledge_time_ns") < F.col("event_time_ns"),
    }
    unique = [["account_id", column] for column in ("broker_event_id", "execution_id", "broker_sequence")]
    return keyed_violations(events, rules, label, unique)


def deduplicate_order_events(events: DataFrame, order: Sequence[str] = ("knowledge_time_ns", "event_id")) -> DataFrame:
    """First arrival of each broker event; a replay adds no row. Copies combine before the shuffle."""
    keys = ["account_id", "broker_event_id"]
    rest = [c for c in events.columns if c not in keys]
    first = events.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("first"))
    return first.select(*keys, "first.*").select(*events.columns)


def readable_order_events(events: DataFrame) -> DataFrame:
    """Microsecond timestamps next to the authoritative nanosecond columns; display only."""
    return events.withColumns(
        {name: timestamp_from_ns(f"{name}_ns") for name in ("event_time", "receive_time", "knowledge_time")}
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_key).alias("__parent")).distinct()
    return child.where(F.col(child_key).isNotNull()).join(
        parents, F.col(child_key) == F.col("__parent"), "left_anti"
    )


def experiment_violations(experiments: DataFrame) -> DataFrame:
    label = F.col("experiment_id").cast("string")
    rules = {"unknown status": ~F.coalesce(F.col("status").isin(*vocab.EXPERIMENT_STATUSES), F.lit(False))}
    return count_violations(experiments, rules, label).unionByName(
        duplicate_count(experiments, ["family_id", "trial_index"], "repeated family_id, trial_index")
    )


def trial_counts(experiments: DataFrame) -> DataFrame:
    """Trials per family, and whether indices run without gaps or repeats."""
    return experiments.groupBy("family_id", "trial_index").agg(F.count("*").alias("copies")).groupBy("family_id").agg(
        F.sum("copies").alias("trials"),
        F.min("trial_index").alias("first_index"),
        F.max("trial_index").alias("last_index"),
        ((F.max("trial_index") - F.min("trial_index") + 1 == F.sum("copies")) & (F.max("copies") == 1)).alias("is_dense"),
    )


def holdout_accesses(accesses: DataFrame) -> DataFrame:
    return accesses.groupBy("family_id").agg(F.count("*").alias("accesses"))


def feature_violations(values: DataFrame, specs: DataFrame) -> DataFrame:
    """Feature legality: known by the decision, inside the valid range, null only where allowed.

    ``specs`` has one row per (feature_id, feature_version): ``missing_policy``, ``valid_low``, ``valid_high``.
    """
    joined = values.join(broadcast_if_small(specs), ["feature_id", "feature_version"], "left")
    rules = {
        "feature without a spec": F.col("missing_policy").isNull(),
        "knowledge_time after decision_time": F.col("knowledge_time") > F.col("decision_time"),
        "value outside its valid range": (F.col("value") < F.col("valid_low")) | (F.col("value") > F.col("valid_high")),
        "null value where the policy forbids it": F.col("value").isNull() & (F.col("missing_policy") != "null"),
    }
    return count_violations(joined, rules, F.concat_ws("/", "feature_id", F.col("instrument_id").cast("string")))


def coverage_report(quotes: DataFrame) -> DataFrame:
    """Quote rows by venue coverage, with how many a quote-based study must refuse."""
    return quotes.groupBy("venue_coverage").agg(
        F.count("*").alias("quotes"), F.count_if(F.col("venue_coverage") == "iex_only").alias("refused")
    )


def consolidated_quotes(quotes: DataFrame) -> DataFrame:
    """Quotes a quote-based study may use: single-venue books are not the national best."""
    return quotes.where(F.col("venue_coverage") != "iex_only")


def require_consolidated(quotes: DataFrame) -> None:
    refused = quotes.agg(F.count_if(F.col("venue_coverage") == "iex_only").alias("n")).first()["n"]
    if refused:
        raise ContractError(f"{refused} quotes carry iex_only coverage, which is not a national best quote")


def promotion_report(events: DataFrame) -> DataFrame:
    """A snapshot with any row of unknown event-time source may not be promoted."""
    unknown = F.count_if(F.col("event_time_source") == "vendor_unknown")
    return events.agg(F.count("*").alias("rows"), unknown.alias("unknown_source_rows"), (unknown == 0).alias("promotable"))


def duplicate_paths(files: DataFrame) -> DataFrame:
    return duplicate_keys(files, ["path"])
