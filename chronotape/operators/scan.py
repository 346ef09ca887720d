"""Ordered running values that never put a hot key into one task.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in a single task. That is the cheapest
plan while every key is small, which one pre-aggregated count decides. For keys with more rows than
``max_cell_rows`` the time line is cut into chunks instead:

1. each (key, chunk) cell is reduced to one summary row, with map-side partial aggregation, and the
   summaries are stored in the shared folder;
2. a small window over the summaries gives the value carried into every cell;
3. carried values enter the data as one extra leading row per cell, so the final window partitions
   by (key, chunk) and no row is joined or shuffled a second time.

Small keys stay whole in the same final window. The summaries also count rows: a cell that is
itself too large, because most of a hot key falls into one chunk, is cut further at quantiles of
the full order key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotape.functions.instants import floor_div
from chronotape.operators.sizing import broadcast_if_small
from chronotape.sources.files import work_folder

_CHUNK, _LIVE, _HOT = "__chunk", "__live", "__hot"
MAX_CELL_ROWS = 4_000_000
_SAMPLES_PER_PIECE = 40


@dataclass(frozen=True)
class Running:
    """One running value: the ``last`` non-null, the ``sum`` or the ``max`` of ``value`` so far."""

    name: str
    kind: str
    value: Column
    inclusive: bool = False


def _over_cells(kind: str, column: str, window: Window) -> Column:
    if kind == "last":
        return F.last(column, ignorenulls=True).over(window)
    return (F.sum if kind == "sum" else F.max)(column).over(window)


def _summary(item: Running, held: str, order: Column) -> Column:
    if item.kind == "last":
        return F.max_by(held, F.when(F.col(held).isNotNull(), order)).alias(held)
    return (F.sum if item.kind == "sum" else F.max)(held).alias(held)


def time_chunk(column: str, chunk_ns: int) -> Column:
    return floor_div(F.col(column), chunk_ns)


def written_copy(df: DataFrame, purpose: str) -> DataFrame:
    """Write a small result to the shared folder and go on from the copy."""
    path = work_folder(df.sparkSession, purpose).root
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_cells(df: DataFrame, hot: DataFrame, by: Sequence[str], order: Sequence[str], max_rows: int) -> DataFrame:
    """Refine the chunk column of the ``hot`` cells (at most rows / ``max_rows`` of them).

    Cut points are order keys at even ranks of a sample. They are stored, so every reader of the
    result uses the same ones. The pieces follow ``order``, ties included, wherever keys differ;
    no row is dropped or capped.
    """
    cell = [*by, _CHUNK]
    pieces = F.ceil(F.col("__rows") / max_rows).cast("int")
    keep = F.rand(11) < F.col("__pieces") * _SAMPLES_PER_PIECE / F.col("__rows")
    wanted = hot.select(*cell, "__rows", pieces.alias("__pieces"))
    sampled = _join_cells(df, wanted, cell, "inner").where(keep)
    ranked = sampled.groupBy(*cell, "__pieces").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("__s"))
    ranks = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("__pieces") - 1, F.lit(1))),
        lambda i: F.get("__s", F.floor(i * F.size("__s") / F.col("__pieces")).cast("int")),
    )
    cuts = written_copy(ranked.select(*cell, F.array_distinct(ranks).alias("__cuts")), "cell-cuts")

    key = F.struct(*order)
    piece = F.coalesce(F.size(F.filter("__cuts", lambda cut: cut <= key)), F.lit(0))
    refined = F.struct(F.col(_CHUNK).alias("chunk"), piece.alias("piece"))
    return _join_cells(df, cuts, cell, "left").withColumn(_CHUNK, refined).drop("__cuts")


def _join_cells(df: DataFrame, cells: DataFrame, cell: Sequence[str], how: str) -> DataFrame:
    """Join on cell columns, NULL keys included; the cell table is small by construction."""
    marked = broadcast_if_small(cells.withColumnsRenamed({c: f"__c{i}" for i, c in enumerate(cell)}))
    same = [F.col(c).eqNullSafe(F.col(f"__c{i}")) for i, c in enumerate(cell)]
    return df.join(marked, same, how).drop(*[f"__c{i}" for i in range(len(cell))])


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    items: Sequence[Running],
    max_cell_rows: int | None = MAX_CELL_ROWS,
) -> DataFrame:
    """Add running values over each ``by`` group in ``order``.

    ``chunk`` must not decrease along ``order``; keys with more than ``max_cell_rows`` rows are cut
    by it, and cells still larger are cut again. None cuts every key by its chunk alone, for chunks
    that bound a cell themselves; without ``by`` the table is always cut. With ``inclusive`` the row itself counts, otherwise only rows
    strictly before it do (NULL at first).
    """
    by, order = list(by), list(order)
    held = {item.name: f"__{item.name}" for item in items}
    prepared = df.withColumns({held[i.name]: i.value for i in items})

    def results(cell: Sequence[str], leading: Sequence[str]) -> list[Column]:
        window = Window.partitionBy(*cell).orderBy(*leading, *order)
        upto = {
            True: window.rowsBetween(Window.unboundedPreceding, Window.currentRow),
            False: window.rowsBetween(Window.unboundedPreceding, -1),
        }
        return [_over_cells(i.kind, held[i.name], upto[i.inclusive]).alias(i.name) for i in items]

    hot_keys: DataFrame | None = None
    if by and max_cell_rows is not None:
        hot_keys = prepared.groupBy(*by).agg(F.count("*").alias("__rows")).where(F.col("__rows") > max_cell_rows)
        if hot_keys.isEmpty():
            return prepared.select(*df.columns, *results(by, []))
        hot_keys = written_copy(hot_keys.select(*by), "hot-keys")
    if hot_keys is None:
        prepared = prepared.withColumn(_CHUNK, chunk)
    else:
        marked = _join_cells(prepared, hot_keys.withColumn(_HOT, F.lit(True)), by, "left")
        prepared = marked.withColumn(_CHUNK, F.when(F.col(_HOT), chunk))

    def summaries(rows: DataFrame) -> DataFrame:
        chunked = rows if hot_keys is None else rows.where(F.col(_HOT))
        parts = [_summary(i, held[i.name], F.struct(*order)) for i in items]
        return written_copy(chunked.groupBy(*by, _CHUNK).agg(*parts, F.count("*").alias("__rows")), "cells")

    cells = summaries(prepared)
    if max_cell_rows is not None:
        hot_cells = cells.where(F.col("__rows") > max_cell_rows)
        if not hot_cells.isEmpty():
            prepared = split_cells(prepared, hot_cells, by, order, max_cell_rows)
            cells = summaries(prepared)

    earlier = Window.partitionBy(*by).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = cells.select(
        *by, _CHUNK, *[_over_cells(i.kind, held[i.name], earlier).alias(held[i.name]) for i in items]
    ).where(" OR ".join(f"{h} IS NOT NULL" for h in held.values()))

    rows = prepared.withColumn(_LIVE, F.lit(True)).unionByName(
        carried.withColumn(_LIVE, F.lit(False)), allowMissingColumns=True
    )
    # Results are computed before carried rows are dropped: the filter cannot move below a window.
    found = results([*by, _CHUNK], [_LIVE])
    return rows.select(*df.columns, _LIVE, *found).where(F.col(_LIVE)).drop(_LIVE)


def positions(
    df: DataFrame, order: Sequence[str], chunk: Column, name: str, by: Sequence[str] = (),
    max_cell_rows: int | None = MAX_CELL_ROWS,
) -> DataFrame:
    """Dense 0-based position in ``order``, across the whole table or within ``by``."""
    one = Running(name, "sum", F.lit(1).cast("bigint"))
    numbered = running(df, by, order, chunk, [one], max_cell_rows)
    return numbered.withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
