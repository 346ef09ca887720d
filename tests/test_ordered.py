"""Chunked scans and as-of joins against brute force, hot keys included."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.operators import asof, audits, scan


def hot_rows(seed, rows=600, instants=200):
    """Key 1 holds most rows, and a third of all rows share one instant."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        key = 1 if rng.random() < 0.7 else rng.choice([2, 3, None])
        at = 50 if rng.random() < 0.33 else rng.randrange(-instants, instants)
        out.append((key, at, i, rng.choice([None, rng.randrange(100)])))
    return out


SCHEMA = "k int, t bigint, i bigint, v bigint"


def items():
    return [
        scan.Running("last_before", "last", F.col("v")),
        scan.Running("sum_upto", "sum", F.col("v"), inclusive=True),
        scan.Running("max_before", "max", F.col("v")),
    ]


def expected(rows):
    out = {}
    for key in {r[0] for r in rows}:
        last, total, top, seen = None, None, None, False
        for _, t, i, v in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            before = (last, top)
            if v is not None:
                last, total, top = v, (total or 0) + v, v if top is None else max(top, v)
            out[i] = (before[0], total, before[1])
    return out


@pytest.mark.parametrize("width, max_cell", [(1_000, 10_000), (25, 300), (1_000, 40), (25, 40)])
def test_running_values(spark, width, max_cell):
    rows = hot_rows(4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = scan.running(df, ["k"], ["t", "i"], scan.time_chunk("t", width), items(), max_cell_rows=max_cell)
    assert got.columns == ["k", "t", "i", "v", "last_before", "sum_upto", "max_before"]
    assert {r.i: (r.last_before, r.sum_upto, r.max_before) for r in got.collect()} == expected(rows)


def test_hot_cells_really_split(spark):
    rows = [(1, 50, i, 1) for i in range(1_000)] + [(2, 50, i, 1) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("__chunk", F.lit(0))
    hot_cells = df.groupBy("k", "__chunk").agg(F.count("*").alias("__rows")).where("__rows > 100")
    sizes = scan.split_cells(df, hot_cells, ["k"], ["t", "i"], 100).groupBy("k", "__chunk").count().collect()
    hot = [r["count"] for r in sizes if r.k == 1]
    assert sum(hot) == 1_000 and len(hot) == 10 and max(hot) < 250
    assert [r["count"] for r in sizes if r.k == 2] == [10]


@pytest.mark.parametrize("max_cell", [None, 50, 10_000])
def test_positions_are_dense_and_global(spark, max_cell):
    rows = hot_rows(5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = scan.positions(df, ["t", "i"], scan.time_chunk("t", 30), "p", max_cell_rows=max_cell)
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    assert {r.i: r.p for r in got.collect()} == {r[2]: n for n, r in enumerate(order)}


def ticks(seed, n, lag=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = 40 if rng.random() < 0.3 else rng.randrange(0, 120)
        rows.append((1 if rng.random() < 0.7 else 2, t, i, t + (rng.randrange(0, lag) if lag else 0)))
    return rows


LEFT, RIGHT = "k int, at bigint, id bigint, unused bigint", "k int, t bigint, rid bigint, known bigint"


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("chunk, max_cell", [(7, 200), (7, 30), (1_000, 10_000)])
def test_asof_matches_brute_force(spark, exact, chunk, max_cell):
    lefts, rights = ticks(6, 200), ticks(7, 150)
    got = asof.asof_join(
        spark.createDataFrame(lefts, LEFT), spark.createDataFrame(rights, RIGHT), by=["k"], left_on=["at"],
        right_on=["t"], payload=["rid", "t"], right_tie=["rid"], allow_exact=exact, prefix="r_", chunk_ns=chunk,
        max_cell_rows=max_cell,
    )
    want = {}
    for k, at, i, _ in lefts:
        usable = [(t, rid) for rk, t, rid, _ in rights if rk == k and (t <= at if exact else t < at)]
        want[i] = max(usable)[1] if usable else None
    assert {r.id: r.r_rid for r in got.collect()} == want


def test_asof_keeps_copies_of_left_rows(spark):
    left = spark.createDataFrame([(1, 10, 1, 0)] * 5, LEFT)
    right = spark.createDataFrame([(1, 10, 3, 10)], RIGHT)
    got = asof.asof_join(left, right, by=["k"], left_on=["at"], right_on=["t"], payload=["rid"])
    assert [r.rid for r in got.collect()] == [3] * 5


@pytest.mark.parametrize("chunk, max_cell", [(7, 200), (7, 30), (1_000, 10_000)])
def test_known_rows_only(spark, chunk, max_cell):
    lefts, rights = ticks(8, 200), ticks(9, 150, lag=30)
    got = asof.usable_asof_join(
        spark.createDataFrame(lefts, LEFT), spark.createDataFrame(rights, RIGHT), by=["k"], decision="at",
        payload=["rid"], event_time="t", knowledge_time="known", right_tie=["rid"], look_ahead="known", chunk_ns=chunk,
        max_cell_rows=max_cell,
    )
    want = {}
    for k, at, i, _ in lefts:
        usable = [(t, rid) for rk, t, rid, known in rights if rk == k and known <= at]
        want[i] = max(usable)[1] if usable else None
    assert {r.id: r.rid for r in got.collect()} == want


def test_look_ahead_raises_or_flags(spark):
    left = spark.createDataFrame([(1, 10, 1, 0), (1, 30, 2, 0)], LEFT)
    right = spark.createDataFrame([(1, 5, 7, 20)], RIGHT)
    options = {"by": ["k"], "decision": "at", "payload": ["rid"], "event_time": "t", "knowledge_time": "known"}
    with pytest.raises(PySparkException, match="look-ahead: matched row known at 20 after decision 10"):
        asof.usable_asof_join(left, right, **options).collect()
    flagged = asof.usable_asof_join(left, right, look_ahead="flag", **options)
    assert {r.id: r.look_ahead for r in flagged.collect()} == {1: True, 2: False}
    assert asof.look_ahead_report(flagged).first().look_ahead_rows == 1
    clean = asof.usable_asof_join(left.where("id = 2"), right, **options)
    assert [r.rid for r in clean.collect()] == [7]


KEY = "event_time bigint, source_rank int, vendor_sequence bigint, venue_sequence bigint, ingest_index bigint"


def test_a_quote_at_the_same_key_never_qualifies(spark):
    orders = spark.createDataFrame([(1, 100, 5, 1, -1, 0)], "instrument_id bigint, " + KEY)
    quotes = spark.createDataFrame(
        [(1, 100, 5, 1, -1, 0, 11), (1, 100, 4, 9, -1, 0, 12), (1, 99, 4, 9, -1, 0, 13)], f"instrument_id bigint, {KEY}, price bigint"
    )
    assert asof.quote_before_order(orders, quotes, payload=["price"]).first().quote_price == 12


def test_halts_and_bands(spark):
    statuses = spark.createDataFrame(
        [(1, 10, "halted", None, None), (1, 20, "resumed", 90, 110), (2, 10, "paused", None, None)],
        "instrument_id bigint, event_time bigint, status string, luld_lower_nano bigint, luld_upper_nano bigint",
    )
    orders = spark.createDataFrame(
        [(1, 1, 5, 100), (2, 1, 10, 100), (3, 1, 20, 100), (4, 1, 25, 111), (5, 1, 25, 110), (6, 2, 11, 1)],
        "id int, instrument_id bigint, event_time bigint, price_nano bigint",
    )
    got = {r.id: r.risk_reason for r in asof.with_halt_decision(orders, statuses).collect()}
    assert got == {
        1: "approved", 2: "symbol_halted", 3: "approved", 4: "outside_luld_band", 5: "approved", 6: "symbol_halted"
    }


def test_shorts_without_known_borrow_are_refused(spark):
    borrow = spark.createDataFrame(
        [(1, 10, 15, True, 100), (2, 10, 10, False, None), (3, 10, 10, True, None)],
        "instrument_id bigint, effective_time bigint, knowledge_time bigint, is_shortable boolean, available_shares bigint",
    )
    shorts = spark.createDataFrame(
        [(1, 1, 12, 50), (2, 1, 15, 50), (3, 1, 20, 101), (4, 2, 20, 1), (5, 3, 20, 10**6), (6, 9, 20, 1)],
        "id int, instrument_id bigint, decision_time bigint, quantity_shares bigint",
    )
    got = {r.id: r.risk_reason for r in asof.with_borrow_decision(shorts, borrow).collect()}
    assert {i for i, reason in got.items() if reason == "approved"} == {2, 5}


@pytest.mark.parametrize("block", [3, 1_000])
def test_unsorted_rows_across_blocks(spark, block):
    rng = random.Random(10)
    keys = [rng.randrange(5) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(keys)), "pos bigint, key bigint").repartition(4)
    got = audits.unsorted_rows(df, [], "pos", ["key"], block)
    assert sorted(r.pos for r in got.collect()) == [i for i in range(1, 50) if keys[i] <= keys[i - 1]]


@pytest.mark.parametrize("block", [4, 1_000])
def test_unsorted_rows_with_gaps_in_the_positions(spark, block):
    df = spark.createDataFrame([(1, 10), (2, 20), (5, 5), (6, 30), (47, 29), (80, 31)], "pos bigint, key bigint")
    assert sorted(r.pos for r in audits.unsorted_rows(df, [], "pos", ["key"], block).collect()) == [5, 47]


NULLED = "f string, pos bigint, a bigint, b string"


def out_of_order(rows):
    """(f, pos) of rows whose (a, b) does not exceed the row before, absent values first."""
    found, last = [], {}
    for f, pos, a, b in sorted(rows, key=lambda r: (r[0], r[1])):
        key = ((a is not None, a or 0), (b is not None, b or ""))
        if f in last and last[f] >= key:
            found.append((f, pos))
        last[f] = key
    return found


@pytest.mark.parametrize("batch", [3, 10_000])
def test_ordered_rows_are_compared_where_they_are_read(spark, tmp_path, batch):
    rng = random.Random(11)
    rows = [(f, p, rng.choice([None, p // 3, p // 3]), rng.choice([None, "x", "y", "\u00e9"])) for f in ("one", "two") for p in range(60)]
    df = spark.createDataFrame(rows, NULLED)
    df.repartitionByRange(5, "f", "pos").sortWithinPartitions("f", "pos").write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = audits.unsorted_rows(spark.read.parquet(str(tmp_path / "t")), ["f"], "pos", ["a", "b"])
        assert sorted((r.f, r.pos) for r in found.collect()) == out_of_order(rows)
        # the table is not read again: only broken rows and ends of runs are shuffled
        assert found.inputFiles() and all("order-runs" in f for f in found.inputFiles())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("most", [0, 2_000_000])
def test_rows_that_arrive_out_of_order_or_in_many_runs(spark, monkeypatch, most):
    monkeypatch.setattr(audits, "MAX_RUNS", most)
    rng = random.Random(12)
    rows = [("f", p, rng.randrange(8), None) for p in range(80)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    found = audits.unsorted_rows(spark.createDataFrame(shuffled, NULLED).repartition(3), ["f"], "pos", ["a", "b"], 7)
    assert sorted((r.f, r.pos) for r in found.collect()) == out_of_order(rows)
    assert audits.unsorted_rows(spark.createDataFrame([], NULLED), ["f"], "pos", ["a", "b"]).count() == 0


def test_operating_state_moves(spark):
    pairs = [(a, b) for a in vocab.OPERATING_STATES for b in vocab.OPERATING_STATES]
    got = {tuple(r[:2]): r[2] for r in spark.createDataFrame(pairs, "a string, b string").select("a", "b", audits.allowed_move(F.col("a"), F.col("b"))).collect()}
    for (a, b), ok in got.items():
        want = a == b or b == "safe" or (b in vocab.STATE_MOVES[a] and b not in vocab.CAPITAL_STATES)
        assert ok == want, (a, b)
    assert not got["off", "paper"] and not got["paper", "canary"] and got["live", "live"] and got["safe", "research"]
