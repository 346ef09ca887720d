"""Identity, bars, history, accounts and audits on small frames with known answers."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.contracts.model import ContractError
from chronotape.operators import accounts, audits, bars, history, identity, normalize, scan
from chronotape.operators.history import FeeComponent, FeeSchedule

HISTORY = "instrument_id bigint, ticker string, effective_time bigint, end_time bigint"


def resolve(spark, rows, events):
    named = spark.createDataFrame(events, "symbol string, event_time bigint")
    return identity.resolve_tickers(named, spark.createDataFrame(rows, HISTORY))


def test_ticker_eras_are_half_open(spark):
    rows = [(1, "AB", 10, 20), (2, "AB", 20, None), (3, "CD", 5, None)]
    got = {(r.symbol, r.event_time): r.instrument_id for r in resolve(
        spark, rows, [("AB", 9), ("AB", 10), ("AB", 19), ("AB", 20), ("AB", 10**18), ("CD", 5), ("ZZ", 5)]).collect()}
    assert got == {("AB", 9): None, ("AB", 10): 1, ("AB", 19): 1, ("AB", 20): 2, ("AB", 10**18): 2, ("CD", 5): 3, ("ZZ", 5): None}


def test_resolution_matches_brute_force_without_extra_rows(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(120):
        start = rng.randrange(0, 90)
        rows.append((rng.randrange(4), rng.choice("AB"), start, rng.choice([None, start + rng.randrange(-3, 25)])))
    events = [(s, t) for s in "AB" for t in range(-2, 100)]
    want = {}
    for s, t in events:
        held = {i for i, ticker, a, b in rows if ticker == s and a <= t and (b is None or t < b)}
        want[s, t] = (len(held), min(held) if len(held) == 1 else None)
    got = resolve(spark, rows, events).collect()
    assert len(got) == len(events)
    assert {(r.symbol, r.event_time): (r.holders, r.instrument_id) for r in got} == want


def test_unknown_and_ambiguous_symbols_fail(spark):
    rows = [(1, "AB", 10, 30), (2, "AB", 20, None), (1, "AB", 12, 15)]
    strict = identity.require_instrument()
    with pytest.raises(PySparkException, match="no instrument held AB at 9"):
        resolve(spark, rows, [("AB", 9)]).select(strict).collect()
    with pytest.raises(PySparkException, match="AB at 25 resolves to 2 instruments"):
        resolve(spark, rows, [("AB", 25)]).select(strict).collect()
    overlaps = identity.overlapping_assignments(spark.createDataFrame(rows, HISTORY)).collect()
    assert [tuple(r) for r in overlaps] == [("AB", 20, 30, 2)]


PRINTS = "instrument_id bigint, event_time bigint, source_rank int, vendor_sequence bigint, venue_sequence bigint, " \
         "ingest_index bigint, price_nano bigint, size_shares bigint, conditions array<string>"


def prints(spark, rows):
    return spark.createDataFrame([(i, t, 5, s, -1, n, p, q, c) for n, (i, t, s, p, q, c) in enumerate(rows)], PRINTS)


def test_bar_semantics(spark):
    df = prints(spark, [
        (1, 100, 2, 11, 10, ["@"]), (1, 100, 1, 10, 10, ["@"]),  # a tie: the lower sequence opens
        (1, 109, 3, 14, 20, []), (1, 105, 4, 99, 1, ["@", "T"]),  # form-T stays out
        (1, 110, 5, 7, 3, None), (2, 95, 6, 5, 1, ["@"]),
    ])
    built = bars.build_bars(df, window_ns=10, origin_ns=100, as_of=110, knowledge_lag_ns=2, receive_time=111, process_time=500)
    got = {(r.instrument_id, r.event_time): r for r in built.collect()}
    assert set(got) == {(1, 100), (1, 110), (2, 90)}  # prints before the open get earlier windows
    first = got[1, 100]
    assert (first.open_nano, first.high_nano, first.low_nano, first.close_nano) == (10, 14, 10, 14)
    assert (first.volume_shares, first.vwap_nano, first.trade_count) == (40, (110 + 100 + 280) // 40, 3)
    assert (first.is_complete, got[1, 110].is_complete) == (True, False)
    assert (first.knowledge_time, first.receive_time, first.process_time) == (112, 112, 500)
    assert got[2, 90].receive_time == 111
    placed = bars.with_bar_positions(built).collect()
    assert {(r.event_time, r.instrument_id): r.ingest_index for r in placed} == {(90, 2): 0, (100, 1): 1, (110, 1): 2}


def test_vwap_beyond_64_bits_and_without_volume(spark):
    big = prints(spark, [(1, 0, 1, 2**62, 2**40, ["@"]), (1, 1, 2, 2**62 - 3, 2**40, ["@"])])
    options = {"window_ns": 10, "as_of": 100}
    assert bars.build_bars(big, **options).first().vwap_nano == 2**62 - 2
    empty = prints(spark, [(1, 0, 1, 5, 0, ["@"])])
    with pytest.raises(PySparkException, match="zero volume"):
        bars.build_bars(empty, **options).collect()
    assert bars.build_bars(empty, zero_volume="null", **options).first().vwap_nano is None
    with pytest.raises(ValueError):
        bars.vwap("ignore")


def test_revisions_as_of(spark):
    schema = "trade_id string, knowledge_time bigint, revision_time bigint, ingest_index bigint, price bigint, is_cancelled boolean"
    df = spark.createDataFrame([
        ("a", 10, None, 0, 100, False), ("a", 20, 20, 5, 101, False), ("a", 30, 30, 9, 101, True), ("b", 11, None, 1, 200, False),
        ("a", 20, 20, 6, 102, False),
    ], schema)
    def at(t):
        return {r.trade_id: (r.price, r.is_cancelled) for r in history.as_known(df, ["trade_id"], t).collect()}
    assert at(9) == {} and at(10) == {"a": (100, False)}
    assert at(25) == {"a": (102, False), "b": (200, False)} and at(30)["a"] == (101, True)


def test_split_adjustment_uses_only_announced_splits(spark):
    actions = spark.createDataFrame(
        [(1, "split", 5, 100, 2, 1), (1, "split", 6, 200, 3, 2), (1, "split", 999, 150, 7, 1), (1, "dividend", 1, 100, None, None),
         (1, "split", 5, 100, 2, 1)],
        "instrument_id bigint, action_type string, announcement_time bigint, effective_time bigint, split_numerator int, split_denominator int",
    )
    df = spark.createDataFrame([(1, t, 100, 600) for t in (99, 100, 199, 200)] + [(2, 150, 100, 600)], "instrument_id bigint, event_time bigint, price_nano bigint, size_shares bigint")
    got = {(r.instrument_id, r.event_time): (r.adjusted_price_nano, r.adjusted_size_shares)
           for r in history.split_adjusted(df, actions, decision_time=500).collect()}
    assert got == {(1, 99): (100, 600), (1, 100): (200, 300), (1, 199): (200, 300), (1, 200): (300, 200), (2, 150): (100, 600)}


def test_fee_schedule(spark):
    schedule = FeeSchedule((
        FeeComponent("share", 1, 3, "per_share", 10), FeeComponent("share", 2, 1, "per_share", 20),
        FeeComponent("value", 1, 1_000, "per_notional", 0), FeeComponent("ticket", 7, 2, "per_order", 0),
    ))
    df = spark.createDataFrame([(t, 1_001, 10) for t in (9, 10, 20)], "event_time bigint, price_nano bigint, quantity_shares bigint")
    got = {r.event_time: (r.share_nano, r.value_nano, r.ticket_nano) for r in history.with_fees(df, schedule).collect()}
    assert got == {9: (None, 11, 4), 10: (4, 11, 4), 20: (20, 11, 4)}
    with pytest.raises(ContractError):
        schedule.cost("absent", price="price_nano", quantity="quantity_shares")


FILLS = "instrument_id bigint, side string, quantity_shares bigint, price_nano bigint, t bigint, commission_nano bigint, " \
        "regulatory_fees_nano bigint, arrival_price_nano bigint"


def fills(spark):
    return spark.createDataFrame([
        (1, "buy", 10, 100, 1, 1, 2, 90), (1, "buy", 20, 130, 2, 1, 2, 131), (1, "sell", 5, 150, 3, 1, 2, 155),
        (2, "sell", 4, 50, 1, 0, 0, 50), (3, "buy", 1, 7, 1, 0, 0, 7), (3, "sell", 1, 9, 2, 0, 0, 9),
    ], FILLS)


def test_positions_and_profit_reconcile(spark):
    held = accounts.with_profit(accounts.positions_from_fills(fills(spark), ["t"]).withColumn("mark_price_nano", F.lit(160).cast("bigint")))
    got = {r.instrument_id: r for r in held.collect()}
    assert {i: (r.quantity_shares, int(r.cash_nano), r.average_cost_nano) for i, r in got.items()} == {
        1: (25, -2850, 120), 2: (-4, 200, 50), 3: (0, 2, 0)
    }
    for r in got.values():
        assert r.realized_pnl_nano + r.unrealized_pnl_nano == r.cash_nano + 160 * r.quantity_shares
    assert (got[1].unrealized_pnl_nano, got[1].realized_pnl_nano) == (40 * 25, 150)
    total = accounts.exposure(held).first()
    assert (total.gross_exposure_nano, total.net_exposure_nano) == (160 * 29, 160 * 21)


def test_average_cost_follows_openings_and_closings(spark):
    moves = [("buy", 100, 10), ("sell", 100, 12), ("buy", 100, 20)]
    rows = [(1, side, q, p, t, 0, 0, 0) for t, (side, q, p) in enumerate(moves)]
    held = accounts.with_profit(accounts.positions_from_fills(spark.createDataFrame(rows, FILLS), ["t"]).withColumn("mark_price_nano", F.lit(20).cast("bigint"))).first()
    assert (held.average_cost_nano, int(held.realized_pnl_nano), int(held.unrealized_pnl_nano)) == (20, 200, 0)


@pytest.mark.parametrize("per_round", [3, 100_000])
def test_average_cost_equals_a_plain_walk(spark, per_round):
    rng = random.Random(4)
    rows = [(i, rng.choice(("buy", "sell")), rng.randrange(1, 40), rng.randrange(1, 10**14), t, 0, 0, 0) for i in range(6) for t in range(1 + 9 * i)]
    want = {}
    for i, side, q, p, *_ in rows:
        held, cost = want.get(i, (0, 0))
        move = q if side == "buy" else -q
        if held * move >= 0:
            cost = (cost * abs(held) + p * q) // (abs(held) + q)
        elif q > abs(held):
            cost = p
        elif q == abs(held):
            cost = 0
        want[i] = (held + move, cost)
    got = accounts.positions_from_fills(spark.createDataFrame(rows, FILLS).repartition(5), ["t"], per_round=per_round).collect()
    assert {r.instrument_id: (r.quantity_shares, r.average_cost_nano) for r in got} == want


def test_running_position_equals_signed_sum(spark):
    run = accounts.running_position(fills(spark), ["t"], scan.time_chunk("t", 2))
    got = {(r.instrument_id, r.t): (r.position_shares, int(r.cash_nano)) for r in run.collect()}
    assert got[1, 3] == (25, -2850) and got[1, 1] == (10, -1000) and got[3, 2] == (0, 2)


def test_marks_are_causal(spark):
    prices = spark.createDataFrame([(1, 5, 6, 100), (1, 8, 12, 200)], "instrument_id bigint, event_time bigint, knowledge_time bigint, price_nano bigint")
    held = accounts.positions_from_fills(fills(spark), ["t"]).where("instrument_id = 1")
    assert accounts.mark_positions(held, prices, 10).first().mark_price_nano == 100
    assert accounts.mark_positions(held, prices, 12).first().mark_price_nano == 200


def test_cost_breakdown_keeps_components_apart(spark):
    r = accounts.cost_breakdown(fills(spark), ["instrument_id"]).where("instrument_id = 1").first()
    assert (int(r.commission_nano), int(r.regulatory_fees_nano), int(r.shortfall_nano)) == (3, 6, 10 * 10 - 20 + 5 * 5)


def test_limits_pick_the_first_breach(spark):
    rows = [(1, 10_000, 5_000, 2_000), (2, 10_000, 5_001, 9_999), (3, 10_000, 5_000, -2_001)]
    df = spark.createDataFrame(rows, "id int, equity_nano bigint, gross_exposure_nano bigint, net_exposure_nano bigint")
    got = {r.id: r.risk_reason for r in accounts.exposure_limit_decision(df).collect()}
    assert got == {1: "approved", 2: "gross_exposure_limit", 3: "net_exposure_limit"}
    assert set(got.values()) <= set(vocab.RISK_REASONS)


@pytest.mark.parametrize("by", [["g"], []])
def test_nearest_rank_percentiles(spark, by):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(200)) for _ in range(500)]
    got = accounts.percentile_lags(spark.createDataFrame(rows, "g string, x bigint"), by, F.col("x"), [50, 95], chunk_ns=17)
    for r in got.collect():
        values = sorted(x for g, x in rows if not by or g == r.g)
        assert [r.p50, r.p95] == [values[-(-len(values) * p // 100) - 1] for p in (50, 95)]


EVENTS = "event_id string, account_id string, client_order_id string, broker_event_id string, execution_id string, " \
         "broker_sequence bigint, event_type string, event_time_ns bigint, receive_time_ns bigint, knowledge_time_ns bigint"


def event(i, **o):
    base = {"event_id": f"e{i}", "account_id": "p", "client_order_id": "c", "broker_event_id": f"b{i}", "execution_id": None,
            "broker_sequence": None, "event_type": "ack", "event_time_ns": 1000, "receive_time_ns": 1500, "knowledge_time_ns": 1500}
    return tuple({**base, **o}.values())


@pytest.mark.parametrize("rows, broken", [
    ([event(1, event_type="fill", execution_id="x1"), event(2, event_type="fill", execution_id="x2")], set()),
    ([event(1), event(2, broker_event_id="b1")], {"repeated account_id, broker_event_id"}),
    ([event(1, event_type="fill", execution_id="x"), event(2, event_type="fill", execution_id="x")], {"repeated account_id, execution_id"}),
    ([event(1, event_type="fill")], {"fill without execution_id"}),
    ([event(1, client_order_id=None, event_type="cancel")], set()),
    ([event(1, knowledge_time_ns=999)], {"knowledge_time precedes event_time"}),
    ([event(1, broker_sequence=4), event(2, broker_sequence=4), event(3)], {"repeated account_id, broker_sequence"}),
])
def test_order_event_constraints(spark, rows, broken):
    report = audits.order_event_violations(spark.createDataFrame(rows, EVENTS))
    assert {r.rule for r in report.where("violations > 0").collect()} == broken


def test_readable_view_loses_nanoseconds_and_the_table_does_not(spark):
    df = audits.readable_order_events(spark.createDataFrame([event(1, event_time_ns=1001), event(2, event_time_ns=1002)], EVENTS))
    assert df.select("event_time").distinct().count() == 1 and df.select("event_time_ns").distinct().count() == 2


def test_a_replay_adds_no_row(spark):
    df = spark.createDataFrame([event(1), event(2, broker_event_id="b1", knowledge_time_ns=1400), event(3)], EVENTS)
    assert {r.event_id for r in audits.deduplicate_order_events(df).collect()} == {"e2", "e3"}


def test_nothing_follows_a_terminal_state(spark):
    df = spark.createDataFrame([("o", 1, "created"), ("o", 2, "filled"), ("o", 3, "canceling"), ("q", 4, "filled")], "o string, t bigint, state string")
    assert [r.t for r in audits.events_after_terminal(df, ["o"], ["t"], scan.time_chunk("t", 2)).collect()] == [3]


def test_experiment_registry_rules(spark):
    df = spark.createDataFrame([("1", "f", 0, "created"), ("2", "f", 0, "nonsense"), ("3", "g", 1, "queued"), ("4", "g", 2, "failed")],
                               "experiment_id string, family_id string, trial_index int, status string")
    report = {r.rule: r.violations for r in audits.experiment_violations(df).collect()}
    assert report == {"unknown status": 1, "repeated family_id, trial_index": 1}
    counts = {r.family_id: (r.trials, r.is_dense) for r in audits.trial_counts(df).collect()}
    assert counts == {"f": (2, False), "g": (2, True)}
    parents = spark.createDataFrame([("f",)], "id string")
    assert {r.experiment_id for r in audits.orphans(df, "family_id", parents, "id").collect()} == {"3", "4"}


def test_gates(spark):
    quotes = spark.createDataFrame([("sip",), ("iex_only",)], "venue_coverage string")
    assert audits.consolidated_quotes(quotes).count() == 1
    with pytest.raises(ContractError, match="1 quotes carry iex_only"):
        audits.require_consolidated(quotes)
    events = spark.createDataFrame([("sip",), ("vendor_unknown",)], "event_time_source string")
    assert audits.promotion_report(events).first().promotable is False
    assert audits.promotion_report(events.limit(1)).first().promotable is True


def test_quote_metrics_flag_and_keep(spark):
    df = spark.createDataFrame([(10, 10), (11, 10), (10, 13)], "bid_price_nano bigint, ask_price_nano bigint")
    got = [tuple(r)[2:] for r in normalize.quote_metrics(df).collect()]
    assert got == [(10, 0, 0, True, False), (10, 1, -1, False, True), (11, 1, 3, False, False)]


def plain_walk(rows):
    """(quantity, average cost) of every instrument, fill by fill."""
    state = {}
    for instrument, side, size, price, _ in sorted(rows, key=lambda r: r[4]):
        held, cost = state.get(instrument, (0, 0))
        move = size if side == "buy" else -size
        if held == 0 or held * move > 0:
            cost = (cost * abs(held) + price * abs(move)) // max(abs(held) + abs(move), 1)
        elif abs(move) >= abs(held):
            cost = 0 if abs(move) == abs(held) else price
        state[instrument] = (held + move, cost)
    return state


@pytest.mark.parametrize("per_round", [7, 100_000])
def test_costs_are_folded_from_the_last_opening(spark, per_round):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice(["buy", "sell"]), rng.randrange(1, 6), rng.randrange(1, 10**9), k) for k in range(600)]
    rows += [(9, "buy", rng.randrange(1, 5), rng.randrange(1, 10**9), k) for k in range(60)]  # never flat
    rows += [(10, "buy", 5, 10, 0), (10, "sell", 5, 12, 1), (11, "buy", 5, 10, 0), (11, "sell", 8, 12, 1)]  # closed; taken through flat
    frame = spark.createDataFrame(rows, "instrument_id bigint, side string, quantity_shares bigint, price_nano bigint, seq bigint")
    got = accounts.positions_from_fills(frame.repartition(5), ["seq"], per_round=per_round).collect()
    assert {r.instrument_id: (r.quantity_shares, r.average_cost_nano) for r in got} == plain_walk(rows)


def test_no_fills_have_no_positions(spark):
    empty = spark.createDataFrame([], "instrument_id bigint, side string, quantity_shares bigint, price_nano bigint, seq bigint")
    assert accounts.positions_from_fills(empty, ["seq"]).collect() == []


def test_partial_unique_keys_in_one_scan(spark, tmp_path):
    rows = [("e1", "a", "b1", "x1", 1), ("e2", "a", "b1", None, 1), ("e3", "a", "b1", None, None), ("e4", None, "b1", "x1", None), ("e5", None, "b1", "x2", None), ("e6", "z", None, None, 7)]
    schema = "event_id string, account_id string, broker_event_id string, execution_id string, broker_sequence bigint, event_type string, event_time_ns bigint, knowledge_time_ns bigint"
    spark.createDataFrame([(*r, "fill" if r[0] in ("e2", "e6") else "ack", 5, 4 if r[0] == "e1" else 5) for r in rows], schema).write.parquet(str(tmp_path / "log"))
    report = audits.order_event_violations(spark.read.parquet(str(tmp_path / "log")))
    assert {r.rule: (r.violations, r.example) for r in report.collect()} == {
        "fill without execution_id": (2, "e2"), "knowledge_time precedes event_time": (1, "e1"),
        "repeated account_id, broker_event_id": (3, "a/b1"), "repeated account_id, execution_id": (0, ""), "repeated account_id, broker_sequence": (1, "a/1"),
    }
    assert report._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
