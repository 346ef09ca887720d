"""Column expressions against exact Python arithmetic."""

from __future__ import annotations

import calendar
import random
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.functions import encoding, instants, money
from chronotape.functions.ordering import after_everything, before_everything, order_key, strictly_after


def values(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]


def fails(df, match):
    with pytest.raises(PySparkException, match=match):
        df.collect()


INSTANTS = {
    "2026-09-19T13:30:00.123456789Z": 1_789_824_600_123_456_789,
    "2026-09-19t13:30:00.5z": 1_789_824_600_500_000_000,
    "2026-09-19 13:30:00+05:30": 1_789_824_600_000_000_000 - 19_800 * 10**9,
    "2026-09-19T13:30:00-04:00": 1_789_824_600_000_000_000 + 14_400 * 10**9,
    "1969-12-31T23:59:59.999999999Z": -1,
    "2016-12-31T23:59:60Z": calendar.timegm((2017, 1, 1, 0, 0, 0)) * 10**9,  # second 60 rolls over
    "2026-09-31T00:00:00Z": calendar.timegm((2026, 10, 1, 0, 0, 0)) * 10**9,  # so does day 31
    "2026-09-19T13:30:00": None,  # no offset
    "2026-13-01T00:00:00Z": None,
    "2026-00-01T00:00:00Z": None,
    "0000-01-01T00:00:00Z": None,
    "2026-09-19T13:30:00.1234567890Z": None,
    "2026-09-19T13:30:00.Z": None,
    "2026-09-19T13:30:00Z\n": None,
    "yesterday": None,
    "": None,
}


def test_instant_text(spark):
    got = values(spark, [(t,) for t in INSTANTS], "t string", text=F.col("t"), ns=instants.ns_from_rfc3339("t"))
    assert dict(got) == INSTANTS


def test_instant_text_round_trip_ignores_the_session_zone(spark):
    rng = random.Random(1)
    samples = [-1, 0, 1, -86_400 * 10**9, *[rng.randrange(-(2**60), 2**62) for _ in range(200)]]
    text = instants.rfc3339_from_ns("ns")
    got = values(spark, [(s,) for s in samples], "ns bigint", ns=F.col("ns"), back=instants.ns_from_rfc3339(text), text=text)
    assert all(ns == back for ns, back, _ in got)
    assert {ns: t for ns, _, t in got}[-1] == "1969-12-31T23:59:59.999999999Z"


def test_zone_free_timestamps_ignore_clock_changes(spark):
    """02:30 does not exist on this day in the session's zone."""
    times = ["2001-04-01 02:30:00.123456", "2001-10-28 01:30:00", "1969-12-31 23:59:59.999999", "2026-07-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    want = [np.datetime64(t.replace(" ", "T"), "ns").astype("int64") for t in times]
    assert [r[0] for r in df.select(instants.ns_from_timestamp_ntz("ts")).collect()] == want


def test_window_start_floors_before_the_origin(spark):
    got = values(spark, [(t,) for t in (-11, -10, -1, 0, 9, 10)], "t bigint", w=instants.window_start("t", 10, 0))
    assert [w for (w,) in got] == [-20, -10, -10, 0, 0, 10]


def test_plausible_band_is_inclusive(spark):
    edges = [vocab.PLAUSIBLE_MIN_NS - 1, vocab.PLAUSIBLE_MIN_NS, vocab.PLAUSIBLE_MAX_NS, vocab.PLAUSIBLE_MAX_NS + 1]
    df = spark.createDataFrame([(e,) for e in edges], "t bigint")
    assert [r[0] for r in df.select(instants.is_plausible("t")).collect()] == [False, True, True, False]
    fails(df.select(instants.require_plausible("t", "decision_time")), "decision_time=.* plausible band")


def test_dollars_are_exact(spark):
    amounts = ["50.03", "0", "-1.000000001", "0.0000051", "4611686018.427387904"]
    got = values(
        spark, [(Decimal(a),) for a in amounts], "p decimal(38,18)", nano=money.nano_from_dollars("p")
    )
    assert [n for (n,) in got] == [int(Decimal(a) * 10**9) for a in amounts]


@pytest.mark.parametrize("bad", ["1.0000000001", "-0.0000000005"])
def test_sub_nano_amounts_fail(spark, bad):
    df = spark.createDataFrame([(Decimal(bad),)], "p decimal(38,18)")
    fails(df.select(money.nano_from_dollars("p", "bid")), "bid=.*sub-nano")


@pytest.mark.parametrize("value, ok", [(2**62, True), (-(2**62), True), (2**62 + 1, False), (-(2**62) - 1, False), (2**70, False)])
def test_storable_range(spark, value, ok):
    df = spark.createDataFrame([(Decimal(value),)], "v decimal(38,0)").select(money.narrow("v", "cash").alias("v"))
    if ok:
        assert df.first()[0] == value
    else:
        fails(df, "cash=.*exceeds the storable range")


def test_fractional_shares_fail(spark):
    assert spark.range(1).select(money.require_whole_shares(F.lit(100.0))).first()[0] == 100
    fails(spark.range(1).select(money.require_whole_shares(F.lit(1.5))), "not a whole share count")


def test_directed_rounding_and_its_ledger(spark):
    rng = random.Random(2)
    cases = [(rng.randrange(-(10**15), 10**15), rng.randrange(0, 2_000), rng.randrange(1, 1_000)) for _ in range(400)]
    cases += [(-7, 1, 2), (7, 1, 2), (6, 1, 2), (0, 1, 3)]
    got = values(
        spark, cases, "b bigint, n bigint, d bigint", b=F.col("b"), n=F.col("n"), d=F.col("d"),
        cost=money.apply_rate("b", F.col("n"), F.col("d")), credit=money.apply_rate("b", F.col("n"), F.col("d"), credit=True),
    )
    total = Fraction(0)
    for b, n, d, cost, credit in got:
        exact = Fraction(b * n, d)
        for entry in (cost, credit):
            assert Fraction(entry.value) + Fraction(entry.remainder, entry.denominator) == exact
            assert abs(Fraction(entry.remainder, entry.denominator)) < 1
            assert entry.value == 0 or (entry.value > 0) == (exact > 0)
        assert abs(credit.value) <= abs(exact) <= abs(cost.value)
        total += Fraction(cost.value) + Fraction(cost.remainder, cost.denominator)
    assert total == sum(Fraction(b * n, d) for b, n, d in cases)


def test_mid_price_keeps_the_half(spark):
    ((mid,),) = values(spark, [(3, 4)], "b bigint, a bigint", m=money.mid_price("b", "a"))
    assert (mid.value, mid.remainder, mid.denominator) == (3, 1, 2)


def test_notional_outgrows_64_bits(spark):
    ((n,),) = values(spark, [(2**62, 2**40)], "p bigint, q bigint", n=money.notional("p", "q"))
    assert int(n) == 2**102


def test_usd_text(spark):
    ((a, b),) = values(spark, [(2**62, -1)], "x bigint, y bigint", a=money.format_usd("x"), b=money.format_usd("y"))
    assert (a, b) == ("4,611,686,018.427387904", "-0.000000001")


def test_ordering_is_total_and_bounded(spark):
    rng = random.Random(3)
    rows = [
        (rng.randrange(0, 4), rng.randrange(0, 8), rng.randrange(-1, 3), rng.randrange(-1, 3), rng.randrange(0, 3))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "event_time bigint, source_rank int, vendor_sequence bigint, venue_sequence bigint, ingest_index bigint")
    assert [tuple(r) for r in df.orderBy(order_key()).collect()] == sorted(rows)
    bounded = df.where(strictly_after(order_key(), before_everything()) & strictly_after(after_everything(), order_key()))
    assert bounded.count() == len(rows)
    assert df.where(strictly_after(order_key(), order_key())).isEmpty()


def test_draws_depend_on_seed_stream_and_key_only(spark):
    df = spark.range(2_000)
    one = {r[0]: r[1] for r in df.select("id", encoding.draw(5, "fills", "id")).collect()}
    two = {r[0]: r[1] for r in df.repartition(7).select("id", encoding.draw(5, "fills", "id")).collect()}
    other = {r[0]: r[1] for r in df.select("id", encoding.draw(5, "marks", "id")).collect()}
    assert one == two and one != other
    assert all(0 <= d < 2**52 for d in one.values())
    assert 400 < encoding.stable_sample(df, 0.25, 5, "fills", "id").count() < 600
    with pytest.raises(ValueError):
        encoding.draw(-1, "fills", "id")
    with pytest.raises(ValueError):
        encoding.draw(1, "", "id")


def test_text_is_normalized_and_no_row_is_lost(spark):
    df = spark.createDataFrame([(1, "café"), (2, "plain"), (3, None), (4, "café")], "id int, t string")
    got = {r.id: r.t for r in encoding.normalize_text(df, ["t"]).collect()}
    assert got == {1: "café", 2: "plain", 3: None, 4: "café"}


def test_documents_have_one_encoding():
    assert encoding.document_lines({"b": [7, None], "a": "cafe\u0301/x"}) == ["\tmap\t2", "/a\ttext\tcaf\u00e9\\sx", "/b\tlist\t2", "/b/0\tint\t7", "/b/1\tNoneType\tNone"]
    assert encoding.document_digest({"a": 1, "b": {"c": True}}) == encoding.document_digest({"b": {"c": True}, "a": 1})
    different = [{}, {"a": 1}, {"a": "1"}, {"a": True}, {"a": None}, {"a": []}, {"a": {}}, {"a/b": 1}, {"a": {"b": 1}}, {"a": "x\ty"}, {"a": "x\\ty"}]
    assert len({encoding.document_digest(d) for d in different}) == len(different)
    for refused in ({"rate": 0.1}, {"x": {1, 2}}, {"deep": [{"y": b""}]}):
        with pytest.raises(TypeError, match="cannot be part"):
            encoding.document_digest(refused)
