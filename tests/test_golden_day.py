"""Raw bytes in, the same sealed snapshot out."""

from __future__ import annotations

import hashlib
import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chronotape.contracts import contract, vocab
from chronotape.functions.ordering import order_key
from chronotape.operators.audits import contract_violations, file_order_violations
from chronotape.plans import snapshot as snap
from chronotape.plans.day import run, session_bars
from chronotape.sources.reference import load_reference
from tests import golden_day as day

# What the day must produce.
EXPECTED_ROWS = {"normalized.trade": 1001, "normalized.quote": 1000, "normalized.bar": 33}
FIRST_BAR = {
    "event_time": 1789738200000000000, "open_nano": 50030000000, "high_nano": 50030000000, "low_nano": 49820000000,
    "close_nano": 49840000000, "volume_shares": 15600, "vwap_nano": 49935897435, "trade_count": 30, "is_complete": True,
}


def build(spark, folder, files=1, **options):
    root = day.write_day(folder, files)
    return run(
        spark, str(root / "raw"), str(root / "reference.json"), str(root / "out"), day.CLOCKS,
        **{"as_of": day.AS_OF, "calendar_version": "xnys_v1", **options},
    )


def copy(result, folder):
    """A snapshot keeps its identity wherever it is materialized."""
    return Path(shutil.copytree(result.root, folder / "moved"))


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    return build(spark, tmp_path_factory.mktemp("day"))


@pytest.fixture(scope="module")
def reader(spark, result):
    return snap.Sealed(spark, result.root)


def test_row_counts(reader):
    assert {e.contract: e.row_count for e in reader.manifest.files} == EXPECTED_ROWS
    for name, rows in EXPECTED_ROWS.items():
        assert reader.table(name).count() == rows


def test_first_trade_is_exact(reader):
    first = reader.table("normalized.trade").orderBy(*vocab.ORDER_KEY).first()
    assert (first.event_time, first.knowledge_time) == (1789738202523646945, 1789738202523896945)
    assert first.instrument_id == day.INSTRUMENT and first.revision_time is None and first.source_rank == 5
    assert first.raw_partition_id == "fixture/tiny_day/000" and first.is_cancelled is False


def test_first_bar_and_totals(reader):
    bars = reader.table("normalized.bar")
    first = bars.orderBy("event_time").first()
    assert {k: first[k] for k in FIRST_BAR} == FIRST_BAR
    assert bars.agg(F.sum("trade_count")).first()[0] == 981
    assert [r.ingest_index for r in bars.orderBy("event_time").collect()] == list(range(33))
    bad = bars.where(
        "open_nano NOT BETWEEN low_nano AND high_nano OR close_nano NOT BETWEEN low_nano AND high_nano "
        "OR vwap_nano NOT BETWEEN low_nano AND high_nano"
    )
    assert bad.isEmpty()
    assert bars.where((F.col("event_time") - day.OPEN_NS) % F.col("window_ns") != 0).isEmpty()


def test_positions_and_sorts_read_stored_bars_and_not_the_prints_again(spark, result, reader):
    trades = reader.table("normalized.trade")
    calendar = load_reference(spark, str(Path(result.root).parent / "reference.json")).calendar
    bars = session_bars(trades, calendar, day.CLOCKS, as_of=day.AS_OF, window_ns=vocab.DEFAULT_WINDOW_NS)
    assert bars.inputFiles() and not any("/trades/" in f for f in bars.inputFiles())
    held = reader.table("normalized.bar").select(bars.columns)
    assert bars.exceptAll(held.withColumn("date", F.col("date").cast("string"))).isEmpty() and bars.count() == held.count()


def test_digest_sums_are_exact(spark):
    rows = [(k % 7, f"t{k % 50}") for k in range(400)]
    found = snap.content_digest(spark.createDataFrame(rows, "a int, b string"), ["a", "b"]).first()
    digests = [hashlib.sha256(json.dumps({"a": a, "b": b}, separators=(",", ":")).encode()).hexdigest() for a, b in rows]
    lanes = [sum(int(d[i : i + 15], 16) for d in digests) for i in (0, 15, 30, 45)]
    assert found["content_sha256"] == hashlib.sha256(",".join(map(str, [400, *lanes])).encode()).hexdigest()
    none = snap.content_digest(spark.createDataFrame([], "a int, b string"), ["a", "b"]).first()
    assert none["content_sha256"] == hashlib.sha256(b"0,0,0,0,0").hexdigest()


def test_form_t_prints_stay_out_of_bars(reader):
    trades = reader.table("normalized.trade")
    assert trades.where(F.array_contains("conditions", "T")).count() == 20


def test_positions_follow_file_order_over_several_files(spark, tmp_path, reader):
    many = build(spark, tmp_path, files=7)
    other = snap.Sealed(spark, many.root).table("normalized.trade")
    trades = reader.table("normalized.trade")
    assert other.exceptAll(trades).isEmpty() and trades.exceptAll(other).isEmpty()
    assert many.snapshot_id == reader.manifest.snapshot_id()  # same records, same data, whatever the file layout


def test_collision_is_ordered_by_sequence(reader):
    trades = reader.table("normalized.trade")
    twice = trades.groupBy("event_time").count().where("count > 1").first()["event_time"]
    pair = trades.where(F.col("event_time") == twice).orderBy(order_key()).select("trade_id", "ingest_index").collect()
    assert [tuple(r) for r in pair] == [("tr-00100", 100), ("tr-collide", 101)]


def test_contract_content_and_physical_order(reader):
    for name in EXPECTED_ROWS:
        table = reader.table(name)
        report = contract_violations(table.drop("date"), contract(name))
        assert report.where("violations > 0").isEmpty()
        assert file_order_violations(table).isEmpty()


def test_open_windows_are_incomplete(spark, tmp_path):
    early = build(spark, tmp_path, as_of=day.OPEN_NS + 600 * vocab.NS_PER_SECOND)
    flags = {r[0] for r in snap.Sealed(spark, early.root).table("normalized.bar").select("is_complete").collect()}
    assert flags == {True, False}


def test_manifest_round_trips_and_verifies(spark, result):
    manifest = snap.open_manifest(spark, result.root)
    assert manifest.snapshot_id() == result.snapshot_id and manifest.integrity() == result.manifest.integrity()
    assert snap.Sealed(spark, result.root).file_findings().isEmpty()


def test_identity_ignores_listing_order_and_physical_files(result):
    m = result.manifest
    turned = snap.Manifest(tuple(reversed(m.files)), calendar_version=m.calendar_version, files_sha256="other")
    assert turned.snapshot_id() == m.snapshot_id() and turned.integrity() != m.integrity()
    assert snap.Manifest(m.files, calendar_version="other").snapshot_id() != m.snapshot_id()


def test_damage_is_found(spark, tmp_path, result):
    out = copy(result, tmp_path)
    trade = next((out / "normalized" / "trade").rglob("*.parquet"))
    quote = next((out / "normalized" / "quote").rglob("*.parquet"))
    data = bytearray(trade.read_bytes())
    data[len(data) // 2] ^= 0xFF
    trade.write_bytes(bytes(data))
    trade.with_name(f".{trade.name}.crc").unlink(missing_ok=True)
    quote.unlink()
    findings = {r.path: r.finding for r in snap.Sealed(spark, str(out)).file_findings().collect()}
    assert findings[str(trade.relative_to(out))] == snap.CHANGED
    assert findings[str(quote.relative_to(out))] == snap.MISSING
    assert len(findings) == 2


def test_unlisted_files_change_nothing_and_cannot_be_read(spark, tmp_path, result):
    out = copy(result, tmp_path)
    partition = out / "normalized" / "trade" / "date=2026-09-18"
    listed = next(partition.glob("*.parquet"))
    (partition / "extra.parquet").write_bytes(listed.read_bytes())
    assert snap.Sealed(spark, str(out)).file_findings().isEmpty()
    reader = snap.Sealed(spark, str(out))
    assert reader.table("normalized.trade").count() == 1001
    assert reader.partition("normalized/trade/date=2026-09-18").count() == 1001
    for path in ("normalized/trade/date=2026-09-19", "normalized/trade/date=2026-09-18/extra.parquet"):
        with pytest.raises(snap.NotSealed, match="no partition of snapshot"):
            reader.partition(path)


def test_row_count_mismatch_is_refused(spark, result):
    body = json.loads(json.dumps([e.__dict__ for e in result.manifest.files]))
    for entry in body:
        entry["row_count"] += entry["contract"] == "normalized.bar"
    wrong = snap.Manifest(tuple(snap.Entry(**e) for e in body), files_sha256=result.manifest.files_sha256)
    with pytest.raises(snap.SealBroken, match="sealed with 34 rows and holds 33"):
        snap.Sealed(spark, result.root, wrong).table("normalized.bar")


def test_repeated_manifest_paths_are_refused(result):
    entry = result.manifest.files[0]
    with pytest.raises(snap.SealBroken, match="comes again"):
        snap.Manifest((entry, entry))
