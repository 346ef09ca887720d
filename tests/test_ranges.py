"""Byte ranges: lines and digests must not depend on where files are cut."""

from __future__ import annotations

import hashlib
import io
import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronotape.contracts import contract
from chronotape.operators import bars, normalize
from chronotape.plans import snapshot as snap
from chronotape.sources import ndjson, ranges, tables
from chronotape.sources.files import Folder
from tests.test_operators import prints
from tests.test_sources import TRADE, raw

BITS = [b"a", b"bc", b"", b" ", b"\t", b"\r", b"\xff\xfe", b"long line " * 7, "é".encode(), b"{}"]


def lines_of(data: bytes) -> list[bytes]:
    return [line for line in data.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]


def read_by_ranges(data: bytes, size: int) -> list[bytes]:
    out = []
    for start in range(0, max(len(data), 1), size):
        for block in ranges._Lines(io.BytesIO(data), start, min(size, len(data) - start), len(data)).blocks():
            starts, ends = ranges._spans(block)
            if len(starts):
                batch = ranges._batch({"path": "f", "start": start}, len(out), block, starts, ends)
                out += [v.as_buffer().to_pybytes() for v in batch.column("value")]
                assert batch.column("raw_line").to_pylist()[-1] == len(out) - 1
    return out


@pytest.mark.parametrize("piece", [1, 3, 16, 1 << 20])
def test_lines_do_not_depend_on_ranges_or_pieces(monkeypatch, piece):
    monkeypatch.setattr(ranges, "PIECE_BYTES", piece)
    rng = random.Random(piece)
    for _ in range(60):
        data = b"\n".join(rng.choice(BITS) for _ in range(rng.randrange(12))) + rng.choice([b"", b"\n"])
        for size in (1, 2, 5, 11, 64, 1_000):
            assert read_by_ranges(data, size) == lines_of(data), (data, size)


def merkle(data: bytes, size: int) -> str:
    leaves = [hashlib.sha256(data[k : k + size]).hexdigest() for k in range(0, max(len(data), 1), size)]
    return leaves[0] if len(leaves) == 1 else hashlib.sha256(",".join(leaves).encode()).hexdigest()


def test_digests_of_files_larger_than_a_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "PIECE_BYTES", 100)
    folder = tmp_path / "a b%3A=c"
    folder.mkdir()
    data = {f"{k}.bin": random.Random(k).randbytes(n) for k, n in enumerate((1, 999, 1_000, 1_001, 12_345))}
    for name, held in data.items():
        (folder / name).write_bytes(held)
    files = ranges.listed(spark, [str(folder)], "*.bin")
    for size in (1_000, 1 << 20):
        got = {r.path.rpartition("/")[2]: r.file_sha256 for r in ranges.file_digests(ranges.byte_ranges(files, size)).collect()}
        assert got == {name: merkle(held, size) for name, held in data.items()}
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan  # a listing opens no file


def test_no_files(spark, tmp_path):
    files = spark.createDataFrame([], "path string, bytes bigint")
    assert ranges.file_digests(ranges.byte_ranges(files, 10)).collect() == []
    assert ranges.numbered_lines(ranges.byte_ranges(files, 10)).collect() == []


def test_positions_hold_when_files_are_packed_anew(spark, tmp_path):
    lines = [[json.dumps({**TRADE, "i": f"{f}-{i}"}) for i in range(200)] + [""] * f for f in range(3)]
    folder = raw(tmp_path, *lines)
    want = {f"{f}-{i}": 200 * f + i for f in range(3) for i in range(200)}
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        for planned, run in (("1000", "100m"), ("100m", "1000"), ("3k", "500")):
            spark.conf.set(name, planned)
            records = ndjson.read_trades(spark, folder)
            spark.conf.set(name, run)
            assert {r.trade_id: r.ingest_index for r in records.repartition(3).collect()} == want
    finally:
        spark.conf.set(name, before)


def test_counts_and_records_of_different_grids_are_refused(spark, tmp_path):
    folder = raw(tmp_path, [json.dumps({**TRADE, "i": str(i)}) for i in range(50)])
    files = ranges.listed(spark, [folder], "*.ndjson")
    records = ndjson.parse(ranges.numbered_lines(ranges.byte_ranges(files, 700)), ndjson.TRADE_WIRE)
    coarse = ranges.numbered_lines(ranges.byte_ranges(files, 1_400), count_only=True)
    with pytest.raises(PySparkException, match="no base for a range"):
        ndjson.with_ingest_index(records, coarse).select("ingest_index").collect()


def test_a_truncated_file_fails(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"12345")
    planned = spark.createDataFrame([(str(tmp_path / "x.bin"), 9, 0, 9)], "path string, bytes bigint, start bigint, length bigint")
    with pytest.raises(PySparkException, match="ends 4 bytes early"):
        ranges.range_digests(planned).collect()


def test_a_snapshot_of_files_in_many_ranges(spark, tmp_path):
    """Sealed and verified range by range: a bit turned in the last range, a file cut short, one gone."""
    rows = [(i % 5, (1_767_225_600 + i) * 10**9, i, 100 + i, 1, ["@"]) for i in range(400)]
    built = bars.build_bars(prints(spark, rows), window_ns=10**9, as_of=0).withColumns(
        {"raw_partition_id": F.lit("p"), "event_time_source": F.lit("sip"), "date": F.concat(F.lit("2026-01-0"), F.col("instrument_id") % 3 + 1)}
    )
    shape = contract("normalized.bar")
    table = normalize.to_contract(bars.with_bar_positions(built, ["date"]), shape, ["date"])
    written = tables.write_contract_table(table, shape, str(tmp_path), partitions=1)
    manifest = snap.seal(spark, [written], str(tmp_path), range_bytes=512)
    sealed = snap.Sealed(spark, str(tmp_path), manifest)
    assert sealed.files.agg(F.min("bytes")).first()[0] > 4 * 512 and sealed.file_findings().isEmpty()
    assert sealed.table(shape.name).count() == 400

    paths = [r.path for r in sealed.files.orderBy("path").collect()]
    assert len(paths) == 3
    first, second, third = (tmp_path / p for p in paths)
    turned = bytearray(first.read_bytes())
    turned[-700] ^= 1
    first.write_bytes(turned)
    second.write_bytes(second.read_bytes()[:-1])
    Folder(spark, str(tmp_path)).remove(paths[2])
    assert not third.exists()
    found = {r.path: (r.finding, r.held is None) for r in sealed.file_findings().collect()}
    assert found == {paths[0]: ("changed", False), paths[1]: ("changed", True), paths[2]: ("missing", True)}
