"""Files as byte ranges: rows that tasks read piece by piece, whatever a file's size.

Ranges are planned as a DataFrame of (path, bytes, start, length), from a listing that Spark makes, and
dealt out by rows. A task opens each of its ranges where it lies and never holds more than a piece of it.
Because the grid of ranges is fixed when they are planned, what is read of a file does not depend on how
Spark packs files into partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a range of a digest, bytes a task holds at once, and most tasks that ranges are dealt to.
RANGE_BYTES, PIECE_BYTES, MOST_TASKS = 64 << 20, 4 << 20, 20_000

DIGESTS = "path string, start bigint, range_sha256 string"
LINES = "raw_file string, raw_block bigint, raw_line bigint, value string"
COUNTS = "raw_file string, raw_block bigint, lines bigint"


def listed(spark: SparkSession, paths: list[str], pattern: str) -> DataFrame:
    """(path, bytes) of the files under some folders; nothing is opened, and Spark lists no file without bytes."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(paths)
    return found.select("path", F.col("length").alias("bytes"))


def byte_ranges(files: DataFrame, range_bytes: Column | int) -> DataFrame:
    """One row per range of every file of ``files`` (path, bytes), dealt evenly; an empty file has one empty range."""
    size = F.lit(range_bytes) if isinstance(range_bytes, int) else range_bytes
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0)), size.cast("bigint"))
    ranges = files.select("path", "bytes", size.cast("bigint").alias("__size"), F.explode(starts).alias("start"))
    ranges = ranges.select("path", "bytes", "start", F.least("__size", F.col("bytes") - F.col("start")).alias("length"))
    tasks = ranges.agg(F.least(F.count("*"), F.lit(MOST_TASKS))).first()[0]  # one number, from the listing alone
    # in key order, so that every task gets its share however few ranges there are
    return ranges.repartitionByRange(max(1, tasks), "path", "start")


def opened(path: str) -> pa.NativeFile:
    """A file of any store that Arrow knows, for reading at any place; the path is as Spark lists it."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + (rest if colon else path).lstrip("/"))
    authority, _, key = rest.lstrip("/").partition("/")
    store, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return store.open_input_file(f"{base.rstrip('/')}/{key}")


def pieces(file: pa.NativeFile, start: int, length: int) -> Iterator[bytes]:
    """The bytes of a range, some at a time; a file that ends early is an error."""
    file.seek(start)
    while length:
        piece = file.read(min(length, PIECE_BYTES))
        if not piece:
            raise EOFError(f"the file ends {length} bytes early")
        length -= len(piece)
        yield piece


def range_digests(ranges: DataFrame) -> DataFrame:
    """(path, start, range_sha256): SHA-256 of the exact bytes of every range."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.select(["path", "start", "length"]).to_pylist():
                state = hashlib.sha256()
                with opened(row["path"]) as file:
                    for piece in pieces(file, row["start"], row["length"]):
                        state.update(piece)
                found.append(state.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("start"), pa.array(found, pa.string())], ["path", "start", "range_sha256"])

    return ranges.mapInArrow(digest, DIGESTS)


def file_digests(ranges: DataFrame) -> DataFrame:
    """(path, file_sha256): a file's digest is the root of a two-level Merkle tree over its ranges.

    A file of one range has the SHA-256 of its bytes; a longer one that of its ranges' digests in order.
    A range is one narrow row, so the largest file is no heavier to combine than many small ones.
    """
    leaves = F.array_sort(F.collect_list(F.struct("start", "range_sha256")))
    held = range_digests(ranges).groupBy("path").agg(F.transform(leaves, lambda leaf: leaf["range_sha256"]).alias("__leaves"))
    root = F.when(F.size("__leaves") == 1, F.element_at("__leaves", 1)).otherwise(F.sha2(F.array_join("__leaves", ","), 256))
    return held.select("path", root.alias("file_sha256"))


class _Lines:
    """The lines that begin inside one range, piece by piece; the last may reach beyond it."""

    def __init__(self, file: pa.NativeFile, start: int, length: int, size: int) -> None:
        self.file, self.start, self.end, self.size = file, start, start + length, size

    def blocks(self) -> Iterator[bytes]:
        """Whole lines, joined, each with its line feed except perhaps the file's last."""
        at = self.start
        self.file.seek(at - 1 if at else 0)
        inside = at == 0 or self.file.read(1) == b"\n"
        held: list[bytes] = []
        while at < self.size:
            piece = self.file.read(min(PIECE_BYTES, self.end - at) if at < self.end else min(PIECE_BYTES, self.size - at))
            if not piece:
                break
            begun, at = at, at + len(piece)
            if begun >= self.end:  # only the rest of the last line is wanted
                stop = piece.find(b"\n")
                held.append(piece if stop < 0 else piece[: stop + 1])
                if stop >= 0:
                    break
                continue
            if not inside:
                first = piece.find(b"\n")
                inside = first >= 0
                piece = piece[first + 1 :] if inside else b""
            last = piece.rfind(b"\n")
            if not piece:
                pass
            elif last < 0:
                held.append(piece)
            else:
                yield b"".join([*held, piece[: last + 1]])
                held = [piece[last + 1 :]] if last + 1 < len(piece) else []
            if at >= self.end and not held:
                return
        if inside and held:
            yield b"".join(held)


#: Bytes that do not make a line count: space, tab, line feed, vertical tab, form feed, carriage return.
_BLANK = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def _spans(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each line that is not blank begins and ends, its line feed left out."""
    raw = np.frombuffer(block, dtype=np.uint8)
    feeds = np.flatnonzero(raw == 0x0A)
    ends = feeds if len(feeds) and feeds[-1] == len(raw) - 1 else np.append(feeds, len(raw))
    starts = np.concatenate([[0], ends[:-1] + 1])
    told = np.logical_or.reduceat(~_BLANK[raw], starts)
    return starts[told], ends[told]


def numbered_lines(ranges: DataFrame, *, count_only: bool = False) -> DataFrame:
    """Lines that are not blank, each with its file, the start of its range and its number among that range's lines.

    With ``count_only``: one row per range with the number of its lines. A line belongs to the range its
    first byte lies in. Bytes are passed on as they are; a line's carriage return stays with it.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                number = 0
                with opened(row["path"]) as file:
                    for block in _Lines(file, row["start"], row["length"], row["bytes"]).blocks():
                        starts, ends = _spans(block)
                        if not count_only and len(starts):
                            yield _batch(row, number, block, starts, ends)
                        number += len(starts)
                if count_only:
                    yield pa.RecordBatch.from_pylist([{"raw_file": row["path"], "raw_block": row["start"], "lines": number}], _COUNTED)

    return ranges.mapInArrow(read, COUNTS if count_only else LINES)


_COUNTED = pa.schema([("raw_file", pa.string()), ("raw_block", pa.int64()), ("lines", pa.int64())])


def _batch(row: dict, number: int, block: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    n, length = len(starts), ends - starts
    raw = np.frombuffer(block, dtype=np.uint8)
    if length.sum() + n == len(raw) or length.sum() == len(raw):  # no blank lines: drop the line feeds only
        kept = raw if length.sum() == len(raw) else np.delete(raw, ends[ends < len(raw)])
    else:
        kept = np.concatenate([raw[a:b] for a, b in zip(starts, ends, strict=True)])
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    value = pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(kept.tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([row["path"]] * n, pa.string()), pa.array([row["start"]] * n, pa.int64()), pa.array(np.arange(number, number + n), pa.int64()), value],
        ["raw_file", "raw_block", "raw_line", "value"],
    )
