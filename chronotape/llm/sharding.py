"""Shards by a keyed permutation of global row numbers.

A Feistel network with cycle walking permutes 0..n-1. Row g lands at place p = permute(g); its shard
is p mod shards and its slot p div shards, so shards differ by one row at most, slots have no gaps,
and both directions can be computed for any row without a shuffle of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotape.llm.common import numbered, present

ROUNDS = 6
#: Fixed values of the round function: a Mersenne prime and two multipliers below it.
PRIME = (1 << 31) - 1
FIRST, SECOND = 1_103_515_245, 747_796_405


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0..size-1, fixed by its size and seed.

    The network works on pairs (left, right) with both sides below ``side``, the least integer whose
    square reaches ``size``; a place outside the range is sent through again until it falls inside,
    which ends because the network itself is a permutation.
    """

    size: int
    seed: int = 0

    @property
    def side(self) -> int:
        return max(1, math.isqrt(max(self.size, 1) - 1) + 1)

    def _mixed(self, half: np.ndarray, round_: int) -> np.ndarray:
        key = (self.seed * 40_503 + round_ * 7_919 + 12_345) % PRIME
        x = (half % PRIME * FIRST + key) % PRIME
        x = (x * x + SECOND) % PRIME
        return (x ^ (x >> 15)) % self.side

    def _network(self, x: np.ndarray, backward: bool = False) -> np.ndarray:
        left, right = x // self.side, x % self.side
        for r in reversed(range(ROUNDS)) if backward else range(ROUNDS):
            sign = -1 if backward else 1
            if r % 2 == 0:
                left = (left + sign * self._mixed(right, r)) % self.side
            else:
                right = (right + sign * self._mixed(left, r)) % self.side
        return left * self.side + right

    def _walked(self, x: np.ndarray, backward: bool) -> np.ndarray:
        out = self._network(x.astype(np.int64), backward)
        while (outside := out >= self.size).any():
            out[outside] = self._network(out[outside], backward)
        return out

    def place(self, row: np.ndarray) -> np.ndarray:
        """Where each row number goes."""
        return self._walked(np.asarray(row), backward=False)

    def row(self, place: np.ndarray) -> np.ndarray:
        """Which row number sits at each place: the inverse of :meth:`place`."""
        return self._walked(np.asarray(place), backward=True)


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 0, overhead: int = 16, partitions: int | None = None) -> DataFrame:
    """Deal documents into ``shards`` shards of equal row counts, in a reproducible shuffled order.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns doc_id, size (UTF-8 bytes plus
    ``overhead``), text_crc32, law ("rows"), shard, slot, row_number and grown_shard (null: the row law
    moves rows when the number of shards changes).

    Row numbers follow (doc_id nulls first, text checksum, size, 64-bit hash), so the result does not
    depend on partitions or file order. Equal rows take neighbouring numbers. A null text has no bytes
    and the checksum of the empty text; an empty table gives an empty result. Texts are read once and
    only their sizes and checksums are shuffled.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    text = present(F.col("text"))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("__hash"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "text_crc32", "size", "__hash")]
    rows, total = numbered(narrow, order, "shards", partitions)
    permutation = Permutation(total, seed)

    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(permutation.place(batch.to_numpy()))

    placed = rows.withColumn("__place", F.pandas_udf(place, "long")("row_number"))
    return placed.select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("__place", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"__place div {shards}").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
