"""Pack documents into sequences of a fixed number of tokens, cutting only what cannot fit.

Token ids are made once and reduced to lengths and checksums, which are stored. A document longer than
a sequence yields full pieces, each a sequence of its own, and one shorter first piece; these and the
short documents are the items of a bin packing. Items are dealt by hash into sets of bounded size; each
set is packed by islands of a grouping genetic algorithm that exchange their elites between epochs
through a shuffle. Random dealing gives every set the lengths' distribution, so sets waste less than
about one sequence each.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotape.llm.common import present, stored
from chronotape.llm.grouping import Island, Packing
from chronotape.llm.tokens import encoder

CAPACITY, END = 1024, 2
#: Items packed together, islands per set, generations per epoch, epochs.
SET, ISLANDS, GENERATIONS, EPOCHS = 4_096, 2, 8, 2


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: all full but the first, which takes what is left over."""
    first = total % capacity or capacity
    return [(0, min(first, total)), *((s, capacity) for s in range(first, total, capacity))]


def token_lengths(docs: DataFrame, ranks: str, capacity: int = CAPACITY) -> DataFrame:
    """uid (unique), doc_id, n_tokens (with the end id) and the checksum of each piece's ids."""
    end = np.asarray([END], dtype="<u4").tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a task's rows get distinct numbers; the result is stored, so they never change
        at = TaskContext.get().partitionId() << 33
        encode_text = encoder(ranks).encode
        for batch in batches:
            totals, sums = [], []
            for text in batch["text"]:
                ids = memoryview(encode_text(text) + end)
                total = len(ids) // 4
                totals.append(total)
                sums.append([zlib.crc32(ids[4 * s : 4 * (s + n)]) for s, n in cut(total, capacity)])
            uid = np.arange(at, at + len(batch))
            at += len(batch)
            yield pd.DataFrame({"uid": uid, "doc_id": batch["doc_id"], "n_tokens": totals, "crcs": sums})

    # an absent id must not turn a batch's ids into floating point numbers, so ids travel as text
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), present(F.col("text")).alias("text"))
    lengths = rows.mapInPandas(encode, "uid long, doc_id string, n_tokens long, crcs array<long>")
    return lengths.withColumn("doc_id", F.col("doc_id").cast("long"))


def _flat(packing: Packing) -> tuple[list[int], list[int]]:
    return [i for b in packing for i in b], [len(b) for b in packing]


def _bins(items: list[int], sizes: list[int]) -> Packing:
    rest = iter([int(i) for i in items])
    return [list(itertools.islice(rest, int(n))) for n in sizes]


_ISLAND = "set int, island int, uids array<long>, lengths array<int>, population array<struct<items:array<int>,sizes:array<int>>>"


def pack_lengths(items: DataFrame, capacity: int = CAPACITY, per_set: int = SET, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Sequence and offset for items of (uid, length), every length between 1 and ``capacity``.

    Returns uid, sequence_id (0 or more, shared by the items of a sequence) and offset.
    """
    sets = max(1, -(-items.count() // per_set))
    members = (
        items.withColumn("set", F.pmod(F.xxhash64("uid"), F.lit(sets)).cast("int"))
        .groupBy("set").agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("m"))  # about per_set rows each
    )
    world = members.select(
        "set", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.col("m.uid").alias("uids"), F.col("m.length").alias("lengths"),
    )

    def island_of(row, population: list) -> Island:
        island = Island([int(n) for n in row.lengths], capacity, seed=int(row.set) * 1_009 + int(row.island))
        island.population = [_bins(p["items"], p["sizes"]) for p in population]
        return island

    def epoch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                if "elite" in batch.columns:
                    island = island_of(row, list(row.population))
                    if row.elite is not None:
                        island.welcome(_bins(row.elite["items"], row.elite["sizes"]))
                else:
                    island = island_of(row, [])
                    island.seed_population()
                island.evolve(GENERATIONS)
                ranked = sorted(island.population, key=island.fitness)
                held = [dict(zip(("items", "sizes"), _flat(p), strict=True)) for p in ranked]
                yield pd.DataFrame({"set": [row.set], "island": [row.island], "uids": [row.uids], "lengths": [row.lengths], "population": [held]})

    state = stored(world.mapInPandas(epoch, _ISLAND), "packing-islands")
    for _ in range(epochs - 1):
        elites = state.select("set", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.get("population", F.lit(0)).alias("elite"))
        state = stored(state.join(elites, ["set", "island"]).mapInPandas(epoch, _ISLAND), "packing-islands")

    best = F.get("population", F.lit(0))
    square = F.aggregate(F.get("population", F.lit(0))["sizes"], F.lit(0), lambda s, n: s + n * n)
    winner = state.groupBy("set").agg(
        F.min_by(F.struct("uids", "lengths", best.alias("p")), F.struct(F.size(best["sizes"]), -square, "island")).alias("w")
    )
    ends = F.expr("transform(sequence(1, size(w.p.sizes)), k -> struct(k - 1 AS bin, slice(w.p.items, 1 + begin[k - 1], w.p.sizes[k - 1]) AS items))")
    begin = F.expr("aggregate(w.p.sizes, array(0), (a, n) -> array_append(a, element_at(a, -1) + n))")
    binned = winner.withColumn("begin", begin).withColumn("b", F.explode(ends))
    placed = binned.select(
        "set", "b.bin", F.expr("transform(b.items, i -> struct(w.uids[i] AS uid, w.lengths[i] AS length))").alias("items")
    )
    offsets = F.expr("aggregate(items, array(0), (a, x) -> array_append(a, element_at(a, -1) + x.length))")
    laid = placed.withColumn("offsets", offsets).select("set", "bin", F.posexplode("items").alias("k", "item"), "offsets")
    return laid.select(
        F.col("item.uid").alias("uid"), (F.col("set").cast("long") * F.lit(1 << 20) + F.col("bin")).alias("sequence_id"),
        F.get("offsets", F.col("k")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, ranks: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset for every piece of every document.

    Takes doc_id and text; other columns are ignored. A null or empty text is the end id alone. Repeated
    rows are packed once each; an empty table gives an empty result. Full pieces have negative sequence
    ids, one each.
    """
    tokens = stored(token_lengths(docs, ranks or vocabulary(), capacity), "packing-tokens")
    first = F.when(F.col("n_tokens") % capacity == 0, F.lit(capacity)).otherwise(F.col("n_tokens") % capacity).cast("int")
    items = tokens.withColumn("length", first).where(F.col("length") < capacity).select("uid", "length")
    packed = pack_lengths(items, capacity).withColumnsRenamed({"sequence_id": "__sequence", "offset": "__offset"})
    pieces = tokens.join(packed, "uid", "left").select(
        "doc_id", "__sequence", "__offset", first.cast("long").alias("__first"), F.posexplode("crcs").alias("piece", "ids_crc32")
    )
    short = (F.col("piece") == 0) & F.col("__sequence").isNotNull()
    return pieces.select(
        "doc_id", "piece",
        F.when(F.col("piece") == 0, F.lit(0)).otherwise(F.col("__first") + (F.col("piece") - 1) * F.lit(capacity)).cast("long").alias("start"),
        F.when(F.col("piece") == 0, F.col("__first")).otherwise(F.lit(capacity)).cast("long").alias("length"),
        "ids_crc32",
        F.when(short, F.col("__sequence")).otherwise(-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.when(short, F.col("__offset")).otherwise(F.lit(0)).cast("long").alias("offset"),
    )
