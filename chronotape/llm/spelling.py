"""Spelling variants: words of the corpus that one inserted, deleted or replaced code point makes equal.

Words are counted over all documents and reduced to a vocabulary. Two words are compared by their
padded code-point matrices, a block of words against a block at a time: the length of their common
prefix plus that of their common suffix reaches the longer length less one exactly if they are one edit
apart.

Blocks meet only where a link is possible. An edit lies in one half of a word, so the other half is
shared: the words of length m and m + 1 that agree in their first m // 2 code points form one lane,
those that agree in their last m // 2 another, and every near pair shares a lane. A lane of many words
is cut into blocks and every pair of its blocks is a tile of its own; tiles of small lanes travel
together. So a task holds a bounded number of words whatever the vocabulary and its hottest lane.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.llm.common import present, stored
from chronotape.operators.sizing import broadcast_if_small

#: Letters are those of Latin-1, where a code point is a byte: lower-cased, anything else a space.
SPACE = 0x20
LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0xC0 else SPACE for c in bytes(range(256)).lower())
#: One in so many (document, word) pairs loses a code point.
MISSPELT = 97
#: Bytes of text whose words are counted at once, words of a block, rows of tiles that travel together.
TEXT_BYTES, BLOCK, TOGETHER = 1 << 23, 1_024, 8_192
#: Pairs that are compared at once.
STEP = 1 << 19

WORDS = "word string, n long"
LINKS = "word string, near string, near_n long"


def _zeros_after(crc: np.ndarray, most: int) -> np.ndarray:
    """CRC-32 of every prefix followed by 0, 1, ... ``most`` zero bytes; its input is the CRC of the prefix."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    state, out = ~crc.astype(np.uint32), []
    for _ in range(most + 1):
        out.append(~state)
        state = table[state & 0xFF] ^ (state >> 8)
    return np.stack(out, axis=1)


def _text_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    """CRC of each document's prefix ``<doc_id>:`` and its letters, some documents or part of a long one at a time."""
    starts: list[int] = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            letters = text.as_py().encode("latin-1", "replace").translate(LETTERS)
            at = 0
            while at < len(letters):
                end = at + TEXT_BYTES - held
                if end < len(letters):  # cut between two words
                    end = letters.find(b" ", end)
                piece = letters[at:] if end < 0 or end >= len(letters) else letters[at:end]
                starts.append(start), texts.append(piece)
                at += len(piece)
                held += len(piece)
                if held >= TEXT_BYTES:
                    yield starts, texts
                    starts, texts, held = [], [], 0
    yield starts, texts


def count_runs(starts: list[int], texts: list[bytes], least_length: int) -> tuple[list[bytes], np.ndarray]:
    """Words of at least ``least_length`` letters in some texts, misspelt as their documents say, and their counts.

    CRC-32 is affine: that of a prefix and a word is the word's own, changed by a mask that depends on the
    prefix and the word's length alone. So every distinct word is hashed once, not once per document.
    """
    raw = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    inside = raw != SPACE
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begin, length = edges[0::2], np.diff(edges)[0::2]
    wanted = length >= least_length
    values = raw[inside][np.repeat(wanted, length)]
    begin, length = begin[wanted], length[wanted]
    if not len(begin):
        return [], np.zeros(0, dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(length)])
    encoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(values)]).dictionary_encode()
    words, code = encoded.dictionary.to_pylist(), encoded.indices.to_numpy()

    text_at = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    text = np.searchsorted(text_at, begin, side="right") - 1
    # code points beyond ASCII take two bytes in UTF-8
    utf8 = [w if w.isascii() else w.decode("latin-1").encode() for w in words]
    width = np.fromiter((len(w) for w in utf8), dtype=np.int64, count=len(utf8))
    own = np.fromiter((zlib.crc32(w) for w in utf8), dtype=np.uint32, count=len(utf8))
    short = width[code] <= 64
    masks = _zeros_after(np.asarray(starts, dtype=np.uint32), 64) ^ _zeros_after(np.zeros(1, dtype=np.uint32), 64)
    mark = own[code] ^ masks[text, np.minimum(width[code], 64)]
    for at in np.flatnonzero(~short):
        mark[at] = zlib.crc32(utf8[code[at]], starts[text[at]])

    wrong = mark % MISSPELT == 0
    counts = np.bincount(code[~wrong], minlength=len(words))
    changed: Counter = Counter()
    for w, h in zip(code[wrong].tolist(), mark[wrong].tolist(), strict=True):
        cut = h % len(words[w])
        changed[words[w][:cut] + words[w][cut + 1 :]] += 1
    kept = {w: n for w, n in changed.items() if len(w) >= least_length}
    there = np.flatnonzero(counts)
    return [words[w] for w in there] + list(kept), np.concatenate([counts[there], np.fromiter(kept.values(), dtype=np.int64, count=len(kept))])


def word_counts(docs: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """(word, n): distinct words of at least ``least_length`` code points and ``least_count`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, texts in _text_pieces(batches):
            words, n = count_runs(starts, texts, least_length)
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), present(F.col("text")).alias("text"))
    counted = read.mapInArrow(count, WORDS).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _lanes(words: DataFrame, least_length: int) -> DataFrame:
    """Every word once for each lane it belongs to: (word, n, side, m, half)."""
    length = F.char_length("word")

    def lane(side: str, m: Column) -> Column:
        half = F.floor(m / 2).cast("int")
        shared = F.left(F.col("word"), half) if side == "prefix" else F.right(F.col("word"), half)
        return F.struct(F.lit(side).alias("side"), shared.alias("half"))

    # a word is one of the shorter (m) or of the longer (m + 1) of its lanes
    sized = words.withColumn("m", F.explode(F.array(length, length - 1))).where(F.col("m") >= least_length)
    both = sized.withColumn("lane", F.explode(F.array(lane("prefix", F.col("m")), lane("suffix", F.col("m")))))
    return both.select("word", "n", "m", "lane.side", "lane.half")


def _tiles(lanes: DataFrame) -> tuple[DataFrame, int]:
    """Lane rows with the tile (i, j) and block they stand in, and the number of rows."""
    key = ["side", "m", "half"]
    sizes = stored(lanes.groupBy(*key).count().where(F.col("count") > 1), "spelling-lanes")
    blocks = F.ceil(F.col("count") / BLOCK)
    rows = sizes.agg(F.coalesce(F.sum(F.col("count") * (2 * blocks - 1)), F.lit(0)).alias("r")).first()["r"]
    large = broadcast_if_small(sizes.where(F.col("count") > BLOCK).select(*key, blocks.cast("int").alias("blocks")))
    placed = lanes.join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    met = F.array_union(
        F.transform(others, lambda j: F.struct(F.col("block").alias("i"), j.alias("j"))),
        F.transform(others, lambda i: F.struct(i.alias("i"), F.col("block").alias("j"))),
    )
    return placed.withColumn("tile", F.explode(met)).select("word", "n", *key, "block", "tile.i", "tile.j"), int(rows)


def matrix(words: list[bytes], width: int) -> np.ndarray:
    """One row of code points per word, padded with zeros."""
    return np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width)


def letter_sets(codes: np.ndarray) -> np.ndarray:
    """A bit for every code point of a row, modulo 64, as one number."""
    bits = np.where(codes > 0, np.uint64(1) << (codes & 63).astype(np.uint64), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=1)


def _pairs(rows: np.ndarray, tiles: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every left row with each place of the right side of its tile t: ``counts[t]`` places from ``starts[t]``."""
    many = counts[tiles]
    shift = starts[tiles] - (np.cumsum(many) - many)
    places = np.arange(many.sum(), dtype=np.int32)
    places += np.repeat(shift.astype(np.int32), many)
    return np.repeat(rows.astype(np.int32), many), places


def near_in_tiles(rows: pd.DataFrame) -> pd.DataFrame:
    """Links found in some tiles; each pair of words is compared in the lane of the half that it shares."""
    out: list[pd.DataFrame] = []
    for m, lane in rows.groupby("m"):
        m = int(m)
        lane = lane.sort_values(["side", "half", "i", "j"], kind="stable", ignore_index=True)
        words = [w.encode("latin-1") for w in lane["word"]]
        ahead, behind = matrix(words, m + 1), matrix([w[::-1] for w in words], m + 1)
        size = np.fromiter((len(w) for w in words), dtype=np.int64, count=len(words))
        letters = letter_sets(ahead)
        tile = lane.groupby(["side", "half", "i", "j"], sort=False).ngroup().to_numpy()
        block, i, j = (lane[c].to_numpy() for c in ("block", "i", "j"))
        by_suffix = (lane["side"] == "suffix").to_numpy()

        # right sides are runs of rows: those of the second block, tile by tile
        right = np.flatnonzero(block == j).astype(np.int32)
        right_count = np.bincount(tile[right], minlength=tile[-1] + 1)
        starts = np.cumsum(right_count) - right_count
        left = np.flatnonzero((block == i) & (size == m))
        reach = np.cumsum(right_count[tile[left]])
        begin = 0
        while begin < len(left):
            end = max(begin + 1, int(np.searchsorted(reach, (reach[begin - 1] if begin else 0) + STEP, side="right")))
            chosen = left[begin:end]
            begin = end
            a, at = _pairs(chosen, tile[chosen], starts, right_count)
            b = right[at]
            # one edit changes the set of letters by two at most, which leaves few pairs for the matrices
            alike = np.bitwise_count(letters[a] ^ letters[b]) <= 2
            a, b = a[alike], b[alike]
            half = m // 2
            prefix, suffix = _common(ahead, a, b, m), _common(behind, a, b, m)
            near = (prefix + suffix >= size[b] - 1) & ~((size[b] == m) & (prefix == m))
            near &= ~(by_suffix[a] & (prefix >= half))  # found in the lane of the prefix
            a, b = a[near], b[near]
            longer = size[b] > m  # the longer word is never a left side, so its link is made here
            out.append(_links(lane, a, b))
            out.append(_links(lane, b[longer], a[longer]))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"word": [], "near": [], "near_n": []})


def _common(codes: np.ndarray, a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
    """Number of leading code points, at most m, that rows a and b share."""
    same = codes[a, :m] == codes[b, :m]
    first = same.argmin(axis=1)
    return np.where(same[np.arange(len(a)), first], m, first)


def _links(lane: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    word, n = lane["word"].to_numpy(), lane["n"].to_numpy()
    return pd.DataFrame({"word": word[a], "near": word[b], "near_n": n[b]})


def near_words(words: DataFrame, least_length: int) -> DataFrame:
    """(word, near, near_n): every ordered pair of ``words`` (word, n) that one edit makes equal, once."""
    tiles, rows = _tiles(_lanes(words, least_length))
    together = max(1, math.ceil(rows / TOGETHER))
    dealt = tiles.withColumn("bin", F.pmod(F.xxhash64("side", "m", "half", "i", "j"), F.lit(together)))
    return dealt.groupBy("bin").applyInPandas(near_in_tiles, LINKS)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word of ``forms`` (word, form, form_n): the last of the forms that follow it.

    Counts at least double from a word to its form, so a chain has at most log2 of the largest count
    steps; each round follows twice as many, and the rounds are as few as the logarithm of that.
    """
    most = forms.agg(F.max("form_n")).first()[0]  # one number
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(2, math.log2(max(2, most or 1))))) + 1):
        ahead = reached.select(F.col("word").alias("__via"), F.col("root").alias("__far"))
        reached = stored(
            reached.join(ahead, F.col("root") == F.col("__via"), "left").select("word", F.coalesce("__far", "root").alias("root")), "spelling-roots"
        )
    return reached


def spelling_variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2) -> DataFrame:
    """word, n, n_near, form, form_n, root: the vocabulary of ``docs`` with each word's better-known spelling.

    Takes doc_id and text; other columns are ignored. Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``,
    A-Z lower-cased; one (document, word) pair in 97 loses a code point, as its checksum says. A null text
    has no words, a null doc_id counts as the empty string, repeated rows count each, and an empty table
    gives an empty result. ``n_near`` is the number of words one edit away; ``form`` the one of them with
    the largest n (ties: the smallest in code-point order) if that n is at least ``ratio`` times the
    word's, else null; ``root`` the end of the chain of forms, the word itself if it has none.
    """
    words = stored(word_counts(docs, least_length, least_count), "spelling-words")
    links = stored(near_words(words, least_length), "spelling-links")
    best = links.groupBy(F.col("word").alias("__w")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("__best")
    )
    known = -F.col("__best.less") >= ratio * F.col("n")
    judged = words.join(best, F.col("word") == F.col("__w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(known, F.col("__best.near")).alias("form"), F.when(known, -F.col("__best.less")).alias("form_n"),
    )
    judged = stored(judged, "spelling-forms")
    followed = roots(judged.where(F.col("form").isNotNull())).withColumnRenamed("word", "__w")
    return judged.join(followed, F.col("word") == F.col("__w"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
