"""Near-duplicate classes: texts linked by a weighted Jaccard similarity of 0.8 or more.

Candidates come from banded consistent weighted samples of TF-IDF weighted five-word shingles, and
every link is verified on the texts themselves. Exact copies are one node. Buckets are never expanded
into all pairs. First every member of a bucket meets the bucket's hub, its most connected member; what
that joins is known to be one class. Only members that are still in another class than their hub then
meet the rest of the bucket, block by block: sketches tell where a link is possible, and those pairs are
verified until the classes are joined. No bucket, member or pair is dropped for its group's size.

At similarity 0.8 a pair shares no band with probability 2e-4 (16 bands of 4 samples). Hubs and members are
verified whatever their sketches say; in the second round an estimate from 64 samples falls below ``POSSIBLE``
with probability 4e-5 at that similarity, so it loses less than the bands do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from chronotape.llm.common import present, stored
from chronotape.llm.components import components
from chronotape.llm.weighted_sets import (
    BANDS, FREQUENCY_BITS, ROWS, SAMPLES, ConsistentSampler, Shingler, buckets, inverse_frequencies, similarity, weights,
)

THRESHOLD = 0.8
#: The least share of equal samples at which a pair is verified in the second round.
POSSIBLE = 38 / SAMPLES
#: Members of a bucket outside its hub's class, and any members, that meet in one group.
BLOCK, REST_BLOCK = 128, 512
_NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    text = present(F.col("text"))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("did"), F.md5(text.cast("binary")).alias("th"), text.alias("text"))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per shingle bucket, over all documents, and the number of documents. The table is of fixed size."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, total = Shingler(), np.zeros((1 << FREQUENCY_BITS) + 1, dtype=np.int64)
        for batch in batches:
            total[-1] += len(batch)
            for text in batch["text"]:
                total[np.unique(buckets(shingler(text)[0]))] += 1
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})

    rows = docs.select(present(F.col("text")).alias("text")).mapInPandas(counts, "bucket long, n long")
    held = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((1 << FREQUENCY_BITS) + 1, dtype=np.int64)
    table[held["bucket"].to_numpy(dtype=np.int64)] = held["n"].to_numpy(dtype=np.int64)
    return table[:-1], int(table[-1])


def signatures(keyed: DataFrame, idf: np.ndarray) -> DataFrame:
    """did, th, sketch and bands of every row; texts without words have no bands."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, sampler = Shingler(), ConsistentSampler()
        for batch in batches:
            sketches, bands = [], []
            for text in batch["text"]:
                shingles, counts = shingler(text)
                if len(shingles):
                    samples = sampler.samples(shingles, weights(shingles, counts, idf))
                    sketches.append(sampler.sketch(samples))
                    bands.append(sampler.bands(samples))
                else:
                    sketches.append(b"")
                    bands.append([])
            yield pd.DataFrame({"did": batch["did"], "th": batch["th"], "sketch": sketches, "bands": bands})

    return keyed.mapInPandas(sign, "did long, th string, sketch binary, bands array<long>")


def _verified(pairs: DataFrame, keyed: DataFrame, nodes: DataFrame, idf: np.ndarray) -> DataFrame:
    """Of ``pairs`` (a, b), those whose texts are similar enough, with their similarity."""
    where = nodes.select("node", "th", "did")

    def named(df: DataFrame, side: str) -> DataFrame:
        names = {"node": side, "th": f"{side}_th", "did": f"{side}_did"}
        return df.join(where.withColumnsRenamed(names), side)

    def texts(side: str) -> DataFrame:
        return keyed.withColumnsRenamed({"th": f"{side}_th", "did": f"{side}_did", "text": f"{side}_text"})

    keys = {side: [f"{side}_th", f"{side}_did"] for side in "ab"}
    full = named(named(pairs, "a"), "b").join(texts("b"), keys["b"]).drop(*keys["b"]).join(texts("a"), keys["a"]).drop(*keys["a"])

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        last: tuple[int, tuple] | None = None
        for batch in batches:
            found = []
            for a, b, a_text, b_text in zip(batch["a"], batch["b"], batch["a_text"], batch["b_text"], strict=True):
                if last is None or last[0] != a:  # rows of a hub arrive together
                    s, n = shingler(a_text)
                    last = a, (s, weights(s, n, idf))
                s, n = shingler(b_text)
                j = similarity(last[1], (s, weights(s, n, idf)))
                if j >= THRESHOLD:
                    found.append((a, b, j))
            yield pd.DataFrame(found, columns=["a", "b", "similarity"]).astype({"a": "int64", "b": "int64", "similarity": float})

    found = full.select("a", "b", "a_text", "b_text").mapInPandas(verify, "a long, b long, similarity double")
    # a row repeated with its id and text would repeat its links
    return found.dropDuplicates(["a", "b"])


class _Group:
    """A block of nodes with their sketches, and their weighted shingles on demand."""

    def __init__(self, frame: pd.DataFrame, shingler: Shingler, idf: np.ndarray) -> None:
        self.ids = frame["node"].to_numpy(dtype=np.int64)
        self.component = frame["component"].to_numpy(dtype=np.int64)
        self.sketch = np.frombuffer(b"".join(bytes(x) for x in frame["sketch"]), dtype="<u2").reshape(-1, SAMPLES)
        self._texts, self._sets, self._shingler, self._idf = frame["text"].tolist(), {}, shingler, idf

    def set(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in self._sets:
            s, n = self._shingler(self._texts[k])
            self._sets[k] = (s, weights(s, n, self._idf))
        return self._sets[k]


def _links_between(band: int, apart: _Group, rest: _Group) -> list[tuple[int, int, float]]:
    """Verified links between two blocks of one bucket that join classes not yet joined by links found here.

    Candidates are met in the order of their estimates, so most classes are joined at the first try. A
    pair belongs to the first band it shares.
    """
    found, root = [], {}

    def top(c: int) -> int:
        while (up := root.get(c, c)) != c:
            c = up
        return c

    pairs = []
    for k in range(len(apart.ids)):
        equal = rest.sketch == apart.sketch[k]
        shared = equal.reshape(-1, BANDS, ROWS).all(axis=2)
        share = equal.mean(axis=1)
        wanted = (rest.component != apart.component[k]) & (share >= POSSIBLE) & shared.any(axis=1) & (shared.argmax(axis=1) == band)
        pairs += [(-share[j], k, j) for j in np.flatnonzero(wanted).tolist()]
    for _, k, j in sorted(pairs):
        one, two = top(int(apart.component[k])), top(int(rest.component[j]))
        if one != two:
            s = similarity(apart.set(k), rest.set(j))
            if s >= THRESHOLD:
                root[one] = two
                a, b = sorted((int(apart.ids[k]), int(rest.ids[j])))
                found.append((a, b, s))
    return found


def _rest(members: DataFrame, keyed: DataFrame, nodes: DataFrame, idf: np.ndarray) -> DataFrame:
    """Further links (a, b, similarity) between classes that meet in some bucket.

    ``members`` has band, key, n, node, component, hub_component and sketch. In buckets with members
    outside the hub's class, those members are cut into blocks of ``BLOCK`` and all members into blocks
    of ``REST_BLOCK``; each pair of blocks is one group, so groups are small whatever a bucket's size, and
    pairs of nodes are never rows.
    """
    # a bucket of two holds only the pair with its hub, which has been judged
    members = members.where("n > 2")
    outside = members.where(F.col("component") != F.col("hub_component"))
    counts = outside.groupBy("key").agg(F.count("*").alias("n_apart"))
    cut = {"blocks": F.ceil(F.col("n_apart") / BLOCK).cast("int"), "rest_blocks": F.ceil(F.col("n") / REST_BLOCK).cast("int")}
    meeting = stored(members.join(counts, "key").withColumns(cut), "near-meeting")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    own_rest = F.pmod(F.xxhash64("node"), F.col("rest_blocks")).cast("int")
    held = ["band", "key", "node", "component", "sketch"]
    apart = meeting.where(F.col("component") != F.col("hub_component")).select(
        *held, own.alias("block"), F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("rest_block")
    )
    rest = meeting.select(*held, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), own_rest.alias("rest_block"))

    where = meeting.select("node").distinct().join(nodes.select("node", "th", "did"), "node")
    texts = keyed.join(where, ["th", "did"]).groupBy("node").agg(F.min("text").alias("text"))
    texts = stored(texts, "near-texts")
    by = ["key", "block", "rest_block"]

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        links = []
        if len(left) and len(right):
            shingler = Shingler()
            links = _links_between(int(left["band"].iloc[0]), _Group(left, shingler, idf), _Group(right, shingler, idf))
        return pd.DataFrame(links, columns=["a", "b", "similarity"]).astype({"a": "int64", "b": "int64", "similarity": float})

    other = rest.join(texts, "node")
    other = other.select(*[F.col(c).alias(f"r_{c}") if c in by else F.col(c).alias(c) for c in other.columns])
    both = apart.join(texts, "node").groupBy(*by).cogroup(other.groupBy(*[f"r_{c}" for c in by]))
    return both.applyInPandas(meet, "a long, b long, similarity double").dropDuplicates(["a", "b"])


def classes(docs: DataFrame) -> DataFrame:
    """Nodes (distinct texts) with their class: th, did (the least id that has the text), node, n_copies, component, and n_links verified."""
    counts, documents = document_frequencies(docs)
    idf = inverse_frequencies(counts, documents)
    keyed = _keyed(docs)
    signed = stored(signatures(keyed, idf), "near-signatures")
    alike = signed.groupBy("th", "sketch", "bands").agg(F.min("did").alias("did"), F.count("*").alias("n_copies"))
    nodes = stored(alike.withColumn("node", F.monotonically_increasing_id()), "near-nodes")

    spread = nodes.select("node", "sketch", F.posexplode("bands").alias("band", "key"))
    sizes = spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(spread.join(sizes, "key"), "near-members")
    fame = members.groupBy("node").agg(F.sum("n").alias("fame"))
    hubs = members.join(fame, "node").groupBy("key").agg(F.max(F.struct("fame", "node")).alias("h"))
    hubs = stored(hubs.select("key", F.col("h.node").alias("hub")), "near-hubs")

    star = members.join(hubs, "key").where("hub != node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(_verified(stored(star, "near-pairs"), keyed, nodes, idf), "near-links")
    label = stored(components(nodes.select("node"), links.select("a", "b")), "near-classes")

    grouped = members.join(label, "node").join(
        hubs.select("key", "hub").join(label.select(F.col("node").alias("hub"), F.col("component").alias("hub_component")), "hub").drop("hub"), "key"
    )
    more = stored(_rest(grouped, keyed, nodes, idf), "near-links")
    if not more.isEmpty():
        links = stored(links.unionAll(more), "near-links")
        label = stored(components(nodes.select("node"), links.select("a", "b")), "near-classes")
    return nodes.drop("bands", "sketch").join(label, "node")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), class_size and kept (one row of each class) per document.

    Takes doc_id and text; other columns are ignored. Null, empty and blank texts differ only as strings:
    null counts as empty, and a text without words is alike only to an equal one. A text of fewer than
    five words is one shingle. Repeated rows are copies of each other; of rows with the class's least id,
    one is kept. An empty table gives an empty result.
    """
    nodes = stored(classes(docs.select("doc_id", "text")), "near-nodes")
    summary = nodes.groupBy("component").agg(
        F.min("did").alias("class_did"), F.sum("n_copies").alias("class_size"), F.min(F.struct("did", "th")).alias("first")
    )
    named = nodes.drop("did").join(summary, "component").select("th", "class_did", "class_size", "first")
    rows = _keyed(docs).select("did", "th").join(named, "th")
    again = F.row_number().over(W.partitionBy("did", "th").orderBy("class_did"))
    kept = (F.struct("did", "th") == F.col("first")) & (again == 1)
    return rows.select(
        F.nullif("did", F.lit(_NO_ID)).alias("doc_id"), F.nullif("class_did", F.lit(_NO_ID)).alias("class_id"), "class_size", kept.alias("kept")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the least id, with its own columns."""
    nodes = stored(classes(docs.select("doc_id", "text")), "near-nodes")
    chosen = nodes.groupBy("component").agg(F.min(F.struct("did", "th")).alias("first")).select("first.did", "first.th")
    chosen = chosen.withColumnsRenamed({"did": "__did", "th": "__th"})
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = F.md5(present(F.col("text")).cast("binary"))
    work = docs.select(F.struct(*columns).alias("__row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("did"), text.alias("th"))
    matched = work.join(chosen, (F.col("did") == F.col("__did")) & (F.col("th") == F.col("__th")))
    # a row repeated with its id and text is kept once
    single = matched.dropDuplicates(["did", "th"])
    return single.select("__row.*")
