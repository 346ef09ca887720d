"""Mix sources to target weights by entropy balancing.

Document rates r minimise ``sum r (log r - 1)`` subject to one token constraint per source,
``sum r * size = target``, and ``0 <= r <= cap``. The dual has one variable per source and the primal
is an exponential tilt, ``r = min(cap, exp(lambda * size / scale))``. Newton's method solves all
sources' duals at once, each step one aggregate over (source, size) cells, kept between brackets that
hold the root. Rates are rounded to whole copies along each source's sizes, so a source's taken words
miss its target by less than one of its largest documents.

Everything is DataFrame functions; sums are of integers or decimals, so reruns agree bit for bit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from chronotape.llm.common import WORD, present, stored

#: Weights of the sources in code point order, repeating; null is the last source.
WEIGHTS = (5, 2, 1)
CAP = 3
#: Relative accuracy asked of each source's dual before rounding, and the most Newton steps taken.
TOLERANCE = 1e-9
MAX_STEPS = 60
#: A (source, size) cell is divided so that about this many rows of it are ranked together.
ROWS_PER_GROUP = 200_000
MIN_DIVISIONS = 64


def word_count(text: Column) -> Column:
    return F.regexp_count(present(text), F.lit(WORD)).cast("long")


def source_key(source: Column) -> Column:
    """A source as a text that is never null and sorts by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Each source's target: its weight's share of all words, at most ``cap`` times what it has.

    ``sizes`` has ``key`` (:func:`source_key`) and source_size, one row per source. What capped sources
    leave is shared again by weight until none is above its cap, which ends at
    target = min(cap * size, weight * level) with one level for all. Sources reach their caps in order
    of size / weight, so the level follows from running sums. These windows pass one narrow row per
    source through a task, never documents.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy("key")) - 1)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod("rank", F.lit(len(weights))))
    held = ranked.select("key", "source_size", weight.cast("long").alias("weight"))
    order = W.orderBy(F.col("source_size") / F.col("weight"), "key")
    filled = held.withColumns(
        {
            "total": F.sum("source_size").over(W.partitionBy()),
            "capped": F.coalesce(F.sum("source_size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) * cap,
            "open": F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)),
        }
    )
    leveled = filled.withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    free = F.col("weight") * F.col("level") <= F.col("source_size") * cap
    common = leveled.withColumn("level", F.min(F.when(free, F.struct("capped", "level"))).over(W.partitionBy())["level"])
    most = (F.col("source_size") * cap).cast("double")
    return common.select("key", "source_size", F.least(most, F.coalesce(F.col("weight") * F.col("level"), most)).alias("target"))


def _solved(cells: DataFrame, cap: int) -> DataFrame:
    """Per source: key, source_size, target, scale, lam. ``cells`` holds (key, size, n)."""
    sizes = cells.groupBy("key").agg(
        F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
        F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("docs"),
    )
    goals = source_targets(sizes.select("key", "source_size"), cap=cap).drop("source_size")
    scale = F.col("source_size") / F.col("docs")
    least = F.col("least") / F.col("scale")
    gap = F.ln(F.try_divide("target", "source_size"))
    # at lambda = log(target / size) / least every rate is below target / size; at log(cap) / least all are at the cap
    state = sizes.join(goals, "key").withColumn("scale", scale).select(
        "key", "source_size", "target", "scale",
        F.coalesce(F.least(gap / least, F.lit(0.0)), F.lit(0.0)).alias("low"),
        F.coalesce(F.when(gap > 0, F.lit(math.log(cap)) / least), F.lit(0.0)).alias("high"),
        F.lit(0.0).alias("lam"),
        (F.col("source_size") == 0).alias("done"),
    )
    state = stored(state, "mixing-dual")
    for _ in range(MAX_STEPS):
        state = stored(_newton(cells, state, cap), "mixing-dual")
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("key", "source_size", "target", "scale", "lam")


def _tilt() -> Column:
    return F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(50.0)))


def _newton(cells: DataFrame, state: DataFrame, cap: int) -> DataFrame:
    """One step for every unsolved source, or a bisection where the step would leave the bracket."""
    tilt, exact = _tilt(), "decimal(38,9)"
    words = F.col("size") * F.col("n")
    parts = (
        cells.where("size > 0").join(state.where(~F.col("done")).select("key", "scale", "lam"), "key")
        .groupBy("key").agg(
            F.sum((F.least(F.lit(float(cap)), tilt) * words).cast(exact)).cast("double").alias("taken"),
            F.sum(F.when(tilt < cap, tilt * F.col("size") / F.col("scale") * words).otherwise(0.0).cast(exact)).cast("double").alias("slope"),
        )
    )
    error = F.col("taken") - F.col("target")
    close = F.abs(error) <= F.greatest(F.col("target") * TOLERANCE, F.lit(1e-6))
    done = F.col("done") | close | (F.col("high") - F.col("low") <= F.abs(F.col("lam")) * 1e-15)
    narrowed = state.join(parts, "key", "left").withColumns(
        {
            "low": F.when(error <= 0, F.col("lam")).otherwise(F.col("low")),
            "high": F.when(error >= 0, F.col("lam")).otherwise(F.col("high")),
        }
    )
    step = F.col("lam") - F.try_divide(error, F.col("slope"))
    inside = (step > F.col("low")) & (step < F.col("high"))
    following = F.when(inside, step).otherwise((F.col("low") + F.col("high")) / 2)
    return narrowed.select(
        "key", "source_size", "target", "scale", "low", "high",
        F.when(done, F.col("lam")).otherwise(following).alias("lam"), done.alias("done"),
    )


def _nearer(whole: DataFrame, cap: int) -> DataFrame:
    """Give or take one copy in the cell whose size is nearest to what its source misses, if that helps."""
    missing = whole.groupBy("key").agg((F.max("target") - F.sum(F.col("__whole") * F.col("size"))).alias("miss"))
    gap = F.abs(F.col("size") - F.abs("miss"))
    room = F.when(F.col("miss") > 0, F.col("__whole") < F.col("cell_n") * cap).otherwise(F.col("__whole") > 0)
    usable = (F.col("size") > 0) & room & (gap < F.abs("miss"))
    chosen = whole.join(missing, "key").where(usable).groupBy("key").agg(F.min(F.struct(gap.alias("g"), "size", "miss")).alias("pick"))
    change = F.when(F.col("size") == F.col("pick.size"), F.signum("pick.miss").cast("long")).otherwise(F.lit(0).cast("long"))
    changed = whole.join(chosen, "key", "left").withColumn("__whole", F.col("__whole") + F.coalesce(change, F.lit(0)))
    return stored(changed.drop("pick"), "mixing-cells")


def mix_sources(docs: DataFrame, cap: int = CAP) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken (= copies * size) per document.

    Takes doc_id, source, text. A null text has size 0; documents of size 0 keep one copy and count for
    nothing. Repeated rows are separate documents. An empty table gives an empty result. No document
    has more than ``cap`` copies. Which documents of one source and size get the extra copy is decided
    by a hash of their id and text.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", *_basis())
    return _with_copies(stored(narrow, "mixing-sizes"), cap)


def mixed_documents(docs: DataFrame, cap: int = CAP) -> DataFrame:
    """The mix itself: every document as many times as its copies, with its own columns.

    Only counts are gathered to decide the copies; texts are dealt once, by source, size and division.
    """
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *_basis())
    copied = _with_copies(work, cap).where("copies > 0")
    return copied.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*")


def _basis() -> list[Column]:
    return [
        source_key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"),
        F.xxhash64(F.lit(7), F.col("doc_id"), F.col("text")).alias("__h"),
    ]


def _with_copies(rows: DataFrame, cap: int) -> DataFrame:
    """Add the result columns to rows that have key, size and __h, and drop key and __h."""
    divisions = max(MIN_DIVISIONS, -(-rows.count() // ROWS_PER_GROUP))
    dealt = rows.withColumn("__d", F.pmod(F.xxhash64(F.lit(11), "__h"), F.lit(divisions)).cast("int"))
    groups = stored(dealt.groupBy("key", "size", "__d").agg(F.count("*").alias("n")), "mixing-groups")
    cells = groups.groupBy("key", "size").agg(F.sum("n").alias("cell_n"))
    rate = F.when(F.col("target") >= F.col("source_size") * cap, F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), _tilt()))
    state = _solved(cells.withColumnRenamed("cell_n", "n"), cap)
    rated = cells.join(state, "key").withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(1.0))
    # whole copies per cell: where the running sum of rates along the sizes passes a half
    along = W.partitionBy("key").orderBy("size")
    reached = F.sum((F.col("rate") * F.col("cell_n")).cast("decimal(38,9)")).over(along.rowsBetween(W.unboundedPreceding, 0))
    whole = (
        rated.withColumn("__passed", F.floor(reached + F.lit("0.5").cast("decimal(2,1)")).cast("long"))
        .withColumn("__whole", F.col("__passed") - F.lag("__passed", 1, 0).over(along))
        .withColumn("__whole", F.when(F.col("size") > 0, F.least(F.col("cell_n") * cap, F.col("__whole"))).otherwise(F.col("cell_n")))
        .select("key", "size", "cell_n", "__whole", "source_size", "target", "rate")
    )
    whole = _nearer(_nearer(stored(whole, "mixing-cells"), cap), cap)
    # and per division of the cell, by the same rule in whole numbers
    inner = W.partitionBy("key", "size").orderBy("__d")
    shared = (
        groups.join(whole, ["key", "size"])
        .withColumn("__upto", F.sum("n").over(inner.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("__upto", F.expr("CAST(CAST(__upto AS DECIMAL(19,0)) * CAST(__whole AS DECIMAL(19,0)) div cell_n AS BIGINT)"))
        .withColumn("__share", F.col("__upto") - F.lag("__upto", 1, 0).over(inner))
        .select("key", "size", "__d", "n", "__share", "source_size", "target", "rate")
    )
    ranked = dealt.withColumn("__rank", F.row_number().over(W.partitionBy("key", "size", "__d").orderBy("__h")))
    placed = ranked.join(shared, ["key", "size", "__d"])
    copies = F.expr("CAST(__share div n AS INT)") + F.when(F.col("__rank") <= F.col("__share") % F.col("n"), 1).otherwise(0)
    out = placed.withColumn("copies", copies).withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
    return out.drop("key", "__h", "__d", "n", "__share", "__rank")
