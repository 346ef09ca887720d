"""Quality rules whose cutoffs carry a guarantee on labelled data.

Each rule compares one rate of a text with a cutoff. A cutoff is certified for a stratum (a language)
when the labelled good documents it rejects are so few that, were its true false rejection rate above
the limit, so few would be seen with probability ``delta / tests`` at most: the exact lower tail of a
binomial. Cutoffs are tested from loose to strict and testing stops at the first failure, which needs
no correction within a rule; Bonferroni's covers the rules and strata. Of the certified cutoffs the one
with the best balance of bad and good documents rejected is used, the loosest on ties.

Everything is DataFrame functions. What is collected or broadcast is one row per stratum.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from chronotape.llm.common import WORD, present, stored
from chronotape.operators.sizing import broadcast_if_small

#: The stratum of the labelled documents of all languages, for languages with too few for cutoffs of their own.
POOLED = "*"
#: Each rule's rate and its grid of cutoffs, from loose to strict: start, end, ratio of neighbours.
RULES: dict[str, tuple[str, float, float]] = {
    "symbols": ("n_symbols / n_words", 4.0, 0.01),
    "repeats": ("n_repeat_words / n_words", 0.5, 0.01),
    "duplicate_lines": ("n_dup_lines / n_lines", 0.9, 0.01),
    "capitals": ("n_capitals / word_chars", 0.9, 0.01),
    "marks": ("n_marks / n_words", 4.0, 0.01),
    "long_words": ("word_chars / n_words", 60.0, 3.0),
}
STEPS = 40


@dataclass(frozen=True)
class RiskLimit:
    """A rule rejects at most ``alpha`` of a stratum's good documents, in all strata and rules together
    with probability ``1 - delta``. Languages with fewer than ``own`` labelled good documents use the
    stratum of all languages."""

    alpha: float = 0.02
    delta: float = 0.05
    own: int = 400
    #: What a rejected good document costs, as a multiple of what a rejected bad one gains.
    good_cost: float = 50.0


def measure(docs: DataFrame) -> DataFrame:
    """Add the counts the rules use; every other column stays, and columns of these names are replaced.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_marks (long) and
    base_failed. Windows of three words are compared by a 64-bit hash within one text. A null text
    counts as empty.
    """
    kept = [c for c in docs.columns if c not in MEASURES]
    text = present(F.col("text"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

    def without(pattern: str) -> Column:
        return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")

    split = docs.select(
        *kept,
        F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "").alias("__words"),
        lines.alias("__lines"),
        without(r"[#*$%&|<>]+").alias("n_symbols"),
        without(r"\p{Lu}+").alias("n_capitals"),
        without(r"[!?]+").alias("n_marks"),
    )
    n = F.size("__words")
    counted = split.select(
        *kept, "n_symbols", "n_capitals", "n_marks",
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.expr("transform(slice(__words, 1, size(__words) - 2), (w, i) -> xxhash64(w, get(__words, i + 1), get(__words, i + 2)))"))
        .otherwise(F.expr("CAST(array() AS ARRAY<BIGINT>)")).alias("__windows"),
    )
    repeated = F.expr("size(array_distinct(__windows)) < size(__windows)")
    # sorted by hash, then place: equal windows are neighbours
    ordered = counted.withColumn(
        "__windows", F.when(repeated, F.expr("sort_array(transform(__windows, (h, i) -> struct(h AS h, i AS i)))"))
    )
    places = ordered.withColumn(
        "__windows",
        F.expr(
            "sort_array(array_distinct(flatten(zip_with(slice(__windows, 1, size(__windows) - 1), slice(__windows, 2, size(__windows) - 1),"
            " (a, b) -> if(a.h = b.h, array(a.i, b.i), CAST(array() AS ARRAY<INT>))))))"
        ),
    )
    covered = F.expr(
        "aggregate(zip_with(slice(__windows, 1, size(__windows) - 1), slice(__windows, 2, size(__windows) - 1), (a, b) -> least(3, b - a)),"
        " 3L, (s, x) -> s + x)"
    )
    out = places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("__windows")
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return out.withColumn("base_failed", failed).select(*kept, *MEASURES)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks", "base_failed")


def cutoff(rule: str, step: int) -> float:
    """The step-th cutoff of a rule's grid, 0 being the loosest."""
    _, loose, strict = RULES[rule]
    return loose * (strict / loose) ** (step / (STEPS - 1))


def _rate(rule: str) -> Column:
    return F.expr(f"coalesce(try_divide(CAST({RULES[rule][0].replace(' / ', ' AS DOUBLE), ')}), 0D)")


def _level(rule: str) -> Column:
    """How many of the rule's cutoffs the document exceeds when counted from the strictest: 0 to STEPS."""
    grid = F.array(*[F.lit(cutoff(rule, s)) for s in range(STEPS)])
    return F.size(F.filter(grid, lambda c: c < _rate(rule)))


def fit_cutoffs(measured: DataFrame, labels: DataFrame, limit: RiskLimit = RiskLimit()) -> DataFrame:
    """One row per labelled language: lang, its ``stratum`` and ``cut_<rule>`` (null where no cutoff is certified).

    Every row also has the cutoffs of all languages together, ``rest_cut_<rule>``, for languages without labels.
    ``measured`` has doc_id, lang and :data:`MEASURES`; ``labels`` has doc_id and quality (1 good, 0 bad).
    Repeated labels of a document count once, contradictory ones not at all. Documents that fail the
    base rules are no evidence about the others and are left out.
    """
    truth = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("quality").alias("__max"))
    truth = truth.where(F.col("good") == F.col("__max")).drop("__max")
    held = measured.where(~F.col("base_failed")).select("doc_id", present(F.col("lang")).alias("lang"), *[_level(r).alias(f"__{r}") for r in RULES])
    held = held.join(truth, "doc_id")
    levels = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"__{r}").alias("level")) for r in RULES])
    cells = held.select("lang", "good", F.explode(levels).alias("x")).groupBy("lang", F.col("x.rule").alias("rule"), F.col("x.level").alias("level"))
    cells = stored(cells.agg(F.sum("good").alias("n_good"), F.sum(1 - F.col("good")).alias("n_bad")), "quality-cells")

    sizes = cells.where(F.col("rule") == next(iter(RULES))).groupBy("lang").agg(F.sum("n_good").alias("n"))
    strata = sizes.select("lang", F.when(F.col("n") >= limit.own, F.col("lang")).otherwise(F.lit(POOLED)).alias("stratum"))
    named = strata.where(F.col("stratum") != POOLED)
    pooled = cells.join(named, "lang").drop("lang").unionByName(cells.drop("lang").withColumn("stratum", F.lit(POOLED)))
    pooled = pooled.groupBy("stratum", "rule", "level").agg(F.sum("n_good").alias("n_good"), F.sum("n_bad").alias("n_bad"))

    # a document of level v is rejected by the v strictest cutoffs, that is by steps STEPS - v and above
    steps = F.sequence(F.lit(0), F.lit(STEPS - 1))
    by = ["stratum", "rule"]
    grid = pooled.groupBy(*by).agg(F.sum("n_good").alias("all_good"), F.sum("n_bad").alias("all_bad")).withColumn("step", F.explode(steps))
    hits = pooled.select(*by, F.col("level"), F.col("n_good"), F.col("n_bad"))
    rejected = (
        grid.join(hits.withColumn("step", F.lit(STEPS) - F.col("level")), [*by, "step"], "left").withColumns(
            {
                "bad": F.coalesce(F.sum("n_bad").over(W.partitionBy(*by).orderBy("step")), F.lit(0)),
                "good": F.coalesce(F.sum("n_good").over(W.partitionBy(*by).orderBy("step")), F.lit(0)),
            }
        )
    )
    allowed = _allowed(pooled, limit)
    judged = rejected.join(allowed, "stratum").withColumn(
        "certified", F.min((F.col("good") <= F.col("allowed")).cast("int")).over(W.partitionBy(*by).orderBy("step")) == 1
    )
    gain = F.coalesce(F.try_divide("bad", "all_bad"), F.lit(0.0)) - F.lit(limit.good_cost) * F.coalesce(F.try_divide("good", "all_good"), F.lit(0.0))
    chosen = judged.where(F.col("certified") & (gain > 0)).groupBy(*by).agg(F.min(F.struct((-gain).alias("g"), F.col("step"))).alias("best"))
    names = F.create_map(*[x for r in RULES for x in (F.lit(r), F.array(*[F.lit(cutoff(r, s)) for s in range(STEPS)]))])
    cuts = chosen.select("stratum", "rule", F.get(names[F.col("rule")], F.col("best.step")).alias("cut"))
    wide = cuts.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES])
    rest = wide.where(F.col("stratum") == POOLED).select(*[F.col(f"cut_{r}").alias(f"rest_cut_{r}") for r in RULES])
    return stored(strata.join(wide, "stratum", "left").join(F.broadcast(rest), F.lit(True), "left"), "quality-cutoffs")


def _allowed(pooled: DataFrame, limit: RiskLimit) -> DataFrame:
    """Per stratum, the most good documents that a certified cutoff may reject (-1: none can be certified).

    The largest k with P(Binomial(n, alpha) <= k) <= delta / tests, summed in logarithms.
    """
    rule = next(iter(RULES))
    strata = pooled.where(F.col("rule") == rule).groupBy("stratum").agg(F.sum("n_good").cast("double").alias("n"))
    tests = strata.agg((F.count("*") * len(RULES)).alias("tests"))
    odds = f"ln({limit.alpha}D / (1 - {limit.alpha}D))"
    walk = (
        f"aggregate(sequence(0L, CAST(ceil(n * {limit.alpha}D) AS BIGINT)),"
        f" named_struct('term', n * ln(1 - {limit.alpha}D), 'total', CAST('-Infinity' AS DOUBLE), 'allowed', -1L),"
        " (s, k) -> named_struct("
        f"  'term', s.term + {odds} + ln(greatest(n - k, 1e-300D) / (k + 1)),"
        "  'total', greatest(s.total, s.term) + ln(1 + exp(least(s.total, s.term) - greatest(s.total, s.term))),"
        "  'allowed', if(greatest(s.total, s.term) + ln(1 + exp(least(s.total, s.term) - greatest(s.total, s.term)))"
        f"      <= ln({limit.delta}D / tests), k, s.allowed)), s -> s.allowed)"
    )
    return strata.join(F.broadcast(tests)).select("stratum", F.expr(walk).alias("allowed"))


def apply_rules(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Add ``kept``: false for a base failure or where a certified cutoff of the document's stratum is exceeded.

    ``measured`` needs lang and :data:`MEASURES`. A language without labels uses the cutoffs of all languages together.
    """
    cuts = [f"cut_{r}" for r in RULES]
    renamed = cutoffs.select(F.col("lang").alias("__lang"), *[F.col(c).alias(f"__{c}") for c in cuts])
    rest = cutoffs.limit(1).select(*[F.col(f"rest_{c}").alias(f"__rest_{c}") for c in cuts])  # equal in every row
    one = cutoffs.sparkSession.range(1).join(rest, F.lit(True), "left").drop("id")
    joined = measured.join(broadcast_if_small(renamed, 10_000), present(F.col("lang")) == F.col("__lang"), "left").join(F.broadcast(one))
    known = F.col("__lang").isNotNull()
    broken = [
        F.coalesce(_rate(r) > F.when(known, F.col(f"__cut_{r}")).otherwise(F.col(f"__rest_cut_{r}")), F.lit(False)) for r in RULES
    ]
    verdict = ~F.col("base_failed")
    for b in broken:
        verdict = verdict & ~b
    return joined.withColumn("kept", verdict).drop("__lang", *[f"__{c}" for c in cuts], *[f"__rest_{c}" for c in cuts])


def judge_quality(docs: DataFrame, labels: DataFrame, limit: RiskLimit = RiskLimit()) -> DataFrame:
    """Counts and verdict per document: doc_id, lang, :data:`MEASURES`, kept. Texts are read once.

    Repeated rows get the same verdict each; an empty table gives an empty result; with no labels only
    the base rules act.
    """
    measured = stored(measure(docs.select("doc_id", "lang", "text")).drop("text"), "quality-measures")
    return apply_rules(measured, fit_cutoffs(measured, labels, limit))


def keep_quality(docs: DataFrame, labels: DataFrame, limit: RiskLimit = RiskLimit()) -> DataFrame:
    """The documents that pass, with their own columns.

    Cutoffs come from a first pass that keeps counts only, so no text is shuffled.
    """
    counted = stored(measure(docs.select("doc_id", "lang", "text")).drop("text"), "quality-measures")
    cutoffs = fit_cutoffs(counted, labels, limit)
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "text", "lang")
    # a filter would be pushed below the counts and repeat their expressions; it does not pass a row's place
    placed = measure(work).withColumn("__place", F.monotonically_increasing_id())
    return apply_rules(placed, cutoffs).where(F.col("kept") & (F.col("__place") >= 0)).select("__row.*")
