"""URL filters: host and path rules first, association rules mined from labelled URLs for the rest.

FP-growth finds the combinations of URL tokens that are frequent among labelled URLs, the label being a
token itself. A combination becomes a rule for a label if the label holds for enough of the URLs that
contain it, and is dropped if a part of it is as sure. Rules are matched through an inverted index: a
rule is filed under its rarest token, so a URL looks up only rules that one of its tokens leads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.llm.common import stored
from chronotape.operators.sizing import broadcast_if_small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Verdict and rule: a host without scheme, then the beginning of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Share of the labelled URLs that a combination and its label must reach, share of the combination's URLs
#: that have the label, and tokens of a combination.
SUPPORT, CONFIDENCE, TOKENS = 0.01, 0.9, 3
LABEL = "label="


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def query_of(url: Column) -> Column:
    """After the first ``?`` behind the path up to ``#`` or the end; empty without one."""
    return F.coalesce(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does. Rules are few and part of the plan."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for judged, rule in sorted(rules, key=lambda r: len(r[1])):
        own, slash, begin = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(slash + begin))
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, judged).otherwise(verdict)
    return name, verdict


def url_tokens(host: Column, path: Column, query: Column) -> Column:
    """The distinct tokens of a URL: labels of its host, runs of its path, keys of its query."""
    runs = F.filter(F.split(path, "[^0-9A-Za-z]+"), lambda t: t != "")
    keys = F.filter(F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1)), lambda t: t != "")
    labels = F.filter(F.split(host, r"\."), lambda t: t != "")

    def marked(place: str, part: Column) -> Column:
        return F.transform(part, lambda t: F.concat(F.lit(f"{place}:"), t))

    return F.array_distinct(F.concat(marked("host", labels), marked("path", runs), marked("query", keys)))


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, tokens: int = TOKENS) -> DataFrame:
    """(label, body, n, confidence, lead): combinations of at most ``tokens`` tokens that are sure of a label.

    ``labelled`` has tokens (distinct, without nulls) and label; rows without a label are ignored. ``n``
    counts the URLs that hold the body and the label, at least ``support`` of all labelled URLs;
    ``lead`` is the body's rarest token. A body is dropped if a part of it is as sure of the same label.
    The number of rules is bounded by 1 / support and the tokens of a URL, not by the number of URLs.
    """
    marked = F.concat(F.lit(LABEL), F.col("label"))
    baskets = labelled.where(F.col("label").isNotNull()).select(F.array_append("tokens", marked).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=support).fit(baskets).freqItemsets
    sets = stored(found.select(F.array_sort("items").alias("items"), F.col("freq").alias("n")).where(F.size("items") <= tokens + 1), "url-itemsets")

    is_label = F.exists("items", lambda t: F.startswith(t, F.lit(LABEL)))
    bodies = sets.where(~is_label & (F.size("items") <= tokens)).select(F.col("items").alias("body"), F.col("n").alias("body_n"))
    with_label = sets.where(is_label & (F.size("items") > 1)).select(
        F.filter("items", lambda t: ~F.startswith(t, F.lit(LABEL))).alias("of"),
        F.element_at(F.filter("items", lambda t: F.startswith(t, F.lit(LABEL))), 1).alias("label"), "n",
    )
    sure = with_label.join(bodies, F.col("of") == F.col("body")).withColumn("confidence", F.col("n").cast("double") / F.col("body_n"))
    sure = stored(sure.where(F.col("confidence") >= confidence).select("label", "body", "n", "confidence"), "url-rules")

    # every proper part of a body that is as sure makes it redundant
    part = F.explode(F.filter(_parts(F.col("body"), tokens), lambda p: F.size(p) < F.size("body")))
    parts = sure.select(F.col("label").alias("l"), F.col("body").alias("whole"), F.col("confidence").alias("c"), part.alias("part"))
    general = sure.select("label", F.col("body").alias("general"), F.col("confidence").alias("general_c"))
    redundant = parts.join(general, (F.col("part") == F.col("general")) & (F.col("l") == F.col("label")) & (F.col("general_c") >= F.col("c")))
    kept = sure.join(redundant.select("l", "whole").distinct(), (F.col("label") == F.col("l")) & (F.col("body") == F.col("whole")), "left_anti")

    counts = bodies.where(F.size("body") == 1).select(F.col("body")[0].alias("token"), "body_n")
    led = kept.select("label", "body", "n", "confidence", F.explode("body").alias("token")).join(counts, "token")
    lead = F.min(F.struct("body_n", "token"))["token"].alias("lead")
    return led.groupBy("label", "body", "n", "confidence").agg(lead).withColumn("label", F.substring_index("label", "=", -1))


def _parts(body: Column, tokens: int) -> Column:
    """All non-empty subsets of a sorted array of at most ``tokens`` elements, each sorted."""

    def grown(subsets: Column, k: int) -> Column:
        more = F.transform(subsets, lambda s: F.array_append(s, F.get(body, F.lit(k))))
        return F.concat(subsets, F.when(F.size(body) > k, more).otherwise(F.array().cast("array<array<string>>")))

    subsets = F.array(F.array().cast("array<string>"))
    for k in range(tokens):
        subsets = grown(subsets, k)
    return F.filter(subsets, lambda s: F.size(s) > 0)


def matched_label(urls: DataFrame, rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and label of every row of ``urls``, which also has tokens: that of the surest rule it holds, or null.

    Ties go to the rule met more often, then to the smaller body in code-point order, then to the smaller label.
    """
    index = rules.select("lead", "body", F.struct((-F.col("confidence")).alias("c"), (-F.col("n")).alias("n"), "body", "label").alias("rank"))
    met = urls.select(*keys, "tokens", F.explode_outer("tokens").alias("token")).join(
        broadcast_if_small(index), (F.col("token") == F.col("lead")) & (F.size(F.array_except("body", "tokens")) == 0), "left"
    )
    return met.groupBy(*keys).agg(F.min("rank")["label"].alias("label"))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labels: DataFrame | None = None, support: float = SUPPORT,
    confidence: float = CONFIDENCE, default: str = "allow",
) -> DataFrame:
    """page_id, host, path, rule, verdict, learned: every URL judged by rules, else by what labels teach, else ``default``.

    Takes page_id and url; other columns are ignored. A host rule fits the host and its subdomains where
    the path begins as the rule's; the longest wins. ``labels`` (url, label) teaches the association
    rules; without it the URLs that ``rules`` decide do. ``learned`` is the label of the surest mined rule
    a URL holds, null if none. A null URL, or one without ``://``, has an empty host and path and no
    tokens, and gets the default. Repeated rows count each; an empty table gives an empty result.
    """
    def parsed(df: DataFrame, *columns: str) -> DataFrame:
        read = df.select(*columns, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), query_of(F.col("url")).alias("query"))
        return read.select(*columns, "host", "path", url_tokens(F.col("host"), F.col("path"), F.col("query")).alias("tokens"))

    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = parsed(pages, "page_id", "url").select(
        F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"), "host", "path", "tokens",
        rule.alias("rule"), verdict.alias("by_rule"),
    )
    judged = stored(judged, "url-parts")
    taught = judged.select("tokens", F.col("by_rule").alias("label")) if labels is None else parsed(labels, "url", "label").select("tokens", "label")
    found = matched_label(judged, mined_rules(taught, support, confidence), ["row", "page_id", "host", "path", "rule", "by_rule"])
    return found.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "label", F.lit(default)).alias("verdict"), F.col("label").alias("learned"))
