import itertools
import math
import re
from collections import Counter

from chronotape.llm.url_rules import RULES, judge_urls, mined_rules

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    found = re.search(r"://([^/?#]*)([^?#]*)(?:\?([^#]*))?", url or "")
    return (found[1].translate(UPPER), found[2], found[3] or "") if found else ("", "", "")


def by_rule(host, path):
    fits = [
        (len(rule), rule, verdict) for verdict, rule in RULES
        if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith(rule[rule.index("/") :])
    ]
    return max(fits)[1:] if fits else (None, None)


def tokens(url):
    host, path, query = parts(url)
    found = [f"host:{t}" for t in host.split(".") if t] + [f"path:{t}" for t in re.split("[^0-9A-Za-z]+", path) if t]
    return set(found + [f"query:{k}" for p in query.split("&") if (k := p.split("=")[0])])


def brute_rules(labelled, support, confidence, most=3):
    least = math.ceil(support * len(labelled))
    bodies, whole = Counter(), Counter()
    for held, label in labelled:
        for k in range(1, most + 1):
            for body in itertools.combinations(sorted(held), k):
                bodies[body] += 1
                whole[body, label] += 1
    sure = {key: n for key, n in whole.items() if n >= least and n / bodies[key[0]] >= confidence}
    kept = {}
    for (body, label), n in sure.items():
        smaller = [p for k in range(1, len(body)) for p in itertools.combinations(body, k)]
        if not any((p, label) in sure and sure[p, label] / bodies[p] >= n / bodies[body] for p in smaller):
            kept[body, label] = (n / bodies[body], n)
    return kept


def brute(rows, support, confidence, labels=None):
    labels = [(u, v) for _, u in rows if (v := by_rule(*parts(u)[:2])[1])] if labels is None else labels
    rules = brute_rules([(tokens(u), v) for u, v in labels if v], support, confidence)
    out = []
    for page_id, url in rows:
        host, path, _ = parts(url)
        rule, verdict = by_rule(host, path)
        held = tokens(url)
        met = sorted((-c, -n, body, label) for (body, label), (c, n) in rules.items() if held >= set(body))
        out.append((page_id, host, path, rule, verdict or (met[0][3] if met else "allow")))
    return sorted(out, key=str)


def run(spark, rows, **given):
    frame = spark.createDataFrame([(i, u, "mine", "mine", "mine") for i, u in rows], "page_id long, url string, verdict string, tokens string, label string")
    out = judge_urls(frame, **given).select("page_id", "host", "path", "rule", "verdict")
    return sorted(map(tuple, out.collect()), key=str)


ODD = [
    (1, None), (None, "http://x.net/a"), (2, ""), (3, "no scheme"), (4, "://"), (5, "http://NET"), (6, "http://Net?x"), (7, "HTTP://A.B.NET/q#://c.org/fr/"),
    (8, "http://example.net/en/1"), (9, "http://notexample.net/en/1"), (10, "http://www.example.com/de"), (11, "http://www.example.com/de/"), (12, "http://org/fr/x?y"),
    (13, "http://a.org#/fr/"), (14, "a://b://c.net/"), (15, "http://É.net/\u4e2d/x"), (16, "http://x.net/" + "a/" * 3_000), (16, "http://x.net/" + "a/" * 3_000),
    (17, "http://..net//"), (18, "http://line\nbreak.net/a\nb?c\nd"), (19, "http://q.io/?=1&&a&b=c=d&a=2#?z=1"),
]


def urls(n):
    hosts = ["shop.example.com", "ads-track.example.net", "news.example.org", "blog.example.com", "m.example.net", "free.example.io"]
    return [
        (100 + k, f"http{'s' * (k % 2)}://{hosts[k % 6]}/{('en', 'de', 'fr', 'es')[(k // 6) % 4]}/{k}{('', '.html', '?utm_source=f', '?page=2&ref=x')[k % 4 if k % 3 else 0]}")
        for k in range(n)
    ]


def test_equals_brute_force_with_odd_urls(spark):
    rows = ODD + urls(240)
    want = brute(rows, 0.01, 0.9)
    assert run(spark, rows) == want and {r[4] for r in want if r[3] is None} == {"allow", "block"}
    for support, confidence in ((0.05, 0.6), (0.002, 1.0), (0.3, 0.5)):
        assert run(spark, rows, support=support, confidence=confidence) == brute(rows, support, confidence)


def test_given_labels_teach(spark):
    rows = ODD + urls(60)
    labels = [(u, "block" if "ads-track" in u or "utm_source" in u else "allow") for _, u in urls(200)] + [(None, "block"), ("http://a.io/", None)]
    frame = spark.createDataFrame(labels, "url string, label string")
    assert run(spark, rows, labels=frame) == brute(rows, 0.01, 0.9, labels)


def test_nothing_to_learn_from(spark):
    assert run(spark, []) == []
    rows = [(1, None), (2, "http://a.example.io/x")]
    assert run(spark, rows) == brute(rows, 0.01, 0.9) == [(1, "", "", None, "allow"), (2, "a.example.io", "/x", None, "allow")]


def test_redundant_rules_are_dropped_and_leads_are_rare(spark):
    labelled = [(["a", "b"], "block")] * 4 + [(["a"], "allow")] * 6 + [(["c", "b"], "block")] * 2 + [(["c"], None)] * 9
    found = mined_rules(spark.createDataFrame(labelled, "tokens array<string>, label string"), 0.1, 0.9)
    assert {(r.label, tuple(r.body), r.lead) for r in found.collect()} == {("block", ("b",), "b"), ("block", ("c",), "c")}


def test_a_url_that_most_rows_share(spark):
    rows = [(k, "http://x.net/same") for k in range(400)] + urls(30)
    got = run(spark, rows)
    assert got == brute(rows, 0.01, 0.9)
