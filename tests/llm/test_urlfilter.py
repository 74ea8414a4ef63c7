import math
import re

from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from loomdoc.llm import urlfilter as U

PAGE = "page_id long, url string"


def parts(url):
    if not url or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    return re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]


def rule(host, path):
    fit = [r for r in U.RULES if (host == r[0].split("/")[0] or host.endswith("." + r[0].split("/")[0])) and path.startswith("/" + r[0].split("/", 1)[1])]
    return max(fit, key=lambda r: len(r[0]), default=(None, None))


def model(urls, order=3):
    """Mean log ratio a character of every string, by the formulas in plain Python."""
    plain = lambda s: re.sub("[^\x20-\x7e]", "\2", s)
    counts = {v: {} for v in ("allow", "block")}
    for s, v in urls.items():
        p = "\1" * order + plain(s) + "\1"
        for i in range(order, len(p)):
            if v:
                for n in range(order + 1):
                    c = counts[v].setdefault(p[i - n : i], {})
                    c[p[i]] = c.get(p[i], 0) + 1

    def prob(v, context, char):
        out = 1 / U.ALPHABET
        for n in range(order + 1):
            c = counts[v].get(context[len(context) - n :], {})
            if c:
                out = (c.get(char, 0) + len(c) * out) / (sum(c.values()) + len(c))
        return out

    scores = {}
    for s in urls:
        p = "\1" * order + plain(s) + "\1"
        r = [round(math.log(prob("allow", p[i - order : i], p[i]) / prob("block", p[i - order : i], p[i])) * U.MICRO) for i in range(order, len(p))]
        scores[s] = sum(r) / len(r) / U.MICRO
    return scores


def test_rules_and_scores(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    url = {r["page_id"]: r["url"] for r in pages.collect()}
    got = U.judge(pages).collect()
    assert len(got) == len(url)
    hosts = {i: parts(u) for i, u in url.items()}
    want = model({h + p: rule(h, p)[1] for h, p in hosts.values()})
    for r in got:
        h, p = hosts[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (h, p, rule(h, p)[0])
        assert abs(r["score"] - want[h + p]) < 1e-5
        assert r["verdict"] == rule(h, p)[1] if r["rule"] else r["verdict"] in ("allow", "block")


def test_learns_what_rules_do_not_say(spark):
    rows = [(i, f"http://good{i % 7}.net/de/{i}") for i in range(100)] + [(100 + i, f"http://bad{i % 7}.com/en/{i}") for i in range(100)]
    rows += [(500, "http://good3.info/de/5"), (501, "http://bad2.info/en/5")]
    got = {r["page_id"]: r["verdict"] for r in U.judge(spark.createDataFrame(rows, PAGE)).collect()}
    assert (got[500], got[501], got[0], got[100]) == ("allow", "block", "allow", "block")


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "no scheme/en/"), (4, "HTTP://WWW.Example.COM/en/7?x#y"), (5, "x://com/en/1"), (6, "x://notcom/en/1"), (7, "://a.example.net/de/88"), (8, "x://é.org/es/ü"), (9, "x://net?/de/"), (10, "x://a://b/en/"), (10, "x://a://b/en/"), (None, "x://q.net/de/1")]
    want = sorted(((i, *parts(u), rule(*parts(u))[0]) for i, u in rows), key=str)
    base = spark.createDataFrame(rows, PAGE)
    for table in (base, base.withColumns({c: F.lit("x") for c in ("host", "path", "s", "gram", "rule", "verdict", "score", "ratio")})):
        got = U.judge(table).collect()
        assert sorted(((r["page_id"], r["host"], r["path"], r["rule"]) for r in got), key=str) == want
        assert all(r["verdict"] == "allow" for r in got if r["page_id"] in (1, 2, 3))
    assert U.judge(base.limit(0)).count() == 0
    unruled = U.judge(base.where("page_id IN (1, 6, 9)")).collect()
    assert {r["verdict"] for r in unruled} == {"allow"}


def test_very_long_urls(spark):
    """Urls of 40,000 characters are judged whole: a rule's, and one that differs from it at its end only."""
    long = "a/bc?" * 8000
    rows = [(1, f"http://x.org/es/{'abc/' * 10_000}"), (2, f"http://x.info/{'abc/' * 10_000}en"), (3, f"http://example.com/en/7{long}")]
    rows += [(10 + i, f"http://good{i}.net/de/{i}") for i in range(20)]
    got = {r["page_id"]: r for r in U.judge(spark.createDataFrame(rows, PAGE)).collect()}
    assert (got[1]["rule"], got[1]["verdict"]) == ("org/es/", "block") and len(got[1]["path"]) == 40_004
    assert got[2]["rule"] is None and len(got[2]["path"]) == 40_003 and math.isfinite(got[2]["score"])
    assert (got[3]["rule"], got[3]["path"]) == ("example.com/en/7", "/en/7a/bc")
