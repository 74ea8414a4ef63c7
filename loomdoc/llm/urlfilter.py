"""URL filter: ratio of two character language models, under rules (DataFrame functions only).

Rules (host and path prefix) decide the URLs they fit, the longest rule first; a rule fits its host
and all subdomains.  The URLs that rules allow and block are also what two models learn from: variable-order
Markov models over characters, contexts of up to ORDER characters, each order interpolated with the
next shorter one by Witten-Bell weights, so an unseen context falls back to a shorter one.  A URL
without a rule is blocked where its log-likelihood ratio (allowed over blocked) per character is
below a threshold, calibrated on the ruled URLs: the point as many deviations below the allowed
mean as above the blocked mean.  Without ruled URLs of both kinds it is allowed.

Scale.  URLs are counted per distinct URL, then per n-gram with partial aggregation; the model's tables
have a row per distinct n-gram of ORDER + 1 characters (those past ASCII are one character), at most
ALPHABET**(ORDER + 1), and are joined, never collected.  Ratios are summed as whole micro-units, so
sums do not depend on their order.  Three numbers reach the driver.

Cases: null, empty and schemeless URLs have empty host and path, no rule, and are allowed; repeated rows
are judged alike and weigh in the models once (distinct host and path); an empty table gives an empty
result; only page_id and url are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

ORDER, ALPHABET = 3, 128
#: (rule, verdict) of the production filter.
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))
_EDGE, _OTHER = "\u0001", "\u0002"
MICRO = 1_000_000


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, slash, start = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """A row per character of s and its end, with the characters before it: gram of order + 1."""
    plain = F.regexp_replace("s", "[^\\x20-\\x7E]", _OTHER)
    padded = F.concat(F.lit(_EDGE * order), plain, F.lit(_EDGE))
    # one pass of a pattern that looks ahead and moves on by one character: linear in the URL, as substr at every place is not
    every = F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{order + 1}}}))"), F.lit(1))
    return urls.withColumn("gram", F.explode(every))


def ratios(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio): log-likelihood ratio, in micro-units, of the last character of every gram of urls
    (s, verdict of its rule or null) after the others, by the models of allowed and blocked URLs."""
    label = {"a": "allow", "b": "block"}
    counts = _grams(urls, order).groupBy("gram").agg(*[F.count(F.when(F.col("verdict") == v, 1)).alias(k) for k, v in label.items()])
    counts = written(counts, "url-grams")
    table, prob = counts.select("gram"), {k: F.lit(1.0 / ALPHABET) for k in label}
    for n in range(order + 1):  # n characters of context
        seen = counts.groupBy(F.substr("gram", F.lit(order + 1 - n), F.lit(n + 1)).alias(f"g{n}")).agg(*[F.sum(k).alias(f"c{n}{k}") for k in label])
        context = F.substr(f"g{n}", F.lit(1), F.lit(n)).alias(f"x{n}")
        whole = seen.groupBy(context).agg(*[f(c).alias(f"{kind}{n}{k}") for k in label for kind, f, c in (("n", F.sum, f"c{n}{k}"), ("t", lambda c: F.count(F.when(F.col(c) > 0, 1)), f"c{n}{k}"))])
        table = table.withColumn(f"g{n}", F.substr("gram", F.lit(order + 1 - n), F.lit(n + 1))).join(seen, f"g{n}")
        table = table.withColumn(f"x{n}", F.substr(f"g{n}", F.lit(1), F.lit(n))).join(whole, f"x{n}")
        for k in label:
            total = F.col(f"n{n}{k}") + F.col(f"t{n}{k}")
            table = table.withColumn(f"p{n}{k}", F.when(total > 0, (F.col(f"c{n}{k}") + F.col(f"t{n}{k}") * prob[k]) / total).otherwise(prob[k]))
            prob[k] = F.col(f"p{n}{k}")
    return table.select("gram", F.round(F.log(prob["a"] / prob["b"]) * MICRO).cast("long").alias("ratio"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """pages (page_id, url) with host, path, rule, verdict, and score (mean log-likelihood ratio a character)."""
    host, path = parts(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = pages.select("host", "path").distinct().withColumn("s", F.concat("host", "path"))
    urls = written(urls.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules)).select("host", "path", "s", "_r.rule", "_r.verdict"), "urls")
    scored = _grams(urls.select("host", "path", "s"), order).join(ratios(urls.select("s", "verdict"), order), "gram").groupBy("host", "path").agg((F.sum("ratio") / F.count("*")).alias("score"))
    scored = written(urls.join(scored, ["host", "path"]), "url-scores")
    mean, sd = (lambda v: F.avg(F.when(F.col("verdict") == v, F.col("score")))), (lambda v: F.stddev_pop(F.when(F.col("verdict") == v, F.col("score"))))
    a, da, b, db = scored.agg(mean("allow"), sd("allow"), mean("block"), sd("block")).first()
    if a is None or b is None:
        verdict = F.lit("allow")
    else:
        cut = (a * db + b * da) / (da + db) if da + db > 0 else (a + b) / 2
        verdict = F.when((F.col("score") < cut) & (F.col("s") != ""), "block").otherwise("allow")
    scored = scored.select("host", "path", "rule", F.coalesce("verdict", verdict).alias("verdict"), (F.col("score") / MICRO).alias("score"))
    return pages.join(scored, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "score")
