"""URL filter: host and path rules, and for all other URLs the ratio of two character language models.

Two smoothed variable-order Markov models, of accepted and of rejected URLs, predict each character from up
to three before it: every order is shrunk towards the next shorter one by as much as its context is
rare. The score of a URL is the difference of its log likelihoods by length; a URL is rejected above a
threshold that lets at most ``false_block`` of held-out accepted URLs be rejected.

DataFrame operations only. Counts come from the distinct URLs of four folds in five, the threshold from the accepted
URLs of the fifth, so with few of them it is coarse; every URL is judged. Characters are reduced to an
alphabet of 39 signs, so the model has 42 ** 4 rows at most and is broadcast within that bound; log ratios are
whole micro-nats, so sums do not depend on their order.

Defined cases: null URLs and those without ``://`` have an empty host and path; URLs without characters score 0
and pass; repeated rows get the same verdict each; without training URLs of one kind every URL
passes; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import ascii_lower, free_name, saved, untaken


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Parts of URLs that count as rejected where no rule says otherwise.
REJECTED_TERMS = ("casino", "pills", "porn", "spam", "viagra", "xxx")
FALSE_BLOCK = 0.01
#: Pseudo-counts that the shorter context stands for.
SHRINK = 4.0
#: Every fifth URL, by hash, is not trained on but calibrates the threshold.
FOLDS = 5
ORDER = 3
_SCALE = 1_000_000
RESULT = ("host", "path", "rule", "verdict", "score")


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(text, parts, 1)), F.regexp_extract(text, parts, 2)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(name, verdict) of the longest rule that fits the host or a parent of it and the path's start, or null."""
    out = F.lit(None)
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def signs(url: Column) -> Column:
    """The URL in the model's alphabet, with start and end marks."""
    text = F.translate(F.lower(url), "123456789\n\r", "000000000  ")
    return F.concat(F.lit("^" * ORDER), F.regexp_replace(text, r"[^a-z0./:?#=&_%~+\-]", "*"), F.lit("$"))


def _grams(urls: DataFrame) -> DataFrame:
    """A row per character: the URL's columns and the character after its context."""
    return urls.select("*", F.explode(F.regexp_extract_all(signs(F.col("url")), F.lit(f"(?=(.{{{ORDER + 1}}}))"), 1)).alias("gram"))


def fit(urls: DataFrame) -> DataFrame:
    """(gram, gain): log ratio of rejected to accepted in micro-nats, from ``urls`` (url, rejected or null)."""
    counts = _grams(urls).groupBy("gram").agg(
        *(F.count(F.when(F.col("rejected") == value, True)).alias(name) for name, value in (("bad", True), ("good", False)))
    )
    counts = saved(counts, "grams")
    total = counts.agg(F.sum("bad"), F.sum("good")).first()

    def within(name: str, start: int, size: int) -> Column:
        return F.sum(name).over(Window.partitionBy(F.substring("gram", start, size)))

    def chance(name: str, all_of: int) -> Column:
        p = F.lit(1 / 64)
        for order in range(ORDER + 1):
            seen = within(name, ORDER + 1 - order, order + 1)
            context = within(name, ORDER + 1 - order, order) if order else F.lit(all_of)
            p = (seen + SHRINK * p) / (context + SHRINK)
        return p

    if not total[0] or not total[1]:
        return counts.select("gram", F.lit(0).cast("long").alias("gain"))
    gain = F.log(chance("bad", total[0])) - F.log(chance("good", total[1]))
    return counts.select("gram", F.round(gain * _SCALE).cast("long").alias("gain"))


def scores(urls: DataFrame, model: DataFrame) -> DataFrame:
    """``urls`` (one row per URL) with ``score``, micro-nats for each character."""
    gained = _grams(urls.select("url")).join(F.broadcast(model), "gram")  # 42 ** 4 rows at most
    total = gained.groupBy("url").agg((F.sum("gain") / F.count(F.lit(1))).alias("score"))
    return urls.join(total, "url", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def threshold(scored: DataFrame, false_block: float = FALSE_BLOCK) -> float:
    """The least score, in thousandths of a nat, that at most ``false_block`` of the accepted URLs exceed; 0 at least."""
    bins = scored.where("NOT rejected").groupBy(F.ceil(F.col("score") * 1000 / _SCALE).alias("bin")).count()
    above = F.sum("count").over(Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1))
    every = F.sum("count").over(Window.partitionBy())
    fit_for = bins.select("bin", (F.coalesce(above, F.lit(0)) <= false_block * every).alias("ok")).where("ok")
    least = fit_for.agg(F.min("bin")).first()[0]
    return max(0.0, (least or 0) * _SCALE / 1000)


def judge(
    pages: DataFrame,
    rules: list[Rule],
    url: str = "url",
    rejected_terms: tuple[str, ...] = REJECTED_TERMS,
    false_block: float = FALSE_BLOCK,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (nats for each character; null without a URL)."""
    untaken(pages, *RESULT)
    host, path = host_and_path(F.col("url"))
    one = pages.select(F.col(url).alias("url")).where("url IS NOT NULL").groupBy("url").agg(F.count(F.lit(1)).alias("rows"))
    one = one.select("url", host.alias("host"), path.alias("path"))
    one = one.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    term = reduce(lambda a, b: a | b, (F.lower("url").contains(t) for t in rejected_terms), F.lit(False))
    one = one.withColumn("rejected", F.coalesce(F.col("rule.verdict") == "block", term))
    one = saved(one.withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS))), "urls")
    model = saved(fit(one.select("url", F.when(F.col("fold") > 0, F.col("rejected")).alias("rejected"))), "url-model")
    scored = saved(scores(one, model), "url-scores")
    least = threshold(scored.where("fold = 0"), false_block)
    key, result = free_name(pages, "_url"), free_name(pages, "_found")
    found = scored.select(
        F.col("url").alias(key),
        F.struct(
            "host",
            "path",
            F.col("rule.name").alias("rule"),
            F.coalesce("rule.verdict", F.when(F.col("score") > least, "block").otherwise("allow")).alias("verdict"),
            (F.col("score") / _SCALE).alias("score"),
        ).alias(result),
    )
    joined = pages.join(found, pages[url] == found[key], "left")
    empty = {"host": "", "path": "", "verdict": "allow"}
    return joined.select(*(pages[c] for c in pages.columns), *(F.coalesce(found[result][c], F.lit(empty.get(c))).alias(c) for c in RESULT))
