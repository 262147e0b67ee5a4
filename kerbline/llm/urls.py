"""URL filter: a list of rules, and association rules mined where no listed rule fits.

A listed rule is a host and a path; it fits that host and its subdomains where the
url's path starts with the rule's, and the longest fitting rule decides.  For the other
urls, FP-growth mines from labelled urls which combinations of url tokens go with
``block`` or ``allow``.  Mined rules below ``support``, ``confidence`` or ``lift`` are
pruned, and so is a rule that a shorter one makes needless; the rest are looked up by
an inverted index, each under its rarest token.  The most confident rule that fits
decides; where none fits, ``default`` does.

Distinct token sets are judged once each, so pages of one site cost little.

Defined results: null urls and urls without ``://`` have an empty host and path, no
token and the default verdict; without labels all pages that no listed rule fits get
the default; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from kerbline.llm.base import sized
from kerbline.staging import stage

# The listed rules (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Mining:
    support: float = 0.005
    confidence: float = 0.7
    lift: float = 1.05  # a rule must say more than the label's own share
    default: str = "allow"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, each empty where there is none."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(`_u`, instr(`_u`, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), CAPITALS, SMALL)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a url: domain endings, path segments and ending; digits as one sign, so numbers agree."""
    parts = F.reverse(F.split(host, r"\."))
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat(F.lit("host:"), F.array_join(F.reverse(F.slice(parts, 1, n)), ".")))
    names = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda x: x != "")
    steps = F.transform(names, lambda x, i: F.concat(F.lit("path"), (i + 1).cast("string"), F.lit(":"), x))
    return F.array_sort(F.array_distinct(F.when(host != "", F.concat(ends, steps)).otherwise(F.array().cast("array<string>"))))


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def mined(baskets: DataFrame, how: Mining) -> DataFrame:
    """(need, verdict, confidence, support): pruned rules from ``baskets`` (tokens, verdict)."""
    goals = [f"verdict={v}" for v in ("allow", "block")]
    items = baskets.select(F.array_append("tokens", F.concat(F.lit("verdict="), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=how.support, minConfidence=how.confidence).fit(items)
    rules = (model.associationRules.where(F.col("consequent")[0].isin(goals) & (F.col("lift") >= how.lift))
             .select(F.array_sort("antecedent").alias("need"), F.substring(F.col("consequent")[0], 9, 99).alias("verdict"), "confidence", "support"))
    rules = stage(rules, "rules")
    # a rule is needless if another of the same verdict asks for a part of its tokens and is as sure
    part = rules.select(F.col("need").alias("p_need"), F.col("verdict").alias("p_verdict"), F.col("confidence").alias("p_confidence"),
                        F.col("need")[0].alias("p_first"))
    needless = (rules.withColumn("token", F.explode("need")).join(part, (F.col("token") == F.col("p_first")) & (F.col("verdict") == F.col("p_verdict")))
                .where((F.size("p_need") < F.size("need")) & (F.size(F.array_except("p_need", "need")) == 0) & (F.col("p_confidence") >= F.col("confidence")))
                .select("need", "verdict").distinct())
    return rules.join(needless, ["need", "verdict"], "left_anti")


def judged(pages: DataFrame, labels: DataFrame, how: Mining | None = None, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per page.  ``labels``: (url, verdict), any urls, block or allow."""
    how = how or Mining()
    host, path = host_path(F.col("_u"))
    rows = pages.select("page_id", F.col("url").alias("_u")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    rows = stage(rows.withColumn("rule", rule).withColumn("known", verdict).withColumn("tokens", tokens(F.col("host"), F.col("path")))
                 .withColumn("key", F.xxhash64("tokens")), "urls")
    known = labels.where("verdict IN ('allow', 'block')").select(F.col("url").alias("_u"), "verdict")
    host, path = host_path(F.col("_u"))
    baskets = stage(known.select(tokens(host, path).alias("tokens"), "verdict").where(F.size("tokens") > 0), "baskets")
    if baskets.isEmpty():
        return rows.select("page_id", "host", "path", "rule", F.coalesce("known", F.lit(how.default)).alias("verdict"))

    found = stage(mined(baskets, how), "pruned")
    seen = rows.where("known IS NULL").select("key", "tokens").dropDuplicates(["key"])
    often = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    rare = (found.select("need", F.explode("need").alias("token")).join(often, "token")
            .groupBy("need").agg(F.min_by("token", F.struct("n", "token")).alias("token")))
    index = stage(found.join(rare, "need"), "index")
    hits = (seen.select("key", "tokens", F.explode("tokens").alias("token")).join(sized(index), "token")
            .where(F.size(F.array_except("need", "tokens")) == 0)
            .groupBy("key").agg(F.max(F.struct("confidence", "support", F.size("need").alias("size"), "verdict")).alias("best"))
            .select("key", F.col("best.verdict").alias("guess")))
    out = rows.join(sized(stage(hits, "verdicts")), "key", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("known", "guess", F.lit(how.default)).alias("verdict"))
