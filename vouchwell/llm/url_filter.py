"""URL verdicts: the longest rule that fits, and gradient-boosted trees for the rest.

The trees see lexical features only: length, host and path length, depth, digit ratio,
character entropy, parameter counts and, for the last two and three labels of the host, the
smoothed share of blocked URLs. They are trained on labelled URLs, by default those that a
rule decides. The shares are counted over all of them. Where there are more than ``FIT_ROWS``,
a sample of that size enters the fit: the rarer class whole or with half of the rows, the
other class with the rest, weighted back to their numbers. Of a URL that occurs n times, n times
its class's share of copies are taken, the fraction rounded up or down by hash.

Defined results: a null URL or one without "://" has an empty host and an empty path; an
empty path starts with no rule's path; without labelled URLs, or with one class of them,
every URL that no rule fits gets the one known class, or "allow"; repeated rows get equal
verdicts; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchwell.storage import broadcast_if_small, materialize

FIT_ROWS = 20_000
SMOOTHING = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = [
    "n_url", "n_host", "n_path", "depth", "labels", "digit_ratio", "entropy",
    "n_params", "n_param_chars", "n_hyphens", "has_fragment", "suffix2_rate", "suffix3_rate",
]

Rule = tuple[str, str, str]  # verdict, host, path


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL, both empty without a scheme."""
    url = F.coalesce(url, F.lit(""))
    place = F.locate("://", url)
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, site, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(site + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def _entropy(text: Column) -> Column:
    chars = F.split(text, "")
    n = F.size(chars)
    shares = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
    return F.aggregate(shares, F.lit(0.0), lambda total, p: total - p * F.log2(p))


def lexical(urls: DataFrame) -> DataFrame:
    """Add the features that a URL alone gives; needs url, host, path."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    count = lambda text, what: F.length(text) - F.length(F.regexp_replace(text, what, ""))
    return urls.withColumns(
        {
            "n_url": F.length(url),
            "n_host": F.length(host),
            "n_path": F.length(path),
            "depth": count(path, "/"),
            "labels": count(host, r"\."),
            "digit_ratio": count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)),
            "entropy": _entropy(url),
            "n_params": F.when(query == "", 0).otherwise(count(query, "&") + 1),
            "n_param_chars": F.length(query),
            "n_hyphens": count(host, "-"),
            "has_fragment": F.contains(url, F.lit("#")).cast("int"),
            "suffix2": _suffix(host, 2),
            "suffix3": _suffix(host, 3),
        }
    )


def _sampled(fit: DataFrame, n: int, blocked: float, fit_rows: int) -> DataFrame:
    """Rows that enter the fit, one a URL and label, with the number of rows that each stands for."""
    rare = min(blocked, n - blocked)
    taken = min(rare, fit_rows // 2)
    rare_label = 1.0 if blocked <= n - blocked else 0.0
    share = F.when(F.col("label") == rare_label, taken / rare).otherwise((fit_rows - taken) / (n - rare))
    rows = fit.groupBy("url", "host", "path", "label").agg(F.count("*").alias("n"))
    chance = F.pmod(F.xxhash64("url", "label", F.lit(1)), F.lit(1 << 30)) / (1 << 30)
    copies = F.floor(F.col("n") * share + chance)
    return rows.withColumns({"weight": copies / share}).where("weight > 0").drop("n")


def _suffix_rates(fit: DataFrame, suffix: str, prior: float) -> DataFrame:
    rate = (F.sum("label") + SMOOTHING * prior) / (F.count("*") + SMOOTHING)
    return materialize(fit.groupBy(suffix).agg(rate.alias(f"{suffix}_rate")), suffix)


def judge(pages: DataFrame, rules: Sequence[Rule], fit_rows: int = FIT_ROWS, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score, the trees' probability of a block.

    ``labelled`` holds url and label (1: block); by default the rules label the pages.
    """
    host, path = parts(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    judged = judged.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        fit = judged.where("found IS NOT NULL").select("url", "host", "path", (F.col("found.verdict") == "block").cast("double").alias("label"))
    else:
        host, path = parts(F.col("url"))
        fit = labelled.select("url", host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label"))
    known = fit.where("label IS NOT NULL").agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    n, blocked = known["n"], known["blocked"] or 0.0
    out = ["page_id", "host", "path", F.col("found.rule").alias("rule")]
    if blocked in (0.0, float(n)):
        rest = F.lit("block" if n and blocked else "allow")
        return judged.select(*out, F.coalesce("found.verdict", rest).alias("verdict"), F.lit(float(bool(n and blocked))).alias("block_score"))
    fit = fit.where("label IS NOT NULL")
    counted = fit.select("label", _suffix(F.col("host"), 2).alias("suffix2"), _suffix(F.col("host"), 3).alias("suffix3"))
    rates = {s: _suffix_rates(counted, s, blocked / n) for s in ("suffix2", "suffix3")}
    fit = _sampled(fit, n, blocked, fit_rows) if n > fit_rows else fit.withColumn("weight", F.lit(1.0))
    fit = materialize(lexical(fit), "labelled_urls")

    def with_rates(rows: DataFrame) -> DataFrame:
        for suffix, table in rates.items():
            rows = rows.join(broadcast_if_small(table), suffix, "left").fillna({f"{suffix}_rate": blocked / n})
        return rows

    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(labelCol="label", weightCol="weight", maxIter=15, maxDepth=4, stepSize=0.2, seed=7)
    model = trees.fit(assemble.transform(with_rates(fit)).select("label", "weight", "features"))
    scored = model.transform(assemble.transform(with_rates(lexical(judged))))
    verdict = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    from pyspark.ml.functions import vector_to_array

    score = vector_to_array("probability")[1]
    return scored.select(*out, F.coalesce("found.verdict", verdict).alias("verdict"), score.alias("block_score"))
