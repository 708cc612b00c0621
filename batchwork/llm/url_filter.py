"""URL filtering: explicit host and path rules first, boosted trees on lexical features else.

The trees learn from labelled URLs.  Where no labels are given, the URLs that a rule decides
serve as labelled examples.  The features are lexical (lengths, depth, digit ratio, entropy,
parameter counts) plus suffix statistics: smoothed block rates of the host's last label and
last two labels and of the path's first segment, counted over all labelled URLs.

Defined results: a null url, and one without ``://``, has an empty host and path, fits no
rule and is judged by the trees on its whole text; with no labelled URL, or labels of one
kind only, every URL without a rule gets that one kind (``allow`` if there are none);
repeated rows and ids are judged row by row; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchwork.llm.common import LOWER, UPPER, text_or_empty, write_scratch

# (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
MAX_TRAIN = 20_000
SMOOTHING = 20.0
FEATURES = ["f_len", "f_host_len", "f_path_len", "f_depth", "f_labels", "f_digit_ratio", "f_host_digit_ratio", "f_entropy",
            "f_params", "f_hyphens", "f_fragment", "f_https", "f_suffix1", "f_suffix2", "f_segment"]


def with_parts(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Add host and path (both empty for null and for text without ``://``)."""
    url = text_or_empty(url_col)
    return urls.withColumns({"host": F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER),
                             "path": F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)})


def rule_column(rules: list[tuple[str, str, str]], index: int) -> Column:
    """The longest fitting rule's text (index 0) or verdict (index 1); null if none fits."""
    def fits(host: str, path: str) -> Column:
        return ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
    shortest_first = sorted(rules, key=lambda r: len(r[0] + r[1]))
    return reduce(lambda rest, r: F.when(fits(r[0], r[1]), F.lit((r[0] + r[1], r[2])[index])).otherwise(rest),
                  shortest_first, F.lit(None).cast("string"))


def with_features(parts: DataFrame, url_col: str = "url") -> DataFrame:
    url, host, path = text_or_empty(url_col), F.col("host"), F.col("path")
    query = F.regexp_extract(url, "\\?([^#]*)", 1)

    def count(c: Column, pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)).cast("double")

    def share(c: Column, pattern: str) -> Column:
        return F.coalesce(F.try_divide(count(c, pattern), F.length(c).cast("double")), F.lit(0.0))
    chars = F.split(url, "")
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    # entropy of the characters: log n - sum(c log c) / n over the distinct characters
    entropy = F.log(n) - F.aggregate(
        F.array_distinct(chars), F.lit(0.0),
        lambda acc, ch: acc + F.when(ch == "", F.lit(0.0)).otherwise(
            (n - F.length(F.replace(url, ch, F.lit(""))).cast("double")) * F.log(F.greatest(n - F.length(F.replace(url, ch, F.lit(""))).cast("double"), F.lit(1.0))))) / n
    return parts.withColumns({
        "f_len": F.length(url).cast("double"), "f_host_len": F.length(host).cast("double"), "f_path_len": F.length(path).cast("double"),
        "f_depth": count(path, "/"), "f_labels": count(host, "\\.") + 1, "f_digit_ratio": share(url, "[0-9]"),
        "f_host_digit_ratio": share(host, "[0-9]"), "f_entropy": entropy,
        "f_params": F.when(query == "", F.lit(0.0)).otherwise(count(query, "&") + 1), "f_hyphens": count(host, "-"),
        "f_fragment": url.contains("#").cast("double"), "f_https": url.startswith("https:").cast("double"),
        "k_suffix1": F.substring_index(host, ".", -1), "k_suffix2": F.substring_index(host, ".", -2),
        "k_segment": F.regexp_extract(path, "^/([^/]*)", 1)})


def suffix_rates(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Join the smoothed block rate of each key, counted over all labelled rows."""
    prior = labelled.agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0]
    for key, name in (("k_suffix1", "f_suffix1"), ("k_suffix2", "f_suffix2"), ("k_segment", "f_segment")):
        rates = labelled.groupBy(key).agg(((F.sum("label") + prior * SMOOTHING) / (F.count("label") + SMOOTHING)).alias(name))
        rows = rows.join(rates, key, "left").fillna({name: float(prior)})
    return rows


def url_filter(urls: DataFrame, url_col: str = "url", rules: list[tuple[str, str, str]] = RULES,
               labels: DataFrame | None = None, max_train: int = MAX_TRAIN) -> DataFrame:
    """Add host, path, rule, verdict and the trees' score (share of ``block``).

    ``labels`` (url, label 1 = block) are labelled URLs; default: those that a rule decides.
    At most about ``max_train`` distinct ones, taken by hash and weighted by their number of
    rows, fit the trees; all rows count in the suffix statistics.  A sample that is empty or
    of one kind fits nothing: the score is then the share of ``block`` among all labelled rows.
    """
    judged = with_features(with_parts(urls, url_col), url_col).withColumns(
        {"rule": rule_column(rules, 0), "rule_verdict": rule_column(rules, 1)})
    if labels is None:
        labelled = judged.where("rule is not null").withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    else:
        labelled = with_features(with_parts(labels.select(F.col("url").alias(url_col), F.col("label").cast("double").alias("label")), url_col), url_col)
    labelled = write_scratch(labelled.select(F.xxhash64(text_or_empty(url_col)).alias("h"), "label", "k_suffix1", "k_suffix2", "k_segment", *FEATURES[:-3]), "url-labelled")
    kinds = labelled.where("label is not null").groupBy("h", "label").agg(F.count(F.lit(1)).alias("weight"))
    n, blocked, distinct = kinds.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.coalesce(F.sum(F.col("weight") * F.col("label")), F.lit(0.0)), F.count(F.lit(1))).first()
    if not n or blocked in (0, n):
        return judged.withColumn("score", F.lit(1.0 if n and blocked else 0.0)).withColumn(
            "verdict", F.coalesce("rule_verdict", F.lit("block" if n and blocked else "allow")))
    pick = F.pmod("h", F.lit(10 ** 15)) < int(10 ** 15 * min(1.0, max_train / distinct))
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # one row per url and label, its copies combined before the shuffle
    sample = labelled.where(pick & F.col("label").isNotNull()).groupBy("h", "label").agg(
        F.count(F.lit(1)).cast("double").alias("weight"), *[F.first(c).alias(c) for c in ("k_suffix1", "k_suffix2", "k_segment", *FEATURES[:-3])])
    train = write_scratch(suffix_rates(sample, labelled).select("label", "weight", *FEATURES).coalesce(4), "url-train")
    if train.select("label").distinct().count() < 2:
        share = blocked / n
        return judged.withColumn("score", F.lit(float(share))).withColumn("verdict", F.coalesce("rule_verdict", F.lit("block" if share >= 0.5 else "allow")))
    model = GBTClassifier(labelCol="label", weightCol="weight", maxIter=15, maxDepth=3, maxBins=32, stepSize=0.3, seed=7).fit(assemble.transform(train))
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(assemble.transform(suffix_rates(judged, labelled)))
    return scored.withColumn("score", vector_to_array("probability")[1]).withColumn(
        "verdict", F.coalesce("rule_verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")))
