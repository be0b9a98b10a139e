"""URL filters: prefix rules first, gradient-boosted trees on lexical features for the rest.

Everything runs as column expressions and Spark ML: host and path are cut out
by one regular expression, the lexical features (length, depth, digit ratio,
entropy, parameter counts, host-suffix statistics) are built-in functions, and
``GBTClassifier`` is fitted on a bounded, documented sample of labelled URLs.  The
suffix statistics count all labelled URLs; they are a table that is joined, however
many suffixes there are.
Labels come from a seed list of host terms; the terms themselves are no
feature, so the trees must find the lexical traits that go with them.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import scratch

# The rules (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# Host terms that label a URL as unwanted.
SEED_TERMS = ["spam", "pills", "bets", "casino", "adult", "porn", "viagra", "lottery"]

SAMPLE_ROWS = 20_000    # most labelled URLs the trees are fitted on
TREES, DEPTH, SEED = 10, 3, 42
SMOOTHING = 20          # labelled URLs of average rate that every suffix counts besides its own
FEATURES = ["url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens",
            "entropy", "params", "query_length", "vowel_ratio", "suffix_rate", "suffix_log_count"]

_HOST_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _HOST_PATH, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _HOST_PATH, 2)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text).cast("double")
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
    terms = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(F.length(c) > 0, -share(c) * F.log2(share(c))).otherwise(0.0))
    return F.when(n > 0, F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    h = F.greatest(F.length(host), F.lit(1)).cast("double")
    out = {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "depth": _count(path, "/"), "labels": _count(host, "."), "digit_ratio": _count(url, string.digits) / n,
        "hyphens": _count(host, "-"), "entropy": _entropy(host),
        "params": F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(0), "query_length": F.length(query),
        "vowel_ratio": _count(host, "aeiou") / h,
    }
    return {k: v.cast("double") for k, v in out.items()}


def _suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """(trees, suffix statistics, share of label 1) from a labelled table (url, label 0/1).

    Statistics cover all rows.  The trees see at most ``sample_rows`` rows, half of them a
    class: those with the smallest keyed hash of their URL, so the sample does not depend
    on file order, weighted so that the classes keep their shares.  Returns None where
    the table lacks one of the two classes.
    """
    rows = labelled.select("url", F.col("label").cast("double").alias("label"))
    rows = rows.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))}).withColumn("suffix", _suffix(F.col("host")))
    by_suffix = scratch(rows.groupBy("suffix").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad")), "url-suffixes")
    total, bad = by_suffix.agg(F.sum("n"), F.sum("bad")).first()
    if not total or not 0 < bad < total:
        return None
    prior = bad / total
    stats = by_suffix.select("suffix", ((F.col("bad") + SMOOTHING * prior) / (F.col("n") + SMOOTHING)).alias("suffix_rate"),
                             F.log1p(F.col("n") / total).alias("suffix_log_count"))
    half = max(sample_rows // 2, 1)
    parts = [rows.where(F.col("label") == label).orderBy(F.xxhash64(F.col("url"), F.lit(SEED)), "url").limit(half)
             .withColumn("weight", F.lit(max(n / half, 1.0))) for label, n in ((0.0, total - bad), (1.0, bad))]
    sample = parts[0].unionByName(parts[1])
    sample = sample.withColumns(lexical(F.col("url"), F.col("host"), F.col("path")))
    ready = _assembled(sample, stats, prior).repartition(1).sortWithinPartitions("url", "label")
    model = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH,
                          seed=SEED, maxBins=32, subsamplingRate=1.0).fit(ready)
    return model, stats, prior


def _assembled(df: DataFrame, stats: DataFrame, prior: float) -> DataFrame:
    """The feature vector; a suffix without labelled URLs has the average rate and no count."""
    df = df.join(stats, "suffix", "left").na.fill({"suffix_rate": prior, "suffix_log_count": 0.0})
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def seed_labels(pages: DataFrame, url_col: str = "url", terms=SEED_TERMS) -> DataFrame:
    """Labelled URLs (url, label): 1 where the host holds a seed term."""
    host = url_host(F.col(url_col))
    hit = F.lit(False)
    for term in terms:
        hit = hit | host.contains(term)
    return pages.where(F.col(url_col).isNotNull() & (F.length(host) > 0)).select(
        F.col(url_col).alias("url"), hit.cast("int").alias("label")).distinct()


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", labelled: DataFrame | None = None,
                rules=RULES, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5) -> DataFrame:
    """host, path, rule, score and verdict of every URL.

    The longest fitting rule decides; where none fits the trees do (score: their
    probability of ``block``).  Null or malformed URLs have empty host and path, no
    rule, score 0 and are allowed; so is every URL without a rule where the labels
    hold only one class.  One result per input row; other columns are not read.
    """
    fitted = fit(labelled if labelled is not None else seed_labels(pages, url_col), sample_rows)
    url = F.col("__url")
    rows = pages.select(F.col(id_col), F.col(url_col).alias("__url")).select(
        id_col, "__url", url_host(url).alias("host"), url_path(url).alias("path"))
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "rule_verdict": verdict})
    if fitted is None:
        rows = rows.withColumn("score", F.lit(0.0))
    else:
        model, stats, prior = fitted
        rows = rows.withColumns({**lexical(url, F.col("host"), F.col("path")), "suffix": _suffix(F.col("host"))})
        rows = model.transform(_assembled(rows, stats, prior))
        rows = rows.withColumn("score", F.when(F.length("host") > 0, vector_to_array("probability")[1]).otherwise(0.0))
    method = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return rows.select(id_col, "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"), "score")
