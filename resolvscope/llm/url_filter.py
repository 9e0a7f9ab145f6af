"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resolvscope.llm.components import _kept, spread_join

# Labelled urls that the trees are fitted on: the bound on the sample.
SAMPLE = 20_000
TREES = 12
DEPTH = 4
THRESHOLD = 0.5

# The rules (verdict, host, path).
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

FEATURES = ["length", "host_length", "depth", "digits", "host_digits", "entropy", "parameters", "hyphens", "labels", "suffix_block", "suffix_seen"]


@dataclass
class Model:
    """Trees (None without labels of both kinds), the verdict where there are none, and statistics of suffixes."""

    trees: GBTClassificationModel | None
    default: float
    suffixes: DataFrame


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), else null."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in longest]
    found = [F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for v, h, p in longest]
    return F.coalesce(*[F.when(f, r) for f, r in zip(fits, found, strict=True)])


def judged(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(page_id, url, host, path, rule) of each row."""
    parts = pages.select("page_id", F.col("url"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    n = F.greatest(F.length(text), F.lit(1))
    shares = F.transform(chars, lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(shares, F.lit(0.0), lambda s, p: s - p * F.log2(p))


def _digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^0-9]", "")) / F.greatest(F.length(text), F.lit(1))


def features(parts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Lexical features, JVM-side. A suffix is the host's last two labels; unseen ones have 0.5, as any that no url counts for."""
    url = F.coalesce(F.col("url"), F.lit(""))
    with_suffix = parts.withColumn("suffix", F.substring_index("host", ".", -2))
    return (
        # A stored table, so Spark broadcasts it as long as it is small.
        spread_join(with_suffix, suffixes, "suffix", "left")
        .withColumn("length", F.length(url).cast("double"))
        .withColumn("host_length", F.length("host").cast("double"))
        .withColumn("depth", F.size(F.filter(F.split("path", "/"), lambda s: s != "")).cast("double"))
        .withColumn("digits", _digits(url))
        .withColumn("host_digits", _digits(F.col("host")))
        .withColumn("entropy", _entropy(url))
        .withColumn("parameters", (F.length(url) - F.length(F.regexp_replace(url, "[?&]", ""))).cast("double"))
        .withColumn("hyphens", (F.length("host") - F.length(F.replace(F.col("host"), F.lit("-"), F.lit("")))).cast("double"))
        .withColumn("labels", F.size(F.split("host", r"\.")).cast("double"))
        .withColumn("suffix_block", F.coalesce("suffix_block", F.lit(0.5)))
        .withColumn("suffix_seen", F.coalesce("suffix_seen", F.lit(0.0)))
    )


def train(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, sample: int = SAMPLE) -> Model:
    """Fit on the distinct urls that a rule labels, at most ``sample`` of them, chosen by a hash of the url.

    Suffix statistics count all labelled urls and keep every suffix.
    """
    labelled = judged(pages, rules).where("rule IS NOT NULL").select(
        "url", "host", "path", F.when(F.col("rule.verdict") == "block", 1.0).otherwise(0.0).alias("label")
    )
    counted = labelled.groupBy(F.substring_index("host", ".", -2).alias("suffix")).agg(F.avg("label").alias("share"), F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked"))
    suffixes = _kept(counted.select("suffix", ((F.col("blocked") + 1) / (F.col("n") + 2)).alias("suffix_block"), F.log1p("n").alias("suffix_seen")), "suffixes")
    totals = labelled.agg(F.avg("label").alias("share"), F.count(F.lit(1)).alias("n")).first()
    share = totals["share"] or 0.0
    if share in (0.0, 1.0):
        return Model(None, share, suffixes)
    chosen = labelled.dropDuplicates(["url"]).orderBy(F.xxhash64("url"), "url").limit(sample)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(chosen, suffixes)).select("features", "label")
    ready = ready.coalesce(1).persist()
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=5, maxBins=32, cacheNodeIds=False).fit(ready)
    ready.unpersist()
    return Model(trees, share, suffixes)


def judge(pages: DataFrame, model: Model, rules: list[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row; score is the trees' probability of ``block``.

    A rule decides where one fits, the longest first; else the trees, or the labels' majority where they are all alike.
    Null urls, and urls without ``://``, have empty hosts and paths and are judged by the trees. Repeated rows and null ids
    are judged alike. Columns other than ``page_id`` and ``url`` are ignored.
    """
    parts = features(judged(pages, rules), model.suffixes)
    if model.trees is None:
        scored = parts.withColumn("score", F.lit(float(model.default)))
    else:
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(parts)
        scored = model.trees.transform(assembled).withColumn("score", vector_to_array("probability")[1])
    verdict = F.coalesce(F.col("rule.verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", F.col("rule.rule").alias("rule"), verdict.alias("verdict"), "score")
