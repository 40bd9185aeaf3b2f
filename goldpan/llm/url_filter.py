"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule names a host and the beginning of a path; it fits the host and its subdomains, and the
longest fitting rule decides. URLs that a rule decides are the labelled ones: a bounded sample of the distinct
ones trains the trees, which judge the URLs that no rule fits. Features come from the URL alone: length, depth,
digits, entropy, parameters, marks, and how often the rules blocked the host's last label, its last two
labels and the first path segment, over all rows that a rule decides.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule; an
empty or unbalanced sample allows everything that no rule fits; repeated rows get a row each; an
empty table gives an empty result; the html is never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.storage import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        return ((F.col("host") == self.host) | F.col("host").endswith("." + self.host)) & F.col("path").startswith(self.path)


# The rules of the contract.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def split(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path: empty host and path where there is no ``://``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"))
    rest = F.when(F.locate("://", F.col("url")) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    rows = rows.withColumn("_rest", rest)
    rows = rows.withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
    rows = rows.withColumn("path", F.regexp_extract(F.expr("substring(_rest, length(_host) + 1)"), r"^[^?#]*", 0))
    return rows.select("page_id", "url", F.translate("_host", UPPER, LOWER).alias("host"), "path")


def decided(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The rule that fits and its verdict; the longest comes first."""
    ordered = sorted(rules, key=lambda r: -len(r.text))

    def first(value: str) -> Column:
        return F.coalesce(*(F.when(r.fits(), F.lit(getattr(r, value))) for r in ordered), F.lit(None).cast("string"))

    return rows.select("*", first("text").alias("rule"), first("verdict").alias("ruled"))


def _entropy(text: str) -> Column:
    n = F.greatest(F.length(text), F.lit(1))
    share = F.transform(
        F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(F.col(text), c, F.lit("")))) / n
    )
    return F.aggregate(share, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _count(pattern: str) -> Column:
    return F.regexp_count("url", F.lit(pattern)).cast("double")


def lexical(rows: DataFrame) -> DataFrame:
    """``rows`` with the numbers read off the URL, and the three keys of the suffix statistics."""
    labels = F.split("host", r"\.")
    n = F.greatest(F.length("url"), F.lit(1))
    return rows.select(
        "*",
        F.length("url").cast("double").alias("f_length"),
        F.length("host").cast("double").alias("f_host"),
        F.size(labels).cast("double").alias("f_labels"),
        F.regexp_count("path", F.lit("/")).cast("double").alias("f_depth"),
        (_count("[0-9]") / n).alias("f_digits"),
        _count("=").alias("f_params"),
        _count("[-_%~]").alias("f_marks"),
        F.coalesce(_entropy("url"), F.lit(0.0)).alias("f_entropy"),
        F.coalesce(_entropy("host"), F.lit(0.0)).alias("f_host_entropy"),
        F.element_at(labels, -1).alias("k_last"),
        F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), F.least(F.size(labels), F.lit(2))), ".").alias("k_two"),
        F.regexp_extract("path", r"^/([^/]*)/", 1).alias("k_segment"),
    )


_NUMBERS = ("length", "host", "labels", "depth", "digits", "params", "marks", "entropy", "host_entropy")
_KEYS = ("last", "two", "segment")


@dataclass
class Model:
    trees: GBTClassificationModel
    rates: dict[str, DataFrame]


def _with_rates(rows: DataFrame, rates: dict[str, DataFrame]) -> DataFrame:
    """Join the blocked share of each key; the tables grow with the hosts, so Spark chooses how."""
    for key, table in rates.items():
        rows = rows.join(table, f"k_{key}", "left").withColumn(f"r_{key}", F.coalesce(f"r_{key}", F.lit(0.5)))
    assembler = VectorAssembler(inputCols=[f"f_{c}" for c in _NUMBERS] + [f"r_{c}" for c in _KEYS], outputCol="features")
    return assembler.transform(rows)


def blocked_shares(ruled: DataFrame) -> dict[str, DataFrame]:
    """For each key its values and the share of ruled rows with it that are blocked, smoothed; over all of them."""
    label = (F.col("ruled") == "block").cast("long")
    keys = [f"k_{key}" for key in _KEYS]
    counted = materialize(
        lexical(ruled).groupBy(*keys).agg(F.sum(label).alias("blocked"), F.count(F.lit(1)).alias("n")), "suffixes"
    )
    return {
        key: materialize(
            counted.groupBy(f"k_{key}").agg(((F.sum("blocked") + 1) / (F.sum("n") + 2)).alias(f"r_{key}")), f"rates_{key}"
        )
        for key in _KEYS
    }


def sampled(ruled: DataFrame, most_per_class: int) -> DataFrame:
    """At most ``most_per_class`` distinct URLs a verdict, in the order of a hash: copies take no places."""
    distinct = ruled.select("url", "host", "path", "ruled").distinct()
    order = (F.xxhash64("url"), "url")
    taken = distinct.filter("ruled = 'block'").orderBy(*order).limit(most_per_class).unionByName(
        distinct.filter("ruled = 'allow'").orderBy(*order).limit(most_per_class)
    )
    return taken.select("url", "host", "path", F.when(F.col("ruled") == "block", 1.0).otherwise(0.0).alias("label"))


def fit(rows: DataFrame, most_per_class: int = 5_000, rounds: int = 10, depth: int = 4) -> Model | None:
    """Trees on a sample of at most ``most_per_class`` distinct ruled URLs a verdict; None where one is missing."""
    ruled = rows.filter(F.col("ruled").isNotNull())
    spark = rows.sparkSession
    local = sampled(ruled, most_per_class).toPandas()  # bounded
    if local["label"].nunique() < 2:
        return None
    rates = blocked_shares(ruled)
    sample = lexical(spark.createDataFrame(local).repartition(4))
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=3, featuresCol="features", labelCol="label")
    features = materialize(_with_rates(sample, rates).select("features", "label"), "url_sample")
    return Model(trees.fit(features), rates)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, most_per_class: int = 5_000) -> DataFrame:
    """page_id, host, path, rule, verdict, and the chance of a block that the trees give where no rule fits."""
    rows = decided(split(pages), rules)
    model = fit(rows, most_per_class)
    if model is None:
        judged = rows.withColumn("chance", F.lit(None).cast("double"))
    else:
        scored = model.trees.transform(_with_rates(lexical(rows), model.rates))
        judged = scored.withColumn("chance", F.when(F.col("rule").isNull(), vector_to_array("probability")[1]))
    verdict = F.coalesce("ruled", F.when(F.col("chance") >= 0.5, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "chance")
