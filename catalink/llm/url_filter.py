"""URL filter: fixed host/path rules, else a logistic regression on hashed character n-grams.

The rules are a short list; the longest that fits decides.  Every other URL is
judged by a model trained on a small labelled URL table: character n-grams of
host and path, hashed to a fixed number of features, logistic regression by
Spark ML.  Scoring is a map over the rows, without a shuffle.

Edge cases: a null URL or one without ``://`` has empty host and path and no
n-grams, and gets the model's verdict for that (its intercept); repeated rows
are judged each; an empty table gives an empty result; only the id and the URL
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .url_labels import LABELLED_URLS

# Fixed rules of the job: action, host, path.
RULES: tuple[tuple[str, str, str], ...] = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

NGRAMS = (3, 4, 5)
FEATURES = 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty where there is no ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substr(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    return (
        df.withColumn("__rest", F.coalesce(rest, F.lit("")))
        .withColumn("host", F.regexp_extract("__rest", r"^[^/?#]*", 0))
        .withColumn("path", F.regexp_extract(F.expr("substr(__rest, length(host) + 1)"), r"^[^?#]*", 0))
        .withColumn("host", F.translate("host", UPPER, LOWER))
        .drop("__rest")
    )


def rule_columns(rules: Iterable[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """``(rule, action)`` of the longest rule that fits ``host`` and ``path``; null if none does."""
    rule = action = None
    for act, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name = F.lit(host + path)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        action = F.when(fits, F.lit(act)) if action is None else action.when(fits, F.lit(act))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, action)


def with_ngrams(df: DataFrame) -> DataFrame:
    """Adds ``grams``: tagged character n-grams of host and path, digits folded to ``0``."""

    def grams(column: str, tag: str, n: int) -> str:
        s = f"concat('^', regexp_replace({column}, '[0-9]+', '0'), '$')"
        return (
            f"transform(sequence(1, greatest(length({s}) - {n - 1}, 1)), i -> concat('{tag}', substr({s}, i, {n})))"
        )

    parts = [grams(c, c[0] + ":", n) for c in ("host", "path") for n in NGRAMS]
    return df.withColumn("grams", F.expr(f"CASE WHEN host = '' AND path = '' THEN cast(array() AS array<string>) ELSE concat({', '.join(parts)}) END"))


def train(labelled: DataFrame, features: int = FEATURES) -> PipelineModel:
    """Fit on ``labelled(url, blocked)``, a small table; Spark ML reads it in full, in a distributed way."""
    rows = with_ngrams(split_url(labelled)).select("grams", F.col("blocked").cast("double").alias("label"))
    stages = [
        HashingTF(numFeatures=features, binary=True, inputCol="grams", outputCol="features"),
        LogisticRegression(maxIter=60, regParam=0.01, standardization=False, featuresCol="features", labelCol="label"),
    ]
    return Pipeline(stages=stages).fit(rows)


def filter_urls(pages: DataFrame, model: PipelineModel, key: str = "page_id", url: str = "url") -> DataFrame:
    """``key, host, path, rule, verdict, score`` of every row; the score is the model's, rule or not."""
    rows = with_ngrams(split_url(pages.select(F.col(key), F.col(url).alias("url"))))
    scored = model.transform(rows)
    rule, action = rule_columns()
    judged = F.when(F.col("prediction") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        key,
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(action, judged).alias("verdict"),
        vector_to_array("probability")[1].alias("score"),
    )


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table that comes with the operator."""
    return spark.createDataFrame(LABELLED_URLS, "url string, blocked int").coalesce(1)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages: rule or model verdict for every URL."""
    model = train(labelled_urls(spark))
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), model)
