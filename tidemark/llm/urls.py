"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

Main path: DataFrame functions and Spark's own JVM logistic regression; no Python runs on executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A small labelled table of host-and-path words, 1 = unwanted.
UNWANTED = (
    "spam-farm", "link-farm", "spam-list", "casino-win", "online-casino", "casino-bonus", "cheap-pills", "pills-online",
    "buy-pills", "free-bets", "bets-bonus", "sports-bets", "adult-x", "adult-cams", "xxx-adult", "ads-track",
    "ads-click", "track-ads", "poker-win", "win-prizes", "cheap-meds", "viagra-cheap", "payday-loans", "replica-watches",
)
WANTED = (
    "news", "library", "weather", "science", "museum", "garden", "history", "university", "recipes", "travel",
    "music", "football", "health", "city", "school", "books", "forum", "wiki", "photos", "report",
    "theater", "winter", "trackers", "betterment", "adulthood", "farmers", "cheaper", "listing", "thread", "station",
)
PREFIXES = ("", "www.", "m.", "blog.")
ENDINGS = (".example.com/en/1", ".example.net/", ".example.org/de/page.html", ".net/fr/2", ".org/es/3/", ".com")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def ngrams(host: Column, path: Column, sizes: Sequence[int] = (3, 4, 5)) -> Column:
    """Character n-grams of ``^host$path``, as an array; linear in the length of the URL.

    The characters are bound to a variable, as the element of an array of one: they are split
    once for the whole URL, where an expression inside the function of a gram would be split again for each.
    """
    whole = F.array(F.split(F.concat(F.lit("^"), host, F.lit("$"), path), ""))

    def of(chars: Column, n: int) -> Column:
        last = F.size(chars) - n
        start = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(start, lambda i: F.concat(*[F.get(chars, i + k) for k in range(n)]))

    return F.transform(whole, lambda chars: F.concat(*[of(chars, n) for n in sizes]))[0]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: (url, label)."""
    rows = []
    for words, label in ((UNWANTED, 1.0), (WANTED, 0.0)):
        for k, word in enumerate(words):
            for j, ending in enumerate(ENDINGS):
                rows.append((f"https://{PREFIXES[(k + j) % len(PREFIXES)]}{word}{ending}", label))
    return spark.createDataFrame(rows, "url string, label double")


def _features(df: DataFrame, size: int) -> DataFrame:
    return HashingTF(numFeatures=size, inputCol="_grams", outputCol="_vector", binary=True).transform(df)


def train(labelled: DataFrame, size: int = 1 << 14) -> LogisticRegressionModel:
    """Fit on a labelled table (url, label) of at most some thousand rows."""
    grams = labelled.select(ngrams(host_of(F.col("url")), path_of(F.col("url"))).alias("_grams"), "label")
    fit = LogisticRegression(featuresCol="_vector", labelCol="label", regParam=0.01, maxIter=40)
    return fit.fit(_features(grams, size).coalesce(1))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null.

    A rule fits its host and all subdomains if the path starts with the rule's.
    Of two rules of equal text the blocking one wins.
    """
    fits = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0] != "block"))
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, key: str = "page_id",
    url: str = "url", size: int = 1 << 14, threshold: float = 0.5,
) -> DataFrame:
    """Judge every row: (key, host, path, rule, verdict, score).

    The verdict is the longest fitting rule's, else ``block`` where the model's
    probability reaches ``threshold``. A null URL, or one without ``://``, has an
    empty host and path and is judged on those. Rows are neither merged nor dropped:
    repeated keys stay repeated, a null key stays null, other columns are ignored.
    ``rules`` is a list typed by people; it is planned into the projection.
    """
    spark = pages.sparkSession
    model = train(labelled_urls(spark) if labelled is None else labelled, size)
    rows = pages.select(F.col(key).alias("_key"), host_of(F.col(url)).alias("_host"), path_of(F.col(url)).alias("_path"))
    rows = rows.withColumn("_rule", rule_for(F.col("_host"), F.col("_path"), rules))
    rows = _features(rows.withColumn("_grams", ngrams(F.col("_host"), F.col("_path"))), size)
    model.setFeaturesCol("_vector").setProbabilityCol("_probability")
    scored = model.transform(rows.drop("_grams")).withColumn("score", vector_to_array("_probability")[1])
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select(
        F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", own).alias("verdict"), "score",
    )
