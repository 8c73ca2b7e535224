"""URL filter: host and path rules, and a logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VarianceThresholdSelector
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host, path prefix).
Rule = tuple[str, str, str]

#: Words of hosts that a filter for text corpora refuses, and of ordinary ones.
BLOCKED_WORDS = (
    "casino", "grand-casino", "casinobonus", "bets", "sportbets", "betting-tips", "live-betting", "poker-room", "pokerstar",
    "slots-jackpot", "pills", "pills-shop", "discount-pills", "viagra", "online-pharmacy", "ads", "adserver", "ad-exchange",
    "track-click", "tracker", "pixel-track", "banner-ads", "popup-ads", "payday-loans", "quick-loans", "win-prize",
    "free-download", "freebies", "adult", "adult-cams", "xxx-video", "porn-tube", "escort-dating", "replica-watches",
    "bitcoin-doubler", "get-rich", "miracle-diet", "cheap-replica",
)
ORDINARY_WORDS = (
    "news", "library", "garden", "history", "weather", "school", "recipes", "travel", "museum", "science", "journal",
    "kitchen", "music", "village", "university", "station", "nation", "fiction", "edition", "theatre", "north", "earth",
    "leather", "father", "island", "market", "forest", "painting", "reading", "teacher", "stories", "letters", "ocean",
    "rivers", "bread", "mother", "other-places", "gathering", "anthem", "methods", "thanks", "python-notes", "hiking",
    "within", "everything", "relations", "action", "tradition", "fashion", "translation", "hospital", "shipping",
    "astronomy", "chess-club", "parish", "railways", "bakery", "seeds-and-trees", "botany", "orchestra", "cinema",
    "marathon", "bookshop", "archive", "poetry", "elections", "parliament", "harbour", "mountains", "beekeeping",
    "track-and-field", "download-manuals", "advice", "adventures", "betterhomes", "alphabet", "spills-and-floods",
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (``host, path, blocked``): each word with usual prefixes, endings and paths."""
    words = [(w, 1.0) for w in BLOCKED_WORDS] + [(w, 0.0) for w in ORDINARY_WORDS]
    table = spark.createDataFrame(words, "word string, blocked double")
    for name, values in (
        ("prefix", ("", "www.", "m.", "blog.")),
        ("ending", (".example.com", ".example.net", ".example.org")),
        ("path", ("/en/1234", "/fr/88.html", "/de/5016/", "/es/7")),
    ):
        table = table.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return table.select(F.concat("prefix", "word", "ending").alias("host"), "path", "blocked")


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty when the url is null or has no ``://``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise("")
    split = r"^([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rows = pages.withColumn("_rest", F.coalesce(rest, F.lit("")))
    rows = rows.withColumn("host", F.translate(F.regexp_extract("_rest", split, 1), upper, lower))
    # A line break ends no part of the url, so the pattern above takes it like any other character.
    return rows.withColumn("path", F.regexp_extract("_rest", split, 2)).drop("_rest")


def _grams(text: Column, size: int) -> Column:
    last = F.greatest(F.length(text) - size + 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), last), lambda k: F.substr(text, k, F.lit(size)))


def with_features(urls: DataFrame, sizes: Sequence[int], buckets: int) -> DataFrame:
    """Adds ``features``: counts of the hashed n-grams of ``^host$`` and of the path, in separate spaces."""
    host, path = F.concat(F.lit("^"), "host", F.lit("$")), F.concat(F.lit("/"), "path", F.lit("$"))
    marked = [F.transform(_grams(part, n), lambda g, k=kind: F.concat(F.lit(k), g)) for n in sizes for kind, part in (("h", host), ("p", path))]
    tokens = urls.withColumn("_grams", F.concat(*marked))
    return HashingTF(numFeatures=buckets, inputCol="_grams", outputCol="features", binary=True).transform(tokens).drop("_grams")


def train(labelled: DataFrame, sizes: Sequence[int] = (3, 4, 5), buckets: int = 1 << 18):
    """Logistic regression for ``blocked`` on a small table of ``host, path, blocked``.

    A bucket that is the same in all labelled rows gets no weight, so it is left out before the fit: what
    the driver holds follows the labelled table, not the number of buckets.
    """
    rows = with_features(labelled, sizes, buckets)
    varied = VarianceThresholdSelector(featuresCol="features", outputCol="varied").fit(rows)
    regression = LogisticRegression(labelCol="blocked", featuresCol="varied", regParam=0.01, maxIter=50)
    return PipelineModel([varied, regression.fit(varied.transform(rows))])


def judge(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame, sizes: Sequence[int] = (3, 4, 5), buckets: int = 1 << 18, threshold: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, blocked_score`` of every page.

    The longest rule that fits decides; where none fits, the model does: ``block`` from ``threshold``
    on. A rule fits its host and the subdomains of it, when the path starts with the rule's path.
    A null or malformed url has an empty host and path, which the model judges like any other. Every
    row gives a row. The model is small; a map over rows, no shuffle.
    """
    model = train(labelled, sizes, buckets)
    rows = with_host_and_path(pages.select("page_id", "url"))
    fits = [
        F.when(
            ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(path)),
            F.struct(F.lit(len(host) + len(path)).alias("size"), F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, host, path in rules
    ]
    longest = reduce(lambda a, b: F.when(a.isNull() | (b["size"] > a["size"]), F.coalesce(b, a)).otherwise(a), fits) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    scored = model.transform(with_features(rows, sizes, buckets)).withColumns({"blocked_score": vector_to_array("probability")[1], "_rule": longest})
    by_model = F.when(F.col("blocked_score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", by_model).alias("verdict"), "blocked_score")
