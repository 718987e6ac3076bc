"""URL filter: rules by host and path, and a logistic regression on character n-grams for the rest."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwave.llm.common import let, table

# --- fixed values: rules (verdict, host and path) ------------------------------------------------
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

# --- labelled hosts: a small training table of general words; hosts it is tested on are not among them ---
UNWANTED = (
    "pills-online", "best-pills", "pharma-cheap", "cheap-meds", "casino-royal", "big-casino", "win-money", "bets-today",
    "sport-bets", "free-spins", "slots-free", "spam-site", "spam-mails", "link-farm", "content-farm", "ad-track", "track-clicks",
    "click-ads", "ads-popup", "adserver", "tracker", "fast-loans", "cheap-loans", "hot-dates", "xxx-cams", "adult-cams",
    "adult-dates", "replica-watch", "lottery-win", "crypto-win", "free-prize",
)
WANTED = (
    "library", "news", "gardening", "wiki", "school", "recipes", "history", "science", "weather", "museum", "music", "travel",
    "forum", "docs", "university", "city", "health", "books", "letters", "authors", "journal", "nature", "theater", "nation",
    "station", "reading", "brother", "thousand", "northern", "another", "teaching", "motion", "heritage", "astronomy", "stable",
    "southwest", "sunshine", "thesis", "earth", "table",
)
PREFIXES = ("", "www.", "blog.", "m.")
ZONES = ("example.com", "example.net", "example.org")
LANGS = ("en", "de", "fr", "es")

NGRAMS = (2, 3, 4)
SLOTS = 1 << 14
BLOCK_AT = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule whose host is the host or a parent and whose path starts the path."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest goes last, so it is asked first
        cut = rule.index("/")
        fits = ((host == rule[:cut]) | F.endswith(host, F.lit("." + rule[:cut]))) & F.startswith(path, F.lit(rule[cut:]))
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, decision).otherwise(verdict)
    return text, verdict


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The default training table: (url, label), label 1 for unwanted hosts."""
    rows = []
    for label, names in ((1.0, UNWANTED), (0.0, WANTED)):
        for i, name in enumerate(names):
            for j, prefix in enumerate(PREFIXES):
                rows.append((f"https://{prefix}{name}.{ZONES[(i + j) % 3]}/{LANGS[(i + 2 * j) % 4]}/{(37 * i + 101 * j) % 997}", label))
    return spark.createDataFrame(rows, "url string, label double")


def with_ngrams(df: DataFrame, host: Column, path: Column) -> DataFrame:
    """Adds the character n-grams of the host and of the path, told apart by a prefix."""

    def grams(text: Column, mark: str) -> Column:
        chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")

        def of_length(c: Column, n: int) -> Column:
            last = F.greatest(F.lit(0), F.size(c) - n)
            return F.transform(F.sequence(F.lit(0), last), lambda i: F.concat(F.lit(mark), *[F.coalesce(F.get(c, i + k), F.lit("")) for k in range(n)]))

        return let(chars, lambda c: F.concat(*[of_length(c, n) for n in NGRAMS]))

    return df.withColumn("_grams", F.concat(grams(host, "h"), grams(path, "p")))


def train(urls: DataFrame) -> PipelineModel:
    """Fits on a labelled URL table (url, label 0 or 1); null labels are left out."""
    host, path = host_and_path(F.col("url"))
    rows = with_ngrams(urls.where(F.col("label").isNotNull()), host, path)
    hashed = HashingTF(inputCol="_grams", outputCol="_hashed", numFeatures=SLOTS, binary=True)
    regression = LogisticRegression(featuresCol="_hashed", labelCol="label", predictionCol="_predicted", probabilityCol="_probability", rawPredictionCol="_raw", regParam=0.01, maxIter=50)
    return Pipeline(stages=[hashed, regression]).fit(rows)


def judge(pages: DataFrame, model: PipelineModel, rules: Sequence[tuple[str, str]] = RULES, block_at: float = BLOCK_AT) -> DataFrame:
    """page_id, host, path, rule, verdict and score (probability of unwanted) of every row of ``pages`` (page_id, url).

    The longest fitting rule decides, else the score. Null urls and urls without ``://`` have empty host
    and path and are scored as such. Equal rows get equal verdicts; other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    scored = model.transform(with_ngrams(parsed, F.col("host"), F.col("path")))
    score = vector_to_array("_probability")[1]
    rule, decided = rule_for(F.col("host"), F.col("path"), rules)
    found = scored.select("page_id", "host", "path", rule.alias("rule"), decided.alias("_decided"), score.alias("score"))
    verdict = F.coalesce("_decided", F.when(F.col("score") >= block_at, "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages"), train(labelled_urls(spark)))
