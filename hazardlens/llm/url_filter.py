"""URL filter: allow and block rules, then logistic regression on hashed n-grams.

Rules decide where they fit; every other url is judged by a logistic regression
on hashed character n-grams of its host and its path, trained here from a small
labelled url table. Features, training and scoring are Spark ML and DataFrame
functions. Rules are looked up by the host's suffixes in a table sent along with an
Arrow function, so the time a url takes does not follow their number. No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path

NGRAMS = (3, 4, 5)
FEATURES = 1 << 16
MAX_RULES = 100_000          # rules go along with every task; a longer list is refused
MAX_TRAINING_URLS = 100_000  # the labelled table is small by contract; a longer one is refused
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``text`` is host, ``/`` and path prefix, like ``example.com/en/``; it fits
    the host and all its subdomains where the path starts with the prefix."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (Rule("com/", ALLOW), Rule("example.com/en/", BLOCK), Rule("www.example.com/en/", ALLOW),
         Rule("net/es/", BLOCK), Rule("net/fr/", BLOCK))

# The small labelled url table: hosts and paths of kinds that a crawl blocks or
# allows, each as https://<host>/<path>. None of them is a site of the test pages.
BLOCKED_HOSTS = (
    "discount-pills.example.org", "buy-pills-online.example.net", "pharmacy-deals.example.net", "cheapest-meds.example.org",
    "cheap-viagra.example.org", "link-farm.example.net", "content-farm.example.org", "seo-spam.example.org", "spam-blog.example.net",
    "spamhost.example.net", "ad-server.example.net", "ads-click.example.org", "click-track.example.org", "tracker-ads.example.net",
    "popads.example.org", "online-casino.example.net", "casino-slots.example.org", "win-jackpot.example.org", "big-win.example.net",
    "poker-bets.example.net", "sports-bets.example.org", "free-spins.example.net", "adult-cams.example.net", "sexy-adult.example.org",
    "xxx-tube.example.org", "free-warez.example.org", "crack-keygen.example.net", "phish-login.example.org",
    "malware-drop.example.net", "payday-loans.example.org", "crypto-scam.example.net", "free-bitcoin.example.org")
ALLOWED_HOSTS = (
    "news.example.org", "library.example.net", "science-daily.example.org", "university.example.net", "museum.example.org",
    "blog.gardening.example.org", "m.weather.example.net", "www.history.example.org", "docs.python.example.net",
    "kitchen-recipes.example.org", "blog.travel.example.net", "www.health-advice.example.org", "forum.cycling.example.net",
    "wiki.example.org", "encyclopedia.example.net", "m.transport.example.org", "school.example.net", "poetry.example.org",
    "theatre.example.org", "blog.nutrition.example.net", "www.education.example.org", "m.nation.example.net", "northern-birds.example.org",
    "blog.father.example.net", "mathematics.example.org", "www.thesaurus.example.net", "earth.example.org", "m.together.example.org",
    "anthropology.example.net", "blog.clothing.example.org", "www.thunder.example.net", "rhythm.example.org", "lighthouse.example.net",
    "m.anthem.example.org", "blog.authors.example.net", "www.station.example.org", "pathways.example.net", "m.gather.example.net",
    "bother.example.org", "blog.southern.example.net")
TRAINING_PATHS = ("/en/101", "/de/202.html", "/fr/303/", "/es/404")


def training_urls(spark: SparkSession) -> DataFrame:
    """The default labelled table: ``url, blocked``."""
    rows = [(f"https://{host}{path}", blocked) for hosts, blocked in ((BLOCKED_HOSTS, 1.0), (ALLOWED_HOSTS, 0.0))
            for host in hosts for path in TRAINING_PATHS]
    return spark.createDataFrame(rows, "url string, blocked double")


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _ngrams(text: Column, mark: str) -> Column:
    """All character n-grams of a text between boundary marks."""
    whole = F.concat(F.lit(mark + "^"), text, F.lit("$"))
    first = 1 + len(mark)

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(first), F.length(whole) - n + 1)
        grams = F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(whole, i, F.lit(n))))
        return F.when(F.length(whole) - n + 1 >= first, grams).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(*(of(n) for n in NGRAMS)))


def _features(urls: DataFrame, host: Column, path: Column, grams: str, name: str) -> DataFrame:
    terms = F.concat(_ngrams(host, "h:"), _ngrams(path, "p:"))
    hasher = HashingTF(numFeatures=FEATURES, binary=True, inputCol=grams, outputCol=name)
    return hasher.transform(urls.withColumn(grams, terms)).drop(grams)


def train(labelled: DataFrame, regularisation: float = 0.01) -> LogisticRegressionModel:
    """A model from ``labelled(url, blocked)``, blocked 0 or 1; null labels teach nothing."""
    rows = labelled.select("url", F.col("blocked").cast("double").alias("blocked")).where("blocked IS NOT NULL")
    if rows.limit(MAX_TRAINING_URLS + 1).count() > MAX_TRAINING_URLS:
        raise ValueError(f"more than {MAX_TRAINING_URLS} labelled urls")
    rows = _features(rows, host_of(F.col("url")), path_of(F.col("url")), "grams", "features")
    lr = LogisticRegression(featuresCol="features", labelCol="blocked", regParam=regularisation, maxIter=50,
                            standardization=False)
    model = lr.fit(rows.coalesce(1))    # a small table: one partition, one fixed order of sums
    # a fitted model holds on to its session through its summary, which tasks cannot take along; a loaded one does not
    path = staging_path(rows.sparkSession, "url-model")
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def _rule_table(rules: Iterable[Rule]) -> dict[str, tuple[list[int], dict[str, str]]]:
    """For each host the lengths of its rules' paths, longest first, and the verdict of
    each path; of two equal texts ``block`` wins."""
    by_host: dict[str, dict[str, str]] = {}
    for r in rules:
        paths = by_host.setdefault(r.host, {})
        if paths.get(r.path) != BLOCK:
            paths[r.path] = r.verdict
    return {h: (sorted({len(p) for p in paths}, reverse=True), paths) for h, paths in by_host.items()}


def _longest(host: str, path: str, table: dict) -> tuple[str | None, str | None]:
    """The longest fitting rule among those of the host and of its suffixes after a dot;
    of equal lengths the longer host."""
    best: tuple[int, str, str, str] | None = None
    at = 0
    while True:
        suffix = host[at:]
        lengths, paths = table.get(suffix, ((), {}))
        for n in lengths:
            if n <= len(path) and path[:n] in paths:
                if best is None or len(suffix) + n > best[0]:
                    best = len(suffix) + n, suffix, path[:n], paths[path[:n]]
                break
        dot = host.find(".", at)
        if dot < 0:
            return (best[1] + best[2], best[3]) if best else (None, None)
        at = dot + 1


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits, nulls without one."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    table = _rule_table(rules)

    @F.pandas_udf("rule string, verdict string")
    def look_up(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_longest(h, p, table) for h, p in zip(hosts, paths)], columns=["rule", "verdict"])

    return look_up(host, path)


def judge(pages: DataFrame, model: LogisticRegressionModel, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, score``.

    ``score`` is the model's chance of a url to block; ``verdict`` is the fitting
    rule's, else ``block`` from ``threshold`` up. A null url, or one without
    ``://``, has empty host and path, fits no rule and is scored like any other.
    Repeated rows and null ids are judged row by row; very long urls whole.
    Other columns are ignored, whatever their names; an empty table gives no
    rows.
    """
    url = pages[url_col].cast("string")
    own = pages.select(pages[id_col].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    own = own.withColumn("fits", fitting_rule(F.col("host"), F.col("path"), rules))
    own = own.select("page_id", "host", "path", F.col("fits.rule").alias("rule"), F.col("fits.verdict").alias("ruled"))
    own = _features(own, F.col("host"), F.col("path"), "grams", "features")
    scored = model.transform(own).withColumn("score", vector_to_array("probability")[1])
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", F.when(F.col("score") >= threshold, BLOCK).otherwise(ALLOW)).alias("verdict"),
                         "score")
