"""URL filters: host and path rules, then gradient-boosted trees on lexical features.

Everything is column expressions and Spark's own tree ensemble; no Python
runs on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.llm.common import bounded_sample
from larderspark.session import cut_lineage

#: (verdict, host, path), fixed values: a rule fits its host and all subdomains, if the path starts with its path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Host words of the label list, by kind: a URL whose host has one between dots, hyphens or digits is labelled bad.
BAD_WORDS = (
    "bet", "bets", "betting", "bingo", "blackjack", "casino", "casinos", "gambling", "jackpot", "lottery", "poker",
    "roulette", "slots",
    "cialis", "meds", "pharma", "pill", "pills", "steroids", "viagra",
    "adult", "cams", "erotic", "escort", "escorts", "hentai", "nude", "nudes", "porn", "porno", "sex", "sexy", "xxx",
    "ad", "ads", "adserver", "adservice", "advert", "adverts", "affiliate", "banner", "banners", "clickbait", "popup",
    "popups", "track", "tracker", "trackers", "tracking",
    "backlinks", "linkfarm", "phish", "phishing", "scam", "spam", "spammer",
    "cracked", "keygen", "malware", "torrents", "trojan", "warez",
)
#: Labelled URLs that the trees are fitted on, at most (chosen by hash), and rows that a suffix needs for a statistic.
TRAINING_ROWS, SUFFIX_ROWS = 10_000, 20
TREES, DEPTH = 15, 3
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "longest_label", "hyphens",
    "digit_ratio", "host_entropy", "path_entropy", "parameters", "suffix_rate", "suffix_share",
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; of equally long ones the first listed."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, h, p in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for empty."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.aggregate(
        F.array_distinct(F.split(text, "")), F.lit(0.0),
        lambda total, c: total - F.when(c == "", F.lit(0.0)).otherwise(share(c) * F.log2(share(c))),
    )


def with_lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with the lexical features but the suffix statistics, and ``suffix``."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    real = lambda c: c.cast("double")
    return urls.withColumns({
        "suffix": F.element_at(labels, -1),
        "url_length": real(F.length(url)), "host_length": real(F.length(host)), "path_length": real(F.length(path)),
        "depth": real(F.size(F.split(path, "/")) - 1), "labels": real(F.size(labels)),
        "longest_label": real(F.array_max(F.transform(labels, F.length))),
        "hyphens": real(F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))),
        "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.length(url), F.lit(1)),
        "host_entropy": entropy(host), "path_entropy": entropy(path),
        "parameters": real(F.when(query == "", 0).otherwise(F.size(F.split(query, "&")))),
    })


def with_suffix(rows: DataFrame, statistics: DataFrame, share: float) -> DataFrame:
    """Bad rate and share of the host's last label; the overall rate and zero for a rare one."""
    return rows.join(F.broadcast(statistics), "suffix", "left").fillna({"suffix_rate": share, "suffix_share": 0.0})


def suspicious_form(url: Column) -> Column:
    """Signs of a bad URL that need no word: a user name before the host, an address for a name, a punycode label,
    two hyphens in one label, or a label with four digits or more."""
    host = host_of(url)
    return host.contains("@") | host.rlike(r"^(\d{1,3}\.){3}\d{1,3}(:\d+)?\z") | host.rlike(
        r"(^|\.)xn--|-[^.]*-|(\d[^.]*){4}")


def labelled_by_words(urls: DataFrame, words=BAD_WORDS) -> DataFrame:
    """(url, label): 1 if a part of the host is a listed word or the URL has a suspicious form, else 0.

    A host with a hyphen and neither of these has a null label: what no list
    names is not thereby good, so it teaches the trees nothing and they judge
    it by its likeness to the labelled ones.
    """
    host = host_of(F.col("url"))
    listed = F.arrays_overlap(F.split(host, "[^a-z]+"), F.array(*map(F.lit, words)))
    label = F.when(listed | suspicious_form(F.col("url")), 1).when(~host.contains("-"), 0)
    return urls.filter("url is not null").select("url", label.alias("label"))


class Model:
    """Trees (None if the labels have one value only), suffix statistics and the share of bad URLs."""

    def __init__(self, trees: GBTClassificationModel | None, statistics: DataFrame, share: float):
        self.trees, self.statistics, self.share = trees, statistics, share


def fit_model(labelled: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Trees from at most about ``rows`` of (url, label); null labels and URLs are left out.

    The suffix statistics have at most ``rows / SUFFIX_ROWS`` rows, so they may
    be broadcast.
    """
    usable = labelled.select("url", "label").filter("url is not null and label in (0, 1)")
    chosen = bounded_sample(usable, rows, "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    lexical = cut_lineage(with_lexical(chosen).coalesce(4), "labelled-urls")
    total, share = lexical.agg(F.count("*"), F.avg("label")).first()
    share = share or 0.0
    statistics = cut_lineage(
        lexical.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("label").alias("bad")).filter(F.col("n") >= SUFFIX_ROWS)
        .select("suffix", ((F.col("bad") + share) / (F.col("n") + 1)).alias("suffix_rate"),
                (F.col("n") / max(total, 1)).alias("suffix_share")),
        "suffixes",
    )
    if not 0 < share < 1:
        return Model(None, statistics, share)
    rows_ = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_suffix(lexical, statistics, share))
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, featuresCol="features", labelCol="label")
    return Model(learner.fit(rows_.select("features", "label")), statistics, share)


def judge(pages: DataFrame, model: Model, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) per row of (page_id, url).

    The longest fitting rule decides; else a score (chance of a bad URL) of
    THRESHOLD or more blocks. A null URL, or one without ``://``, has an empty
    host and path and is scored like any other. No shuffle.
    """
    urls = pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    if model.trees is None:
        scored = urls.withColumn("score", F.lit(model.share))
    else:
        rows = with_suffix(with_lexical(urls), model.statistics, model.share)
        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
        scored = model.trees.transform(rows).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "score")


def filter_pages(pages: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``judge`` with a model of ``labelled``; unset, the pages' URLs labelled by words and form."""
    return judge(pages, fit_model(labelled_by_words(pages) if labelled is None else labelled))
