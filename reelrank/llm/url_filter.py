"""URL verdicts: explicit host and path rules, then gradient-boosted trees.

The trees see lexical features only: lengths, depth, digit ratio, entropy,
parameter and hyphen counts, and how often a host suffix was blocked among the
labelled URLs. They are trained on labelled URLs. Where no labelled table is
given, :func:`weak_labels` labels URLs by terms that hosts of link spam, gambling
and the like carry in their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import materialise

#: Labelled URLs that the fit reads at most.
SAMPLE = 20_000
TREES, DEPTH, SEED = 20, 4, 42

#: Parts of host names that mark a host as unwanted (labels for training only).
HOST_TERMS = ("casino pills bets betting poker adult xxx porn spam farm cheap free win ads track tracker click "
              "viagra loan loans lottery escort warez crack replica").split()

FEATURES = ["url_length", "host_length", "path_length", "depth", "labels", "digits", "digit_ratio", "entropy",
            "host_entropy", "params", "hyphens", "longest_label", "suffix_rate", "suffix_seen"]


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``pattern`` = host + path prefix, like ``example.org/es/``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        _, slash, rest = self.pattern.partition("/")
        return slash + rest


#: Fixed by the task.
RULES = (Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
         Rule("allow", "com/fr/"), Rule("block", "com/de/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: str) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: str, path: str, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(pattern, verdict) of the longest rule that fits; null if none does."""
    pattern = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):  # a longer one overwrites
        fits = ((F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)) & F.col(path).startswith(rule.path)
        pattern = F.when(fits, rule.pattern).otherwise(pattern)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return pattern, verdict


def _suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits (0 for empty text)."""
    n = F.length(text)
    share = F.transform(F.array_distinct(F.split(text, "")), lambda c: (
        n - F.length(F.replace(text, c, F.lit("")))) / n)
    bits = F.aggregate(share, F.lit(0.0), lambda acc, p: acc - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


def _lexical(urls: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``urls`` (url, host, path ...) with the feature columns. ``suffixes``
    (suffix, suffix_rate, suffix_seen) come from the bounded labelled sample."""
    url = F.coalesce("url", F.lit(""))
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parts = F.split("host", r"\.")
    rows = urls.withColumns({
        "url_length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": F.length(F.regexp_replace("path", "[^/]", "")), "labels": F.size(parts), "digits": digits,
        "digit_ratio": F.when(F.length(url) > 0, digits / F.length(url)).otherwise(0.0),
        "entropy": _entropy(url), "host_entropy": _entropy(F.col("host")),
        "params": F.when(query == "", 0).otherwise(F.length(F.regexp_replace(query, "[^&]", "")) + 1),
        "hyphens": F.length(F.regexp_replace("host", "[^-]", "")),
        "longest_label": F.array_max(F.transform(parts, lambda p: F.length(p))),
        "suffix": _suffix(F.col("host"))})
    return rows.join(F.broadcast(suffixes), "suffix", "left").fillna({"suffix_rate": 0.5, "suffix_seen": 0.0})


def weak_labels(urls: DataFrame) -> DataFrame:
    """url, label (1: block) for URLs with a host, by :data:`HOST_TERMS`."""
    bad = F.arrays_overlap(F.split(host_of("url"), r"[.\-]"), F.array(*[F.lit(t) for t in HOST_TERMS]))
    return urls.filter(host_of("url") != "").select("url", bad.cast("int").alias("label"))


@dataclass
class UrlModel:
    """Fitted trees (None: all labels were ``constant``) and suffix statistics."""

    trees: object
    suffixes: DataFrame
    constant: str | None = None

    def verdicts(self, urls: DataFrame, name: str) -> DataFrame:
        if self.trees is None:
            return urls.withColumn(name, F.lit(self.constant))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(_lexical(urls, self.suffixes))
        judged = self.trees.transform(rows)
        return judged.select(*urls.columns, F.when(F.col("_prediction") == 1.0, "block").otherwise("allow").alias(name))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> UrlModel:
    """Train on at most ``sample`` distinct labelled URLs (url, label), chosen
    by a hash of the URL. One class only, or no row, gives a constant verdict
    (allow if there is no row)."""
    rows = labelled.filter("url is not null and label in (0, 1)").groupBy("url").agg(F.max("label").alias("label"))
    rows = rows.orderBy(F.xxhash64("url"), "url").limit(sample)
    rows = materialise(rows.withColumns({"host": host_of("url"), "path": path_of("url")}), "url-sample")
    suffixes = materialise(
        rows.groupBy(_suffix(F.col("host")).alias("suffix")).agg(
            ((F.sum("label") + 1.0) / (F.count("*") + 2.0)).alias("suffix_rate"),
            F.log1p(F.count("*").cast("double")).alias("suffix_seen")), "url-suffixes")
    classes = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(classes) < 2:
        return UrlModel(None, suffixes, "block" if classes == {1} else "allow")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(_lexical(rows, suffixes))
    trees = GBTClassifier(featuresCol="_features", labelCol="label", predictionCol="_prediction",
                          maxIter=TREES, maxDepth=DEPTH, seed=SEED)
    return UrlModel(trees.fit(vectors.select("_features", "label")), suffixes)


def judge(pages: DataFrame, model: UrlModel, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, rule, verdict, decided_by.

    A null URL, or one without ``://``, has an empty host and path and fits no
    rule; the trees judge it. Equal rows come back as often as given. Other
    columns are not read.
    """
    urls = pages.select("page_id", "url").withColumns({"host": host_of("url"), "path": path_of("url")})
    judged = model.verdicts(urls, "_learned")
    pattern, verdict = matching_rule("host", "path", rules)
    return judged.select("page_id", "host", "path", pattern.alias("rule"),
                         F.coalesce(verdict, F.col("_learned")).alias("verdict"),
                         F.when(verdict.isNull(), "model").otherwise("rule").alias("decided_by"))
