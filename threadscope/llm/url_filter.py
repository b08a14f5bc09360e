"""URL filter: rules by host and path, and boosted trees for the other URLs.

Rules decide the URLs that they fit. URLs that a rule decides are also the
labelled examples: gradient-boosted trees learn from them which lexical
features (lengths, depth, digit ratio, entropy, parameter counts, suffix
statistics) go with a block, and judge the rest. All of it runs as DataFrame
functions and Spark ML in the JVM.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadscope.llm.common import free_name

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"

FEATURES = ["n_url", "n_host", "n_path", "depth", "labels", "digit_ratio", "host_digit_ratio", "entropy", "params",
            "has_fragment", "hyphens", "percents", "upper_ratio", "longest_segment", "ends_slash",
            "domain_rate", "domain_seen", "first_rate", "first_seen"]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty if the url is null or has no ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; may be empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, _, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), "/" + path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits the host or one of its parent domains and the
    start of the path, or null. ``rules``: rule -> verdict, a short list."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):  # the last one set, so the longest, wins
        h, p = split_rule(rule)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits (empty: 0)."""
    n = F.char_length(text).cast("double")

    def add(total: Column, c: Column) -> Column:
        share = (n - F.char_length(F.replace(text, c, F.lit("")))) / n
        return F.when((c == "") | (share <= 0), total).otherwise(total - share * F.log(share) / math.log(2))

    return F.when(n > 0, F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), add)).otherwise(F.lit(0.0))


def _count(text: Column, chars: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("double")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def lexical(df: DataFrame, url: Column, host: Column, path: Column) -> DataFrame:
    """``df`` with the lexical features and the two keys of suffix statistics:
    the host's last label and the path's first segment."""
    n, digits = F.char_length(url).cast("double"), "0123456789"
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    segments = F.split(path, "/")
    return df.withColumns({
        "n_url": n, "n_host": F.char_length(host).cast("double"), "n_path": F.char_length(path).cast("double"),
        "depth": _count(path, "/"), "labels": _count(host, ".") + 1.0,
        "digit_ratio": _ratio(_count(url, digits), n), "host_digit_ratio": _ratio(_count(host, digits), F.char_length(host)),
        "entropy": entropy(url), "params": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"), "hyphens": _count(url, "-"),
        "percents": _count(url, "%"), "upper_ratio": _ratio(_count(url, UPPER), n),
        "longest_segment": F.array_max(F.transform(segments, F.char_length)).cast("double"),
        "ends_slash": path.endswith("/").cast("double"),
        "domain": F.substring_index(host, ".", -1),
        "first": F.coalesce(F.get(segments, F.lit(1)), F.lit(""))})


def _rates(labelled: DataFrame, key: str) -> DataFrame:
    """Labelled URLs, and blocked ones, of each value of ``key``; counted over all."""
    return labelled.groupBy(key).agg(F.count("*").cast("double").alias(f"{key}_n"),
                                     F.sum("label").alias(f"{key}_blocked"))


def _with_rates(df: DataFrame, rates: dict[str, DataFrame], prior: float, strength: float, own: Column) -> DataFrame:
    """Smoothed share of blocked URLs by suffix; ``own``: how many rows of the
    row's own URL are among those counted, which are then left out."""
    for key, r in rates.items():
        df = df.join(r, key, "left")
        n = F.coalesce(F.col(f"{key}_n"), F.lit(0.0)) - own
        blocked = F.coalesce(F.col(f"{key}_blocked"), F.lit(0.0)) - own * F.coalesce(F.col("label"), F.lit(0.0))
        df = (df.withColumns({f"{key}_rate": (blocked + prior * strength) / (n + strength), f"{key}_seen": F.log1p(n)})
              .drop(f"{key}_n", f"{key}_blocked"))
    return df


def filter_urls(df: DataFrame, url: str, rules: dict[str, str], max_examples: int = 20_000, trees: int = 20,
                depth: int = 4, strength: float = 5.0, seed: int = 7) -> DataFrame:
    """``df`` with host, path, rule, verdict (``allow`` or ``block``) and
    blocked_score (the trees' probability of a block; null where a rule
    decides). Columns of those names are replaced; all rows are kept.

    The rule's verdict holds where a rule fits, otherwise the trees'. The trees
    are fitted on a sample of the distinct URLs that rules decide (the bound
    that the fit has; suffix statistics count all rows), of each label half of
    ``max_examples`` at most, or more where the other label has fewer. A hash
    of the url draws them in proportion to the rows that repeat them, the most
    frequent ones always; an example weighs as many rows as it stands for.
    Where no rule fits any url, every verdict is ``allow``; where all rules
    that fit agree, that verdict is everyone's. Null and empty urls have an
    empty host and path.
    """
    names = ["host", "path", "rule", "verdict", "blocked_score"]
    df = df.drop(*names)
    # The row goes along as one struct, so no column of it can clash.
    u, row = F.coalesce(F.col("_url"), F.lit("")), free_name(df, "_row")
    rows = df.select(F.struct("*").alias(row), F.col(f"`{url}`").cast("string").alias("_url"))
    rows = rows.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    blocking = [r for r, v in rules.items() if v == "block"]
    rows = rows.withColumn("label", F.when(F.col("rule").isNotNull(), F.col("rule").isin(blocking).cast("double")))
    ruled = F.when(F.col("label") > 0, "block").when(F.col("label") == 0, "allow")
    result = [F.col(f"{row}.*"), "host", "path", "rule"]
    n, blocked = rows.agg(F.count("label"), F.sum("label")).first()
    if not n or blocked in (0, n):
        only = "block" if n and blocked else "allow"
        return rows.select(*result, F.coalesce(ruled, F.lit(only)).alias("verdict"),
                           F.when(F.col("rule").isNull(), float(only == "block")).alias("blocked_score"))
    labelled = lexical(rows.filter("label is not null").select("_url", "host", "path", "label"), u, F.col("host"), F.col("path"))
    rates = {key: _rates(labelled, key) for key in ("domain", "first")}
    prior = blocked / n
    # A rule decides by the url, so equal URLs have one label.
    urls = labelled.groupBy("_url", "label").agg(F.count("*").cast("double").alias("_n"))
    have = {r.label: r.n for r in urls.groupBy("label").agg(F.count("*").alias("n")).collect()}
    room = {y: max(max_examples // 2, max_examples - have[1.0 - y]) for y in (0.0, 1.0)}
    # Threshold sampling: rows / u, with u from 0 to 1 by hash, reaches the label's limit. Limits come from a histogram.
    u_hash = (F.pmod(F.xxhash64("_url", F.lit(seed)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    urls = urls.withColumn("_level", F.floor(F.log2(F.col("_n") / u_hash) * 64))
    levels = urls.groupBy("label", "_level").agg(F.count("*").alias("n")).collect()  # 64 levels an octave
    least = {}
    for y in (0.0, 1.0):
        taken, least[y] = 0, None
        for level, size in sorted(((r._level, r.n) for r in levels if r.label == y), reverse=True):
            if least[y] is not None and taken + size > room[y]:
                break
            taken, least[y] = taken + size, level
        if taken == have[y]:
            least[y] = 0  # all: each stands for its own rows
    limit = F.when(F.col("label") > 0, least[1.0]).otherwise(least[0.0])
    drawn = urls.filter(F.col("_level") >= limit)
    weight = F.greatest("_n", F.pow(F.lit(2.0), limit / 64))
    features = lexical(drawn.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))}),
                       F.col("_url"), F.col("host"), F.col("path"))
    examples = _with_rates(features, rates, prior, strength, F.col("_n")).select("label", weight.alias("_weight"), *FEATURES)
    examples = examples.repartition(4).persist()
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    boosted = GBTClassifier(featuresCol="_features", labelCol="label", weightCol="_weight", maxIter=trees, maxDepth=depth, stepSize=0.2,
                            seed=seed, predictionCol="_predicted")
    boosted = boosted.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    model = PipelineModel([assemble, boosted.fit(assemble.transform(examples))])
    examples.unpersist()
    decided = rows.filter("rule is not null").select(*result, ruled.alias("verdict"),
                                                     F.lit(None).cast("double").alias("blocked_score"))
    open_rows = lexical(rows.filter("rule is null"), u, F.col("host"), F.col("path"))
    judged = model.transform(_with_rates(open_rows, rates, prior, strength, F.lit(0.0)))
    judged = judged.select(*result, F.when(F.col("_predicted") > 0.5, "block").otherwise("allow").alias("verdict"),
                           F.get(vector_to_array("_probability"), F.lit(1)).alias("blocked_score"))
    return decided.unionByName(judged)
