"""URL filter: rules first, else gradient-boosted trees on lexical features.

Rules name a host (and so its subdomains) and the start of a path. The URLs that a rule judges are the labelled ones;
the trees are fitted on at most ``TRAIN_ROWS`` of them, those with the smallest hash, and judge the others.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import written

#: Most labelled URLs that the trees are fitted on; it also bounds the table of suffix statistics.
TRAIN_ROWS = 20_000
TREES = 12
DEPTH = 4
#: Rows that a suffix without labels counts for.
PRIOR_ROWS = 5.0
FOLDS = 5

FEATURES = [
    "url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "host_digits", "entropy", "parameters",
    "query_length", "hyphens", "percent_codes", "longest_token", "extension", "secure", "suffix_seen", "suffix_blocked",
    "domain_seen", "domain_blocked",
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?`` or ``#``.

    A null URL, and one without ``://``, has two empty strings.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits (of equal ones, the first in order) and its verdict, else null twice."""
    rule = verdict = F.lit(None).cast("string")
    for name in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        rule_host, _, rule_path = name.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(rules[name])).otherwise(verdict)
    return rule, verdict


def _lexical(urls: DataFrame) -> DataFrame:
    """Adds the features that a URL has by itself, its suffix and its domain."""
    u = F.coalesce("_url", F.lit(""))
    length = F.greatest(F.length(u), F.lit(1))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]", ""))
    entropy = F.expr(
        "aggregate(transform(array_distinct(split(coalesce(_url, ''), '')), "
        "c -> (length(_url) - length(replace(_url, c, ''))) / double(greatest(length(_url), 1))), 0D, "
        "(a, p) -> a - if(p > 0, p * log2(p), 0D))"
    )
    labels = F.split("_host", r"\.")
    return urls.withColumns({
        "url_length": F.length(u), "host_length": F.length("_host"), "path_length": F.length("_path"),
        "depth": F.size(F.filter(F.split("_path", "/"), lambda x: x != "")), "host_labels": F.size(labels),
        "digit_ratio": digits(u) / length, "host_digits": digits(F.col("_host")), "entropy": F.coalesce(entropy, F.lit(0.0)),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")), "query_length": F.length(query),
        "hyphens": F.length(u) - F.length(F.replace(u, F.lit("-"), F.lit(""))),
        "percent_codes": F.size(F.split(u, "%")) - 1,
        "longest_token": F.array_max(F.transform(F.split(u, "[^A-Za-z0-9]+"), F.length)),
        "extension": F.col("_path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"), "secure": u.startswith("https://").cast("int"),
        "_suffix": F.element_at(labels, -1), "_domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)),
    })


def _with_statistics(urls: DataFrame, sample: DataFrame, training: bool) -> DataFrame:
    """Adds how often each suffix and domain is labelled and which part of that is blocked.

    In training, a row sees the counts of the other folds only, so that no statistic holds its own label.
    """
    prior = F.lit(sample.agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0])
    out = urls
    for key in (["_suffix"], ["_domain"]):
        # at most as many rows as the sample has
        n, b = F.lit(0), F.lit(0.0)
        for sign, by in ((1, key), *([(-1, [*key, "_fold"])] if training else [])):
            names = f"_n{sign}", f"_b{sign}"
            counted = sample.groupBy(*by).agg(F.count("*").alias(names[0]), F.sum("label").alias(names[1]))
            out = out.join(F.broadcast(counted), by, "left")
            n, b = n + sign * F.coalesce(names[0], F.lit(0)), b + sign * F.coalesce(names[1], F.lit(0.0))
        out = out.withColumns({f"{key[0][1:]}_seen": F.log1p(n), f"{key[0][1:]}_blocked": (b + PRIOR_ROWS * prior) / (n + PRIOR_ROWS)})
        out = out.drop("_n1", "_b1", "_n-1", "_b-1")
    return out


def judge(urls: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(id, host, path, rule, verdict) of every row: the longest fitting rule's verdict, else that of the trees.

    Null and empty URLs are judged by the trees like others. Without labelled URLs everything else is allowed; if all
    labels agree, so do the verdicts. Equal URLs get equal verdicts and are learned from once; whole URLs count, however
    long. Repeated rows stay, an empty table gives no rows; only the id and url columns are read.
    """
    host, path = host_and_path(F.col("_url"))
    named = urls.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url")).withColumns({"_host": host, "_path": path})
    rule, verdict = matching_rule(F.col("_host"), F.col("_path"), rules)
    ruled = named.withColumns({"rule": rule, "_verdict": verdict})
    labelled = ruled.filter("rule is not null").select("_url", "_host", "_path", (F.col("_verdict") == "block").cast("double").alias("label"))
    labelled = labelled.distinct()  # copies of one URL would fill the sample
    chosen = labelled.orderBy(F.xxhash64("_url"), "_url").limit(train_rows).withColumn("_fold", F.pmod(F.hash("_url"), F.lit(FOLDS)))
    sample = written(_lexical(chosen), "labelled")
    kinds = [r.label for r in sample.select("label").distinct().orderBy("label").collect()]  # at most 0 and 1
    if len(kinds) < 2:
        learned = ruled.withColumn("_learned", F.lit("block" if kinds == [1.0] else "allow"))
    else:
        assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
        train = assemble.transform(_with_statistics(sample, sample, True)).select("features", "label")
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=42, maxBins=32).fit(train)
        scored = model.transform(assemble.transform(_with_statistics(_lexical(ruled), sample, False)))
        learned = scored.withColumn("_learned", F.when(F.col("prediction") > 0.5, "block").otherwise("allow"))
    return learned.select(
        F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), "rule",
        F.coalesce("_verdict", "_learned").alias("verdict"),
    )
