"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for the rest.

All in DataFrame functions and Spark's own trees; the trees are fitted on URLs that the rules label.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, stage

#: (verdict, host, path) of the rules in use: a rule fits its host and all subdomains where the path starts with its path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
FEATURES = [
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "hyphens", "entropy", "parameters",
    "query_length", "has_fragment", "secure", "longest_label", "vowel_ratio", "suffix_share", "suffix_count",
]
#: Parts of the labelled URLs; a URL's suffix share comes from the other parts.
FOLDS = 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first :// to the next of / ? # or the end, A-Z lower-cased) and path (then to ? # or the end); both
    empty for null and where there is no ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as written (host and path in one), and its verdict; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def _entropy(s: Column) -> Column:
    """Bits a character, over the alphabet of lower-case letters, digits and all else as one."""
    n = F.greatest(F.char_length(s), F.lit(1)).cast("double")
    total = F.lit(0.0)
    for c in "abcdefghijklmnopqrstuvwxyz0123456789":
        share = (F.char_length(s) - F.char_length(F.replace(s, F.lit(c), F.lit("")))) / n
        total = total - F.when(share > 0, share * F.log2(share)).otherwise(0.0)
    other = F.char_length(F.regexp_replace(s, "[a-z0-9]", "")) / n
    return total - F.when(other > 0, other * F.log2(other)).otherwise(0.0)


def _count(s: Column, pattern: str) -> Column:
    return F.regexp_count(s, F.lit(pattern)).cast("double")


def with_features(pages: DataFrame, url: str = "url") -> DataFrame:
    """pages' columns with host, path and FEATURES but those of the suffix (the last two labels of the host), none null."""
    u = F.coalesce(F.col(url), F.lit(""))
    host, path = host_and_path(u)
    out = pages.withColumn("host", host).withColumn("path", path)
    name, verdict = rule(F.col("host"), F.col("path"))
    out = out.withColumn("rule", name).withColumn("__verdict", verdict)
    out = out.withColumn("__suffix", F.substring_index("host", ".", -2))
    out = out.withColumn("__query", F.regexp_extract(u, "\\?([^#]*)", 1))
    n = F.greatest(F.char_length(u), F.lit(1)).cast("double")
    cols = {
        "url_length": F.log1p(F.char_length(u).cast("double")),
        "host_length": F.char_length("host").cast("double"),
        "path_length": F.char_length("path").cast("double"),
        "host_depth": _count(F.col("host"), "\\."),
        "path_depth": _count(F.col("path"), "/"),
        "digit_ratio": _count(u, "[0-9]") / n,
        "hyphens": _count(F.col("host"), "-"),
        "entropy": _entropy(F.lower("host")),
        "parameters": _count(F.col("__query"), "="),
        "query_length": F.char_length("__query").cast("double"),
        "has_fragment": F.contains(u, F.lit("#")).cast("double"),
        "secure": F.startswith(F.lower(u), F.lit("https")).cast("double"),
        "longest_label": F.array_max(F.transform(F.split("host", "\\."), lambda x: F.char_length(x))).cast("double"),
        "vowel_ratio": _count(F.col("host"), "[aeiou]") / F.greatest(F.char_length("host"), F.lit(1)),
    }
    return out.withColumns(cols)


def _fold(url: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), F.coalesce(F.col(url), F.lit(""))), F.lit(FOLDS))


def suffixes(featured: DataFrame, url: str) -> DataFrame:
    """__suffix with, for each fold of the URLs, how many the rules block and label under it, and suffix_count, the logarithm of
    its URLs."""
    fold = _fold(url)
    blocked, labelled = (
        F.array(*[F.sum(F.when((fold == k) & F.expr(what), 1).otherwise(0)) for k in range(FOLDS)])
        for what in ("__verdict = 'block'", "__verdict is not null")
    )
    return featured.groupBy("__suffix").agg(blocked.alias("__blocked"), labelled.alias("__labelled"), F.log1p(F.count("*").cast("double")).alias("suffix_count"))


def with_suffixes(base: DataFrame, url: str) -> DataFrame:
    """base with suffix_share and suffix_count. A labelled URL's suffix_share leaves out the URLs of its own fold, so that no label has a
    part in its own features."""
    shares = stage(suffixes(base.select("__suffix", "__verdict", url), url), "url-suffixes")  # of its own, so that a hot suffix's rows can be split
    counted = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x) - F.when(F.col("__verdict").isNotNull(), F.get(c, _fold(url).cast("int"))).otherwise(0)
    share = (counted(F.col("__blocked")) + 1) / (counted(F.col("__labelled")) + 2)
    return base.join(shares, "__suffix", "left").withColumn("suffix_share", share)


def sampled(featured: DataFrame, url: str, most_rows: int) -> DataFrame:
    """FEATURES and label of at most most_rows labelled URLs, as many allowed as blocked where there are as many: of most_rows / 2 buckets of
    the URL's hash, the one of least hash, found in each task before any row is sent."""
    out = None
    for v, k in (("allow", 0), ("block", 1)):
        rows = featured.where(F.col("__verdict") == v).withColumn("__h", F.xxhash64(F.lit(1), F.coalesce(F.col(url), F.lit(""))))
        chosen = rows.groupBy(F.pmod("__h", F.lit(most_rows // 2)).alias("bucket")).agg(F.min("__h").alias("__h")).select("__h")
        rows = rows.join(F.broadcast(chosen), "__h").dropDuplicates(["__h"]).select(*FEATURES, F.lit(k).cast("double").alias("label"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(df)


def fitted(sample: DataFrame, trees: int, depth: int):
    """Boosted trees on a sample, or the share of blocked URLs in it where it has one label only (0 where it is empty)."""
    sample = stage(sample, "url-sample")
    rows = sample.groupBy("label").count().collect()  # two rows at most
    if len(rows) < 2:
        return float(rows[0][0]) if rows else 0.0
    train = _assembled(sample.coalesce(2).sort(*FEATURES)).select(F.col("__features").alias("features"), "label")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, maxBins=32, seed=1, cacheNodeIds=False).fit(train)
    return model.setFeaturesCol("__features").setRawPredictionCol("__raw").setProbabilityCol("__probability").setPredictionCol("__prediction")


def scored_by(model, featured: DataFrame) -> DataFrame:
    if isinstance(model, float):
        return featured.withColumn("block_score", F.lit(model))
    return model.transform(_assembled(featured)).withColumn("block_score", vector_to_array("__probability")[1])


def held_out_auc(pages: DataFrame, url: str = "url", most_rows: int = 4096, trees: int = 12, depth: int = 4) -> float:
    """The area under the ROC curve of the trees' score on the labelled URLs of one fold, learned from the other folds."""
    prepare(pages.sparkSession)
    featured = with_suffixes(with_features(pages.select(url), url), url)
    model = fitted(sampled(featured.where(_fold(url) > 0), url, most_rows), trees, depth)
    rows = scored_by(model, featured.where((_fold(url) == 0) & F.col("__verdict").isNotNull()))
    rows = rows.select(F.when(F.col("__verdict") == "block", 1.0).otherwise(0.0).alias("label"), F.col("block_score").cast("double").alias("rawPrediction"))
    return BinaryClassificationEvaluator().evaluate(rows)


def judge(pages: DataFrame, url: str = "url", most_rows: int = 4096, trees: int = 12, depth: int = 4) -> DataFrame:
    """pages' columns but for `url` kept as they are, with host, path, rule, verdict (allow or block) and block_score.

    Where a rule fits, the longest decides; else boosted trees do, fitted on at most most_rows labelled URLs. Where the rules label
    no URL or all alike, the rest takes that label, or allow. A null or empty URL has empty host and path and is judged
    by the trees; repeated rows are judged alike; columns named as a result's are replaced; an empty table gives no rows.
    """
    prepare(pages.sparkSession)
    taken = {"host", "path", "rule", "verdict", "block_score", *FEATURES}
    taken |= {f"__{c}" for c in ("verdict", "suffix", "query", "h", "blocked", "labelled", "features", "raw", "probability", "prediction")}
    columns = [c for c in pages.columns if c not in taken or c == url]
    featured = with_suffixes(with_features(pages.select(*columns), url), url)
    scored = scored_by(fitted(sampled(featured, url, most_rows), trees, depth), featured)
    verdict = F.coalesce("__verdict", F.when(F.col("block_score") > 0.5, "block").otherwise("allow"))
    return scored.select(*columns, "host", "path", "rule", verdict.alias("verdict"), "block_score")
