"""URL filters: explicit rules first, then a logistic regression on hashed
character n-grams of host and path.

DataFrame functions and Spark ML only.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no host part."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule that fits, or null.

    A rule ``host/path`` fits its host and all its subdomains if the url's path
    starts with the rule's. Equally long rules are tried in the given order.
    """
    out = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=len, reverse=True)):
        name, _, rest = rule.partition("/")
        own = (host == name) | host.endswith("." + name)
        out = F.when(own & path.startswith("/" + rest), F.lit(rule)).otherwise(out)
    return out


def _grams(text: Column, n: int, tag: str) -> Column:
    """Character n-grams of a text with start and end marks, each with a tag."""
    chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    chars = F.filter(chars, lambda c: c != "")
    shifted = [F.slice(chars, F.lit(k + 1), F.greatest(F.size(chars) - F.lit(n - 1), F.lit(0))) for k in range(n)]
    joined = shifted[0]
    for nxt in shifted[1:]:
        joined = F.zip_with(joined, nxt, lambda x, y: F.concat(x, y))
    return F.transform(joined, lambda g: F.concat(F.lit(tag), g))


def with_grams(urls: DataFrame, host: str, path: str, out: str, n: int = 3) -> DataFrame:
    """Add the array of hashed-feature inputs: n-grams of host and of path."""
    return urls.withColumn(out, F.concat(_grams(F.col(host), n, "h"), _grams(F.col(path), n, "p")))


def train(labelled: DataFrame, features: int = 1 << 14, n: int = 3, reg: float = 1e-3, iterations: int = 40):
    """Fit (HashingTF, model) on a small table (host, path, label); None if it lacks a class.

    The caller bounds the table (see ``bounded_sample``).
    """
    small = with_grams(labelled.select("host", "path", F.col("label").cast("double").alias("label")), "host", "path", "grams", n)
    hashing = HashingTF(numFeatures=features, binary=True, inputCol="grams", outputCol="vector")
    data = hashing.transform(small).select("label", "vector").coalesce(1).cache()
    try:
        rows = {r["label"]: r["count"] for r in data.groupBy("label").count().collect()}  # two rows
        if len(rows) < 2:
            return None
        # both labels weigh the same, however many urls the rules happen to judge
        share = sum(rows.values()) / 2
        weighed = data.withColumn("weight", F.when(F.col("label") == 1, share / rows[1.0]).otherwise(share / rows[0.0]))
        return hashing, LogisticRegression(
            featuresCol="vector", labelCol="label", weightCol="weight", regParam=reg, maxIter=iterations
        ).fit(weighed)
    finally:
        data.unpersist()


def bounded_sample(labelled: DataFrame, rows: int, seed: int) -> DataFrame:
    """The ``rows`` distinct (host, path, label) rows of smallest hash: bounded, reproducible."""
    distinct = labelled.select("host", "path", "label").distinct()
    return distinct.orderBy(F.xxhash64("host", "path", "label", F.lit(seed)), "host", "path", "label").limit(rows)


def filter_urls(
    pages: DataFrame, allow: list[str], block: list[str], labelled: DataFrame | None = None, *, train_rows: int = 8_000,
    seed: int = 11, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5,
) -> DataFrame:
    """Judge every url: page_id, host, path, rule, verdict, score.

    ``verdict`` is the rule's where one fits, else the model's: ``block`` from a
    probability (``score``) of ``threshold``. The model is trained on
    ``labelled`` (host, path, label 1 for block), at most ``train_rows`` rows of
    it; by default on the urls that the rules judge. Without both labels in the
    training table every url without a rule is allowed (score null).

    Null urls and urls without ``://`` have empty host and path, no rule, and
    the model's verdict on the empty strings. Repeated rows are each judged; an
    empty table gives no rows; other columns are not read.
    """
    rules = [*allow, *block]
    judged = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    judged = judged.withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = judged.filter(F.col("rule").isNotNull()).select("host", "path", F.col("rule").isin(block).cast("int").alias("label"))
    fitted = train(bounded_sample(labelled, train_rows, seed))
    if fitted is None:
        scored = judged.withColumn("score", F.lit(None).cast("double"))
    else:
        hashing, model = fitted
        grams = with_grams(judged, "host", "path", "__grams")
        vectors = model.transform(hashing.setInputCol("__grams").setOutputCol("vector").transform(grams))
        scored = vectors.withColumn("score", vector_to_array("probability")[1])
    by_rule = F.when(F.col("rule").isin(allow), "allow").when(F.col("rule").isin(block), "block")
    by_model = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_model).alias("verdict"), "score")
