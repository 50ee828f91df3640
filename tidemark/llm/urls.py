"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

The labelled URLs are the table's own: a URL that a rule decides is a labelled example.
The trees (Spark ML) are fitted on at most about ``MAX_TRAIN`` different labelled URLs, half of
them for each verdict, chosen by a hash of the URL and weighed by the rows they stand for;
that bounds the fit and nothing else. Statistics of a host's suffix and site and of the path's first
segment (hashed to ``SECTIONS`` numbers) are counted over all labelled rows, in ``FOLDS`` folds
by URL: a labelled row sees those of the other folds, so no URL is described by its own label.
Every URL is judged.

The table is scanned four times: statistics per section (with the sizes), per site, the sample, the verdicts. Sites that
hold more than 1/``HOT`` of the rows, fewer than ``HOT`` of them, are looked up in a broadcast; the
other sites are joined, so no site's rows meet in one task.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path and is judged
on features that are all zero or counted from the text; no labelled URL at all gives
``allow``, and examples of one verdict only give that verdict; equal rows get equal rows;
only the id and URL columns are read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, staged, table

NAME = "op5_url_filter"
# (host and path start, verdict); fixed by the contract
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
MAX_TRAIN = 20_000
TREES, DEPTH, SMOOTHING = 20, 4, 20.0
FOLDS, HOT, SECTIONS = 5, 1000, 4096
FEATURES = ("length", "host_length", "path_length", "labels", "depth", "digits", "host_digits", "hyphens", "entropy",
            "params", "fragment", "extension", "secure", "suffix_rate", "suffix_count", "site_rate", "site_count", "section_rate", "section_count")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        site, start = rule[:rule.index("/")], rule[rule.index("/"):]
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _count(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _entropy(text: Column) -> Column:
    """Bits per character of the text's own character distribution."""
    n = F.char_length(text).cast("double")
    each = F.array_distinct(F.split(text, ""))
    share = lambda c: (n - F.char_length(F.replace(text, c, F.lit("")))) / n
    bits = F.aggregate(F.filter(each, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (url, host, path) with the features of the text, and suffix (last label) and site (last two)."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    query_part = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    share = lambda n, of: n / F.greatest(F.lit(1), of)
    columns = {
        "length": F.char_length(url), "host_length": F.char_length(host), "path_length": F.char_length(path),
        "labels": _count(host, "."), "depth": _count(path, "/"),
        "digits": share(_count(url, "0123456789"), F.char_length(url)),
        "host_digits": share(_count(host, "0123456789"), F.char_length(host)), "hyphens": _count(url, "-"),
        "entropy": _entropy(url), "params": F.when(query_part != "", _count(query_part, "&") + 1).otherwise(0),
        "fragment": F.contains(url, F.lit("#")).cast("int"),
        "extension": (F.regexp_extract(path, r"\.[A-Za-z0-9]{1,5}$", 0) != "").cast("int"),
        "secure": F.startswith(F.lower(url), F.lit("https:")).cast("int")}
    pages = pages.withColumns({k: v.cast("double") for k, v in columns.items()})
    return pages.withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("site", F.substring_index("host", ".", -2))


def _folds(key: str) -> list[Column]:
    """Labelled and blocked rows per fold, as arrays."""
    here = [F.col("label").isNotNull() & (F.col("fold") == k) for k in range(FOLDS)]
    return [F.array(*[F.coalesce(F.sum(F.when(w, of)), F.lit(0.0)) for w in here]).alias(f"{key}_{x}")
            for x, of in (("c", F.lit(1.0)), ("b", F.col("label")))]


def site_statistics(pages: DataFrame) -> DataFrame:
    """Per site: its rows, and labelled and blocked rows per fold, of the site and of its suffix."""
    sites = staged(pages.groupBy("suffix", "site").agg(F.count("*").alias("rows"), *_folds("site")), "url-sites")
    add = lambda x: F.array(*[F.sum(F.col(f"site_{x}")[k]) for k in range(FOLDS)]).alias(f"suffix_{x}")
    return sites.join(sites.groupBy("suffix").agg(add("c"), add("b")), "suffix").drop("suffix")


def section_statistics(pages: DataFrame) -> DataFrame:
    """Per section, ``SECTIONS`` rows at most: the same of it, its rows, and sketches of the different URLs of either verdict."""
    seen = [F.hll_sketch_agg(F.when(F.col("label") == v, F.col("url"))).alias(f"urls_{v}") for v in (0, 1)]
    return staged(pages.groupBy("section").agg(F.count("*").alias("rows"), *_folds("section"), *seen), "url-sections")


def with_statistics(pages: DataFrame, sites: DataFrame, sections: DataFrame, rows: int, prior: float) -> DataFrame:
    """``pages`` with smoothed block rates and log counts of site, suffix and section, out of fold where labelled."""
    parts = [f"{key}_{x}" for key in ("suffix", "site") for x in "cb"]
    of = F.struct(*parts)
    hot = F.col("rows") * HOT > rows
    few = sites.where(hot).select("site", of.alias("of_hot"))
    rest = sites.where(~hot).select("site", F.lit(0).alias("spread"), of.alias("of_rest"))
    parts = F.struct("section_c", "section_b").alias("of_section")
    pages = pages.join(F.broadcast(sections.select("section", parts)), "section", "left").join(F.broadcast(few), "site", "left")
    # rows of hot sites are dealt by their URL and id and find nothing in the join
    away = F.pmod(F.xxhash64("page_id", "url"), F.lit(HOT)).cast("int") + 1
    pages = pages.withColumn("spread", F.when(F.col("of_hot").isNull(), 0).otherwise(away)).join(rest, ["site", "spread"], "left")
    by_site = F.coalesce("of_hot", "of_rest")
    for key, found in (("suffix", by_site), ("site", by_site), ("section", F.col("of_section"))):
        kept = [F.aggregate(found[f"{key}_{x}"], F.lit(0.0), lambda a, v: a + v)
                - F.when(F.col("label").isNotNull(), F.get(found[f"{key}_{x}"], F.col("fold"))).otherwise(0.0) for x in "bc"]
        b, c = [F.coalesce(k, F.lit(0.0)) for k in kept]
        pages = pages.withColumns({f"{key}_rate": (b + SMOOTHING * prior) / (c + SMOOTHING), f"{key}_count": F.log1p(c)})
    return pages.drop("of_hot", "of_rest", "of_section", "spread")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          max_train: int = MAX_TRAIN, learn: Column | None = None) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, block_score (the trees' probability of block).

    ``learn``: a condition on ``url`` for the rows whose labels may be used, all by default."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"))
    pages = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    pages = pages.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    known = F.col("ruled").isNotNull() if learn is None else F.col("ruled").isNotNull() & learn
    pages = pages.withColumn("label", F.when(known, (F.col("ruled.verdict") == "block").cast("double")))
    pages = lexical(pages).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int"))

    segment = F.regexp_extract("path", r"(?s)^/([^/]*)", 1)
    pages = pages.withColumn("section", F.pmod(F.xxhash64(segment), F.lit(SECTIONS)))

    sections = section_statistics(pages)
    total = lambda x: F.coalesce(F.sum(F.aggregate(f"section_{x}", F.lit(0.0), lambda a, v: a + v)), F.lit(0.0))
    rows, n, blocked, allow_urls, block_urls = sections.agg(
        F.coalesce(F.sum("rows"), F.lit(0)), total("c"), total("b"),
        *[F.greatest(F.lit(1), F.hll_sketch_estimate(F.hll_union_agg(f"urls_{v}"))) for v in (0, 1)]).first()
    prior = blocked / n if n else 0.0
    if 0 < blocked < n:
        pages = with_statistics(pages, site_statistics(pages), sections, rows, prior)
        pages = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(pages)
        share = F.when(F.col("label") == 1, min(1.0, max_train / 2 / block_urls)).otherwise(min(1.0, max_train / 2 / allow_urls))
        chosen = F.col("label").isNotNull() & (F.pmod(F.xxhash64(F.lit(1), "url"), F.lit(1 << 30)) < share * (1 << 30))
        sample = (pages.where(chosen).withColumn("share", share).groupBy("url", "label")
                  .agg(F.first("features").alias("features"), (F.count("*") / F.first("share")).alias("weight")))
        trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH,
                              stepSize=0.2, seed=7)
        # the fit is a function of the rows, not of the order they come in
        fitted = trees.fit(staged(sample.repartition(8, "url").sortWithinPartitions("url"), "url-sample"))
        pages = fitted.transform(pages).withColumn("block_score", vector_to_array("probability")[1])
    else:
        pages = pages.withColumn("block_score", F.lit(float(prior)))
    verdict = F.coalesce("ruled.verdict", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return pages.select("page_id", "host", "path", F.col("ruled.rule").alias("rule"), verdict.alias("verdict"), "block_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


SQL = None
