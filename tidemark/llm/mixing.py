"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, -ln(u) / quality weight, from a hash of its id,
so reruns agree. A source whose target is worth e whole epochs and a rest takes each
document e times and, in key order, once more the documents that fill the rest: those
whose middle word still lies inside it, which misses the rest by half a document at most.

Prefix sums run on two levels: sums of (source, key range) are added up per source, and
rows only inside their range. The ranges hold about equal shares of their source: the
distribution of its keys follows from how many of its documents have which quality. With
~sqrt(n) ranges both levels hold ~sqrt(n) rows per group, whichever source is hot and
whatever the quality of its texts; only equal ids, whose keys are equal, stay together.

Targets: sources by code point, NULL last, weigh ``WEIGHTS`` in turn and share all words;
no target exceeds ``MAX_EPOCHS`` times its source, the excess goes to the others by weight
(water-filling, in closed form over sources sorted by size / weight).

Defined cases: a NULL text has size 0 and takes 0; NULL source is a source of its own;
NULL ids draw one common key; equal rows are separate documents with equal keys, taken
one after the other; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACED_WORD, small_side, staged, table

NAME = "op3_source_mix"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
MIN_RANGES = 64
BANDS = 8  # bands of quality for each factor of e
SYMBOL = r"[0-9#$%&*|!@+=<>^~]"


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def text_quality(text: Column) -> Column:
    """Quality weight of a text, 0.1 to 1: falls with its share of digits and symbols."""
    share = F.regexp_count(text, F.lit(SYMBOL)) / F.greatest(F.lit(1), F.char_length(text)).cast("double")
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.coalesce(share, F.lit(0.0)) * 4.0)


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 52 bits of a hash of the id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(2 ** 52)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target, epochs, rest (over ``source``, ``size`` rows)."""
    # windows without a key: one row per source
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    order = [F.col("source_size") / F.col("w"), F.col("place")]
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    totals = totals.withColumn("place", F.row_number().over(by_name))
    totals = totals.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(F.col("source_size") * max_epochs).over(before), F.lit(0))
             ).cast("double") / F.sum("w").over(onward).cast("double")
    cap = F.col("source_size") * max_epochs
    totals = totals.withColumn("level", level).withColumn("n_docs", F.sum("docs").over(every))
    # the level rises while sources are capped in this order and falls afterwards: its peak is the answer
    totals = totals.withColumn("fill", F.max("level").over(every))
    target = F.least(F.col("w") * F.col("fill"), cap.cast("double"))
    epochs = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("long")
    return (totals.withColumn("target", target).withColumn("epochs", epochs)
            .select("source", "source_size", "target", "epochs", "n_docs",
                    (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest")))


def ranged(sized: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """Rows of ``sized`` with the columns of ``targets``, key and part, the key's range in its source."""
    # smallest and largest quality, unlike a mean, are the same in every run over the rows
    bands = sized.groupBy("source", F.floor(F.ln("quality") * BANDS).alias("band")).agg(
        F.count("*").alias("n"), ((F.min("quality") + F.max("quality")) / 2).alias("q"))
    shapes = bands.groupBy(F.col("source").alias("named")).agg(F.sort_array(F.collect_list(F.struct("q", "n"))).alias("shape"), F.sum("n").alias("members"))
    # one row per source, so a hot source is not dealt to one task
    plans = small_side(targets.join(shapes, F.col("source").eqNullSafe(F.col("named"))).drop("named"), "targets")
    rows = sized.join(plans, sized["source"].eqNullSafe(plans["source"])).drop(plans["source"])
    rows = rows.withColumn("key", -F.ln(uniform(F.col("doc_id"), seed)) / F.col("quality"))
    # share of the source's keys up to this one; it never falls as the key grows
    below = F.aggregate("shape", F.lit(0.0), lambda a, b: a + b["n"] * (1 - F.exp(-b["q"] * F.col("key")))) / F.col("members")
    ranges = F.greatest(F.lit(MIN_RANGES), F.ceil(F.sqrt("n_docs")))
    return rows.withColumn("part", F.floor(below * ranges)).drop("shape", "members")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        size: Column | None = None, quality: Column | None = None, weights=WEIGHTS,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Per document row: doc_id, source, size, source_size, target, taken."""
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        (text_size(F.col(text_col)) if size is None else size).alias("size"),
        (text_quality(F.col(text_col)) if quality is None else quality).alias("quality"))
    sized = staged(sized, "sizes")  # texts are read once; what follows needs these columns only
    targets = source_targets(sized, weights, max_epochs)
    rows = ranged(sized, targets, seed)

    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"),
                       F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "part").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    middle = F.col("offset") + F.col("within") + F.col("size") / 2.0
    taken = F.col("size") * (F.col("epochs") + F.when(middle <= F.col("rest"), 1).otherwise(0))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


def mix_sql(documents: str = "documents") -> str:
    """DuckDB SQL of ``mix`` with its defaults, over the table ``documents``."""
    return rf"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{SPACED_WORD}')) AS BIGINT) AS size,
       greatest(0.1, 1.0 - coalesce(len(regexp_extract_all(text, '{SYMBOL}')) / CAST(greatest(1, length(text)) AS DOUBLE), CAST(0 AS DOUBLE)) * 4.0) AS quality,
       -ln((CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST({2 ** 52} AS DOUBLE)) AS e
  FROM {documents}),
named AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source),
weighed AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][(place - 1) % {len(WEIGHTS)} + 1] AS w FROM named),
levels AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum({MAX_EPOCHS} * source_size) OVER (ORDER BY CAST(source_size AS DOUBLE) / w, place
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
       / CAST(sum(w) OVER (ORDER BY CAST(source_size AS DOUBLE) / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighed),
targets AS (SELECT source, source_size, least(w * (SELECT max(level) FROM levels),
       CAST({MAX_EPOCHS} * source_size AS DOUBLE)) AS target FROM levels),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets),
keyed AS (SELECT s.doc_id, s.source, s.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
       coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.e / s.quality, s.doc_id, s.size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + s.size / CAST(2 AS DOUBLE) AS middle
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, source, size, source_size, target, CAST(size * (epochs + CASE WHEN middle <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM keyed
"""


SQL = f"SELECT doc_id, size, source_size, target, taken FROM ({mix_sql()})"
