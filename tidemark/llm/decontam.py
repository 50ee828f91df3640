"""Benchmark decontamination: windows of test items looked up in whole training texts.

DataFrame functions only. The broadcast hash set holds every benchmark window under its
longest word. Each text is split into words once, every word is probed against that set
inside the scan, and the window around a found word is compared word by word, so only
verified hits leave the scan.

Defined cases: a NULL or empty text has no words and no hits; a NULL item text has
no window; a NULL item id counts as the id ''; item rows with one id are one item;
repeated document rows each get a row; an empty benchmark hits nothing. Only the
named id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_ALNUM, fresh_name, lower_az, sql_lower, table

NAME = "op8_decontamination"
WINDOW = 13
# Bytes of benchmark windows that one broadcast may hold; more are scanned for in blocks.
BROADCAST_LIMIT = 64 << 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_az(text), NOT_ALNUM), "")


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """Distinct (h, lead, m, gram, item): hash of the window's longest word, the words before it
    in the window, the window's length and words, and its item."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             words_of(F.col(text_col)).alias("words"))
    items = items.filter(F.size("words") > 0).withColumn("m", F.least(F.lit(window), F.size("words")))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)
    grams = items.select("item", "m", "words", F.explode(starts).alias("i")).select(
        "item", "m", F.slice("words", F.col("i"), F.col("m")).alias("gram"))
    longest = F.array_max(F.transform("gram", lambda w, j: F.struct(
        F.length(w).alias("n"), w.alias("w"), j.alias("lead"))))
    return grams.select(F.xxhash64(longest["w"]).alias("h"), longest["lead"].alias("lead"), "m",
                        F.array_join("gram", " ").alias("gram"), "item").distinct()


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, broadcast_limit: int = BROADCAST_LIMIT, keep: Column | None = None) -> DataFrame:
    """One row per document row: doc_id, n_words, spans [start, end), items (distinct, sorted as text).

    ``keep``, an expression over ``docs``, is added as column kept.
    """
    grams = benchmark_windows(benchmark, text_col="text", window=window)
    size = grams.agg(F.sum(F.length("gram") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / broadcast_limit))  # each block is broadcast and scanned for by itself

    # the empty word behind the last one stands for the document itself
    words = F.array_append(words_of(F.col(text_col)), "")
    base = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                       (F.lit(None).cast("string") if keep is None else keep).alias("kept"), words.alias("words"))
    seen = base.select("doc_id", "rid", "kept", "words", F.posexplode("words").alias("pos", "word"))
    seen = seen.withColumn("hash", F.when(F.col("word") != "", F.xxhash64("word")))
    is_doc = F.col("word") == ""
    start = F.col("pos") - F.col("lead")
    same = (start >= 0) & (F.array_join(F.slice("words", F.greatest(F.lit(0), start) + 1, F.col("m")), " ") == F.col("gram"))
    rows = None
    for block in range(blocks):
        part = F.broadcast(grams.filter(F.pmod("h", F.lit(blocks)) == block))
        found = seen.join(part, F.col("hash") == F.col("h"), "left")
        found = found.filter((is_doc & F.lit(block == 0)) | (F.col("item").isNotNull() & same)).select(
            "rid", F.when(is_doc, F.col("doc_id")).alias("doc_id"), F.when(is_doc, F.col("pos")).alias("n"),
            F.when(is_doc, F.col("kept")).alias("kept"),
            F.when(~is_doc, F.struct(start.alias("start"), (start + F.col("m")).alias("end"))).alias("span"), "item")
        rows = found if rows is None else rows.union(found)
    return rows.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"),
        *([] if keep is None else [F.max("kept").alias("kept")])).drop("rid")


def hit_words(spans: Column) -> Column:
    """Number of positions that sorted spans cover."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, zero, lambda a, s: F.struct(
        F.greatest(a["upto"], s["end"]).alias("upto"),
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["upto"], s["start"]))).cast("long").alias("n")),
        lambda a: a["n"])


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document row: n_words, n_hit, n_items, items_sha256, contaminated."""
    out = scan(docs, benchmark, **options).withColumn("n_hit", hit_words(F.col("spans")))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def drop_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """``docs`` without its contaminated rows, all columns kept.

    The verdict depends on the text alone, so rows are matched by a hash of id and text,
    made inside the scan: no text is shuffled.
    """
    key = fresh_name(docs.columns, "row_hash")
    row_hash = F.xxhash64(F.col(id_col), F.col(text_col))
    bad = (scan(docs, benchmark, id_col, text_col, keep=row_hash, **options)
           .filter(is_contaminated(hit_words(F.col("spans")), F.col("n_words"))).select(F.col("kept").alias(key)).distinct())
    return docs.withColumn(key, row_hash).join(bad, key, "left_anti").drop(key)


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """doc_id and text with the hit words (and the separators after them) taken out."""
    scanned = scan(docs, benchmark, id_col, text_col, keep=F.col(text_col), **options).withColumnRenamed("kept", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    # each piece is one word with the separators behind it; in front of the first stands the head
    pieces = F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"), F.lit(0))
    head = F.regexp_extract(text, r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    cut = scanned.withColumn("hit", F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["start"], s["end"] - 1)))))
    cut = cut.withColumn("pieces", pieces)
    kept = F.filter("pieces", lambda p, i: ~F.array_contains("hit", i))
    return cut.select("doc_id", F.when(F.size("spans") == 0, F.col("text"))
                      .otherwise(F.concat(head, F.array_join(kept, ""))).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({sql_lower('text')}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({sql_lower('text')}, '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS m, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS gram
       FROM (SELECT item, w, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS gram
       FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)),
hits AS (SELECT rid, i, m, item FROM dw JOIN bw USING (m, gram)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + m)) AS p FROM hits) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN its USING (rid)
"""
