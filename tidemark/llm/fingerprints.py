"""Document fingerprints: one-permutation MinHash, optimal densification, packed low bits.

Every 5-word shingle is hashed once; the top bits of the hash name its bin and the bin
keeps the smallest rest. An empty bin copies the bin that its own probe sequence, a
universal hash of (bin, attempt), first finds filled. Of each bin the low byte is stored,
and the likeness of two fingerprints is corrected for the 1 in 256 bytes that agree by chance.

``with_next`` also compares each text with the one that follows in descending id order,
and with an edited text. The order is made by ranges of ids: the bounds (at most
``MAX_PARTS`` numbers) come from quantiles, each range is one sorted task, and its last
row gets the first row of the next range sent along. An id (or NULL) that holds several
quantiles gets as many ranges of its own, cut by the hash of the text.

Defined cases: a NULL text is empty; an empty text has the fingerprint '' and is like
other empty texts (1) and unlike the rest (0); a text of fewer than five words is one
shingle; equal ids are ordered by their text (those of an id with several ranges by the
text's hash first), NULL ids come last; of a table with one row the next document is the
row itself; rows equal in id and text stay in one range.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.shingles import WordHashes, chunked, mix64, shingles

NAME = "op4_fingerprints"
BITS = 8  # 256 bins
BINS = 1 << BITS
ROWS_PER_PART, MAX_PARTS = 2_000, 20_000
FIRST = -(1 << 63)
SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def densified(bins: np.ndarray) -> np.ndarray:
    """Fill the empty bins (all ones) of rows that have a filled one."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    row, col = np.nonzero(bins == empty)
    alive = (bins != empty).any(axis=1)
    row, col = row[alive[row]], col[alive[row]]
    out, attempt = bins.copy(), 0
    while len(row):
        attempt += 1
        probe = (mix64(col.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(attempt)) & np.uint64(BINS - 1)).astype(np.int64)
        found = bins[row, probe]
        ok = found != empty
        out[row[ok], col[ok]] = found[ok]
        row, col = row[~ok], col[~ok]
    return out


def fingerprint_bytes(texts: list[str | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(len(texts), BINS) stored bytes, and which texts have any word."""
    words, sizes = hashes.of(texts)
    h, owner = shingles(words, sizes)
    bins = np.full(len(texts) * BINS, 0xFFFFFFFFFFFFFFFF, np.uint64)
    np.minimum.at(bins, owner * BINS + (h >> np.uint64(64 - BITS)).astype(np.int64), h & np.uint64((1 << (64 - BITS)) - 1))
    return (densified(bins.reshape(-1, BINS)) & np.uint64(0xFF)).astype(np.uint8), sizes > 0


def likeness(a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """Estimated resemblance of rows of stored bytes, corrected for chance agreement."""
    chance = 1 / 256
    same = (a == b).mean(axis=1)
    out = np.clip((same - chance) / (1 - chance), 0, 1)
    return np.where(some_a & some_b, out, (some_a == some_b).astype(float))


def packed(rows: np.ndarray, some: np.ndarray) -> list[str]:
    return [base64.b64encode(r.tobytes()).decode() if s else "" for r, s in zip(rows, some)]


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint of every document row; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in chunked(texts):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(
                    packed(*fingerprint_bytes(texts[i:j], hashes)), pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, fingerprint string")


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, extra, order): each with the one after it; extras only follow."""
    hashes = WordHashes()
    held: tuple | None = None  # the last row so far waits for its next
    for batch in batches:
        ids, texts, extras = (batch.column(c).to_pylist() for c in ("doc_id", "text", "extra"))
        texts = [t or "" for t in texts]
        for i, j in chunked(texts):
            rows = list(zip(ids[i:j], texts[i:j], extras[i:j]))
            if held is not None:
                rows.insert(0, held)
            held = rows[-1]
            own = [k for k in range(len(rows) - 1) if not rows[k][2]]
            if own:
                yield _rows(rows, own, hashes)
    # every range ends with an extra row, so what is held at the end is no document


def _rows(rows: list[tuple], own: list[int], hashes: WordHashes) -> pa.RecordBatch:
    texts = [r[1] for r in rows]
    edited = [_edited(texts[k], texts[k + 1]) for k in own]
    prints, some = fingerprint_bytes(texts, hashes)
    e_prints, e_some = fingerprint_bytes(edited, hashes)
    at = np.array(own)
    return pa.RecordBatch.from_arrays([
        pa.array([rows[k][0] for k in own], pa.int64()), pa.array([len(texts[k]) for k in own], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array(packed(prints[at], some[at]), pa.string()), pa.array(packed(e_prints, e_some), pa.string()),
        pa.array(likeness(prints[at], e_prints, some[at], e_some), pa.float64()),
        pa.array(likeness(prints[at], prints[at + 1], some[at], some[at + 1]), pa.float64())],
        [c.split()[0] for c in SCHEMA.split(", ")])


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row its fingerprint, its edited text's, and the likenesses (``SCHEMA``)."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")) \
        .withColumn("key", F.coalesce("doc_id", F.lit(FIRST)))
    n = docs.select("key").count()
    parts = max(1, min(MAX_PARTS, math.ceil(n / ROWS_PER_PART)))
    cuts = docs.agg(F.percentile_approx("key", F.array(*[F.lit(i / parts) for i in range(1, parts)]),
                                        max(10_000, 20 * parts))).first()[0] if parts > 1 else []
    cuts = sorted(Counter(cuts or []).items(), reverse=True)
    values = [c for c, _ in cuts]
    # descending: the range of a key is the number of cuts not below it, found among every 128th cut first
    bounds = F.lit(values).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    coarse = F.lit(values[127::128]).cast("array<bigint>") if len(cuts) >= 128 else F.array().cast("array<bigint>")
    above = lambda a: F.size(F.filter(a, lambda b: b >= F.col("key")))
    block = above(coarse) * 128
    docs = docs.withColumn("part", block + above(F.slice(bounds, block + 1, 128)))
    # the keys of several quantiles: their own ranges come before the rest of the range that they begin
    own = [0] + [times if times > 1 else 0 for _, times in cuts]
    parts = len(own) + sum(own)
    at = lambda a, kind: F.element_at(F.lit(a).cast(f"array<{kind}>"), F.col("part") + 1)
    if any(own):
        hot = (at(own, "int") > 0) & (at([None, *values], "bigint") == F.col("key"))
        docs = docs.withColumn("hash", F.when(hot, F.xxhash64(F.coalesce("text", F.lit("")))).otherwise(F.lit(0).cast("bigint")))
        # descending hashes, like the keys
        share = (F.lit(2.0 ** 63) - F.col("hash").cast("double")) / 2.0 ** 64
        place = F.when(hot, F.least(F.floor(share * at(own, "int")).cast("int"), at(own, "int") - 1)).otherwise(at(own, "int"))
        docs = docs.withColumn("part", at([i + n for i, n in enumerate(accumulate([0, *own[:-1]]))], "int") + place)
    else:
        docs = docs.withColumn("hash", F.lit(0).cast("bigint"))
    heads = sorted((r["part"], *r["head"]) for r in docs.groupBy("part").agg(F.max(F.struct("key", "hash")).alias("head")).collect())
    if not heads:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    # part -> its first key and hash, and the part whose last row it follows
    first, first_hash, before = [None] * parts, [None] * parts, [None] * parts
    for k, (part, head, head_hash) in enumerate(heads):
        first[part], first_hash[part], before[part] = head, head_hash, heads[k - 1][0]
    is_head = (at(first, "bigint") == F.col("key")) & (at(first_hash, "bigint") == F.col("hash"))
    places = F.when(is_head, F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("extra")),
                                     F.struct(at(before, "int").alias("part"), F.lit(1).alias("extra")))) \
        .otherwise(F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("extra"))))
    sent = docs.select("doc_id", "text", "key", "hash", F.inline(places))
    return (sent.repartitionById(parts, F.col("part"))
            .sortWithinPartitions("part", "extra", F.desc("key"), F.desc("hash"), "text")
            .select("doc_id", "text", "extra").mapInArrow(_compare, SCHEMA))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(table(spark, sf_dir, "documents"))


SQL = None
