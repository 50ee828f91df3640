"""Near-duplicate groups by an LSH forest over MinHash signatures.

1. Every text becomes its set of 5-word shingles, a hash of the set, and ``TREES`` x
   ``DEPTH`` MinHash values. Equal sets are one class from here on.
2. Each tree sorts all classes by its own values. The sort is a range partitioning, so no
   region, however dense, belongs to one task. A class's candidates are its ``NEAR``
   followers in that order that share at least ``MIN_DEPTH`` leading values: where many
   classes share them the neighbours are those with the longest common prefix, so the
   depth adapts to the region. Neighbours across a partition's border are met in a
   second small step over the border rows.
3. Candidates whose signatures agree too little to reach the threshold (by more than six
   standard deviations) go. Each class's best ``BEST`` are checked on full sets, links become
   components, and all candidates between different components are checked after them.
4. Classes that had more neighbours than ``NEAR`` in some region get an exact way: sets that
   reach the threshold share one of their rarest shingles (prefix filtering), so all pairs
   of them that do, lie in different components and fit in size are checked too.
5. A document's component is the smallest id in its class's component.

A pair of similarity 0.75 is missed by all trees with probability (1 - 0.75^3)^16 = 2e-4,
one of 0.8 with 2e-5, and a missed pair matters only if nothing else connects the two.

Defined cases: a NULL or empty text, or one without words, has no shingle and is a
component of its own; fewer than five words are one shingle; rows with one id and one
text are one document with equal rows; a row with a NULL id gets the component of its
group, and is kept only where no member has an id; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import xxhash

from tidemark.llm.common import fresh_name, staged, table
from tidemark.llm.components import connected_components
from tidemark.llm.shingles import WordHashes, shingles, text_runs

NAME = "op6_near_duplicates"
TREES, DEPTH, MIN_DEPTH, NEAR, BEST = 16, 8, 3, 4, 2
SHARE = 75  # percent of the union that a link's intersection holds at least
LEAST_ESTIMATE = 0.5
FAR = NEAR + 1  # a class that still shares leading values with the row so far away is crowded
SKETCH = 1 << 18  # counters of shingles, for the order of rarity
ROWS_PER_PART = 50_000
FIRST = -(1 << 63)
_rng = np.random.default_rng(20240613)
_A = _rng.integers(0, 1 << 63, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, TREES * DEPTH, np.uint64)


def shingle_sets(texts: list[str | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and their number per text."""
    words, sizes = hashes.of(texts)
    h, owner = shingles(words, sizes)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.bincount(owner[new], minlength=len(texts))


def set_keys(h: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """A 128-bit hash of each set; None for the empty one."""
    ends = np.cumsum(sizes)
    return [xxhash.xxh3_128_digest(h[e - s:e].tobytes()) if s else None for s, e in zip(sizes, ends)]


def signatures(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(sets with shingles, TREES * DEPTH) MinHash values of 16 bits."""
    firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.empty((len(firsts), TREES * DEPTH), ">u2")
    if len(firsts):
        for k in range(TREES * DEPTH):
            out[:, k] = np.minimum.reduceat((h * _A[k] + _B[k]) >> np.uint64(16), firsts) & np.uint64(0xFFFF)
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for i, j, texts in text_runs(batch.column("text")):
            h, sizes = shingle_sets(texts, hashes)
            sig = iter(signatures(h, sizes))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(i, j - i), batch.column("text_hash").slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(set_keys(h, sizes), pa.binary()),
                pa.array([next(sig).tobytes() if s else None for s in sizes], pa.binary())], ["doc_id", "text_hash", "n_shingles", "key", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for _, _, texts in text_runs(batch.column("text")):
            h, sizes = shingle_sets(texts, hashes)
            parts = np.split(h, np.cumsum(sizes)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(set_keys(h, sizes), pa.binary()),
                                              pa.array([p.tobytes() for p in parts], pa.binary())], ["key", "members"])


def _near(orders: np.ndarray, j: int) -> np.ndarray:
    """Whether each sorted row shares its tree and MIN_DEPTH leading values with the row j behind it."""
    head = 1 + 2 * MIN_DEPTH
    return (orders[:-j, :head] == orders[j:, :head]).all(axis=1) if len(orders) > j else np.zeros(0, bool)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one sorted partition: candidate pairs, crowded classes (border -1), first and last rows for the borders."""
    part, width = TaskContext.get().partitionId(), 1 + 2 * DEPTH
    names = ["a", "b", "border", "place"]

    def border(keys: list[bytes], orders: np.ndarray, at: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([None] * len(keys), pa.binary()),
                                           pa.array([at] * len(keys), pa.int32()), pa.array([o.tobytes() for o in orders], pa.binary())], names)

    held, keys = np.zeros((0, width), np.uint8), []  # the last FAR rows so far
    fresh, begin = 0, 0
    for batch in batches:
        rows = np.frombuffer(b"".join(batch.column("place").to_pylist()), np.uint8).reshape(-1, width)
        if fresh < FAR and len(rows):  # the first FAR rows, which may come in several batches
            n = min(FAR - fresh, len(rows))
            yield border(batch.column("key").to_pylist()[:n], rows[:n], part)
            fresh += n
        begin = len(keys)
        orders, keys = np.concatenate([held, rows]), keys + batch.column("key").to_pylist()
        a, b = [], []
        for j in range(1, NEAR + 1):
            for i in np.flatnonzero(_near(orders, j)):
                if i + j >= begin:  # else both were there before
                    a.append(min(keys[i], keys[i + j]))
                    b.append(max(keys[i], keys[i + j]))
        crowded = {keys[k] for i in np.flatnonzero(_near(orders, FAR)) if i + FAR >= begin for k in (i, i + FAR)}
        found, n = len(a), len(crowded)
        yield pa.RecordBatch.from_arrays([pa.array([*a, *crowded], pa.binary()), pa.array(b + [None] * n, pa.binary()),
                                          pa.array([None] * found + [-1] * n, pa.int32()), pa.array([None] * (found + n), pa.binary())], names)
        held, keys = orders[-FAR:], keys[-FAR:]
    if keys:
        yield border(keys, held, part + 1)


def _across(rows: pd.DataFrame) -> pd.DataFrame:
    """Candidates, and crowded classes (b missing), among the at most 2 * FAR rows around one border."""
    rows = rows.sort_values("place").drop_duplicates()
    orders, keys = np.frombuffer(b"".join(rows["place"]), np.uint8).reshape(len(rows), -1), rows["a"].tolist()
    pairs = [(min(keys[i], keys[i + j]), max(keys[i], keys[i + j]))
             for j in range(1, NEAR + 1) for i in np.flatnonzero(_near(orders, j))]
    pairs += [(keys[k], None) for i in np.flatnonzero(_near(orders, FAR)) for k in (i, i + FAR)]
    return pd.DataFrame(pairs, columns=["a", "b"])


def candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b) with a < b of ``classes`` (key, sig): neighbours in any tree's order; and (key) of crowded classes."""
    trees = F.explode(F.array(*[F.concat(F.lit(bytes([t])), F.substring("sig", 2 * DEPTH * t + 1, 2 * DEPTH)) for t in range(TREES)]))
    rows = classes.select("key", trees.alias("place"))
    parts = max(1, classes.count() * TREES // ROWS_PER_PART)
    found = staged(rows.repartitionByRange(parts, "place", "key").sortWithinPartitions("place", "key").mapInArrow(
        _neighbours, "a binary, b binary, border int, place binary"), "neighbours")
    across = found.filter("border >= 0").groupBy("border").applyInPandas(_across, "a binary, b binary")
    found = staged(found.filter("border IS NULL OR border < 0").select("a", "b").union(across).distinct(), "candidates")
    return found.filter("a != b"), found.filter("b IS NULL").select(F.col("a").alias("key"))


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, TREES * DEPTH) for c in ("sig_a", "sig_b"))
        like = (x == y).mean(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(like, pa.float64())], ["a", "b", "like"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= SHARE * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_())], ["a", "b", "linked"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SKETCH, np.int64)
    for batch in batches:
        for members in batch.column("members"):
            counts += np.bincount((np.frombuffer(members.as_buffer(), np.uint64) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["at", "n"])


def rare_shingles(crowd: DataFrame, counts: np.ndarray) -> DataFrame:
    """(token, key, group, n, left): of every set of ``crowd`` the rarest shingles, one of which any
    set that reaches the threshold with it has among its own; ``left`` of its n shingles are
    no rarer. ``counts`` orders them; any order that is the same for all sets is right, a
    good one keeps the groups small."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, group, members in zip(batch.column("key").to_pylist(), batch.column("group").to_pylist(), batch.column("members")):
                h = np.frombuffer(members.as_buffer(), np.uint64)
                n = len(h) - -(-SHARE * len(h) // 100) + 1
                first = h[np.lexsort((h, counts[(h & np.uint64(SKETCH - 1)).astype(np.int64)]))[:n]].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(first), pa.array([key] * n, pa.binary()), pa.array([group] * n, pa.binary()),
                                                  pa.array([len(h)] * n, pa.int32()), pa.array(np.arange(len(h), len(h) - n, -1, np.int32))],
                                                 ["token", "key", "group", "n", "left"])

    return crowd.mapInArrow(run, "token bigint, key binary, group binary, n int, left int")


def apart_pairs(rows: DataFrame) -> DataFrame:
    """(a, b) of ``rows`` of ``rare_shingles`` that share a token, differ in group and may reach the threshold.

    Their first common token bounds the intersection by what is left from there on in
    either set. Most rows of a token belong to one group; pairs are made only from the
    others, so a large group costs its size and not its square."""
    tops = rows.groupBy("token", "group").agg(F.count("*").alias("c")).groupBy("token").agg(
        F.max_by("group", F.struct("c", "group")).alias("top"), F.count("*").alias("groups")).filter("groups > 1")
    other = rows.select("token", F.col("key").alias("key2"), F.col("group").alias("group2"), F.col("n").alias("n2"), F.col("left").alias("left2"))
    minor = rows.join(tops, "token").filter("group != top")
    fits = (F.col("group") != F.col("group2")) & ((F.col("group2") == F.col("top")) | (F.col("key") < F.col("key2"))) & (
        (100 + SHARE) * F.least("left", "left2") >= SHARE * (F.col("n") + F.col("n2")))
    return minor.join(other, (minor["token"] == other["token"]) & fits).select(
        F.least("key", "key2").alias("a"), F.greatest("key", "key2").alias("b")).distinct()


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets pass the threshold."""
    side = lambda s: sets.select(F.col("key").alias(s), F.col("members").alias(f"set_{s}"))
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(
        _linked, "a binary, b binary, linked boolean").filter("linked").drop("linked")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: doc_id, text_hash, n_shingles, component_id, kept."""
    return _grouped(docs, id_col, text_col).drop("group")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``groups`` and the group itself, which is there without any id; NULL for a text without a shingle."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signed = staged(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _signed, "doc_id bigint, text_hash bigint, n_shingles bigint, key binary, sig binary"), "signed")
    own = F.coalesce("doc_id", F.lit(FIRST))  # NULL ids look their text up under one key
    classes = staged(signed.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.min(own).alias("rep"), F.first("sig").alias("sig")), "classes")

    found, crowded = candidates(classes)
    side = lambda s: classes.select(F.col("key").alias(s), F.col("sig").alias(f"sig_{s}"))
    likely = lambda p: p.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "sig_b").mapInArrow(
        _estimated, "a binary, b binary, like double").filter(F.col("like") >= LEAST_ESTIMATE)
    pairs = staged(likely(found), "pairs")

    # the sets of the classes that have a candidate or are crowded, made again from the text of one member
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).union(crowded).distinct()
    needed = classes.join(keys, "key").select("key", "rep")
    texts = docs.join(needed.select("rep").distinct(), own == F.col("rep"), "left_semi")
    sets = texts.select("text").mapInArrow(_sets, "key binary, members binary").filter("key IS NOT NULL")
    sets = staged(sets.join(needed.select("key"), "key", "left_semi").dropDuplicates(["key"]), "sets")

    # each class's best candidates first: they connect most of a group
    both = pairs.union(pairs.select("b", "a", "like"))
    best = both.groupBy("a").agg(F.slice(F.sort_array(F.collect_set(F.struct("like", "b")), asc=False), 1, BEST).alias("best"))
    best = best.select("a", F.explode("best.b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    roots = staged(connected_components(_checked(best, sets)), "roots")

    # then every candidate whose ends are still apart
    ends = lambda df, s: df.join(roots.select(F.col("node").alias(s), F.col("root").alias(f"root_{s}")), s, "left") \
        .withColumn(f"root_{s}", F.coalesce(f"root_{s}", s))
    apart = ends(ends(pairs.join(best, ["a", "b"], "left_anti").select("a", "b"), "a"), "b").filter("root_a != root_b")
    more = _checked(apart, sets)
    tops = connected_components(ends(ends(more, "a"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))

    regroup = lambda df, tops: df.join(tops, F.col("group") == F.col("node"), "left").select(
        "key", "least", F.coalesce("root", "group").alias("group"))
    named = staged(regroup(regroup(classes.select("key", "least", F.col("key").alias("group")), roots), tops), "groups")

    # the exact way for crowded classes
    counts = np.zeros(SKETCH, np.int64)
    for r in sets.mapInArrow(_counted, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[r["at"]] = r["n"]
    crowd = named.join(crowded, "key", "left_semi").select("key", "group").join(sets, "key")
    rare = staged(rare_shingles(crowd, counts), "rare")
    rest = likely(apart_pairs(rare).join(pairs.select("a", "b"), ["a", "b"], "left_anti"))
    group_of = lambda s: named.select(F.col("key").alias(s), F.col("group").alias(f"group_{s}"))
    late = _checked(rest, sets).join(group_of("a"), "a").join(group_of("b"), "b")
    late = connected_components(late.select(F.col("group_a").alias("a"), F.col("group_b").alias("b")))
    named = staged(regroup(named, late), "groups")
    smallest = named.groupBy("group").agg(F.min("least").alias("component"))
    by_key = named.join(smallest, "group").select("key", "group", "component")
    out = signed.select("doc_id", "text_hash", "n_shingles", "key").join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.withColumn("component_id", component).select(
        "doc_id", "text_hash", "n_shingles", "group", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group, all columns as they are.

    It is the row of the smallest id, NULL last, and of those the one of the smallest text
    hash: members may share an id or have none. A text without a shingle is its own group.
    """
    rows = _grouped(docs, id_col, text_col).select("group", "doc_id", "text_hash")
    first = rows.filter("group IS NOT NULL").groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("m")).select("m.doc_id", "m.text_hash")
    own, digest = fresh_name(docs.columns, "own_id"), fresh_name(docs.columns, "text_hash")
    kept = first.union(rows.filter("group IS NULL").select("doc_id", "text_hash")).select(
        F.coalesce("doc_id", F.lit(FIRST)).alias(own), F.col("text_hash").alias(digest)).distinct()
    marked = docs.withColumn(own, F.coalesce(F.col(id_col).cast("bigint"), F.lit(FIRST))).withColumn(digest, F.xxhash64(text_col))
    return marked.join(kept, [own, digest], "left_semi").dropDuplicates([own, digest]).drop(own, digest)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents")).drop("text_hash")


SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT x.a, x.b FROM (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS shared FROM s l JOIN s r USING (g) WHERE l.doc_id <> r.doc_id GROUP BY 1, 2) x
  JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b WHERE 100 * shared >= {SHARE} * (na.n + nb.n - shared)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.doc_id = d.doc_id
"""
