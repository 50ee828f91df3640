"""Nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm (0 for queries), so that
the nearest by distance has the largest inner product. A random rotation then spreads every
distance evenly over the components. Centres of lists are fitted on a bounded sample, every vector
goes to the list of its nearest centre, and a query probes the lists nearest to it.

Inside a probed list the rotated vectors lie in column blocks. Distances are summed block by
block; after d of D components the sum times D / d estimates the distance, and a candidate
is abandoned when the estimate exceeds the best known limit by more than chance explains: the factor
(1 + EPSILON / sqrt(d))^2. Dense blocks are one matrix product, later ones touch the survivors only.
The first lists of a query give its limit for the others, so these return few candidates.

How many lists are probed is measured on each table: for a bounded number of queries all rows are
scanned, and the least number is taken that finds ``TARGET`` of their true neighbours.

Equal vectors are one class, searched once, of which at most k + 1 ids are kept: more can be
in no result. Long lists are cut in chunks and their queries in slots, so a task holds a
bounded part of either. The candidates found are scored exactly, in double precision, on the
original vectors. The sample (``PER_LIST`` vectors a list, at most ``MAX_LISTS`` lists), the
centres and the rotation are what the driver holds and sends out.

Defined cases: rows without id or vector, zero vectors, vectors with NULL or non-finite components
and those of another length than most (of two equally frequent ones the longer) take no part; equal rows
are one; an id with several vectors asks with each and gets the best of all; rows of the query's
own id are no candidates; ties go to the smaller id; with fewer than k
candidates all are returned; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table

NAME = "op13_nearest_neighbours"
K = 20
QUERY_EVERY = 20
MAX_LISTS, PER_LIST, ROUNDS = 4096, 64, 8
CHUNK, SLOT = 8192, 8192        # vectors and queries of a list that a task holds
TILE, QUERY_TILE = 1024, 128    # those that are compared at once
BLOCK = 16                      # components of a column block
EPSILON = 2.1
MARGIN = 20                     # candidates kept beyond k + 1 for the exact scores
TARGET, TRIAL_QUERIES = 0.97, 256
SEED = 13


# --- the scan -----------------------------------------------------------------------------

def smallest(query: np.ndarray, other: np.ndarray, dist: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` smallest distances of each query (ties: the smaller other)."""
    order = np.lexsort((other, dist, query))
    query, other, dist = query[order], other[order], dist[order]
    first = np.concatenate([[True], np.diff(query) != 0])[:len(query)]
    rank = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
    return query[rank < keep], other[rank < keep], dist[rank < keep]


def scan_tile(q: np.ndarray, x: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, squared distance) of the pairs that no test abandons."""
    dims = x.shape[1]
    blocks = [slice(i, min(i + BLOCK, dims)) for i in range(0, dims, BLOCK)]

    def dense(b: slice) -> np.ndarray:
        u, v = q[:, b], x[:, b]
        return np.maximum((u * u).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2 * (u @ v.T), 0)

    def bound(done: int) -> np.ndarray:
        return limit * ((done / dims) * (1 + EPSILON / math.sqrt(done)) ** 2 if done < dims else 1.0)

    part, at = dense(blocks[0]), 1
    alive = part <= bound(blocks[0].stop)[:, None]
    while at < len(blocks) and alive.mean() > 0.2:
        part += dense(blocks[at])
        alive &= part <= bound(blocks[at].stop)[:, None]
        at += 1
    i, j = np.nonzero(alive)
    dist = part[i, j]
    for b in blocks[at:]:
        dist = dist + ((q[i, b] - x[j, b]) ** 2).sum(1)
        left = dist <= bound(b.stop)[i]
        i, j, dist = i[left], j[left], dist[left]
    return i, j, dist


def scan(q: np.ndarray, x: np.ndarray, limit: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, squared distance): the ``keep`` nearest vectors of each query within its limit."""
    out = []
    for lo in range(0, len(q), QUERY_TILE):
        part, near = q[lo:lo + QUERY_TILE], limit[lo:lo + QUERY_TILE].copy()
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
        for at in range(0, len(x), TILE):
            i, j, d = scan_tile(part, x[at:at + TILE], near)
            best = smallest(*(np.concatenate(p) for p in zip(best, (i, j + at, d))), keep)
            n = np.bincount(best[0], minlength=len(part))
            full = n == keep
            last = np.cumsum(n) - 1
            near[full] = np.minimum(near[full], best[2][last[full]])
        out.append((best[0] + lo, best[1], best[2]))
    return tuple(np.concatenate(p) for p in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


# --- the index ----------------------------------------------------------------------------

@dataclass
class Index:
    """What the workers need: rotation, centres (rotated) and the square of the largest norm."""

    rotation: np.ndarray
    centres: np.ndarray
    top: float

    def rotated(self, x: np.ndarray, query: bool) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top - (x * x).sum(1), 0))
        return (np.column_stack([x, more]) @ self.rotation).astype(np.float32)

    def lists(self, r: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest lists of rotated vectors, nearest first."""
        d = (self.centres ** 2).sum(1)[None, :] - 2 * (r @ self.centres.T)
        return np.argsort(d, axis=1, kind="stable")[:, :n]


def fit(sample: np.ndarray, lists: int, top: float) -> Index:
    """Rotation and centres (Lloyd's rounds) from a sample in the order given."""
    rng = np.random.default_rng(SEED)
    dims = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    index = Index(rotation, np.zeros((0, dims), np.float32), top)
    points = index.rotated(sample, query=False)
    index.centres = points[rng.choice(len(points), min(lists, len(points)), replace=False)]
    for _ in range(ROUNDS):
        own = np.concatenate([index.lists(points[i:i + 4096], 1)[:, 0] for i in range(0, len(points), 4096)])
        sums = np.zeros_like(index.centres, dtype=np.float64)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(sums))
        index.centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], index.centres).astype(np.float32)
    return index


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """A list column without NULLs, all of one length, as a matrix."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, -1) if n else np.zeros((0, 0), kind)


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1)


# --- jobs ---------------------------------------------------------------------------------

def classes_of(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (rep, vec, ids: their k + 1 smallest) and every row (id, rep)."""
    vec = F.col(vec_col).cast("array<double>")
    sound = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vec, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), vec.alias("vec")).filter(F.col("id").isNotNull() & sound)
    rows = rows.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec")})
    sizes = rows.groupBy(F.size("vec").alias("dims")).count()
    common = sizes.agg(F.max(F.struct("count", "dims"))["dims"]).first()[0]
    rows = rows.filter(F.size("vec") == (common or 0))
    # row_number up to a bound is cut before the shuffle as well, so a class of any size stays small
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    classes = staged(few.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.first("vec").alias("vec"),
                                                 F.array_sort(F.collect_set("id")).alias("ids")), "classes")
    return classes, rows.select("id", "h1", "h2")


def sample_of(classes: DataFrame, n: int, bound: int) -> np.ndarray:
    """About ``bound`` vectors (all, if there are no more), chosen by hash, in order of it."""
    part = classes if n <= bound else classes.filter(F.pmod("h1", F.lit(1 << 40)) < int((1 << 40) * bound / n))
    rows = part.select("h1", "h2", "vec").toArrow().sort_by([("h1", "ascending"), ("h2", "ascending")])
    return _matrix(rows.column("vec").combine_chunks())


def place_lists(classes: DataFrame, index: Index) -> DataFrame:
    """rep, list and packed rotated vector of every class: the inverted lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = index.rotated(_matrix(batch.column("vec")), query=False)
            own = index.lists(r, 1)[:, 0] if len(r) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(own.astype(np.int32)), pa.array([v.tobytes() for v in r], pa.binary())],
                                             ["rep", "list", "packed"])
    return staged(classes.select("rep", "vec").mapInArrow(run, "rep bigint, list int, packed binary"), "lists")


def route(queries: DataFrame, index: Index, probes: int) -> DataFrame:
    """query, packed and its ``probes`` nearest lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                r = index.rotated(_matrix(part.column("vec")), query=True)
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array([v.tobytes() for v in r], pa.binary()),
                                                  pa.array(list(index.lists(r, probes).astype(np.int32)), pa.list_(pa.int32()))], ["query", "packed", "lists"])
    return queries.select("rep", "vec").mapInArrow(run, "query bigint, packed binary, lists array<int>")


def probes_needed(classes: DataFrame, lists: DataFrame, queries: DataFrame, index: Index, k: int, target: float) -> int:
    """The least number of lists in which the trial queries' true neighbours are found to the share ``target``."""
    n = queries.count()
    trial = sample_of(queries, n, TRIAL_QUERIES)[:2 * TRIAL_QUERIES]
    if not len(trial):
        return 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for batch in batches:
            x, reps = _matrix(batch.column("vec")), batch.column("rep").to_numpy()
            if len(x):
                near = -(trial @ x.T)
                few = np.argpartition(near, min(k, len(x) - 1), axis=1)[:, :k + 1]
                rows = np.repeat(np.arange(len(trial)), few.shape[1])
                found = (rows, reps[few.ravel()], near[rows, few.ravel()])
                best = smallest(*(np.concatenate(p) for p in zip(best, found)), k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(best[0]), pa.array(best[1]), pa.array(best[2])], ["trial", "rep", "near"])

    found = classes.select("rep", "vec").mapInArrow(run, "trial bigint, rep bigint, near double")
    place = F.row_number().over(Window.partitionBy("trial").orderBy("near", "rep"))
    true = found.withColumn("place", place).filter(F.col("place") <= k + 1).join(lists.select("rep", "list"), "rep").select("trial", "list").collect()
    order = np.argsort(index.lists(index.rotated(trial, query=True), len(index.centres)), axis=1)
    ranks = np.sort([order[r["trial"], r["list"]] for r in true])
    return int(ranks[max(0, math.ceil(target * len(ranks)) - 1)]) + 1


def search_lists(lists: DataFrame, probes: DataFrame, sizes: dict[int, int], keep: int) -> DataFrame:
    """query, rep, dist: of each probed list the nearest classes within the query's limit.

    ``probes``: query, packed, limit, list. ``sizes``: classes of each list, of which there are at most MAX_LISTS.
    """
    asked = {r["list"]: r["n"] for r in probes.groupBy("list").agg(F.count("*").alias("n")).collect()}
    count = lambda of, unit: F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for l, n in of.items() if n > unit  # noqa: E731, E741
                                                                        for v in (l, -(-n // unit))]), F.col("list")), F.lit(1)) \
        if any(n > unit for n in of.values()) else F.lit(1)
    chunks, slots = count(sizes, CHUNK), count(asked, SLOT)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    spread = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    base = lists.select("rep", "packed", "list", spread("rep", chunks).alias("chunk"), every(slots).alias("slot"))
    asks = probes.select("query", "packed", "limit", "list", every(chunks).alias("chunk"), spread("query", slots).alias("slot"))

    def run(base: pa.Table, asks: pa.Table) -> pa.Table:
        empty = {"query": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "dist": pa.array([], pa.float64())}
        if not len(base) or not len(asks):
            return pa.table(empty)
        i, j, d = scan(_unpacked(asks.column("packed")), _unpacked(base.column("packed")), asks.column("limit").to_numpy(), keep)
        return pa.table({"query": asks.column("query").to_numpy()[i], "rep": base.column("rep").to_numpy()[j], "dist": d.astype(np.float64)})

    keys = ["list", "chunk", "slot"]
    return base.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(run, "query bigint, rep bigint, dist double")


def nearest(found: DataFrame, keep: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query").orderBy("dist", "rep"))
    return found.withColumn("place", place).filter(F.col("place") <= keep)


def search(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
           target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row that ``is_query`` (over column ``id``) names."""
    classes, rows = classes_of(vectors, id_col, vec_col, k)
    asked = staged(rows.filter(is_query).distinct().join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).select(F.col("id").alias("query_id"), "rep"), "asked")
    keep = k + 1 + MARGIN
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    n, top = classes.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index = fit(sample_of(classes, n, PER_LIST * min(MAX_LISTS, math.isqrt(n))), min(MAX_LISTS, math.isqrt(n)), top)
    lists = place_lists(classes, index)
    sizes = {r["list"]: r["n"] for r in lists.groupBy("list").agg(F.count("*").alias("n")).collect()}
    queries = classes.join(asked.select("rep").distinct(), "rep", "left_semi")
    probes = probes_needed(classes, lists, queries, index, k, target)

    # the first lists give each query the limit for the others
    routed = staged(route(queries, index, probes), "routed")
    first = max(1, probes // 8)
    step = lambda df, lo, n: df.select("query", "packed", "limit", F.explode(F.slice("lists", lo, n)).alias("list"))
    early = staged(nearest(search_lists(lists, step(routed.withColumn("limit", F.lit(float("inf"))), 1, first), sizes, keep), keep), "early")
    limits = early.filter(F.col("place") == keep).select("query", F.col("dist").alias("limit"))
    limited = routed.join(limits, "query", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    late = search_lists(lists, step(limited, first + 1, MAX_LISTS), sizes, keep)
    found = nearest(early.select("query", "rep", "dist").union(late), keep).select("query", "rep")

    # exact scores on the original vectors; every class stands for its smallest ids
    mine, other = classes.select(F.col("rep").alias("query"), F.col("vec").alias("q")), classes.select("rep", F.col("vec").alias("x"), "ids")
    score = F.aggregate(F.zip_with("q", "x", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = found.join(other, "rep").join(mine, "query").select("query", score.alias("score"), F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    scored = scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    out = asked.join(scored, asked["rep"] == scored["query"]).filter(F.col("query_id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_EVERY == 0)


SQL = None
