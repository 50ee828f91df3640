"""Merkle manifest of a dataset, its trees stored by blocks in van Emde Boas layout.

Every row is a leaf: the hash of its fields. The leaves of one group (a language) in order
of their id make a tree, the roots of the groups another one, the forest. A parent is the hash
of its two children's hex digests; the last node of a level without a partner is hashed alone.

Rows are put in order by ranges and numbered from the sizes of the ranges before theirs.
An aligned run of ``2 ** HEIGHT`` nodes is a block: one task hashes it up to its
root, and the roots of the blocks are the nodes of the next floor, until a tree has one block.
Blocks are written as tables, one row a block, so a lost executor costs a re-read.

Inside a block the nodes lie in van Emde Boas order: a tree of h levels is split at half its
height, the top subtree is stored first, then each bottom subtree from left to right, every one
split in the same way. ``layout`` does that address arithmetic once per height for all nodes
of a depth; building a block and reading the siblings of a leaf go through it. The stretch
that a path touches is short at every page or cache size, none of which is a parameter.

From the forest downwards every block receives the path of its own root (side and digest of
the sibling of each level), so a leaf's proof is the path inside its block and that.

Defined cases: NULL fields are written as ``-``, so NULL and '' differ; a NULL group is a group
of its own, before all others; NULL ids come first; rows of one id are ordered by their
leaves, and equal rows take neighbouring places; an empty table has no row and no root; only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table

NAME = "op11_merkle_manifest"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEIGHT = 10                 # a block holds up to 2 ** HEIGHT nodes of a level below its root
FULL = 1 << HEIGHT
BLOCK = ("tree string, block bigint, n int, levels int, total bigint, root binary, body binary, "
         "labels array<string>, altered array<binary>")


# --- hashing ----------------------------------------------------------------------------

def field(value: Column) -> Column:
    """``-`` for NULL, else UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def parent(children: Sequence[str]) -> str:
    """Hash of one or two hex digests."""
    return sha256("".join(children).encode()).hexdigest()


@lru_cache
def layout(height: int) -> list[np.ndarray]:
    """For each depth, 0 (the root) to ``height``: the addresses of its nodes from left to right."""
    at: list[np.ndarray] = [None] * (height + 1)

    def place(depth: int, levels: int, first: np.ndarray) -> None:
        """Subtrees of ``levels`` levels, one under each node of ``depth``; ``first`` is where each begins."""
        if levels == 1:
            at[depth] = first
            return
        top = levels // 2
        place(depth, top, first)
        below = np.arange(1 << (depth + top))      # roots of the bottom subtrees
        place(depth + top, levels - top, first[below >> top] + ((1 << top) - 1)
              + (below & ((1 << top) - 1)) * ((1 << (levels - top)) - 1))

    place(0, height + 1, np.zeros(1, np.int64))
    return at


def block_of(leaves: Sequence[bytes], levels: int) -> bytes:
    """Body of a block: all nodes over ``leaves``, ``levels`` levels up, in van Emde Boas order."""
    at = layout(levels)
    body = np.zeros(((2 << levels) - 1, 32), np.uint8)
    digests = [x.hex() for x in leaves]
    for depth in range(levels, -1, -1):
        if depth < levels:
            digests = [parent(digests[i:i + 2]) for i in range(0, len(digests), 2)]
        body[at[depth][:len(digests)]] = np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(-1, 32)
    return body.tobytes()


def paths_in(body: bytes, levels: int, n: int) -> list[list[str]]:
    """For each of the ``n`` leaves of a block its siblings up to the block's root.

    A step is ``L`` or ``R``, the side where the sibling stands, and its digest; ``N`` where there is none.
    """
    at, digests, leaf = layout(levels), body.hex(), np.arange(n)
    steps = []
    for depth in range(levels, 0, -1):
        up = levels - depth
        sibling = (leaf >> up) ^ 1
        there = sibling < -(-n >> up)
        address = at[depth][np.where(there, sibling, 0)] * 64
        steps.append([(("R" if s & 1 else "L") + digests[a:a + 64]) if t else "N"
                      for a, s, t in zip(address.tolist(), sibling.tolist(), there.tolist())])
    return list(map(list, zip(*steps))) if steps else [[] for _ in range(n)]


def fold(leaf: str, path: Sequence[str]) -> str:
    """The root that a leaf and the siblings of its path lead to."""
    for step in path:
        side, sibling = step[0], step[1:]
        leaf = parent([leaf] if side == "N" else [sibling, leaf] if side == "L" else [leaf, sibling])
    return leaf


# --- trees ------------------------------------------------------------------------------

def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, their place in their ``tree`` by ``order``, and ``total``, its size."""
    ordered = staged(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                     .drop("salt").withColumn("at", F.monotonically_increasing_id()), "leaves")
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    # a range holds neighbours only, so a tree has one run in each of its ranges
    runs = ordered.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("n").over(of_tree).alias("total"))
    return ordered.join(starts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _blocks(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("pos")
    hashes, total = rows.column("hash").to_pylist(), rows.column("total")[0].as_py()
    levels = HEIGHT if total > FULL else (total - 1).bit_length()
    body = block_of(hashes, levels)
    one = {"tree": key[0].as_py(), "block": key[1].as_py(), "n": len(hashes), "levels": levels, "total": total,
           "root": body[:32], "body": body, "labels": rows.column("label").to_pylist(), "altered": rows.column("altered").to_pylist()}
    return pa.Table.from_pylist([one], pa.schema([
        ("tree", pa.string()), ("block", pa.int64()), ("n", pa.int32()), ("levels", pa.int32()), ("total", pa.int64()), ("root", pa.binary()),
        ("body", pa.binary()), ("labels", pa.list_(pa.string())), ("altered", pa.list_(pa.binary()))]))


def floors_over(nodes: DataFrame) -> list[DataFrame]:
    """Tables of blocks, the lowest floor first, over tree, pos, total, hash, label, altered rows."""
    floors = []
    while not floors or not nodes.isEmpty():
        group = nodes.withColumn("block", F.shiftright("pos", HEIGHT)).groupBy("tree", "block")
        floors.append(staged(group.applyInArrow(_blocks, BLOCK), f"floor{len(floors)}"))
        nodes = floors[-1].filter(F.col("total") > FULL).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("total") / FULL).alias("total"), F.col("root").alias("hash"),
            F.lit(None).cast("string").alias("label"), F.lit(None).cast("binary").alias("altered"))
    return floors


def tops(floors: Sequence[DataFrame]) -> DataFrame:
    """tree, floor, subroot: the root of every tree and the floor it stands on."""
    out = None
    for i, blocks in enumerate(floors):
        part = blocks.filter(F.col("total") <= FULL).select("tree", F.lit(i).alias("floor"), F.col("root").alias("subroot"))
        out = part if out is None else out.union(part)
    return out


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """tree, pos, label, path, subroot of every leaf of the blocks."""
    for batch in batches:
        for b in batch.to_pylist():
            path = [p + b["path"] for p in paths_in(b["body"], b["levels"], b["n"])]
            yield pa.RecordBatch.from_arrays([
                pa.array([b["tree"]] * b["n"], pa.string()), pa.array([(b["block"] << HEIGHT) + i for i in range(b["n"])], pa.int64()),
                pa.array(b["labels"], pa.string()), pa.array(path, pa.list_(pa.string())), pa.array([b["subroot"]] * b["n"], pa.binary())],
                ["tree", "pos", "label", "path", "subroot"])


SPREAD = "tree string, pos bigint, label string, path array<string>, subroot binary"


def with_paths(floors: Sequence[DataFrame], ends: DataFrame) -> DataFrame:
    """The blocks of the lowest floor with the path from their root; ``ends``: tree, floor, subroot, path."""
    known = None
    for i in range(len(floors) - 1, -1, -1):
        own = ends.filter(F.col("floor") == i).select("tree", F.lit(0).cast("bigint").alias("block"), "path", "subroot")
        known = own if known is None else known.union(own)
        blocks = floors[i].join(known, ["tree", "block"])
        if i:
            known = staged(blocks.mapInArrow(_spread, SPREAD).select("tree", F.col("pos").alias("block"), "path", "subroot"), f"paths{i}")
    return blocks


class Manifest:
    """``blocks``: the lowest floor with paths and subroots; ``root``: hex digest, None for an empty table."""

    def __init__(self, blocks: DataFrame, root: str | None):
        self.blocks, self.root = blocks, root


def build(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
          altered: dict[str, Column] | None = None) -> Manifest:
    """Manifest of ``docs``. ``altered`` gives other values of fields, for ``proofs`` to hold against the manifest."""
    leaf = leaf_hash([F.col(c) for c in fields])
    other = F.lit(None).cast("binary") if altered is None else leaf_hash([altered.get(c, F.col(c)) for c in fields])
    rows = docs.select(F.coalesce(F.concat(F.lit("."), F.col(group_col).cast("string")), F.lit("")).alias("tree"),
                       F.col(id_col).alias("id"), leaf.alias("hash"), other.alias("altered"),
                       F.monotonically_increasing_id().alias("salt"))   # parts equal rows
    rows = rows.withColumn("altered", F.when(F.col("altered") != F.col("hash"), F.col("altered")))
    rows = staged(rows, "rows")     # the texts are read once; ranges are drawn from this
    nodes = numbered(rows, ["id", "hash", "salt"]).withColumn("label", F.col("id").cast("string")).drop("id")
    floors = floors_over(nodes)

    groups = staged(tops(floors), "subroots")
    none = F.lit(None).cast("binary").alias("altered")
    trees = numbered(groups.select(F.lit("").alias("tree"), F.col("tree").alias("label"), F.col("subroot").alias("hash"), none), ["label"])
    forest = floors_over(trees)
    root = tops(forest).first()
    summit = tops(forest).withColumn("path", F.array().cast("array<string>"))
    up = with_paths(forest, summit).mapInArrow(_spread, SPREAD).select(F.col("label").alias("tree"), "path")
    ends = staged(groups.join(up, "tree"), "ends")
    return Manifest(with_paths(floors, ends), root and bytes(root["subroot"]).hex())


def proofs(manifest: Manifest) -> DataFrame:
    """Per row: label (its id as text), leaf, subroot, root, proof_sha256, folded_root, verified."""
    root = manifest.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                n, levels, digests = b["n"], b["levels"], b["body"].hex()
                leaves = [digests[a:a + 64] for a in (layout(levels)[levels][:n] * 64).tolist()]
                path = [p + b["path"] for p in paths_in(b["body"], levels, n)]
                proof = [sha256("".join(s[1:] for s in p).encode()).hexdigest() for p in path]
                folded = [fold(leaf if new is None else new.hex(), p) for leaf, new, p in zip(leaves, b["altered"], path)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(b["labels"], pa.string()), pa.array(leaves), pa.array([b["subroot"].hex()] * n), pa.array([root] * n, pa.string()),
                    pa.array(proof), pa.array(folded), pa.array([f == root for f in folded])],
                    ["label", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return manifest.blocks.mapInArrow(run, "label string, leaf string, subroot string, root string, proof_sha256 string, "
                                           "folded_root string, verified boolean")


def tampered(docs: DataFrame) -> dict[str, Column]:
    """n_chars one higher where 7 divides the id's crc32 (NULL stays)."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(hit, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    return {"n_chars": more.cast("decimal(21,0)")}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = proofs(build(docs, altered=tampered(docs)))
    return out.select(F.col("label").cast("bigint").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _field_sql(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


def _tree_sql(name: str, source: str) -> str:
    """Nodes (g, level, pos, hash, n) over source (g, pos, hash)."""
    return (f"{name}(g, level, pos, hash, n) AS (SELECT g, 0, pos, hash, count(*) OVER (PARTITION BY g) FROM {source} UNION ALL "
            f"SELECT g, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY g, level, pos // 2, n)")


def _steps_sql(leaves: str, nodes: str) -> str:
    """Paths of the leaves (g, pos) in their tree, as text steps in order of the level."""
    return (f"SELECT l.g, l.pos, list(CASE WHEN s.hash IS NULL THEN 'N' WHEN s.pos % 2 = 1 THEN 'R' || s.hash ELSE 'L' || s.hash END ORDER BY o.level) AS steps "
            f"FROM {leaves} l JOIN {nodes} o ON o.g = l.g AND o.n > 1 AND o.pos = l.pos >> o.level "
            f"LEFT JOIN {nodes} s ON s.g = o.g AND s.level = o.level AND s.pos = xor(o.pos, 1) GROUP BY l.g, l.pos")


_CRC = ("xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
        "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))")
_LEAF = "sha256(" + " || ".join(map(_field_sql, FIELDS)) + ")"
_ALTERED = f"sha256({' || '.join(_field_sql(f if f != 'n_chars' else '(CAST(n_chars AS HUGEINT) + 1)') for f in FIELDS)})"
SQL = f"""
WITH RECURSIVE h AS (SELECT doc_id, lang, {_LEAF} AS hash, CASE WHEN doc_id IS NOT NULL AND n_chars IS NOT NULL AND {_CRC} % 7 = 0
  THEN {_ALTERED} END AS altered FROM documents),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT lang FROM h)),
leaves AS (SELECT doc_id, g, hash, altered, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, hash) - 1 AS pos
  FROM h JOIN langs ON h.lang IS NOT DISTINCT FROM langs.lang),
{_tree_sql('nodes', 'leaves')},
subroots AS (SELECT 0 AS g, g AS pos, hash FROM nodes WHERE n = 1),
{_tree_sql('tops', 'subroots')},
inner_steps AS ({_steps_sql('leaves', 'nodes')}),
outer_steps AS ({_steps_sql('subroots', 'tops')}),
paths AS (SELECT l.doc_id, l.hash AS leaf, l.altered, s.hash AS subroot, list_concat(coalesce(i.steps, []), coalesce(o.steps, [])) AS steps
  FROM leaves l JOIN subroots s ON s.pos = l.g LEFT JOIN inner_steps i ON i.g = l.g AND i.pos = l.pos LEFT JOIN outer_steps o ON o.pos = l.g),
folded AS (SELECT *, (SELECT hash FROM tops WHERE n = 1) AS root, list_reduce(list_prepend(coalesce(altered, leaf), steps), lambda a, s:
  CASE substr(s, 1, 1) WHEN 'L' THEN sha256(substr(s, 2) || a) WHEN 'R' THEN sha256(a || substr(s, 2)) ELSE sha256(a) END) AS folded_root FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: substr(s, 2)), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM folded
"""
