"""Merkle manifest against trees written out in plain Python."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.llm import manifest


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, more=0):
    n = None if r.n_chars is None else r.n_chars + more
    return H(field(r.doc_id), field(r.source), field(r.lang), field(n), field(r.text))


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(levels, k):
    path = []
    for level in levels[:-1]:
        j = k ^ 1
        path.append(("N", "") if j >= len(level) else ("L" if j < k else "R", level[j]))
        k >>= 1
    return path


def up(h, path):
    for side, s in path:
        h = H(h) if side == "N" else H(s, h) if side == "L" else H(h, s)
    return h


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
        trees[g] = levels_of([leaf_of(r) for r in groups[g]])
    forest = levels_of([trees[g][-1][0] for g in langs])
    root, out = forest[-1][0], []
    for i, g in enumerate(langs):
        for k, r in enumerate(groups[g]):
            path = siblings(trees[g], k) + siblings(forest, i)
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            folded = up(leaf_of(r, int(hit)), path)
            out.append((r.doc_id, leaf_of(r), trees[g][-1][0], root, H(*(s for _, s in path)), folded, folded == root))
    return sorted(out, key=repr)


def result(df):
    out = manifest.proofs(manifest.build(df, altered=manifest.tampered(df)))
    return sorted((tuple([None if r.label is None else int(r.label), *r[1:]]) for r in out.collect()), key=repr)


@pytest.mark.parametrize("height", [2, 10])
def test_manifest_is_brute_force(spark, docs, edge, monkeypatch, height):
    """Blocks of 4 leaves make several floors; texts, NULLs, repeated rows and NULL ids as in ``edge``."""
    monkeypatch.setattr(manifest, "HEIGHT", height)
    monkeypatch.setattr(manifest, "FULL", 1 << height)
    some = docs.where("doc_id < 90").withColumn("lang", F.when(F.col("doc_id") % 10 == 3, F.lit(None)).otherwise(F.col("lang")))
    for df in (some, edge, edge.limit(1), edge.withColumn("lang", F.col("text").substr(1, 2))):
        got = result(df)
        assert got == brute(df.collect()) and len(got) == df.count()
    assert any(not r[-1] for r in result(some))


def test_empty_table(empty):
    m = manifest.build(empty, altered=manifest.tampered(empty))
    assert m.root is None and manifest.proofs(m).count() == 0


def test_equal_rows_are_spread(spark):
    """A third of all rows is one row; each has its place and a proof of its own."""
    one = Row(doc_id=7, source="s", lang="en", n_chars=1, text="x")
    rows = [one] * 40 + [Row(**{**one.asDict(), "doc_id": i}) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    assert result(df.repartition(5)) == brute(rows)


@pytest.mark.parametrize("height", range(0, 12))
def test_layout_is_van_emde_boas(height):
    at = manifest.layout(height)
    assert sorted(np.concatenate(at).tolist()) == list(range((2 << height) - 1))
    assert at[0][0] == 0
    top = (height + 1) // 2
    if top:     # the top half lies first, then one bottom tree after the other, each laid out alike
        assert max(np.concatenate(at[:top])) == (1 << top) - 2
        below = manifest.layout(height - top)
        size = (2 << (height - top)) - 1
        for d, addresses in enumerate(below):
            for tree in range(1 << top):
                own = at[top + d][tree << d:(tree + 1) << d]
                assert (own == (1 << top) - 1 + tree * size + addresses).all()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13])
def test_block_paths_lead_to_its_root(n):
    leaves = [sha256(bytes([i])).digest() for i in range(n)]
    for levels in ((n - 1).bit_length(), (n - 1).bit_length() + 2):
        body = manifest.block_of(leaves, levels)
        paths = manifest.paths_in(body, levels, n)
        assert all(manifest.fold(x.hex(), p) == body[:32].hex() and len(p) == levels for x, p in zip(leaves, paths))
