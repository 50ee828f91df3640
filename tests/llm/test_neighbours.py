"""Nearest neighbours against all inner products, written out."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import neighbours

SF01 = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label string, rep int, vec string"
IS_QUERY = "id % 20 = 0"


def brute(rows, k, is_query=lambda i: i % 20 == 0):
    """{query: [(vec_id, score)]} over (id, vector) rows that take part."""
    ok = [(i, tuple(np.float32(v))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    lengths = [len(v) for _, v in ok]
    common = max(set(lengths), key=lambda n: (lengths.count(n), n)) if ok else 0
    ok = {(i, v) for i, v in ok if len(v) == common}
    out = {}
    for q, qv in ok:
        if is_query(q):
            scores = sorted((-sum(float(a) * float(b) for a, b in zip(qv, v)), i) for i, v in ok if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def result(df, **options):
    out = {}
    for r in neighbours.search(df, F.expr(IS_QUERY), **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    table = spark.read.parquet(f"{SF01}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in table.collect()], 20)
    got = result(table)
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    scores = {(q, i): s for q, every in brute([(r.vec_id, r.embedding) for r in table.collect()], 500).items() for i, s in every}
    assert all(abs(s - scores[q, i]) < 1e-12 for q, g in got.items() for i, s in g)
    assert all(g == sorted(g, key=lambda x: (-x[1], x[0])) for g in got.values())


def test_edges(spark):
    """Lengths of inner products differ, vectors tie, rows repeat or take no part; lists are cut in several chunks and slots."""
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.standard_normal(8) * (1 + i % 5)]) for i in range(400)]
    rows += [(i, [1.0] + [0.0] * 6 + [2.0]) for i in range(1000, 1200)]           # a third are one vector
    rows += [rows[3], rows[3], (20, rows[3][1])]                                     # repeated; one id with two vectors
    rows += [(2000, None), (2020, []), (2040, [0.0] * 8), (2060, [1.0, None] + [0.0] * 6), (2080, [float("nan")] + [1.0] * 7),
             (2100, [float("inf")] + [1.0] * 7), (2120, [1.0, 2.0]), (None, [1.0] * 8), (-20, [-1.0] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], SCHEMA).repartition(4)
    want = brute(rows, 20)
    got = result(df, target=1.0)
    assert set(got) == set(want)
    assert np.mean([[i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want if q != 20]) > 0.95
    assert all(len(g) == 20 for g in got.values())
    few = df.where("vec_id between 0 and 12 or vec_id = 2000")
    assert [i for i, _ in result(few)[0]] == [i for i, _ in brute([r for r in rows if r[0] in range(13)], 20)[0]]
    for none in (df.limit(0), df.where("vec_id = 2040")):
        assert neighbours.search(none, F.expr(IS_QUERY)).count() == 0
    assert neighbours.search(df.where("vec_id = 20"), F.expr(IS_QUERY)).count() == 0          # no row but the query's own


def test_chunks_and_slots_lose_nothing(spark, monkeypatch):
    rnd = np.random.default_rng(6)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rnd.standard_normal((300, 6)))]
    df = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], SCHEMA)
    is_query = F.col("id") % 2 == 0
    whole = neighbours.search(df, is_query, target=1.0).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(neighbours, "CHUNK", 7)
    monkeypatch.setattr(neighbours, "SLOT", 5)
    assert neighbours.search(df, is_query, target=1.0).orderBy("query_id", "rank").collect() == whole


def test_scan_abandons_only_what_the_limit_excludes():
    rnd = np.random.default_rng(2)
    x, q = (rnd.standard_normal((n, 65)).astype(np.float32) for n in (3000, 150))
    d = ((q[:, None, :].astype(float) - x[None]) ** 2).sum(2)
    i, j, dist = neighbours.scan(q, x, np.full(150, np.inf), 40)
    assert (np.bincount(i) == 40).all() and np.allclose(dist, d[i, j], rtol=1e-3)
    want = np.argsort(d, axis=1)[:, :40]
    found = sum(len(set(j[i == r].tolist()) & set(want[r].tolist())) for r in range(150))
    assert found >= 0.97 * 150 * 40
    limit = np.sort(d, axis=1)[:, 10].astype(np.float32)
    i2, j2, d2 = neighbours.scan(q, x, limit, 40)
    assert (d2 <= limit[i2] * 1.001).all() and (np.bincount(i2, minlength=150) <= 12).all() and len(i2) >= 0.9 * 150 * 10


def test_smallest_breaks_ties_by_number():
    q, o, d = neighbours.smallest(np.array([1, 0, 1, 1]), np.array([5, 9, 4, 3]), np.array([2.0, 1.0, 2.0, 7.0]), 2)
    assert (q.tolist(), o.tolist(), d.tolist()) == ([0, 1, 1], [9, 4, 5], [1.0, 2.0, 2.0])
