"""Decontamination, license scan and mixing against plain Python."""

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import decontam, licenses, mixing

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_hits(text, items, window=13):
    words = ALNUM.findall(lower(text))
    hit, ids = set(), set()
    for item_id, item in items:
        w = ALNUM.findall(lower(item))
        m = min(window, len(w))
        for i in range(len(w) - m + 1) if m else ():
            for j in range(len(words) - m + 1):
                if words[j:j + m] == w[i:i + m]:
                    hit |= set(range(j, j + m))
                    ids.add(str(item_id))
    return len(words), len(hit), sorted(ids)


def test_decontamination_is_brute_force(spark):
    items = [(10, " ".join(f"w{i}" for i in range(20))), (9, "short one here"), (11, None), (12, ""), (None, "zebra Yak"), (9, "other phrase of nine")]
    long = " ".join(f"w{i}" for i in range(20))
    texts = [long, "x " + long[4:-4] + " y", "A SHORT one, here! short one here", None, "", "zebra yak zebra-yak", "w0 w1 w2", "clean words only " * 30,
             "short one here " + "pad " * 57, "short one here " + "pad " * 58]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[2])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    known = [("" if i is None else i, t) for i, t in items]

    def want(text):
        n, hit, ids = brute_hits(text, known)
        return n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0 and 20 * hit >= n

    for limit in (decontam.BROADCAST_LIMIT, 400):       # 400 bytes: the benchmark is scanned for in blocks
        got = decontam.report(docs, bench, broadcast_limit=limit).collect()
        expected = Counter((i, *want(t)) for i, t in [*enumerate(texts), (0, texts[0]), (None, texts[2])])
        assert Counter(tuple(r) for r in got) == expected


def test_decontaminated_documents_and_spans(spark, edge, empty, benchmark):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over")], "item_id long, text string")
    kept = decontam.drop_documents(edge, bench)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 4
    cut = {r.doc_id: r.text for r in decontam.remove_spans(edge.where("doc_id in (5, 9)"), bench).collect()}
    assert cut[5] == "A the lazy dog near the old river bank today" and cut[9] == "line one.\nline two.\n\nline two."
    assert decontam.report(edge, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.report(empty, benchmark).count() == 0
    r = decontam.report(edge, benchmark).collect()
    assert len(r) == edge.count() and all(x.n_items == 0 and x.items_sha256 == hashlib.sha256(b"").hexdigest() for x in r)


def test_license_base_is_brute_force(spark, edge, empty):
    texts = ["cc by cc by-sa 4.0. CC-BY", "All rights reserved all RIGHTS reserved", "general public license cc_by",
             "GNU General Public License, version 2 or any later version", "no license", None, "", "cc by" * 3, "x cc\nby y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(edge.select("doc_id", "text"))
    rows = df.collect()
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.report(df).collect())

    def want(text):
        w = ALNUM.findall(lower(text))
        at = [(i, label) for phrase, label in licenses.BASE.items() for p in [phrase.split()]
              for i in range(len(w)) if w[i:i + len(p)] == p]
        starts = [i for i, _ in at]
        return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))

    assert got == Counter((r.doc_id, *want(r.text)) for r in rows)
    assert licenses.report(empty).count() == 0


def test_license_rules_match_and_suppress(spark):
    cases = {"GNU General Public License, version 2 or any later version": "gpl,gpl-2-or-later", "released under the MIT License": "mit,released",
             "licensed under the Apache License, Version 2.0.": "apache-2.0,licensed", "CC BY-NC-SA 4.0": "cc-by,cc-by-nc-sa-4.0",
             "BSD 3-clause license": "bsd-3-clause", "SPDX-License-Identifier: MPL-2.0": "mpl-2.0", "mit der Zeit": "",
             "gplv3 and LGPL 2.1": "gpl-3,lgpl-2.1", "Copyright (c) 2020 X. All rights reserved.": "copyright,reserved"}
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.report(df).collect()}
    assert [got[i][0] for i in range(len(cases))] == list(cases.values())
    assert all(0 <= s <= 1 and (s > 0) == bool(x) for x, s in got.values())
    # every rule finds itself behind its keyword
    for label, key, pattern, _, _ in licenses.rules():
        re.compile(pattern)
        assert key.strip()


def water_fill(sizes, weights, cap=3):
    left, free, out = float(sum(sizes)), set(range(len(sizes))), {}
    while True:
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > cap * sizes[i]]
        if not over:
            return [out.get(i, share.get(i)) for i in range(len(sizes))]
        for i in over:
            out[i] = float(cap * sizes[i])
            left -= out[i]
            free.discard(i)


def test_mix_is_brute_force(spark, docs):
    rows = mixing.mix(docs.withColumn("source", F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("s"), F.least(F.col("doc_id") % 5, F.lit(2)))))).collect()
    names = sorted({r.source for r in rows if r.source is not None}) + [None]
    sizes = [sum(r.size for r in rows if r.source == s) for s in names]
    targets = water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])
    for s, size, target in zip(names, sizes, targets):
        own = [r for r in rows if r.source == s]
        assert all(r.source_size == size and math.isclose(r.target, target, rel_tol=1e-9) for r in own)
        assert all(r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in own)
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own) / 2 + 1
        epochs = min(r.taken // max(1, r.size) for r in own if r.size)
        assert epochs == int(target // size)          # complete epochs first
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs.withColumn("source", F.when(F.col("doc_id") % 7 != 0, F.concat(
        F.lit("s"), F.least(F.col("doc_id") % 5, F.lit(2))))).repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_mix_takes_the_smallest_keys(spark):
    import hashlib as h
    df = spark.createDataFrame([(i, "ab" if i < 40 else "zz", "w " * (1 + i % 3)) for i in range(80)], "doc_id long, source string, text string")
    rows = mixing.mix(df).collect()

    def key(i):
        return -math.log((int(h.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52)

    for s in ("ab", "zz"):
        own = sorted((r for r in rows if r.source == s), key=lambda r: key(r.doc_id))
        extra = [r.taken // r.size for r in own]
        assert extra == sorted(extra, reverse=True)


def test_mix_edges(edge, empty):
    rows = mixing.mix(edge).collect()
    assert len(rows) == edge.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert mixing.mix(empty).count() == 0


def test_license_sql_agrees_on_odd_texts(spark):
    import duckdb
    texts = ["cc by cc by-sa 4.0. CC-BY", "gnu gpl v3 only gplv2 or later, GPL 3.0", None, "", "All rights reserved. all rights reserved",
             "Creative Commons Attribution-ShareAlike License 3.0 cc by sa", "bsd three-clause BSD license mit licence MIT License",
             "copyright 1999 copyright (c) 2001", "spdx license identifier apache 2 0 apache license version 2.0", "é cc by É cc by"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    rel = con.sql(licenses.SQL)
    want = sorted(tuple(dict(zip(rel.columns, r))[c] for c in licenses.report(df).columns) for r in rel.fetchall())
    assert sorted(tuple(r) for r in licenses.report(df).collect()) == want


def test_targets_are_broadcast_only_while_small(spark):
    from tidemark.llm.common import small_side
    df = spark.range(50).selectExpr("id", "repeat('x', 100) AS source")
    big = spark.range(10).withColumn("other", F.lit(1))
    plan = lambda limit: big.join(small_side(df, "side", limit), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(50 * 200) and "broadcast" not in plan(1000)
    assert big.join(small_side(df.limit(0), "side"), "id").count() == 0


def test_key_ranges_are_even_at_every_quality(spark):
    sized = spark.range(30_000).selectExpr(
        "id AS doc_id", "IF(id % 3 = 0, NULL, IF(id % 3 = 1, 'low', 'mixed')) AS source", "id % 7 AS size",
        "CASE id % 3 WHEN 0 THEN 1.0D WHEN 1 THEN 0.1D ELSE 0.1D + 0.9D * pmod(hash(id), 1000) / 1000 END AS quality")
    rows = mixing.ranged(sized, mixing.source_targets(sized))
    assert rows.count() == 30_000
    most = rows.groupBy("source", "part").count().groupBy("source").agg(F.max("count").alias("m")).collect()
    assert len(most) == 3 and all(r.m <= 3 * 10_000 / 174 for r in most)   # 174 = ceil(sqrt(30,000)) ranges
    spans = rows.groupBy("source", "part").agg(F.min("key").alias("a"), F.max("key").alias("b")).collect()
    for source in (None, "low", "mixed"):
        bounds = [(r.a, r.b) for r in sorted((r for r in spans if r.source == source), key=lambda r: r.part)]
        assert all(x[1] < y[0] for x, y in zip(bounds, bounds[1:]))
