"""Run a registered query on Spark and its oracle SQL on DuckDB; compare.

Usable from pytest (``compare``) and as a script:
``python tests/oracle_check.py [sf_dir] [query ...]``.
Values are compared exactly (doubles bit for bit), rows order-insensitively,
columns by name, and types through a Spark <-> DuckDB mapping.
"""

from __future__ import annotations

import math
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "date": {"DATE"}, "boolean": {"BOOLEAN"}, "float": {"FLOAT"}, "smallint": {"SMALLINT"},
    "timestamp_ntz": {"TIMESTAMP"}, "timestamp": {"TIMESTAMP WITH TIME ZONE", "TIMESTAMP"},
}


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if v is None:
        return None
    return v


def _key(row):
    return tuple((0, "") if v is None else (1, repr(v)) for v in row)


def compare(spark, con, name, fn, sql, sf_dir, verbose=True):
    sdf = fn(spark, sf_dir)
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_types) != sorted(d_types):
        problems.append(f"columns differ: spark={list(s_types)} duck={list(d_types)}")
    else:
        for c in s_types:
            ok = d_types[c] in SPARK_TO_DUCK.get(s_types[c], {s_types[c].upper()})
            if not ok and not (s_types[c].startswith("decimal") and d_types[c].startswith("DECIMAL")):
                problems.append(f"type {c}: spark={s_types[c]} duck={d_types[c]}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows: spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        cols = sorted(s_types)
        si = [list(s_types).index(c) for c in cols]
        di = [list(d_types).index(c) for c in cols]
        sr = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
        dr = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
        bad = [(a, b) for a, b in zip(sr, dr) if a != b]
        if bad:
            maxdiff = 0.0
            for a, b in bad:
                for x, y in zip(a, b):
                    if isinstance(x, float) and isinstance(y, float):
                        maxdiff = max(maxdiff, abs(x - y))
            problems.append(f"{len(bad)} differing rows (max float diff {maxdiff:g}); first: "
                            f"spark={bad[0][0]} duck={bad[0][1]} cols={cols}")
    if verbose:
        print(f"{'OK ' if not problems else 'BAD'} {name}: {len(s_rows)} rows"
              + ("" if not problems else " | " + " | ".join(problems)), flush=True)
    return problems


def main(argv):
    from tidemark.session import build_session
    from __spark_entry__ import oracle_sql, queries
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session()
    con = duck_connect(sf_dir)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in os_:
            df = qs[name](spark, sf_dir)
            print(f"--  {name}: {df.count()} rows (no oracle)", flush=True)
            continue
        try:
            bad += bool(compare(spark, con, name, qs[name], os_[name], sf_dir))
        except Exception as e:  # report and continue
            bad += 1
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:800]}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
