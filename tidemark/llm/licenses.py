"""License scan: ordered signature rules gated by keywords, overlaps resolved by containment.

DataFrame functions only. A text is normalised once to its words with single spaces
around each (`` cc by 4 0 ``), so every rule is a regular expression on whole words and
a place is a pair of word numbers. A text meets a rule only if it contains the rule's
keyword; a first gate on the few distinct stems spares all other texts. Detections are
ordered by start, then longest, then rule priority, and one that lies inside an earlier
kept one is suppressed. Base phrases are rules that are never suppressed.

Defined cases: a NULL or empty text has no words, no places and score 0; equal document
rows each get a row; ties between rules on the same words go to the lower priority
number. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_ALNUM, lower_az, sql_lower, table

NAME = "op9_license_scan"
# phrase -> label; fixed by the contract
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def _versions(*versions: str) -> list[tuple[str, str]]:
    """(label form, word form) of version numbers: ('2.0', '2 0')."""
    return [(v, v.replace(".", " ")) for v in versions]


def rules() -> list[tuple[str, str, str, float, int]]:
    """(label, keyword, pattern, confidence, priority) of every signature, most specific first.

    Written as families of names, versions and endings; a pattern matches whole words. A
    keyword is made of whole words that every match of the pattern contains; one that
    ends in ``*`` may end inside a word.
    """
    lic = "licen[cs]e"
    out: list[tuple[str, str, str, float]] = []
    gnu = {"gpl": "general public", "lgpl": "(?:lesser|library) general public", "agpl": "affero general public"}
    endings = {"-or-later": " (?:or (?:any|at your option any) later version|or later)", "-only": " only", "": ""}
    for short, name in gnu.items():
        for v, w in _versions("1", "2", "2.1", "3"):
            w = w if v == "2.1" else f"{w}(?: 0)?"
            for end, tail in endings.items():
                out += [(f"{short}-{v}{end}", "general public", f"(?:gnu )?{name} {lic} (?:as published by the free software foundation )?(?:either )?(?:version |v)?{w}{tail}", 1.0),
                        (f"{short}-{v}{end}", f"{short}*", f"(?:gnu )?{short} ?(?:version |v)?{w}{tail}", 0.95)]
        out += [(short, "general public", f"(?:gnu )?{name} {lic}", 0.9), (short, short, f"gnu {short}", 0.8)]
    parts = {"by": ("by", "attribution"), "by-sa": ("by sa", "attribution share ?alike"), "by-nc": ("by nc", "attribution non ?commercial"),
             "by-nd": ("by nd", "attribution no ?deriv(?:ative)?s"), "by-nc-sa": ("by nc sa", "attribution non ?commercial share ?alike"),
             "by-nc-nd": ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s")}
    for label, (short, name) in parts.items():
        for v, w in [*_versions("1.0", "2.0", "2.5", "3.0", "4.0"), ("", "")]:
            tag, tail, sure = (f"-{v}", f" {w}", 1.0) if v else ("", "", 0.85)
            out += [(f"cc-{label}{tag}", "cc", f"cc {short}{tail}", sure),
                    (f"cc-{label}{tag}", "creative", f"creative commons {name}(?: {lic})?{tail}", sure)]
    out += [("cc0-1.0", "cc0", "cc0(?: 1 0)?", 0.95), ("cc0-1.0", "creative", "creative commons zero", 0.95),
            ("public-domain", "public domain", "(?:dedicated to|in|into) the public domain", 0.8)]
    named = {"apache": ("apache", ["1.0", "1.1", "2.0"]), "mpl": ("mozilla public", ["1.0", "1.1", "2.0"]),
             "epl": ("eclipse public", ["1.0", "2.0"]), "eupl": ("european union public", ["1.0", "1.1", "1.2"]),
             "cddl": ("common development and distribution", ["1.0", "1.1"]), "artistic": ("artistic", ["1.0", "2.0"]),
             "osl": ("open software", ["1.0", "2.0", "2.1", "3.0"]), "afl": ("academic free", ["1.1", "1.2", "2.0", "2.1", "3.0"]),
             "ofl": ("open font", ["1.0", "1.1"]), "bsl": ("boost software", ["1.0"]), "odbl": ("open database", ["1.0"]),
             "php": ("php", ["3.0", "3.01"]), "python": ("python(?: software foundation)?", ["2.0"]), "zpl": ("zope public", ["1.1", "2.0", "2.1"]),
             "lppl": ("latex project public", ["1.0", "1.1", "1.2", "1.3"]), "cpl": ("common public", ["1.0"]), "ecl": ("educational community", ["1.0", "2.0"])}
    for short, (name, versions) in named.items():
        key = name.split("(")[0]
        for v, w in _versions(*versions):
            out += [(f"{short}-{v}", key, f"{name} {lic} (?:version |v)?{w}", 1.0),
                    (f"{short}-{v}", short, f"{short} (?:{lic} )?(?:version |v)?{w}", 0.9)]
        out.append((short, key, f"{name} {lic}", 0.85))
    for n in ("2", "3", "4"):
        word = {"2": "two|simplified", "3": "three|new|revised", "4": "four|original"}[n]
        out += [(f"bsd-{n}-clause", "bsd", f"bsd (?:{n}|{word}) clause(?: {lic})?", 1.0),
                (f"bsd-{n}-clause", "bsd", f"(?:{n}|{word}) clause bsd(?: {lic})?", 1.0)]
    out += [("bsd", "bsd", f"bsd(?: style)? {lic}", 0.8),
            ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification", 0.95),
            ("mit", "mit lic*", f"mit {lic}", 0.95), ("mit", "expat", f"expat {lic}", 0.95), ("mit", "x11", f"x11 {lic}", 0.8),
            ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 0.95),
            ("isc", "isc", f"isc {lic}", 0.95), ("isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose", 0.9),
            ("zlib", "zlib", f"zlib(?: libpng)? {lic}", 0.95), ("zlib", "provided as is", "this software is provided as is without any express or implied warranty", 0.7),
            ("unlicense", "unlicense", "(?:the )?unlicense", 0.9), ("wtfpl", "wtfpl", "wtfpl", 0.9),
            ("postgresql", "postgresql", f"postgresql {lic}", 0.95),
            ("no-reproduction", "reproduced", "(?:may|must) not be (?:copied|reproduced|redistributed)(?: or (?:copied|reproduced|redistributed))*", 0.7),
            ("copyright", "copyright", "copyright(?: c)? (?:19|20)[0-9]{2}", 0.6),
            ("licensed", "licensed", "(?:is |are )?licensed under", 0.4), ("released", "released", "(?:is |are )?released under", 0.4)]
    for label in ("apache-2.0", "mit", "isc", "bsd-2-clause", "bsd-3-clause", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0",
                  "mpl-2.0", "epl-2.0", "cc0-1.0", "unlicense", "zlib", "bsl-1.0", "cc-by-4.0", "cc-by-sa-4.0"):
        words = label.replace("-", " ").replace(".", " ")
        out.append((label, "spdx", f"spdx license identifier {words}", 1.0))
    return [(label, f" {key[:-1]}" if key.endswith("*") else f" {key} ", pattern, sure, i)
            for i, (label, key, pattern, sure) in enumerate(out)]


def normalised(text: Column) -> Column:
    """`` w1 w2 ... `` : the words, lower-cased, one space around each; '' without words."""
    words = F.trim(F.regexp_replace(lower_az(text), NOT_ALNUM, " "))
    return F.when(words == "", "").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _spaces(s: Column) -> Column:
    return F.octet_length(s) - F.octet_length(F.replace(s, F.lit(" "), F.lit("")))


def _places(norm: Column, pattern: Column) -> Column:
    """[start, end) in words of every match: the spaces before it number the word it begins at."""
    whole = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    inner = F.transform(F.regexp_extract_all(norm, whole, F.lit(0)), _spaces)
    before = F.transform(F.split(norm, whole), _spaces)
    none = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(-1).alias("at"), none.alias("out"))
    step = lambda a, x: F.struct(
        (a["at"] + x["before"] + F.coalesce(x["inner"], F.lit(0))).alias("at"),
        F.when(x["inner"].isNull(), a["out"]).otherwise(F.array_append(a["out"], F.struct(
            (a["at"] + x["before"]).alias("start"), (a["at"] + x["before"] + x["inner"] + 1).alias("end")))).alias("out"))
    return F.aggregate(F.arrays_zip(before.alias("before"), inner.alias("inner")), start, step, lambda a: a["out"])


def _rule_table() -> Column:
    """The rules and base phrases as one constant array of structs."""
    row = lambda label, key, pattern, sure, rank, base: F.struct(
        F.lit(label).alias("label"), F.lit(key).alias("keyword"), F.lit(pattern).alias("pattern"),
        F.lit(float(sure)).alias("sure"), F.lit(rank).alias("rank"), F.lit(base).alias("base"))
    return F.array(*[row(label, f" {phrase} ", phrase, 0.9, -1, True) for phrase, label in BASE.items()], *[row(*r, False) for r in rules()])


def _kept(found: Column) -> Column:
    """Detections (sorted by start, longest, priority) that lie in no earlier kept one."""
    none = F.array().cast("array<struct<label:string,sure:double>>")
    return F.aggregate(found, F.struct(F.lit(0).alias("upto"), none.alias("out")), lambda a, d: F.struct(
        F.greatest(a["upto"], -d["minus_end"]).alias("upto"),
        F.when(-d["minus_end"] <= a["upto"], a["out"]).otherwise(F.array_append(
            a["out"], F.struct(d["label"].alias("label"), d["sure"].alias("sure")))).alias("out")), lambda a: a["out"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: doc_id, n_words, base (starts and labels), kept (labels and confidences)."""
    stems = sorted({k for _, k, *_ in rules()} | {f" {phrase} " for phrase in BASE}, key=lambda k: (len(k), k))
    stems = [k for k in stems if not any(o != k and o in k for o in stems)]
    docs = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                       normalised(F.col(text_col)).alias("norm"))
    gate = F.lit(False)
    for k in stems:
        gate = gate | F.contains("norm", F.lit(k))
    none = F.lit(None).cast("struct<label:string,keyword:string,pattern:string,sure:double,rank:int,base:boolean>")
    # a text that passes no gate, and every text besides its rules, is one row with a NULL rule
    own = F.when(gate, F.concat(F.array(none), F.filter(_rule_table(), lambda r: F.contains("norm", r["keyword"])))) \
        .otherwise(F.array(none))
    rows = docs.select("doc_id", "rid", "norm", F.explode(own).alias("rule"))
    is_doc = F.col("rule").isNull()
    rows = rows.select("rid", F.when(is_doc, F.col("doc_id")).alias("doc_id"),
                       F.when(is_doc, F.greatest(F.lit(0), _spaces(F.col("norm")) - 1)).alias("n_words"), "rule",
                       F.when(~is_doc, _places(F.col("norm"), F.col("rule.pattern"))).alias("places"))
    rows = rows.filter(F.col("n_words").isNotNull() | (F.size("places") > 0))
    found = F.transform("places", lambda p: F.struct(
        p["start"].alias("start"), (-p["end"]).alias("minus_end"), F.col("rule.rank").alias("rank"),
        F.col("rule.base").alias("base"), F.col("rule.label").alias("label"), F.col("rule.sure").alias("sure")))
    per_doc = rows.withColumn("found", found).groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
    return per_doc.select("doc_id", "n_words", F.filter("found", lambda d: d["base"]).alias("base"),
                          _kept(F.filter("found", lambda d: ~d["base"])).alias("kept"))


def report(docs: DataFrame, **columns) -> DataFrame:
    """Digest of ``scan``: counts, first and last base word, labels and score.

    ``score`` is the highest confidence among kept detections (0.9 for a base phrase), 0 without any.
    """
    base, kept = F.col("base"), F.col("kept")
    labels = F.array_distinct(F.concat(F.transform(base, lambda d: d["label"]), F.transform(kept, lambda d: d["label"])))
    sure = F.concat(F.transform(base, lambda d: d["sure"]), F.transform(kept, lambda d: d["sure"]), F.array(F.lit(0.0)))
    starts = F.transform(base, lambda d: d["start"])
    return scan(docs, **columns).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda d: d["label"]))), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"), F.array_max(sure).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """DuckDB SQL of ``report``. Its patterns cannot look around, so every space is doubled
    and a match takes the inner one on either side."""
    quote = lambda x: x.replace("'", "''")
    wide = lambda p: " (?:" + p.replace(" ?", "(?:~)?").replace(" ", "  ").replace("~", "  ") + ") "
    table = [(label, f" {phrase} ", phrase, 0.9, -1, True) for phrase, label in BASE.items()] + [(*r, False) for r in rules()]
    values = ",\n".join(f"('{label}', '{quote(key)}', '{quote(wide(p))}', CAST({sure} AS DOUBLE), {rank}, {base})"
                        for label, key, p, sure, rank, base in table)
    words = lambda x: f"len(regexp_extract_all({x}, '[^ ]+'))"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, trim(regexp_replace({sql_lower('text')}, '{NOT_ALNUM}', ' ', 'g')) AS w FROM documents),
n AS (SELECT rid, doc_id, {words('w')} AS n_words, CASE WHEN w = '' THEN '' ELSE ' ' || w || ' ' END AS norm FROM d),
rules(label, keyword, pattern, sure, rank, base) AS (VALUES {values}),
m AS (SELECT rid, label, sure, rank, base, regexp_extract_all(replace(norm, ' ', '  '), pattern) AS hits,
      string_split_regex(replace(norm, ' ', '  '), pattern) AS gaps FROM n JOIN rules ON contains(norm, keyword)),
p AS (SELECT rid, label, sure, rank, base, {words('hits[k]')} AS size,
      coalesce(list_sum(list_transform(gaps[1:k], lambda x: {words('x')})), 0) + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: {words('x')})), 0) AS start
      FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM m)),
kept AS (SELECT * FROM p WHERE NOT base QUALIFY start + size > coalesce(max(start + size) OVER (PARTITION BY rid
      ORDER BY start, -size, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)),
found AS (SELECT rid, label, sure, start, base FROM p WHERE base UNION ALL SELECT rid, label, sure, start, base FROM kept),
g AS (SELECT rid, count_if(base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
      string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(sure) AS score FROM found GROUP BY rid)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, CAST(0 AS DOUBLE)) AS score
FROM n LEFT JOIN g USING (rid)
"""


SQL = _sql()
