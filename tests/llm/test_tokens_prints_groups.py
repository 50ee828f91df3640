"""Token counts, fingerprints, near-duplicate groups and the pipeline against brute force."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import components, dedup, fingerprints, tokens
from tidemark.llm.shingles import WIDTH

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


def test_token_counts_are_the_librarys(spark, docs, edge, empty, library):
    for df in (docs, edge):
        got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(df, PATH).collect()))
        want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), library(r.text), library(r.text) > 512) for r in df.collect())
        assert got == want
    assert tokens.count_tokens(empty, PATH).count() == 0


def test_token_counts_of_odd_white_space_and_special_strings(library):
    counter, rnd = tokens.Counter(PATH, tokens.whole_tokens(PATH), tokens.odd_characters(PATH)), random.Random(4)
    parts = ["a", "The", " ", "  ", "\n", "\t", "'s", "'", "12", "é", "日本", "<|endoftext|>", " ", "!", "don't", "\x1c", "\x85", " ", "😀", "\r\n", "<|"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert counter.count(text) == library(text), repr(text)


def test_token_counts_of_spaces_after_other_white_space(library):
    counter, rnd = tokens.Counter(PATH, tokens.whole_tokens(PATH), tokens.odd_characters(PATH)), random.Random(5)
    texts = ["x \u00a0 \u00a0 y", "x" + " \u00a0" * 4 + " y", "x\n ", "x \n  y", " \u00a0 ", "x \u3000 \u3000 y"]
    parts = ["a", "The", " ", " ", " \u00a0 \u00a0", "\u00a0", "\u00a0", "\n", "\t", "\u2003", "\u3000", "\x1c", "12", "'s", "<|endoftext|>"]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(4000)]
    for text in texts:
        assert counter.count(text) == library(text), repr(text)


def test_token_counts_of_every_code_point(library):
    """Every code point in three contexts, a few to a text."""
    from tokenizers import Tokenizer
    encoder = Tokenizer.from_file(PATH)
    counter = tokens.Counter(PATH, tokens.whole_tokens(PATH), tokens.odd_characters(PATH))
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    odd = set(tokens.odd_characters(PATH))
    assert all(counter.count(f"{c}'s") == library(f"{c}'s") for c in odd)
    plain = [c for c in chars if c not in odd]
    texts = [form.format("".join(plain[i:i + 8])) for i in range(0, len(plain), 8) for form in (("{0}'s a", "x{0}1", "1{0} {0}!") if i % 256 == 0 else ("x{0}1",))]
    for i in range(0, len(texts), 20_000):
        part = texts[i:i + 20_000]
        for text, code in zip(part, encoder.encode_batch_fast(part, add_special_tokens=False)):
            assert counter.count(text) == len(code.ids), repr(text)


def shingle_set(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split("[\x20\x09-\x0D]+", w) if x]
    return {tuple(w[i:i + WIDTH]) for i in range(max(1, len(w) - WIDTH + 1))} if w else set()


def test_fingerprints_with_next(spark, docs, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_PART", 7)       # many ranges, so borders matter
    rows = sorted(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect(), key=lambda r: -r.doc_id)
    got = {r.doc_id: r for r in fingerprints.with_next(docs).collect()}
    assert len(got) == len(rows)
    prints, errors = {}, []
    for r, following in zip(rows, [*rows[1:], rows[0]]):
        half = len(r.text) // 2
        edited = r.text[:len(r.text) - half] + following.text[:half]
        g = got[r.doc_id]
        assert g.n_chars == len(r.text) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(r.text, g.fingerprint) == g.fingerprint
        for value, other in ((g.near_edited, edited), (g.near_next, following.text)):
            a, b = shingle_set(r.text), shingle_set(other)
            errors.append(abs(value - (len(a & b) / len(a | b) if a | b else 1)))
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.02
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs).collect()}
    assert plain == {k: g.fingerprint for k, g in got.items()}


def test_fingerprints_of_hot_ids_are_spread(spark, monkeypatch):
    """A third of the ids is NULL, a sixth the same: their rows are many tasks', and the order holds across them."""
    monkeypatch.setattr(fingerprints, "ROWS_PER_PART", 100)
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 6 = 1 THEN 700 ELSE id END AS doc_id",
        "concat_ws(' ', 'text', id * 7919 % 3001, 'of', id % 50, 'words', id, 'and more') AS text")
    got = fingerprints.with_next(df).withColumn("task", F.spark_partition_id())
    rows = got.collect()
    assert len(rows) == 3000
    per_task = {}
    for r in rows:
        per_task[r.task] = per_task.get(r.task, 0) + 1
    assert max(per_task.values()) <= 350
    source = df.select("doc_id", "text", F.xxhash64("text").alias("hash")).collect()
    count = {}
    for r in source:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    order = sorted(source, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), -r.hash if count[r.doc_id] > 1 else 0, r.text))
    want = []
    for r, following in zip(order, [*order[1:], order[0]]):
        half = len(r.text) // 2
        want.append((r.doc_id is None, r.doc_id or 0, hashlib.sha256((r.text[:len(r.text) - half] + following.text[:half]).encode()).hexdigest()))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.edited_sha256) for r in rows) == sorted(want)


def test_fingerprint_edges(spark, edge, empty):
    rows = fingerprints.with_next(edge).collect()
    assert len(rows) == edge.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {""}
    same = [r for r in rows if r.doc_id == 5]
    assert len(same) == 3 and len({r.fingerprint for r in same}) == 1 and sum(r.near_next == 1.0 for r in same) >= 2
    assert fingerprints.with_next(empty).count() == 0
    one = fingerprints.with_next(edge.where("doc_id = 4")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"two wtwo ").hexdigest()


def brute_groups(rows):
    """doc_id -> (set size, smallest id reachable) by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_duplicate_groups_are_brute_force(spark, docs):
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    next_id = 10_000
    for size in (2, 5, 60):                      # groups of near copies, the last larger than any neighbourhood
        base = rnd.choices(vocabulary, k=400)
        for _ in range(size):
            words = list(base)
            for _ in range(rnd.randint(0, 12)):
                words[rnd.randrange(400)] = rnd.choice(vocabulary)
            rows.append((next_id, " ".join(words)))
            next_id += 1
    words = rnd.choices(vocabulary, k=300)       # a chain: each a link of the next only
    for _ in range(6):
        rows.append((next_id, " ".join(words)))
        next_id += 1
        words = words[30:] + rnd.choices(vocabulary, k=30)
    rows += [(next_id, rows[5][1].upper()), (next_id + 1, None), (next_id + 2, " \t"), (next_id + 3, "one two"), (next_id + 4, "ONE  two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in dedup.groups(df).collect()}
    want = {i: (n, c, c == i) for i, (n, c) in brute_groups(rows).items()}
    assert got == want


def test_near_duplicate_borders(spark, docs, monkeypatch):
    monkeypatch.setattr(dedup, "ROWS_PER_PART", 60)             # many partitions per order
    got = {r.doc_id: r.component_id for r in dedup.groups(docs).collect()}
    want = {i: c for i, (_, c) in brute_groups([(r.doc_id, r.text) for r in docs.collect()]).items()}
    assert got == want


def test_near_duplicate_edges(spark, edge, empty):
    rows = dedup.groups(edge).collect()
    assert len(rows) == edge.count()
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id in (5, 6)} == {(5, 5), (6, 5)}
    assert {r.component_id for r in rows if r.doc_id is None and r.n_shingles} == {3}
    one = dedup.keep_one(edge)
    assert one.columns == edge.columns
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in one.collect())
    assert kept == sorted([(False, i) for i in range(11) if i != 6] + [(True, 0)])
    assert dedup.groups(empty).count() == 0


def test_one_row_is_kept_of_groups_with_missing_or_shared_ids(spark):
    rnd = random.Random(8)
    base = [[f"{name}{rnd.randrange(3000)}" for _ in range(200)] for name in "abc"]
    near = lambda k, i: " ".join([*base[k][:-1], f"end{i}"])
    rows = [(None, near(0, i)) for i in range(3)] + [(7, near(1, i)) for i in range(3)]
    rows += [(None, near(2, 0)), (9, near(2, 1)), (8, near(2, 2)), (8, near(2, 3)), (None, None), (None, ""), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = dedup.keep_one(df).collect()
    assert sorted(str(r.doc_id) for r in got if r.text) == ["7", "8", "None"]
    assert sum(not r.text for r in got) == 3
    assert {r.text[0] for r in got if r.text} == set("abc")


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (201, 200)]
    df = spark.createDataFrame([(f"{a:04d}", f"{b:04d}") for a, b in links], "a string, b string")
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    assert {got[f"{i:04d}"] for i in range(41)} == {"0000"} and {got[f"{i:04d}"] for i in range(100, 160)} == {"0100"}
    assert got["0201"] == "0200"
    assert components.connected_components(df.limit(0)).count() == 0


def test_pipeline_stages(spark, edge, tmp_path):
    import corpus_pipeline as cp
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = docs
    for name, stage in cp.STAGES[:-1]:
        after = cp.staged(stage(spark, left, sf), "test")
        assert after.columns == docs.columns and after.exceptAll(left).count() == 0, name
        assert 0.6 * left.count() < after.count() <= left.count(), name
        left = after
    ids = {r.doc_id for r in left.select("doc_id").collect()}
    final = cp.run(spark, sf).collect()
    assert {r.doc_id for r in final} == ids and len(final) == len(ids)
    for name, stage in cp.STAGES:               # awkward rows and none at all pass every stage
        assert stage(spark, edge, sf).count() <= edge.count()
        assert stage(spark, edge.limit(0), sf).count() == 0


def test_stages_keep_columns_of_any_name(spark, benchmark):
    """Columns named like the helpers' own come out with their values and types."""
    from tidemark.llm import decontam, language, quality
    names = ("_id", "_hash", "_key", "_text", "own_id", "text_hash", "row_hash", "kept", "mark")
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, text, *[n + "!" for n in names]), (2, text, *[n + "?" for n in names])],
                                 "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    first = docs.where("doc_id = 1").collect()
    assert dedup.keep_one(docs).schema == docs.schema and dedup.keep_one(docs).collect() == first
    kept = decontam.drop_documents(docs, benchmark)
    assert kept.schema == docs.schema and sorted(kept.collect()) == sorted(docs.collect())
    hit = spark.createDataFrame([(1, "two three four")], "item_id long, text string")
    assert decontam.drop_documents(docs, hit).count() == 0
    lang = language.fit(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"))
    assert {r["_text"] for r in language.identify(docs, lang, ["doc_id", "_text"]).collect()} == {"_text!", "_text?"}
    model = quality.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    assert {r["_text"] for r in quality.score(docs, model, ["doc_id", "_text"]).collect()} == {"_text!", "_text?"}


def test_workers_hold_a_run_of_texts(spark):
    """A batch's texts become Python strings about a MB at a time, 4 MB in the stages that judge texts."""
    import pyarrow as pa

    from tidemark.llm.common import rows_kept
    from tidemark.llm.shingles import text_runs
    texts = [f"w{i} " * 20_000 for i in range(100, 300)] + [None, "", "x" * (3 << 20), None, "one two"]
    column = pa.array(texts, pa.string())
    runs = list(text_runs(column, 1 << 20))
    assert [t for _, _, r in runs for t in r] == texts and [s for s, _, _ in runs] == [0, *(e for _, e, _ in runs[:-1])]
    assert all(sum(len(t or "") for t in r[:-1]) < 1 << 20 for _, _, r in runs)
    assert not list(text_runs(column[:0])) and [r[2] for r in text_runs(column[200:202])] == [[None, ""]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([0] * len(texts)), column], ["doc_id", "text_hash", "text"])
    signed = list(dedup._signed(iter([batch])))
    assert max(b.num_rows for b in signed) <= 14 and [i for b in signed for i in b.column("doc_id").to_pylist()] == list(range(len(texts)))
    one = [r for i in range(len(texts)) for b in dedup._signed(iter([batch.slice(i, 1)])) for r in b.to_pylist()]
    assert [r for b in signed for r in b.to_pylist()] == one
    sets = [r for b in dedup._sets(iter([batch])) for r in b.to_pylist()]
    assert [r["key"] for r in sets] == [r["key"] for r in one]

    docs = spark.range(0, 200, 1, 1).withColumn("text", F.repeat(F.lit("w "), 50_000))
    most = lambda: lambda texts: [sum(map(len, texts)) < 5 << 20] * len(texts)
    assert rows_kept(docs, "text", most).count() == 200


def test_near_duplicates_write_what_is_read_again(spark, docs, monkeypatch):
    """Tables that one job reads are not written: each file costs the executors processes that set its mode."""
    labels = []
    monkeypatch.setattr(dedup, "staged", lambda df, label: labels.append(label) or components.staged(df, label))
    assert dedup.groups(docs).count() == docs.count()
    assert sorted(labels) == ["candidates", "classes", "groups", "groups", "neighbours", "pairs", "rare", "roots", "sets", "signed"]
