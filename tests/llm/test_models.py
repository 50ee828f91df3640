"""Language model, language ID, quality and URL filter against brute force and held-out accuracy."""

import itertools
import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import language, lm, quality, urls

SF01 = "/root/testdata/sf0.01"


class BruteKN:
    """Interpolated modified Kneser-Ney of order two, written out."""

    def __init__(self, texts):
        self.pairs, self.words = Counter(), Counter()
        for t in texts:
            tokens = [*lm.words_of(t), lm.END]
            self.words.update(tokens)
            self.pairs.update(zip([lm.BEGIN, *tokens], tokens))
        self.before, self.after = Counter(), defaultdict(Counter)
        for (a, b), n in self.pairs.items():
            self.before[b] += 1
            self.after[a][b] = n
        count = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        self.d2, self.d1 = lm.discounts(count(self.pairs)), lm.discounts(count(self.before))
        self.mass = sum(self.d1[min(n, 3)] for n in self.before.values()) / max(len(self.pairs), 1)
        self.sums = {a: (sum(c.values()), sum(self.d2[min(n, 3)] for n in c.values())) for a, c in self.after.items()}

    def word(self, w):
        n = self.before[w]
        return max(n - self.d1[min(n, 3)], 0) / len(self.pairs) + self.mass / (len(self.words) + 1)

    def pair(self, a, b):
        after = self.after.get(a)
        if not after:
            return self.word(b)
        total, left = self.sums[a]
        n = after[b]
        return (max(n - self.d2[min(n, 3)], 0) + left * self.word(b)) / total

    def score(self, text):
        tokens = [*lm.words_of(text), lm.END]
        return sum(math.log10(self.pair(a, b)) for a, b in zip([lm.BEGIN, *tokens], tokens))


def test_language_model_is_kneser_ney(docs):
    train, test = docs.where("doc_id % 3 != 1"), docs
    got = {r.doc_id: r for r in lm.score(test, lm.train(train)).collect()}
    brute = BruteKN([r.text for r in train.collect()])
    n, v = sum(brute.words.values()), len(brute.words)
    for r in test.collect():
        g, tokens = got[r.doc_id], [*lm.words_of(r.text), lm.END]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(tokens), sum(t in brute.words for t in tokens), n)
        assert math.isclose(g.base_score, sum(math.log10((brute.words[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens), rel_tol=1e-9)
        assert math.isclose(g.score, brute.score(r.text), rel_tol=1e-9)
    some = next(a for a in brute.after if a != lm.BEGIN)
    unknown = brute.pair(some, b"\x00 no word")
    assert math.isclose(sum(brute.pair(some, w) for w in brute.words) + unknown, 1, rel_tol=1e-9)


def test_language_model_in_many_small_files(docs, monkeypatch):
    """Blocks cut twice, several files a task, facts summed in two steps, few files open: the same scores."""
    plain = {r.doc_id: r for r in lm.score(docs, lm.train(docs)).collect()}
    for name, value in {"TOKENS_PER_FILE": 300, "WORDS_PER_FILE": 100, "WORDS_PER_RANGE": 200, "PIECE_BITS": 3, "FLUSH_TOKENS": 5000,
                        "FILES_PER_SALT": 64, "MIN_FILES": 4, "TASK_BITS": 4, "OPEN_BYTES": 20_000}.items():
        monkeypatch.setattr(lm, name, value)
    model = lm.train(docs)
    assert model.pair_files >= 128
    got = {r.doc_id: r for r in lm.score(docs, model).collect()}
    assert set(got) == set(plain) and all(
        (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (r.n_tokens, r.n_known, r.train_tokens)
        and math.isclose(got[i].score, r.score, rel_tol=1e-9) for i, r in plain.items())


def test_language_model_files_close_beyond_their_bound(tmp_path):
    for i in range(8):
        lm.write_file(str(tmp_path), lm.file_name("pairs", i), np.arange(100, dtype=np.uint64) + np.uint64(i), np.full(100, i, np.uint32))
    lm.write_file(str(tmp_path), lm.file_name("pairs", 3), np.arange(100, dtype=np.uint64) + np.uint64(3), np.full(100, 3, np.uint32))
    files = lm.Files(str(tmp_path), limit=3 * 1200)
    for i in [*range(8), *range(8)]:
        keys, counts = files.columns(lm.file_name("pairs", i), np.uint64, np.uint32)
        assert keys[0] == i and len(keys) == 100 and set(counts.tolist()) == {i}
        assert files.size <= 3 * 1200 and len(files.held) <= 3
    assert not files.exists(lm.file_name("pairs", 8))
    big = np.array([1, 1 << 40])
    assert lm.unpack_counts(lm.pack_counts(big), 2).tolist() == big.tolist()


def test_language_model_edges(spark, edge, empty):
    model = lm.train(edge)
    rows = lm.score(edge, model).collect()
    assert len(rows) == edge.count() and all(r.score < 0 and r.n_known == r.n_tokens for r in rows)
    brute = BruteKN([r.text for r in edge.collect()])
    assert all(math.isclose(r.score, brute.score(None), rel_tol=1e-9) for r in rows if r.doc_id in (0, 1, 2))
    assert lm.score(empty, model).count() == 0
    assert {(r.score, r.n_known) for r in lm.score(edge, lm.train(empty)).collect()} == {(0.0, 0)}


def test_held_out_texts_score_better_than_the_base(spark):
    rows = lm.query(spark, SF01).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def brute_viterbi(scores, penalty):
    best = max(itertools.product(range(scores.shape[1]), repeat=len(scores)), key=lambda path: sum(
        scores[i, k] for i, k in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:])))
    return sum(scores[i, k] for i, k in enumerate(best)) - penalty * sum(a != b for a, b in zip(best, best[1:]))


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    scores = (-rng.integers(0, 60, (40, 3)) / 10).astype(np.float32)
    sizes = np.array([7, 0, 1, 6, 3])
    rows = rng.integers(0, 40, sizes.sum())
    labels = language.viterbi(rows, sizes, scores, 2.0)
    for s, e in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes)):
        x, path = scores[rows[s:e]], labels[s:e]
        value = sum(x[i, k] for i, k in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
        assert e == s or math.isclose(value, brute_viterbi(x, 2.0), abs_tol=1e-4)


def test_language_counts_do_not_depend_on_blocks(docs, monkeypatch):
    rows = docs.select("text", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("lang"))
    whole = {tuple(r) for r in language.training_counts(rows).collect()}
    monkeypatch.setattr(language, "BLOCK", 50)
    monkeypatch.setattr(language, "CACHE_WORDS", 300)
    assert whole and {tuple(r) for r in language.training_counts(rows).collect()} == whole


def test_language_accuracy_spans_and_edges(spark, edge, empty):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = language.query(spark, SF01).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    model = language.fit(docs.where(~language.held_out()))
    one = {r.lang: r.text for r in docs.where(language.held_out() & F.length("text").between(600, 900)).collect()}
    mixed = spark.createDataFrame([(1, one["fr"] + "\n" + one["de"])], "doc_id long, text string")
    found = language.identify(mixed, model, ["doc_id"], spans=True).first().spans
    assert [s.lang for s in found] == ["fr", "de"] and abs(found[0].end - len(one["fr"])) <= 20
    rows = language.identify(edge, model, edge.columns[:2]).collect()
    assert len(rows) == edge.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (0, 1, 2, 8))
    assert language.identify(empty, model, ["doc_id"]).count() == 0
    assert {r.lang_pred for r in language.identify(edge, language.fit(empty), ["doc_id"]).collect()} == {"und"}
    assert language.keep_identified(edge, model).columns == edge.columns


def test_words_end_at_punctuation_and_scripts():
    assert language.words_of("L'été/the-end, x2y Привет東京タワーです") == ["l'été", "the", "end", "x", "y", "привет", "東京", "タワーで", "す"]
    assert language.words_of("a" * 100) == ["a" * 64, "a" * 36] and language.words_of("12 !? __") == [] == language.words_of(None)
    text = "".join(map(chr, range(0x20, 0x3000)))
    assert [c for w in language.words_of(text) for c in w if c.isalpha()] == [c for c in text.lower() if c.isalpha()]


def test_spans_part_texts_without_spaces(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = language.fit(docs.where(~language.held_out()))
    one = {r.lang: r.text for r in docs.where(language.held_out() & F.length("text").between(600, 900)).collect()}
    joined = ["/".join(one[lang].split()) for lang in ("en", "fr")]
    mixed = spark.createDataFrame([(1, "İ" + "/".join(joined)), (2, ",".join(joined))], "doc_id long, text string")
    for row in language.identify(mixed, model, ["doc_id", "text"], spans=True).collect():
        assert [s.lang for s in row.spans] == ["en", "fr"] and abs(row.spans[0].end - len(joined[0])) <= 20
        assert row.spans[1].end - len(row.text.rstrip(".!?,;")) in (0, -1) and 0.3 < row.score < 0.7


def test_languages_are_bounded(spark):
    rows = [(i, "hello how are you today", f"junk{i}") for i in range(30)] + [(100 + i, "guten tag wie geht es", "de") for i in range(3)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_langs=5)
    assert model.langs == ["de", "junk0", "junk1", "junk10", "junk11"]


def test_scripts_narrow_the_languages(spark):
    words = {"ru": "привет как дела сегодня хорошо", "en": "hello how are you today fine", "el": "καλημέρα τι κάνεις σήμερα"}
    train = spark.createDataFrame([(i, w * 3, lang) for i, (lang, w) in enumerate(words.items())], "doc_id long, text string, lang string")
    model = language.fit(train)
    texts = spark.createDataFrame([(1, "новые слова совсем"), (2, "unseen english letters"), (3, "άγνωστα γράμματα")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.identify(texts, model, ["doc_id"]).collect()}
    assert got == {1: "ru", 2: "en", 3: "el"}


def test_crf_marginals_are_brute_force():
    rng = np.random.default_rng(5)
    sizes = np.array([3, 1, 5, 2])
    score, stay = rng.normal(size=sizes.sum()), np.array([0.7, -0.3])
    got, pairs = quality.marginals(score, quality.Lockstep(sizes), stay)
    want_pairs = np.zeros(2)
    for s, e in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes)):
        total, good = 0.0, np.zeros(e - s)
        seq = np.zeros(2)
        for path in itertools.product((0, 1), repeat=e - s):
            same = [sum(a == b == k for a, b in zip(path, path[1:])) for k in (0, 1)]
            w = math.exp(sum(score[s + i] for i, y in enumerate(path) if y) + np.dot(same, stay))
            total += w
            good += w * np.array(path)
            seq += w * np.array(same)
        assert np.allclose(got[s:e], good / total)
        want_pairs += seq / total
    assert np.allclose(pairs, want_pairs)


def test_quality_accuracy_and_edges(spark, edge, empty):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.query(spark, SF01).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert sum(g > b for g in good for b in bad) >= 0.97 * len(good) * len(bad)
    assert sum(r.predicted == r.quality for r in rows) >= 0.93 * len(rows)
    model = quality.fit(docs, labels)
    rows = quality.score(edge, model, edge.columns[:2]).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.text or ""].add(r.score)
    assert all(len(s) == 1 for s in by_id.values())
    assert quality.score(empty, model, ["doc_id"]).count() == 0
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(edge, none, ["doc_id"]).collect()} == {0.5}
    sure = quality.fit(docs, labels.where("quality = 1"))
    assert {r.score for r in quality.score(edge, sure, ["doc_id"]).collect()} == {1.0}
    lines = quality.score(edge.where("doc_id = 9"), model, ["doc_id"], lines=True).first().line_scores
    assert len(lines) == 3
    assert quality.keep_good(edge, sure).columns == edge.columns


def test_quality_learns_from_long_documents(spark):
    good = "\n".join(["The river runs past the old mill and on to the sea."] * 3)
    bad = "\n".join(f"{i} | {i * 7} | #{i}" for i in range(quality.MAX_LINES + 50))
    docs = spark.createDataFrame([(i, bad if i % 2 else good) for i in range(40)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 = 0 as int) quality")
    model = quality.fit(docs, labels)
    scores = quality.document_scores([good, bad], model)[0]
    assert model.constant is None and scores[0] > 0.7 and scores[1] < 0.3


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = rest[:min((rest.index(c) for c in "?#" if c in rest), default=len(rest))]
    best = None
    for rule, verdict in urls.RULES:
        site, start = rule.split("/", 1)
        if (host == site or host.endswith("." + site)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


def test_url_rules_and_method(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "url")
    odd = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "http://a.net/es/1", "http://anet/es/1", "http://x.com", "http://x.com?q=/",
           "http://u@x.com:80/y#z", "ftp://b.example.com/en/?a=1&b=2", "http://É.COM/", "x" * 9000 + "://y.com/", "http://y.com/" + "z/" * 5000]
    pages = pages.unionByName(spark.createDataFrame([(1000 + i, u) for i, u in enumerate(odd)] + [(1000, None)], "page_id long, url string"))
    pages = pages.withColumn("label", F.lit("x")).withColumn("features", F.lit(1))
    rows, out = pages.collect(), urls.judge(pages).collect()
    want = Counter((r.page_id, *brute_rule(r.url)[:3]) for r in rows)
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in out) == want
    verdicts = {r: v for r, v in urls.RULES}
    assert all(r.verdict == verdicts[r.rule] if r.rule else r.verdict in ("allow", "block") for r in out)
    # the trees agree with most of the rules they learned from
    ruled = [r for r in out if r.rule]
    assert sum((r.block_score >= 0.5) == (r.verdict == "block") for r in ruled) >= 0.9 * len(ruled)
    assert urls.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge(pages.where("url LIKE 'http://%.example.org/%'")).collect()} == {"allow"}
    assert {r.verdict for r in urls.judge(pages.where("url LIKE '%.net/es/%' OR url LIKE '%.org/%'")).collect()} == {"block"}


def test_url_trees_agree_on_held_out_urls(spark):
    pages = spark.read.parquet(f"{SF01.replace('0.01', '0.1')}/pages.parquet").select("page_id", "url")
    out = urls.judge(pages, learn=F.crc32(F.col("url").cast("binary")) % 5 != 0)
    rows = out.join(pages, "page_id").where("rule IS NOT NULL").where(F.crc32(F.col("url").cast("binary")) % 5 == 0).collect()
    assert len(rows) > 200
    assert sum((r.block_score >= 0.5) == (r.verdict == "block") for r in rows) >= 0.9 * len(rows)


def test_url_trees_with_one_blocked_url_and_a_hot_site(spark):
    many = spark.range(20_000).select(F.col("id").alias("page_id"), F.when(F.col("id") == 77, "http://a.net/es/1?x=1&y=2").when(
        F.col("id") % 3 == 0, "http://hot.com/same").otherwise(F.concat(F.lit("https://s"), F.col("id") % 900, F.lit(".com/p"), "id")).alias("url"))
    many = many.unionByName(spark.createDataFrame([(-1, "http://b.net/de/2?x=3&y=4"), (-2, "https://t.org/page")], "page_id long, url string"))
    out = urls.judge(many, max_train=400)
    assert out.count() == 20_002
    scores = out.where("page_id < 0 OR page_id IN (0, 1, 77)").select("page_id", "block_score").collect()
    assert len({round(r.block_score, 9) for r in scores}) > 1  # trees, not the share of blocked rows
    score = {r.page_id: r.block_score for r in scores}
    assert score[77] > score[0] and score[77] > score[1]


def test_url_statistics_leave_out_the_row_s_own_fold(spark):
    rows = [(i, f"http://x.com/{i % 7}", float(i % 2)) for i in range(40)] + [(99, "http://x.com/z", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, label double").withColumn("site", F.lit("x.com")).withColumn(
        "suffix", F.lit("com")).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(urls.FOLDS)).cast("int")).withColumn("section", F.lit(5).cast("long"))
    for rows_of_table in (41, 10 ** 9):  # the site is hot, or it is not
        got = urls.with_statistics(pages, urls.site_statistics(pages), urls.section_statistics(pages), rows_of_table, 0.5).collect()
        assert len(got) == 41
        for r in got:
            others = [x for x in got if x.label is not None and (r.label is None or x.fold != r.fold)]
            rate = (sum(x.label for x in others) + urls.SMOOTHING * 0.5) / (len(others) + urls.SMOOTHING)
            assert all(math.isclose(x, rate) for x in (r.site_rate, r.suffix_rate, r.section_rate)) and math.isclose(r.site_count, math.log1p(len(others)))
