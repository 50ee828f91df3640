"""Tokenizer alignment against token pairs compared one by one."""

from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment

PATHS = [str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD = [None, "", " ", "a", "  two  spaces ", "tab\tand\nline\r\n", "naïve café", "日本語のテキスト", "😀 👩‍👩‍👧 é", "x▁y", "<s> </s><|endoftext|> <0x41><unk>", "\x00\x01",
       "a" * 300, "ﬁ ½ ①", "word. Next, (one) — two…", "  nbsp  here", " ", "don't we'll I'm", "1234567890 3.14", "<0x0A>▁", "long words " * 900]


@pytest.fixture(scope="module")
def lexicon():
    return alignment.Lexicon(*PATHS)


def pieces(text):
    """Ids and bytes of both tokenizers by the libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATHS[0])
    t.encode_special_tokens = True
    a = t.encode(" " + text, add_special_tokens=False)
    letters = alignment.byte_letters()
    m = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    b = m.encode(text)
    bytes_b = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in b]
    return a.ids, [bytes(letters[c] for c in w) for w in a.tokens], b, bytes_b


def spans(words):
    ends = np.cumsum([len(w) for w in words]).tolist()
    return [(e - len(w), e) for w, e in zip(words, ends)]


def brute(text):
    """n_a, n_b, n_groups, n_links, n_overlaps, n_shared, digest, linked id pairs."""
    if not text:
        return (0,) * 6 + ("", [])
    a, wa, b, wb = pieces(text)
    if b"".join(wa) != (" " + text).encode() or b"".join(wb) != (" " + text).encode():
        return (0,) * 6 + ("", [])
    sa, sb = spans(wa), spans(wb)
    at_b = {e: j for j, (_, e) in enumerate(sb)}
    links = [(i, at_b[e]) for i, (_, e) in enumerate(sa) if e in at_b]
    overlaps = sum(1 for x in sa for y in sb if x[0] < y[1] and y[0] < x[1]) if len(sa) < 400 else None
    written, shared, i, j = [], 0, 0, 0
    for x, y in links:
        written.append(",".join(map(str, a[i:x + 1])) + "|" + ",".join(map(str, b[j:y + 1])))
        shared += (x + 1 - i) * (y + 1 - j)
        i, j = x + 1, y + 1
    return len(a), len(b), len(written), len(links), overlaps, shared, sha256(";".join(written).encode()).hexdigest(), [(a[x], b[y]) for x, y in links]


def test_alignment_is_brute_force(spark, docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, ODD[5])] + [(r.doc_id + 100, r.text) for r in docs.where("doc_id < 60").collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({"links": F.lit("x"), "n_a": F.lit(-1)})
    aligned = alignment.Aligned(frame, *PATHS)
    want = [(i, *brute(t)) for i, t in rows]
    n = Counter(p for w in want for p in w[8])
    top = {b: max(n[p] for p in n if p[1] == b) for b in {p[1] for p in n}}
    expected = Counter((*w[:5], None if w[5] is None else w[5], *w[6:8], sum(n[p] == top[p[1]] for p in w[8]), sum(n[p] for p in w[8])) for w in want)
    names = ["doc_id", *alignment.COLUMNS[:-1], "n_best", "count_sum"]
    loose = {r[0] for r in expected if r[5] is None}
    got = Counter(tuple(None if c == "n_overlaps" and r["doc_id"] in loose else r[c] for c in names) for r in aligned.report().collect())
    assert got == expected
    table = {(r.a_id, r.b_id): (r.n, r.best_of_b) for r in aligned.pair_table().collect()}
    assert table == {p: (k, k == top[p[1]]) for p, k in n.items()}


def test_alignment_edges(edge, empty):
    assert alignment.Aligned(empty, *PATHS).report().count() == 0
    got = alignment.Aligned(edge, *PATHS).report().collect()
    assert len(got) == edge.count()
    assert all((r.n_a, r.n_links, r.groups_sha256, r.count_sum) == (0, 0, "", 0) for r in got if r.doc_id in (0, 1))


@pytest.mark.parametrize("terms", [1, 7, 1 << 20])
def test_products_are_those_of_dense_matrices(terms):
    rnd = np.random.default_rng(3)
    for _ in range(30):
        x, y = (rnd.random((rnd.integers(1, 9), k)) < 0.4 for k in (6, 6))
        a, bt = sparse(x), sparse(y).transposed()
        dense = x.astype(int) @ y.T.astype(int)
        got = np.zeros_like(dense)
        for rows, cols, values in a.times(bt, terms):
            assert (np.diff(rows * 100 + cols) > 0).all()
            got[rows, cols] = values
        assert (got == dense).all() and (a.terms(bt) == dense.sum(axis=1)).all()


def sparse(x):
    return alignment.Csr(np.concatenate([[0], np.cumsum(x.sum(axis=1))]), np.nonzero(x)[1], x.shape[1])


def test_shared_links_are_all_pairs_of_a_group():
    found = alignment.align(np.array([2, 1, 4, 3]), np.array([3, 2, 1, 4]))
    assert list(zip(found.link_a.tolist(), found.link_b.tolist())) == [(1, 0), (3, 3)]
    pairs = {(int(i), int(j)) for rows, cols in found.shared_links(terms=2) for i, j in zip(rows, cols)}
    assert pairs == {(0, 0), (1, 0), (2, 1), (2, 2), (2, 3), (3, 1), (3, 2), (3, 3)}
    assert found.shared_counts().tolist() == [1, 1, 3, 3] and found.overlaps_of.tolist() == [1, 1, 3, 1]


def test_lexicon_holds_every_pair_that_can_end_together(lexicon):
    rnd = np.random.default_rng(1)
    keys = set(lexicon.keys.tolist())
    for i, j in zip(rnd.integers(0, 50257, 4000).tolist(), rnd.integers(0, 32000, 4000).tolist()):
        a, b = lexicon.a[i], lexicon.b[j]
        assert (((i << 32) | j) in keys) == bool(a and b and (a.endswith(b) or b.endswith(a)))
    assert lexicon.cuts and len(keys) < alignment.MAX_PAIRS


SCRIPTS = ["naïve café déjà vu.", "слово за словом, ещё", "ελληνικά κείμενα", "हिन्दी पाठ में", "ไทย ภาษา", "한국어 문장 입니다", "x² y½ ½ z ª º", "٣ ٤ words", "a_ _b __ c",
           "é x e ́x", "İ ı ß ﬀ ﬁ z", "the naïve the café the"]


def expect(lexicon, columns, texts):
    for row, want in zip(zip(*(c.to_pylist() for c in columns), strict=True), map(brute, texts), strict=True):
        assert row[:4] == want[:4] and row[5:7] == want[5:7] and want[4] in (None, row[4])
        assert [(k >> 32, k & 0xFFFFFFFF) for k in lexicon.keys[row[7]].tolist()] == want[7]


@pytest.mark.parametrize("units, size", [(0, 0), (5, 1 << 20), (40, 60), (1 << 20, 1 << 20)])
def test_what_a_worker_forgets_changes_no_result(lexicon, monkeypatch, units, size):
    monkeypatch.setattr(alignment, "CACHE_UNITS", units)
    monkeypatch.setattr(alignment, "CACHE_BYTES", size, raising=False)
    encoder = alignment.Encoder(*PATHS, lexicon)
    texts = (ODD + SCRIPTS) * 2
    for i in range(0, len(texts), 3):
        expect(lexicon, encoder.columns(texts[i:i + 3]), texts[i:i + 3])


def test_units_met_most_stay_known(lexicon, monkeypatch):
    """Before, a full worker forgot all its units and encoded the common ones anew."""
    monkeypatch.setattr(alignment, "CACHE_UNITS", 60)
    encoder = alignment.Encoder(*PATHS, lexicon)
    learned, learn = Counter(), encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda units: (learned.update(units), learn(units)))
    common = [f"word{i}" for i in range(20)]
    for n in range(30):
        texts = [" ".join(common + [f"new{n}x{k}" for k in range(15)] + common)]
        expect(lexicon, encoder.columns(texts), texts)
    assert {learned[w] for w in common} == {1} and len(encoder.known) <= 60 + 35


def test_repeated_units_are_aligned_once(lexicon, monkeypatch):
    """Before, the tokens of every occurrence went through the products."""
    tokens, align = [], alignment.align
    monkeypatch.setattr(alignment, "align", lambda a, b: (tokens.append(len(a)), align(a, b))[1])
    texts = ["over and over again, é et é " * 200] * 3
    columns = alignment.Encoder(*PATHS, lexicon).columns(texts)
    assert sum(tokens) < 40
    expect(lexicon, columns, texts)


def test_a_text_spelt_out_although_its_units_are_not_is_one_unit(lexicon):
    encoder = alignment.Encoder(*PATHS, lexicon)
    encoder.columns(["ab cd"])
    encoder.unlike |= {"ab": b" ab c", "cd": b"d"}      # as if B put the space elsewhere
    texts = ["ab cd", "ab ab", "cd"]
    columns = [c.to_pylist() for c in encoder.columns(texts)]
    assert columns[0][1:] == [0, 0] and columns[6][1:] == ["", ""]
    assert (columns[0][0], columns[6][0]) == (brute("ab cd")[0], brute("ab cd")[6])


def test_texts_are_cut_where_tokens_end_after_every_character(lexicon):
    import sentencepiece
    from tokenizers import Tokenizer

    pre = Tokenizer.from_file(PATHS[0]).pre_tokenizer
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    shown = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and len(alignment.CUT.split(f"x{chr(c)} y")) == 2]
    assert len(shown) > 100_000
    for i in range(0, len(shown), 500):
        units = [f"x{c}" for c in shown[i:i + 500]]
        text = " ".join(units)
        starts = {span[0] for _, span in pre.pre_tokenize_str(text)}
        assert all(i in starts for i, c in enumerate(text) if c == " ")
        assert model.encode(text) == [k for ids in model.encode(units) for k in ids]
