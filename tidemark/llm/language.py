"""Language identification: script ranges, per-word scores, Viterbi over the words of a text.

A word is a run of letters of one script (with the marks and apostrophes inside it), so
punctuation, digits and a change of script end it; scripts written without spaces are cut
into pieces of ``PIECE`` letters, very long runs into pieces of ``LONGEST``.

Fitted on at most about ``MAX_TRAIN`` documents chosen by a hash of id and text, in at most
``MAX_LANGS`` languages (those of most documents there; ties by name): counts of hashed
character n-grams per language (``DIM`` x languages numbers) and of the scripts that each
language is written in. A word's script narrows the languages; its score in each is the
clipped log posterior of its n-grams. Viterbi with a switching penalty labels every word,
so a text of several languages falls into spans; the prediction is the language that holds
most letters and ``score`` its share of them.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0; without any
training text everything is ``und``; ties between languages go to the first by name; what
is no letter belongs to no span; equal rows get equal rows. Only the id,
text and (for learning) language columns are read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, fresh_name, rows_kept, table
from tidemark.llm.shingles import chunked, mix64

NAME = "op7_language_id"
MAX_TRAIN, MAX_LANGS = 20_000, 200
DIM, GRAMS = 1 << 15, 5
CLIP, PENALTY, SMOOTHING = 6.0, 8.0, 0.5
RARE_SCRIPT = 0.002  # a script that holds less of a language's letters than this is not one of its own
CACHE_WORDS = 200_000
CHUNK, BLOCK = 4 << 20, 40_000  # characters and new words that are worked on at once
# Unicode ranges of scripts: (first, last, name). Letters outside all of them are "other".
SCRIPTS = ((0x41, 0x24F, "latin"), (0x370, 0x3FF, "greek"), (0x400, 0x52F, "cyrillic"), (0x530, 0x58F, "armenian"),
           (0x590, 0x5FF, "hebrew"), (0x600, 0x6FF, "arabic"), (0x900, 0x97F, "devanagari"), (0x980, 0x9FF, "bengali"),
           (0xB80, 0xBFF, "tamil"), (0xE00, 0xE7F, "thai"), (0x10A0, 0x10FF, "georgian"), (0x3040, 0x30FF, "kana"),
           (0x4E00, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"), (0x1E00, 0x1EFF, "latin"))
NAMES = sorted({s[2] for s in SCRIPTS} | {"other"})
UNSPACED = ("han", "kana", "thai")
PIECE, LONGEST = 4, 64


def script_of(letter: str) -> int:
    code = ord(letter)
    for first, last, name in SCRIPTS:
        if first <= code <= last:
            return NAMES.index(name)
    return NAMES.index("other")


def _class(codes: Iterator[int]) -> str:
    """Code points as the inside of a pattern's class."""
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


@cache
def _word_pattern() -> re.Pattern:
    inside = _class(c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Mn", "Mc")) + "'\u2019"
    kinds, known = [], ""
    for name in dict.fromkeys(s[2] for s in SCRIPTS):
        letters = _class(c for first, last, of in SCRIPTS if of == name for c in range(first, last + 1) if chr(c).isalpha())
        kinds.append(f"[{letters}][{letters}{inside}]{{0,{(PIECE if name in UNSPACED else LONGEST) - 1}}}")
        known += letters
    other = f"(?![{known}])[^\\W\\d_]"
    return re.compile("|".join([*kinds, f"{other}(?:{other}|[{inside}]){{0,{LONGEST - 1}}}"]))


def words_of(text: str | None) -> list[str]:
    return _word_pattern().findall(text.lower()) if text else []


def chunks_of(text: str | None) -> list[str]:
    """What white space parts, long ones cut into their words; no word goes over its end."""
    chunks = text.lower().split() if text else []
    if chunks and max(map(len, chunks)) > LONGEST:
        chunks = [w for c in chunks for w in ([c] if len(c) <= LONGEST else words_of(c))]
    return chunks


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1- to 5-grams of every word's bytes, marked at both ends, and each word's number of them."""
    marked = [b"<" + w.encode() + b">" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    text = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(text))
    found, owners = [], []
    owner = np.repeat(np.arange(len(words)), sizes)
    h = np.zeros(len(text), np.uint64)
    for n in range(1, GRAMS + 1):
        h = h[:len(text) - n + 1] * np.uint64(0x100000001B3) + text[n - 1:] + np.uint64(n)
        whole = at[:len(h)] + n <= ends[:len(h)]
        found.append((mix64(h[whole]) & np.uint64(DIM - 1)).astype(np.int32))
        owners.append(owner[:len(h)][whole])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.bincount(owner, minlength=len(words))


def letters_of(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def training_counts(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over ``docs`` (lang, text); bucket -1 - s counts letters of script s."""
    def counted(lang: str, chunks: Counter) -> pa.RecordBatch:
        n, total, spelled, times = Counter(), np.zeros(DIM, np.int64), [], []

        def add() -> None:
            buckets, sizes = gram_buckets(spelled)
            np.add(total, np.bincount(buckets, weights=np.repeat(times, sizes), minlength=DIM).astype(np.int64), out=total)
            spelled.clear()
            times.clear()

        for chunk, k in chunks.items():
            for word in filter(None, map(letters_of, words_of(chunk))):
                n[-1 - script_of(word[0])] += k * len(word)
                spelled.append(word)
                times.append(k)
            if len(spelled) >= BLOCK:
                add()
        if spelled:
            add()
        n.update({int(i): int(total[i]) for i in np.flatnonzero(total)})
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(list(n), pa.int32()),
                                           pa.array(list(n.values()), pa.int64())], ["lang", "bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(lang, Counter()).update(chunks_of(text))
                if len(held[lang]) > CACHE_WORDS:
                    yield counted(lang, held.pop(lang))
        for lang in list(held):
            yield counted(lang, held.pop(lang))

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, bucket int, n bigint")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log probabilities of buckets and scripts allowed, per language."""

    def __init__(self, langs: list[str], weights: np.ndarray, allowed: np.ndarray):
        self.langs, self.weights, self.allowed = langs, weights, allowed

    @classmethod
    def of(cls, rows: list) -> Model:
        """From (lang, bucket, n) rows: DIM x languages of them at most."""
        langs = sorted({r["lang"] for r in rows})
        at = {lang: i for i, lang in enumerate(langs)}
        counts, letters = np.zeros((DIM, len(langs))), np.zeros((len(NAMES), len(langs)))
        for r in rows:
            (counts[r["bucket"]] if r["bucket"] >= 0 else letters[-1 - r["bucket"]])[at[r["lang"]]] = r["n"]
        weights = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0) + SMOOTHING * DIM)
        allowed = letters >= RARE_SCRIPT * letters.sum(axis=0)
        allowed[~allowed.any(axis=1)] = True  # a script never met narrows nothing
        return cls(langs, weights.astype(np.float32), allowed)

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of words in each language (0 for a word's best) and their numbers of letters."""
        spelled = [letters_of(w) for w in words]
        letters = np.fromiter(map(len, spelled), np.int64, len(words))
        buckets, sizes = gram_buckets(spelled)  # the marks alone give every word some
        score = np.add.reduceat(self.weights[buckets], np.cumsum(sizes) - sizes)
        allowed = self.allowed[[script_of(w[0]) if w else 0 for w in spelled]]
        score = np.where(allowed, score, -np.inf)
        score = np.maximum(score - score.max(axis=1, keepdims=True), -CLIP)
        return np.where((letters > 0)[:, None], score, 0).astype(np.float32), letters


class Words(dict):
    """For each chunk met so far, the row numbers of its words in a table of their scores."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.scores, self.letters = np.zeros((0, len(model.langs)), np.float32), np.zeros(0, np.int64)

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word rows of all texts, words per text, and the tables of scores and letters."""
        if len(self) > CACHE_WORDS:
            self.clear()
            self.scores, self.letters = self.scores[:0], self.letters[:0]
        chunks = list(map(chunks_of, texts))
        flat = list(chain.from_iterable(chunks))
        new, words = list(set(flat).difference(self)), []
        for chunk in new:
            found = words_of(chunk)
            first = len(self.letters) + len(words)
            self[chunk] = range(first, first + len(found))
            words += found
        scored = [self.model.scores(words[k:k + BLOCK]) for k in range(0, len(words), BLOCK)]
        self.scores = np.concatenate([self.scores, *(f[0] for f in scored)])
        self.letters = np.concatenate([self.letters, *(f[1] for f in scored)])
        runs = list(map(self.__getitem__, flat))
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, chunks), np.int64, len(chunks)))
        sizes = np.bincount(owner, weights=lengths, minlength=len(texts)).astype(np.int64)
        return np.fromiter(chain.from_iterable(runs), np.int64, int(lengths.sum())), sizes, self.scores, self.letters


def viterbi(rows: np.ndarray, sizes: np.ndarray, scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best label of every word; all texts advance together, the longest first in the order."""
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    ordered = sizes[order]
    steps = int(ordered[0]) if len(ordered) else 0
    # texts that still have a word at step t, and where the step's entries begin
    live = len(ordered) - np.searchsorted(ordered[::-1], np.arange(steps), side="right")
    base = np.concatenate([[0], np.cumsum(live)])
    stays = np.empty((int(base[-1]), scores.shape[1]), bool)
    origin = np.empty(int(base[-1]), np.int16)
    best = np.zeros((len(ordered), scores.shape[1]), np.float32)
    for t in range(steps):
        n = live[t]
        here = best[:n]
        top = here.argmax(axis=1)
        moved = (here.max(axis=1) - penalty)[:, None]
        stays[base[t]:base[t + 1]] = here >= moved
        origin[base[t]:base[t + 1]] = top
        best[:n] = np.maximum(here, moved) + scores[rows[starts[:n] + t]]
    labels = np.empty(len(rows), np.int16)
    state = best.argmax(axis=1).astype(np.int16)
    for t in range(steps - 1, -1, -1):
        n = live[t]
        labels[starts[:n] + t] = state[:n]
        stay = stays[base[t]:base[t + 1]][np.arange(n), state[:n]]
        state[:n] = np.where(stay, state[:n], origin[base[t]:base[t + 1]])
    return labels


def _spans(text: str | None, labels: np.ndarray, langs: list[str]) -> list[dict]:
    """Runs of words of one label, by code points of the text."""
    if not len(labels):
        return []
    # places in the lower-cased text; a few letters grow by that
    low = text.lower()
    at = None if len(low) == len(text) else np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
    places = np.array([m.span() for m in _word_pattern().finditer(low)])
    first, last = places[:, 0], places[:, 1] - 1
    if at is not None:
        first, last = at[first], at[last]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]])
    return [{"start": int(first[a]), "end": int(last[b - 1]) + 1, "lang": langs[labels[a]]} for a, b in zip(cuts[:-1], cuts[1:])]


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", spans: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score; ``keep`` names the columns to carry.

    ``spans`` adds the runs of words of one language: (start, end, lang), places by code points of the text.
    """
    hidden = fresh_name(keep, "_text")
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    schema = ", ".join([*(f"`{f.split(' ', 1)[0]}` {f.split(' ', 1)[1]}" for f in fields), "lang_pred string", "score double",
                        *(["spans array<struct<start:int,end:int,lang:string>>"] if spans else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model)
        for batch in batches:
            texts = batch.column(hidden).to_pylist()
            for i, j in chunked(texts, CHUNK):
                pred, score, runs = _judge(texts[i:j], model, words, spans)
                part = batch.slice(i, j - i)
                arrays = [part.column(k) for k in keep] + [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
                if spans:
                    arrays.append(pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))))
                yield pa.RecordBatch.from_arrays(arrays, [*keep, "lang_pred", "score", *(["spans"] if spans else [])])

    return docs.select(*keep, F.col(text_col).alias(hidden)).mapInArrow(run, schema)


def _judge(texts: list[str | None], model: Model, words: Words, spans: bool):
    if not model.langs:
        return ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    rows, sizes, scores, letters = words.of(texts)
    labels = viterbi(rows, sizes, scores)
    n = len(model.langs)
    owner = np.repeat(np.arange(len(texts)), sizes)
    held = np.bincount(owner * n + labels, weights=letters[rows] if len(rows) else None, minlength=len(texts) * n).reshape(-1, n)
    total, top = held.sum(axis=1), held.argmax(axis=1)
    pred = [model.langs[k] if t > 0 else "und" for k, t in zip(top, total)]
    score = np.where(total > 0, held.max(axis=1) / np.maximum(total, 1), 0.0)
    ends = np.cumsum(sizes)
    runs = [_spans(t, labels[e - s:e], model.langs) for t, s, e in zip(texts, sizes, ends)] if spans else None
    return pred, score, runs


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_train: int = MAX_TRAIN, max_langs: int = MAX_LANGS) -> Model:
    """Model of about ``max_train`` of ``docs`` with a text and a language, in ``max_langs`` languages at most."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    docs = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    share = min(1.0, max_train / max(1, docs.select("doc_id").count()))
    docs = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share * (1 << 20))
    common = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs + 1).collect()
    if len(common) > max_langs:
        docs = docs.filter(F.col("lang").isin([r["lang"] for r in common[:max_langs]]))
    return Model.of(training_counts(docs).collect())


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without texts of no language or of none that holds ``least`` of the letters."""
    def judge():
        words = Words(model)

        def keep(texts: list[str | None]) -> list[bool]:
            out: list[bool] = []
            for i, j in chunked(texts, CHUNK):
                pred, score, _ = _judge(texts[i:j], model, words, False)
                out += [p != "und" and s >= least for p, s in zip(pred, score)]
            return out
        return keep

    return rows_kept(docs, text_col, judge)


def held_out():
    return crc_mod(F.col("doc_id"), 4) == 2


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    return identify(docs.withColumn("held_out", held_out()), model, ["doc_id", "held_out"])


SQL = None
