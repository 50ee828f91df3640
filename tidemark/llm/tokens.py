"""Token counts with a whole-token shortcut, equal to the tokenizer library's.

A byte-level BPE splits a text into pre-tokens and merges each by itself. Offline, on the
driver, every vocabulary string is encoded once: those that come out as the one token
they are make the shortcut set (bounded by the vocabulary, sent to the workers once per
query). In a text a pre-token from that set counts as one, and only the rest is merged.

A text is cut before each space that follows a character other than white space: there a
pre-token always ends (one of white space may run on over a space), and what the
pre-tokenizer does after it depends on nothing before. Such units are short and repeat, so
each worker keeps the counts of units it has met (emptied when full, which changes no
result). Strings of special tokens are cut out first and count as one each, as the library
does by default.

The two know Unicode in different editions, so the characters that the library's
pre-tokenizer and the pattern here class differently are found offline as well, over all
code points; a text with one of them goes to the library as it is.

Defined cases: a NULL or empty text has 0 bytes and 0 tokens; equal rows each get a row;
only the id and text columns are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

NAME = "op2_token_counts"
LIMIT = 512
CACHE_UNITS = 400_000
# The pre-tokenizer's pattern (fixed by the byte-level tokenizer files).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary, and its byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and that the tokenizer encodes as one token."""
    import regex
    from tokenizers import Tokenizer

    pattern, letters = regex.compile(PATTERN), byte_letters()
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    texts = []
    for word in vocabulary:
        try:
            texts.append(bytes(letters[c] for c in word).decode())
        except (UnicodeDecodeError, KeyError):  # part of a character, or a special token
            continue
    encoder = Tokenizer.from_file(path)
    encoder.encode_special_tokens = True
    codes = encoder.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, c in zip(texts, codes) if len(c.ids) == 1 and pattern.fullmatch(t)
                     and pattern.findall(t) == [t])


def _probe(c: str) -> str:
    """A text in which a character stands between letters, digits, marks and white space."""
    return f"x{c}y1{c}2!{c}? {c} "


@lru_cache
def odd_characters(path: str) -> str:
    """The characters that the library's pre-tokenizer cuts otherwise than ``PATTERN``, in order."""
    import regex
    from tokenizers import Tokenizer

    pattern, pre = regex.compile(PATTERN), Tokenizer.from_file(path).pre_tokenizer

    def spans(text: str) -> list[list[tuple[int, int]]]:
        return [[span for _, span in pre.pre_tokenize_str(text)], [m.span() for m in pattern.finditer(text)]]

    found = []
    for first in range(0, 0x110000, 256):
        block = [chr(c) for c in range(first, first + 256) if not 0xD800 <= c < 0xE000]
        if not block:
            continue
        # between the cuts of both, neighbours are of one class in either; one of them is probed for all
        text = "".join(block)
        cuts = {at for side in spans(text) for span in side for at in span} if first else set(range(len(block) + 1))
        cuts = sorted(cuts)
        for a, b in zip(cuts, cuts[1:]):
            one, other = spans(_probe(block[a]))
            if one != other:
                found += block[a:b]
    return "".join(found)


class _Units(dict):
    """Token count of a unit that follows a space; short ones are kept."""

    def __init__(self, merged):
        super().__init__()
        self.merged = merged

    def __missing__(self, unit: str) -> int:
        n = self.merged(" " + unit)
        if len(unit) < 64:
            self[unit] = n
        return n


class Counter:
    """Token counts of texts; one per task."""

    def __init__(self, path: str, whole: frozenset[str], odd: str):
        import regex
        from tokenizers import Tokenizer

        self.find = regex.compile(PATTERN).findall
        self.runs_on = regex.compile(r"\s ").search
        self.cut = regex.compile(r"(?<!\s) ").split
        self.encoder = Tokenizer.from_file(path)
        self.encoder.encode_special_tokens = True  # special strings are cut out here
        self.library = Tokenizer.from_file(path)
        self.odd = frozenset(odd)
        self.whole = whole
        with open(path, encoding="utf-8") as f:
            self.strings = sorted((t["content"] for t in json.load(f)["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, self.strings)))
        self.known = _Units(self.merged)

    def merged(self, unit: str) -> int:
        """Tokens of a text by its pre-tokens: one for a whole token, else what its merges leave."""
        n = 0
        for piece in self.find(unit):
            n += 1 if piece in self.whole else len(self.encoder.encode(piece, add_special_tokens=False).ids)
        return n

    def plain(self, text: str) -> int:
        if len(self.known) > CACHE_UNITS:
            self.known.clear()
        head, *units = self.cut(text) if self.runs_on(text) else text.split(" ")
        return self.merged(head) + sum(map(self.known.__getitem__, units))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not text.isascii() and not self.odd.isdisjoint(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        if not any(s in text for s in self.strings):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``path`` names the tokenizer file on every node.
    """
    offline = docs.sparkSession.sparkContext.broadcast((whole_tokens(path), odd_characters(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, *offline.value)
        for batch in batches:
            n = [counter.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                       F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint").alias("n_bytes")
                       ).mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


SQL = None
