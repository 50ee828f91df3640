"""Alignment of two tokenizers over the same texts by sparse incidence products.

Both tokenizers' tokens tile the bytes of a text. Their token-byte incidence matrices are built
by hand in CSR form (row starts and column numbers); Gustavson's row-by-row product A x Bt
has one entry for every pair of tokens that overlap, its value the bytes they share. Overlapping
tokens that end on the same byte are linked, and these bytes cut both sequences into groups.
The product of the token-group incidence matrices gives the shared-group links, all pairs of
tokens of one group; the query counts them from the row sizes of that product and
``shared_links`` makes them, a bounded stretch of rows at a time.

Texts are cut into units whose last byte ends a token on both sides, so nothing crosses units and
the matrices of a text are block-diagonal: its tokens, links, groups and products are those of its
units, one behind the other. The units of a chunk that are new are taken together, as one such
matrix. Products run over stretches of rows with a bounded number of terms.

Two tokens that end together cover bytes of which one is the end of the other. So the id
pairs that can ever be linked follow from the two vocabularies alone (``Lexicon``): some hundred
thousand, whatever the corpus. A link is kept as its number in that list; corpus counts are one
number a pair, added up inside the tasks, then over tasks, and sent back to the workers.
Neither tokenizer merges over a space that follows a visible character (of B that is proven from
its vocabulary, else texts stay whole), so texts are cut there. Each chunk's units are encoded and
aligned once, and a worker keeps what it found for them; when that is full, the units met most stay.
The texts are encoded once: links are written to the shared folder, and counts and the second
pass read them from there.

Defined cases: a text that is NULL, empty, or that the tokens of either side do not spell out
exactly (with the leading space) has no tokens: zeros, and '' in place of a digest. Strings of
special tokens are plain text. Equal rows each count. Only the id and the text column are read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table
from tidemark.llm.tokens import byte_letters

NAME = "op12_tokenizer_alignment"
CHUNK = 1 << 18             # characters of texts that are taken together
TOGETHER = 32               # units that the tokenizer A takes as one text
TERMS = 1 << 22             # terms of a product that are held at once
CACHE_UNITS = 200_000       # units that a worker keeps, and their bytes; then it keeps those met most, which changes no result
CACHE_BYTES = 1 << 22
# A pre-token of A ends before a space that follows another character than white space (here: visible ASCII,
# letters and digits). A last space stays with its word: B has no token for an empty unit.
CUT = re.compile(r" (?<=[!-~\w] )(?=[\s\S])")
MAX_PAIRS = 1 << 24         # id pairs whose counts are sent to the workers: 8 bytes each


# --- sparse matrices ----------------------------------------------------------------------

class Csr:
    """Rows of column numbers: those of row i are ``cols[starts[i]:starts[i + 1]]``, all entries one."""

    def __init__(self, starts: np.ndarray, cols: np.ndarray, width: int):
        self.starts, self.cols, self.width = starts, cols, width

    def __len__(self) -> int:
        return len(self.starts) - 1

    def rows_of(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def transposed(self) -> Csr:
        """Counting sort of the entries by column."""
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.cols, minlength=self.width))])
        return Csr(starts, self.rows_of()[np.argsort(self.cols, kind="stable")], len(self))

    def terms(self, other: Csr) -> np.ndarray:
        """Terms of each row of the product with ``other``; its entries, where no two terms meet."""
        sizes = np.concatenate([[0], np.cumsum(np.diff(other.starts)[self.cols])])
        return sizes[self.starts[1:]] - sizes[self.starts[:-1]]

    def times(self, other: Csr, terms: int = TERMS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The product by Gustavson's rule - row i is the sum of other's rows named in row i - as
        (rows, columns, values), sorted, for stretches of rows of about ``terms`` terms."""
        before = np.concatenate([[0], np.cumsum(self.terms(other))])
        lo = 0
        while lo < len(self):
            hi = max(lo + 1, int(np.searchsorted(before, before[lo] + terms, "right")) - 1)
            named = self.cols[self.starts[lo]:self.starts[hi]]
            first, size = other.starts[named], other.starts[named + 1] - other.starts[named]
            at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(before[hi] - before[lo])
            rows = np.repeat(np.arange(lo, hi), np.diff(before[lo:hi + 1]))
            key = rows * other.width + other.cols[at]
            if len(key) and (np.diff(key) < 0).any():
                key.sort()
            new = np.flatnonzero(np.concatenate([[True], np.diff(key) != 0])) if len(key) else np.zeros(0, np.int64)
            yield key[new] // other.width, key[new] % other.width, np.diff(np.concatenate([new, [len(key)]]))
            lo = hi


def tiling(sizes: np.ndarray) -> Csr:
    """Token-byte incidence of tokens that lie one behind the other."""
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return Csr(starts, np.arange(starts[-1]), int(starts[-1]))


@dataclass
class Alignment:
    """Two token sequences over the same bytes: links (token numbers) and each token's group."""

    link_a: np.ndarray
    link_b: np.ndarray
    overlaps_of: np.ndarray     # overlapping B tokens of each A token
    group_a: np.ndarray
    group_b: np.ndarray

    def group_matrices(self) -> tuple[Csr, Csr]:
        n = len(self.link_a)
        one = lambda g: Csr(np.arange(len(g) + 1), g, n)
        return one(self.group_a), one(self.group_b).transposed()

    def shared_links(self, terms: int = TERMS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of tokens of one group, in stretches."""
        a, bt = self.group_matrices()
        for rows, cols, _ in a.times(bt, terms):
            yield rows, cols

    def shared_counts(self) -> np.ndarray:
        """Shared-group links of each A token: the row sizes of the product."""
        a, bt = self.group_matrices()
        return a.terms(bt)


def align(size_a: np.ndarray, size_b: np.ndarray) -> Alignment:
    """Alignment of two tilings of the same bytes, given the tokens' sizes in bytes (none empty)."""
    a, b = tiling(size_a), tiling(size_b)
    links, overlaps = [], np.zeros(len(a), np.int64)
    for rows, cols, _ in a.times(b.transposed()):
        overlaps += np.bincount(rows, minlength=len(a))
        together = a.starts[rows + 1] == b.starts[cols + 1]
        links.append((rows[together], cols[together]))
    link_a, link_b = (np.concatenate([x[i] for x in links]) if links else np.zeros(0, np.int64) for i in (0, 1))
    return Alignment(link_a, link_b, overlaps, np.searchsorted(link_a, np.arange(len(a))), np.searchsorted(link_b, np.arange(len(b))))


# --- vocabularies -------------------------------------------------------------------------

class Lexicon:
    """Token bytes of both tokenizers and the id pairs that can be linked.

    ``a`` is a byte-level BPE (.json), ``b`` a sentencepiece model. ``keys`` are the sorted pairs (id of
    a) << 32 | id of b for which one's bytes end with the other's.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        letters = byte_letters()
        with open(path_a, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.a = [b""] * (max(vocabulary.values()) + 1)
        for word, i in vocabulary.items():
            if all(c in letters for c in word):     # not so: strings of special tokens, which are never met
                self.a[i] = bytes(letters[c] for c in word)
        model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.b = [b""] * model.get_piece_size()
        for i in range(len(self.b)):
            if model.is_byte(i):
                self.b[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.b[i] = model.id_to_piece(i).replace("▁", " ").encode()
        ids = {}
        for side, words in (("a", self.a), ("b", self.b)):
            ids[side] = {}
            for i, w in enumerate(words):
                if w:
                    ids[side].setdefault(w, []).append(i)
        pairs = {(i << 32) | j for i, w in enumerate(self.a) for k in range(len(w)) for j in ids["b"].get(w[k:], ())}
        pairs |= {(i << 32) | j for j, w in enumerate(self.b) for k in range(len(w)) for i in ids["a"].get(w[k:], ())}
        if len(pairs) > MAX_PAIRS:
            raise ValueError(f"the vocabularies have {len(pairs)} id pairs that can be linked; the limit is {MAX_PAIRS}")
        self.keys = np.array(sorted(pairs), np.int64)
        # B's merges stay on one side of a space that follows another character, unless a piece reaches over one
        self.made: Encoder | None = None
        self.cuts = not any(re.search("[^▁]▁", model.id_to_piece(i)) for i in range(len(self.b)))

    def encoder(self, path_a: str, path_b: str) -> Encoder:
        """Both tokenizers, made once in a worker: this object stays there from task to task."""
        if self.made is None:
            self.made = Encoder(path_a, path_b, self)
        return self.made


def _closed(unit: str) -> bool:
    """Whether a text may be cut before a space that follows ``unit``."""
    return "!" <= unit[-1] <= "~" or unit[-1].isalnum()


class Encoder:
    """Both tokenizers with the units met so far."""

    def __init__(self, path_a: str, path_b: str, lexicon: Lexicon):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        import sentencepiece
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path_a)
        self.tokenizer.encode_special_tokens = True
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.lexicon = lexicon
        self.size_a, self.size_b = (np.array([len(w) for w in words], np.int64) for words in (lexicon.a, lexicon.b))
        # how a token is written in the digest's text: first of its unit, first of its group and not
        self.forms = [form + str(i) for form, n in (("\n", len(lexicon.a)), (";", len(lexicon.a)), (",", len(lexicon.a)),
                                                    ("|", len(lexicon.b)), (",", len(lexicon.b))) for i in range(n)]
        # the units by their numbers, which go up in ``known``
        self.known: dict[str, int] = {}
        self.unlike: dict[str, bytes] = {}              # what B spells in place of a unit
        self.written: list[str] = []
        self.sums = np.zeros((0, 5), np.int64)          # n_a, n_b, n_links, n_overlaps, n_shared
        self.links = np.zeros(0, np.int32)
        self.uses = np.zeros(0, np.int64)
        self.bytes = np.zeros(0, np.int64)

    def learn(self, units: list[str]) -> None:
        """Encode and align units that are not known; those that B does not spell out are noted in ``unlike``."""
        if not units:
            return
        # A takes several at once where each ends as the texts were cut
        closed = [u for u in units if _closed(u)]
        n = len(closed)
        units = closed + [u for u in units if not _closed(u)] if n < len(units) else closed
        spaced = [" " + u for u in units]
        joined = ["".join(spaced[i:min(i + TOGETHER, n)]) for i in range(0, n, TOGETHER)] + spaced[n:]
        want = [u.encode() for u in spaced]
        size, whole = np.fromiter(map(len, want), np.int64, len(want)), b"".join(want)
        bounds = np.concatenate([[0], np.cumsum(size)])

        ids = list(chain.from_iterable([e.ids for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]))
        a = np.array(ids, np.int64)
        upto = np.concatenate([[0], np.cumsum(self.size_a[a])])
        ends = np.searchsorted(upto, bounds)
        if upto[-1] != len(whole) or (upto[ends] != bounds).any() or b"".join(map(self.lexicon.a.__getitem__, ids)) != whole:
            raise ValueError("the byte-level tokenizer does not spell its input")    # it has a token for every byte
        n_a = np.diff(ends)

        pieces = self.model.encode(units, num_threads=1)
        n_b = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = list(chain.from_iterable(pieces))
        b = np.array(ids, np.int64)
        ends = np.concatenate([[0], np.cumsum(n_b)])
        upto = np.concatenate([[0], np.cumsum(self.size_b[b])])
        if (upto[ends] != bounds).any() or b"".join(map(self.lexicon.b.__getitem__, ids)) != whole:
            spelt = [b"".join([self.lexicon.b[i] for i in x]) for x in pieces]
            like = np.array([x == w for x, w in zip(spelt, want)])
            self.unlike.update((units[i], spelt[i]) for i in np.flatnonzero(~like).tolist())
            a, b = a[np.repeat(like, n_a)], b[np.repeat(like, n_b)]
            n_a, n_b = n_a * like, n_b * like           # the others count as without tokens
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units))))
        self.keep(a, b, n_a, n_b)
        self.uses = np.concatenate([self.uses, np.zeros(len(units), np.int64)])
        self.bytes = np.concatenate([self.bytes, size])

    def keep(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
        """Align units, given their ids one behind the other and how many each has, and add what is found."""
        found = align(self.size_a[a], self.size_b[b])
        per_unit = lambda n, values: np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], np.cumsum(n)])])
        linked = np.zeros(len(a), np.int64)
        linked[found.link_a] = 1
        self.sums = np.concatenate([self.sums, np.stack(
            [n_a, n_b, per_unit(n_a, linked), per_unit(n_a, found.overlaps_of), per_unit(n_a, found.shared_counts())], axis=1)])
        pair = np.searchsorted(self.lexicon.keys, (a[found.link_a] << 32) | b[found.link_b])
        self.links = np.concatenate([self.links, pair.astype(np.int32)])

        # places of the tokens in the written form: A's of a group, then B's
        groups = len(found.link_a)
        upto_a, upto_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=groups))]) for g in (found.group_a, found.group_b))
        first = lambda g: np.concatenate([[True], np.diff(g) != 0])[:len(g)]
        form_a = np.where(first(found.group_a), 1, 2)
        form_a[(np.cumsum(n_a) - n_a)[n_a > 0]] = 0
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + upto_b[found.group_a]] = a + form_a * len(self.size_a)
        codes[np.arange(len(b)) + upto_a[found.group_b + 1]] = b + 3 * len(self.size_a) + np.where(first(found.group_b), 0, len(self.size_b))
        texts = iter("".join(map(self.forms.__getitem__, codes.tolist())).split("\n")[1:])
        self.written += texts if (n_a > 0).all() else [next(texts) if n else "" for n in n_a.tolist()]

    def forget(self) -> None:
        """Keep the units met most that fit in half the room, and half their uses."""
        order = np.argsort(-self.uses, kind="stable")[:CACHE_UNITS // 2]
        kept = np.sort(order[(np.cumsum(self.bytes[order]) <= CACHE_BYTES // 2) & (self.uses[order] > 1)])
        units, at = list(self.known), self.links_of(kept)
        self.known = {units[i]: n for n, i in enumerate(kept.tolist())}
        self.unlike = {u: spelt for u, spelt in self.unlike.items() if u in self.known}
        self.written = [self.written[i] for i in kept.tolist()]
        self.links, self.sums, self.uses, self.bytes = self.links[at], self.sums[kept], (self.uses[kept] + 1) // 2, self.bytes[kept]

    def links_of(self, units: np.ndarray) -> np.ndarray:
        """Places in ``links`` of the links of units (numbers), one behind the other."""
        ends, size = np.cumsum(self.sums[:, 2]), self.sums[units, 2]
        return np.repeat(ends[units] - np.cumsum(size), size) + np.arange(int(size.sum()))

    def numbers(self, units: set[str]) -> dict[str, int]:
        """The numbers of units, all known then."""
        out = {u: self.known.get(u, -1) for u in units}
        new = [u for u, n in out.items() if n < 0]
        self.learn(new)
        out.update((u, self.known[u]) for u in new)
        return out

    def units(self, texts: Sequence[str | None]) -> tuple[list[list[str]], dict[str, int]]:
        """The units of each text (none where the tokens do not spell the text out) and their numbers."""
        if len(self.known) > CACHE_UNITS or self.bytes.sum() > CACHE_BYTES:
            self.forget()
        parts = [(CUT.split(t) if self.lexicon.cuts else [t]) if t else [] for t in texts]
        numbers = self.numbers(set(chain.from_iterable(parts)))
        if not self.unlike.keys().isdisjoint(numbers):
            for i, units in enumerate(parts):
                if not self.unlike.keys().isdisjoint(units):
                    parts[i] = self.spelt(texts[i], units)
                    numbers |= self.numbers(set(parts[i]))
        return parts, numbers

    def spelt(self, text: str, units: list[str]) -> list[str]:
        """A text with units that are spelt otherwise: as one unit if it is spelt out all the same, else none."""
        if b"".join([self.unlike[u] if u in self.unlike else (" " + u).encode() for u in units]) != (" " + text).encode():
            return []
        self.numbers({text})
        return [] if text in self.unlike else [text]

    def columns(self, texts: Sequence[str | None]) -> list[pa.Array]:
        """n_a, n_b, n_groups, n_links, n_overlaps, n_shared, groups_sha256 and links of each text."""
        parts, numbers = self.units(texts)
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
        found = list(map(numbers.__getitem__, chain.from_iterable(parts)))
        unit = np.array(found, np.int64)
        self.uses += np.bincount(unit, minlength=len(self.known))
        upto = np.concatenate([np.zeros((1, self.sums.shape[1]), np.int64), np.cumsum(self.sums[unit], axis=0)])
        n_a, n_b, links, overlaps, shared = (upto[ends[1:]] - upto[ends[:-1]]).T
        written = list(map(self.written.__getitem__, found))
        digests = [sha256(";".join(written[i:j]).encode()).hexdigest() if j > i else "" for i, j in zip(ends.tolist(), ends[1:].tolist())]
        return [*map(pa.array, (n_a, n_b, links, links, overlaps, shared)), pa.array(digests, pa.string()),
                pa.ListArray.from_arrays(pa.array(upto[ends, 2].astype(np.int32)), pa.array(self.links[self.links_of(unit)]))]


# --- jobs ---------------------------------------------------------------------------------

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_shared", "groups_sha256", "links")
SCHEMA = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COLUMNS[:6]) + ", groups_sha256 string, links array<int>"


class Aligned:
    """``rows``: one per document, with links as numbers into ``lexicon.keys``, written to the shared folder."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"):
        self.lexicon = Lexicon(path_a, path_b)
        shipped = docs.sparkSession.sparkContext.broadcast(self.lexicon)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = shipped.value.encoder(path_a, path_b)
            for batch in batches:
                upto = np.concatenate([[0], np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
                i = 0
                while i < len(batch):   # texts are made a chunk at a time
                    rows = batch.slice(i, max(1, int(np.searchsorted(upto, upto[i] + CHUNK, "right")) - 1 - i))
                    yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *encoder.columns(rows.column("text").to_pylist())], ["doc_id", *COLUMNS])
                    i += len(rows)

        self.rows = staged(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA), "links")

    def counts(self) -> np.ndarray:
        """How many links of the corpus hold each pair of the lexicon."""
        size = len(self.lexicon.keys)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros(size, np.int64)
            for batch in batches:
                n += np.bincount(batch.column("links").flatten().to_numpy(), minlength=size)
            pair = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int32)), pa.array(n[pair])], ["pair", "n"])

        sums = self.rows.select("links").mapInArrow(run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
        out = np.zeros(size, np.int64)
        out[sums.column("pair").to_numpy()] = sums.column("n").to_numpy()
        return out

    def highest(self, counts: np.ndarray) -> np.ndarray:
        """For each pair whether its count is the highest of its B id (ties included)."""
        b = self.lexicon.keys & 0xFFFFFFFF
        top = np.zeros(int(b.max()) + 1 if len(b) else 0, np.int64)
        np.maximum.at(top, b, counts)
        return (counts > 0) & (counts == top[b])

    def pair_table(self) -> DataFrame:
        """a_id, b_id, n, best_of_b of every linked id pair: which tokens of the one stand for which of the other."""
        counts = self.counts()
        met = np.flatnonzero(counts)
        keys = self.lexicon.keys[met]
        return self.rows.sparkSession.createDataFrame(pa.table({
            "a_id": keys >> 32, "b_id": keys & 0xFFFFFFFF, "n": counts[met], "best_of_b": self.highest(counts)[met]}))

    def report(self) -> DataFrame:
        """Per document row: doc_id, the columns of ``rows`` without links, n_best and count_sum."""
        counts = self.counts()
        shipped = self.rows.sparkSession.sparkContext.broadcast((counts, self.highest(counts)))
        kept = ["doc_id", *COLUMNS[:-1]]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, best = shipped.value
            for batch in batches:
                links = batch.column("links")
                pair, ends = links.flatten().to_numpy(), np.concatenate([[0], np.cumsum(links.value_lengths().to_numpy())])
                sums = [np.concatenate([[0], np.cumsum(v[pair], dtype=np.int64)]) for v in (best, n)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums)],
                                                 [*kept, "n_best", "count_sum"])

        return self.rows.mapInArrow(run, SCHEMA.rsplit(",", 1)[0] + ", n_best bigint, count_sum bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = (str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return Aligned(table(spark, sf_dir, "documents"), *paths).report()


SQL = None
