"""Interpolated modified Kneser-Ney language model, counted in Spark, memory-mapped by workers.

Order two (the previous word, or the text's begin, and the word). The model is a set of
sorted hash arrays below the shared folder, cut by hash range into files of bounded size:

* word files: sorted 64-bit word hashes and counts. A word's number is its rank over all files.
* pair files: sorted hashes of word pairs and their counts. The hash is a bijection of the
  pair of numbers, so different pairs never share one.
* fact files, one beside each word file: how many followers of a word occur once, twice and
  more often, and how many words it follows.

Tasks count what they read in sorted blocks and send each block's slices to the task of
their hash range, which merges them and writes its files one after the other; no word or
pair, however frequent, sends more than one entry per block. A block is cut into at most
2^``PIECE_BITS`` slices; where there are more files, a second pass merges the blocks of a
slice and cuts them finer, so slices stay long. Facts are sent per range of words, and
there are at most 2^32 / ``WORDS_PER_RANGE`` ranges, so their rows grow with the pairs.

File names follow from the folder and the number of the file; a task that runs twice writes
the same bytes. The driver and the tasks hold the first number of every word file (a
megabyte at most) and sums, no lists of files. Scoring maps the files and looks sorted
batches of pairs up in them; a task keeps at most ``OPEN_BYTES`` of files open. Files on a
store that cannot be mapped are read into memory under the same bound, never copied to a
local disk.

Limit: word numbers have 32 bits; a vocabulary of 2^32 words or more raises.

Defined cases: a NULL text is empty, and an empty text is its end alone; equal rows each
train and score; without training texts every token has probability 1 of the one unknown
word, so all scores are 0; counts-of-counts that are zero use the discounts 0.5, 1, 1.5.
"""

from __future__ import annotations

import uuid
from collections import Counter, OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, staged, table
from tidemark.llm.shingles import chunked, mix64
from tidemark.session import scratch_path

NAME = "op1_lm_score"
END, BEGIN = b"", b"\n"  # no word is either
CACHE_WORDS, FLUSH_WORDS, FLUSH_TOKENS = 300_000, 400_000, 4_000_000
WORDS_PER_FILE, TOKENS_PER_FILE, MIN_FILES = 1 << 15, 1 << 22, 64
PIECE_BITS = 10  # a block is cut into at most 2^10 slices at once
TASK_BITS = 4  # a task writes up to 2^4 pair files
WORDS_PER_RANGE, FILES_PER_SALT = 1 << 22, 4096  # facts are summed per range of words, first per so many pair files
OPEN_BYTES = 256 << 20
CHUNK = 8 << 20
SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def pack(sorted_keys: np.ndarray) -> bytes:
    """Ascending numbers as compressed byte planes of their differences."""
    steps = np.diff(sorted_keys, prepend=np.zeros(1, sorted_keys.dtype))
    return zstandard.compress(steps.view(np.uint8).reshape(len(steps), -1).T.tobytes(), 1)


def unpack(data: bytes, kind=np.uint64) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel(), dtype=kind)


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[firsts], *(np.add.reduceat(v[order], firsts) if len(firsts) else v[:0] for v in values)


def _bits(files: int) -> int:
    return max(files - 1, 0).bit_length()


def _slices(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The runs of sorted 64-bit hashes that belong to one file."""
    if not len(hashes):
        return
    part = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(part[a]), slice(int(a), int(b))


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts in four bytes each, in eight where one needs them."""
    return zstandard.compress(counts.astype(np.uint32 if not len(counts) or counts.max() >> 32 == 0 else np.uint64).tobytes(), 1)


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    raw = zstandard.decompress(data)
    return np.frombuffer(raw, np.uint64 if n and len(raw) // n == 8 else np.uint32).astype(np.int64)


def file_name(kind: str, i: int) -> str:
    """Where file ``i`` of a kind lies in the model's folder; 4096 files to a folder."""
    return f"{kind}/{i >> 12}/{i}"


def write_file(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Write arrays one after the other below the shared folder, all or nothing."""
    system, path = fs.FileSystem.from_uri(folder)
    final = f"{path}/{name}"
    system.create_dir(final.rsplit("/", 1)[0], recursive=True)
    part = f"{final}-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).tobytes())
    try:
        system.move(part, final)
    except OSError:
        # another attempt of this task was first; its file holds the same bytes
        if system.get_file_info(final).type == fs.FileType.NotFound:
            raise
        system.delete_file(part)


class Files:
    """Files of a model that a task has open, mapped or read; those unused for longest go beyond ``limit`` bytes."""

    def __init__(self, folder: str, limit: int | None = None):
        self.system, self.path = fs.FileSystem.from_uri(folder)
        self.limit = OPEN_BYTES if limit is None else limit
        self.held: OrderedDict[str, np.ndarray] = OrderedDict()
        self.size = 0

    def get(self, name: str) -> np.ndarray:
        if name in self.held:
            self.held.move_to_end(name)
            return self.held[name]
        path = f"{self.path}/{name}"
        if isinstance(self.system, fs.LocalFileSystem):
            got = np.memmap(path, np.uint8, "r")
        else:
            with self.system.open_input_file(path) as file:
                got = np.frombuffer(file.read_buffer(), np.uint8)
        self.held[name] = got
        self.size += got.size
        while self.size > self.limit and len(self.held) > 1:
            self.size -= self.held.popitem(last=False)[1].size
        return got

    def exists(self, name: str) -> bool:
        return name in self.held or self.system.get_file_info(f"{self.path}/{name}").type == fs.FileType.File

    def columns(self, name: str, *kinds) -> list[np.ndarray]:
        """The arrays, all of the same length, that a file holds one after the other."""
        raw, out, at = self.get(name), [], 0
        n = raw.size // sum(np.dtype(k).itemsize for k in kinds)
        for kind in kinds:
            size = np.dtype(kind).itemsize * n
            out.append(raw[at:at + size].view(kind))
            at += size
        return out


class Vocabulary:
    """Word numbers from the word files, by hash range; ``firsts``: the first number of every file, then their total."""

    def __init__(self, folder: str, firsts: np.ndarray):
        self.files, self.firsts, self.bits = Files(folder), firsts, _bits(len(firsts) - 1)
        self.known: dict[bytes, int] = {}

    def arrays(self, i: int) -> list[np.ndarray]:
        if self.firsts[i] == self.firsts[i + 1]:
            return [np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        return self.files.columns(file_name("words", i), np.uint64, np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of ascending hashes, -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int64)
        for i, run in _slices(hashes, self.bits):
            there = self.arrays(i)[0]
            at = np.searchsorted(there, hashes[run])
            ok = at < len(there)
            ok[ok] = there[at[ok]] == hashes[run][ok]
            out[run] = np.where(ok, at + self.firsts[i], -1)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = list(set(words).difference(self.known))
        if new:
            hashes = np.fromiter(map(word_hash, new), np.uint64, len(new))
            order = np.argsort(hashes)
            for k, number in zip(order, self.numbers(hashes[order]).tolist()):
                self.known[new[k]] = number
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def pairs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(previous, word) numbers of all tokens of all texts, ends included, and tokens per text."""
        words = [words_of(t) for t in texts]
        sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        begin, end = self.of([BEGIN, END])
        numbers = self.of([x for w in words for x in w])
        ends = np.cumsum(sizes) - 1
        inside = np.ones(int(sizes.sum()), bool)
        inside[ends] = False
        word = np.full(len(inside), end, np.int64)
        word[inside] = numbers
        previous = np.empty_like(word)
        previous[1:] = word[:-1]
        previous[ends - sizes + 1] = begin
        return previous, word, sizes


def pair_hash(previous: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64((previous.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64))


def _unmix64(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix64``."""
    def unshift(x, n):
        y = x ^ (x >> np.uint64(n))
        return y ^ (y >> np.uint64(2 * n)) if 4 * n >= 64 else y

    inverse = lambda m: np.uint64(pow(m, -1, 1 << 64))
    x = unshift(x, 31) * inverse(0x94D049BB133111EB)
    x = unshift(x, 27) * inverse(0xBF58476D1CE4E5B9)
    return unshift(x, 30)


def count_words(docs: DataFrame) -> DataFrame:
    """(h, n): hash and count of every word of ``docs`` (text), ends included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            hashes = np.fromiter(map(word_hash, counted), np.uint64, len(counted)).view(np.int64)
            out = pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(list(counted.values()), pa.int64())], ["h", "n"])
            counted.clear()
            return out

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counted[END] += 1
                counted.update(words_of(text))
                if len(counted) > FLUSH_WORDS:
                    yield flush()
        if counted:
            yield flush()

    return docs.mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


class Model:
    """Where the files lie and the few numbers that the driver knows; shipped to every task."""

    def __init__(self, folder, firsts, n_words, n_tokens, n_docs, pair_files=0, pair_discounts=None, word_discounts=None, n_pairs=0, spread=1.0):
        self.folder, self.firsts, self.n_words, self.n_tokens, self.n_docs = folder, firsts, n_words, n_tokens, n_docs
        self.pair_files, self.pair_discounts, self.word_discounts, self.n_pairs, self.spread = pair_files, pair_discounts, word_discounts, n_pairs, spread


def discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and more from the numbers of entries counted 1 to 4 times."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3 and n4):
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0, [0, 1, 2, 3])


def _write_words(vocabulary: DataFrame, files: int, folder: str) -> DataFrame:
    bits = _bits(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column("h").to_numpy(zero_copy_only=False), b.column("n").to_numpy(zero_copy_only=False)) for b in batches]
        if got:
            h, n = summed(np.concatenate([g[0] for g in got]).view(np.uint64), np.concatenate([g[1] for g in got]))
            for i, run in _slices(h, bits):
                write_file(folder, file_name("words", i), h[run], n[run])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([len(h[run])])], ["file", "words"])

    part = F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)
    return vocabulary.repartitionById(files, part).mapInArrow(run, "file int, words bigint")


BLOCK = "file int, keys binary, counts binary"


def _cut(keys: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """The slices of one sorted block."""
    rows = [(i, pack(keys[r]), pack_counts(counts[r])) for i, r in _slices(keys, bits)]
    for k in range(0, len(rows), 256):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 256]), (pa.int32(), pa.binary(), pa.binary()))],
                                         ["file", "keys", "counts"])


def _uncut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for b in batches:
        for i, k, c in zip(*(b.column(x) for x in ("file", "keys", "counts"))):
            keys = unpack(k.as_py())
            yield i.as_py(), keys, unpack_counts(c.as_py(), len(keys))


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))


def _count_pairs(docs: DataFrame, folder: str, firsts: np.ndarray, bits: int) -> DataFrame:
    """Sorted blocks of pairs, cut by hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(folder, firsts)
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            yield from _cut(keys, counts, bits)

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in chunked(texts, CHUNK):
                previous, word, _ = words.pairs(texts[i:j])
                held.append(pair_hash(previous, word))
                if sum(map(len, held)) > FLUSH_TOKENS:
                    yield from flush()
        if held:
            yield from flush()

    return docs.mapInArrow(run, BLOCK)


def _cut_finer(blocks: DataFrame, bits: int, to_bits: int, tasks: int) -> DataFrame:
    """Blocks of each of 2^``bits`` ranges merged into long ones and cut by 2^``to_bits`` ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for _, keys, counts in _uncut(batches):
            held.append((keys, counts))
            if sum(len(h[0]) for h in held) > FLUSH_TOKENS:
                yield from _cut(*_merged(held), to_bits)
                held.clear()
        if held:
            yield from _cut(*_merged(held), to_bits)

    # the blocks of a range are many: they are dealt to several tasks
    salts = max(1, tasks >> bits)
    salt = F.pmod(F.xxhash64("keys"), F.lit(salts)).cast("int")
    return blocks.repartitionById(salts << bits, F.col("file") * salts + salt).mapInArrow(run, BLOCK)


FACTS = "range int, kind int, ids binary, n binary, stats array<bigint>"
TOTAL = -1  # the kind of the rows with the numbers of pairs


def _fact_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), 256):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows[k:k + 256]), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())))],
            ["range", "kind", "ids", "n", "stats"])


def _write_pairs(blocks: DataFrame, bits: int, task_bits: int, folder: str, starts: np.ndarray) -> DataFrame:
    """Merge the blocks of each hash range, write its file; per file its numbers of pairs, and rows of facts per word range.

    ``starts``: the number of the first word of every range.
    """
    def facts(ids: np.ndarray, kind: int, n: np.ndarray) -> list[tuple]:
        cuts = np.searchsorted(ids, starts[1:].astype(ids.dtype))
        return [(i, kind, pack(x), pack_counts(y), None)
                for i, (x, y) in enumerate(zip(np.split(ids, cuts), np.split(n, cuts))) if len(x)]

    def write(i: int, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, counts = _merged(held)
        write_file(folder, file_name("pairs", i), keys, np.minimum(counts, 0xFFFFFFFF).astype(np.uint32))
        pair = _unmix64(keys)
        previous, word = pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)
        rows = [(0, TOTAL, None, None, [len(keys), *(int((counts == c).sum()) for c in (1, 2, 3, 4))])]
        ids, n1, n2, n3 = summed(previous, *(x.astype(np.int64) for x in (counts == 1, counts == 2, counts > 2)))
        for kind, n in enumerate((n1, n2, n3)):
            rows += facts(ids[n > 0], kind, n[n > 0])
        ids, n = summed(word, np.ones(len(word), np.int64))
        yield from _fact_rows(rows + facts(ids, 3, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], -1
        for i, keys, counts in _uncut(batches):
            if held and i != at:
                yield from write(at, held)
                held = []
            at = i
            held.append((keys, counts))
        if held:
            yield from write(at, held)

    return (blocks.repartitionById(1 << task_bits, F.shiftright("file", bits - task_bits))
            .sortWithinPartitions("file").mapInArrow(run, FACTS))


def _range_sums(batches: Iterator[pa.RecordBatch], starts: np.ndarray) -> dict[int, np.ndarray]:
    """Per range the facts (once, twice, more, follows) of its words."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for r, kind, ids, n in zip(*(b.column(x) for x in ("range", "kind", "ids", "n"))):
            r, ids = r.as_py(), unpack(ids.as_py()).astype(np.int64)
            if r not in sums:
                sums[r] = np.zeros((4, starts[r + 1] - starts[r]), np.int64)
            sums[r][kind.as_py(), ids - starts[r]] += unpack_counts(n.as_py(), len(ids))
    return sums


def _sum_facts(rows: DataFrame, starts: np.ndarray, salts: int) -> DataFrame:
    """The facts of a range summed by several tasks, as rows of the same kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, s in _range_sums(batches, starts).items():
            ids = [np.flatnonzero(x) for x in s]
            yield from _fact_rows([(r, k, pack(ids[k].astype(np.uint64) + np.uint64(starts[r])), pack_counts(s[k][ids[k]]), None)
                                   for k in range(4) if len(ids[k])])

    salt = F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int")
    return rows.repartitionById((len(starts) - 1) * salts, F.col("range") * salts + salt).mapInArrow(run, FACTS)


def _write_facts(rows: DataFrame, starts: np.ndarray, firsts: np.ndarray, folder: str) -> DataFrame:
    """Write the facts of every word file; per range how many words follow 1 to 4 others, and any."""
    per_range = (len(firsts) - 1) // (len(starts) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, s in _range_sums(batches, starts).items():
            for i in range(r * per_range, (r + 1) * per_range):
                if firsts[i] < firsts[i + 1]:
                    part = s[:, firsts[i] - starts[r]:firsts[i + 1] - starts[r]]
                    write_file(folder, file_name("facts", i), *np.minimum(part, 0xFFFFFFFF).astype(np.uint32))
            n = [int((s[3] == c).sum()) for c in (1, 2, 3, 4)] + [int((s[3] > 0).sum())]
            yield from _fact_rows([(r, TOTAL, None, None, n)])

    return rows.repartitionById(len(starts) - 1, F.col("range")).mapInArrow(run, FACTS)


def _totals(rows: DataFrame) -> list[int]:
    """The sums of the five numbers in the rows of kind ``TOTAL``."""
    got = rows.filter(F.col("kind") == TOTAL).agg(*[F.coalesce(F.sum(F.col("stats")[k]), F.lit(0)).alias(f"s{k}") for k in range(5)]).first()
    return list(got)


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count ``docs`` and write the model's files below the shared folder."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "llm-lm")
    docs = docs.select(F.col(text_col).alias("text"))
    vocabulary = staged(count_words(docs), "words")
    n_words, n_tokens = vocabulary.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if n_words >= 1 << 32:
        raise ValueError("word numbers have 32 bits")
    if not n_words:
        return Model(folder, np.zeros(1, np.int64), 0, 0, 0)
    n_docs = vocabulary.filter(F.col("h") == int(np.uint64(word_hash(END)).astype(np.int64))).first()["n"]
    # the begin has a number but is no word: no text contains it, and it counts nothing
    vocabulary = vocabulary.union(spark.range(1).select(F.lit(int(np.uint64(word_hash(BEGIN)).astype(np.int64))), F.lit(0)))
    files = 1 << _bits(max(MIN_FILES, n_words // WORDS_PER_FILE))
    sizes = np.zeros(files, np.int64)
    for r in _write_words(vocabulary, files, folder).collect():
        sizes[r["file"]] = r["words"]
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    ranges = min(files, 1 << _bits(max(MIN_FILES, n_words // WORDS_PER_RANGE)))
    starts = firsts[::files // ranges]

    bits = _bits(max(MIN_FILES, n_tokens // TOKENS_PER_FILE))
    task_bits = max(min(bits, _bits(MIN_FILES)), bits - TASK_BITS)
    blocks = _count_pairs(docs, folder, firsts, min(bits, PIECE_BITS))
    if bits > PIECE_BITS:
        blocks = _cut_finer(blocks, PIECE_BITS, bits, 1 << task_bits)
    rows = staged(_write_pairs(blocks, bits, task_bits, folder, starts), "pairs")
    sums = _totals(rows)
    facts = rows.filter(F.col("kind") != TOTAL)
    salts = max(1, (1 << bits) // FILES_PER_SALT)
    if salts > 1:
        facts = _sum_facts(facts, starts, salts)
    # the rows are written once: an aggregate that runs again would write the files again
    follows = _totals(staged(_write_facts(facts, starts, firsts, folder), "facts"))
    by_pair, by_word = discounts(sums[1:]), discounts(follows[:4])
    # mass that the discounts leave for words as such, spread over the vocabulary and the unknown word
    once, twice = follows[:2]
    spread = float(by_word[1] * once + by_word[2] * twice + by_word[3] * (follows[4] - once - twice)) / sums[0]
    return Model(folder, firsts, n_words, n_tokens, n_docs, 1 << bits, by_pair, by_word, sums[0], spread)


class Scorer:
    """Log10 probabilities of texts; one per task."""

    def __init__(self, model: Model):
        self.model, self.words = model, Vocabulary(model.folder, model.firsts)
        self.files = self.words.files

    def word_facts(self, ids: np.ndarray) -> np.ndarray:
        """(count, followers once, twice, more, words followed) of ascending word numbers."""
        out = np.zeros((5, len(ids)), np.int64)
        firsts = self.model.firsts
        part = np.searchsorted(firsts, ids, side="right") - 1
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]) if len(part) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            i = int(part[a])
            at = ids[a:b] - firsts[i]
            out[0, a:b] = self.words.arrays(i)[1][at]
            for k, column in enumerate(self.files.columns(file_name("facts", i), *[np.uint32] * 4)):
                out[k + 1, a:b] = column[at]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of ascending pair hashes."""
        out = np.zeros(len(keys), np.int64)
        for i, run in _slices(keys, _bits(self.model.pair_files)):
            name = file_name("pairs", i)
            if not self.files.exists(name):  # no pair of the training texts is in this range
                continue
            there, counts = self.files.columns(name, np.uint64, np.uint32)
            at = np.minimum(np.searchsorted(there, keys[run]), len(there) - 1)
            out[run] = np.where(there[at] == keys[run], counts[at], 0)
        return out

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, known tokens, base score and model score per text."""
        m = self.model
        if not m.n_words:
            sizes = np.array([len(words_of(t)) + 1 for t in texts], np.int64)
            return sizes, np.zeros_like(sizes), np.zeros(len(sizes)), np.zeros(len(sizes))
        previous, word, sizes = self.words.pairs(texts)
        ids, back = np.unique(np.concatenate([previous, word]), return_inverse=True)
        known = ids >= 0
        facts = np.zeros((5, len(ids)), np.int64)
        facts[:, known] = self.word_facts(ids[known])
        before, now = facts[:, back[:len(word)]], facts[:, back[len(word):]]
        base = np.log10((now[0] + 0.5) / (m.n_tokens + 0.5 * (m.n_words + 1)))
        # the word by itself: how many different words it follows, and the spread mass
        follows = now[4]
        p = np.maximum(follows - m.word_discounts[np.minimum(follows, 3)], 0) / m.n_pairs + m.spread / (m.n_words + 1)
        begin = self.words.of([BEGIN])[0]
        seen = np.where(previous == begin, m.n_docs, before[0])  # how often the previous word precedes a token
        both = (previous >= 0) & (word >= 0)
        keys, at = np.unique(pair_hash(previous[both], word[both]), return_inverse=True)
        count = np.zeros(len(word), np.int64)
        count[both] = self.pair_counts(keys)[at]
        d = m.pair_discounts
        left = d[1] * before[1] + d[2] * before[2] + d[3] * before[3]
        p = np.where(seen > 0, (np.maximum(count - d[np.minimum(count, 3)], 0) + left * p) / np.maximum(seen, 1), p)
        ends = np.cumsum(sizes) - sizes
        add = lambda x: np.add.reduceat(x, ends)  # noqa: E731  every text has a token
        return sizes, add((now[0] > 0).astype(np.int64)), add(base), add(np.log10(p))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", held_out=None) -> DataFrame:
    """Per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in chunked(texts, CHUNK):
                n, known, base, own = scorer.score(texts[i:j])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"), pa.array(n), pa.array(known),
                    pa.array(np.full(j - i, scorer.model.n_tokens, np.int64)), pa.array(base), pa.array(own)],
                    [c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), (F.lit(False) if held_out is None else held_out).alias("held_out"),
                       F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 5) == 1
    return score(docs, train(docs.filter(~held_out)), held_out=held_out)


SQL = None
