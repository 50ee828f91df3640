"""Quality classifier: a linear-chain CRF over the lines of a text.

Every line is good or bad; its features are its own shape (length, symbols, capitals,
repetition, ...) and that of its neighbours, and a transition weight per label lets runs of
lines agree. The score of a document is the length-weighted mean of the lines' marginal
probabilities of good, from forward-backward.

Lines inherit their document's label for learning. The model (a few dozen numbers) is
fitted by maximum likelihood on at most about ``MAX_TRAIN`` labelled documents, chosen by a
hash of the id. A longer one is learned as chains of ``MAX_LINES`` lines in a row, each with
its label; where the chosen documents have more than ``MAX_TRAIN`` chains, about so many of
them are drawn, long and short ones alike. These bound the fit and nothing else.

Defined cases: a NULL or empty text, or one of blank lines, is one empty line; without
labels every score is 0.5, with labels of one kind only it is that kind's (0 or 1);
a document with several label rows counts once for each; NULL labels teach nothing; equal
rows get equal scores. Only the id and text columns, and ``quality`` of the labels, are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, fresh_name, rows_kept, staged, table
from tidemark.llm.shingles import chunked

NAME = "op10_quality"
MAX_TRAIN, MAX_LINES = 6_000, 400
STEPS, RATE, RIDGE = 250, 0.15, 1e-3
THRESHOLD = 0.3
SYMBOLS = b"!#$%&*@^~|=+<>{}[]\\/_`"
CAPITALS, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
OWN = 10  # features of a line itself
NEAR = (2, 3, 5, 6)  # of these also the neighbours' values are features
SIZE = OWN + 2 * len(NEAR)


def line_features(line: bytes, words: list[bytes], seen: bool) -> tuple[float, ...]:
    n, k = max(1, len(line)), max(1, len(words))
    return (1.0, np.log1p(len(words)) / 3, (n - len(line.translate(None, SYMBOLS))) / n * 5 if line else 0.0,
            (n - len(line.translate(None, CAPITALS))) / n * 2 if line else 0.0,
            (n - len(line.translate(None, DIGITS))) / n * 5 if line else 0.0,
            len(set(words)) / k, line.count(b"|") / k, min(3.0, len(line) / k / 8),
            1.0 if line[-1:] in b".!?" and line else 0.0, float(seen))


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature rows and lengths of all lines, and lines per text."""
    rows, lengths, sizes = [], [], []
    for text in texts:
        lines = [x for x in (text or "").encode().split(b"\n") if x.strip()] or [b""]
        seen: set[bytes] = set()
        for line in lines:
            rows.append(line_features(line, line.split(), line in seen))
            lengths.append(max(1, len(line)))
            seen.add(line)
        sizes.append(len(lines))
    own, sizes = np.array(rows, np.float64).reshape(-1, OWN), np.array(sizes, np.int64)
    near = own[:, NEAR]
    ends = np.cumsum(sizes)
    before, after = np.zeros_like(near), np.zeros_like(near)
    before[1:], after[:-1] = near[:-1], near[1:]
    before[ends[:-1]] = 0  # a text's first line has no line before it
    after[ends - 1] = 0
    return np.hstack([own, before, after]), np.array(lengths, np.float64), sizes


class Lockstep:
    """Sequences laid out so that step t of all of them is one slice; longest first."""

    def __init__(self, sizes: np.ndarray):
        order = np.argsort(-sizes, kind="stable")
        ordered, starts = sizes[order], (np.cumsum(sizes) - sizes)[order]
        self.steps = int(ordered[0]) if len(ordered) else 0
        self.live = len(ordered) - np.searchsorted(ordered[::-1], np.arange(self.steps), side="right")
        base = np.concatenate([[0], np.cumsum(self.live)]).astype(int)
        self.at = [slice(base[t], base[t + 1]) for t in range(self.steps)]
        step = np.repeat(np.arange(self.steps), self.live)
        place = np.arange(len(step)) - base[step]
        self.index = starts[place] + step  # of each entry: its row in the flat order


def marginals(score: np.ndarray, steps: Lockstep, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and the expected number of (bad, bad) and (good, good) steps.

    ``score`` is the lines' weight for good (bad has 0); ``stay`` the weights of staying bad and good.
    """
    s = score[steps.index]
    ahead, back = np.zeros((len(s), 2)), np.zeros((len(s), 2))
    for t, at in enumerate(steps.at):
        if t == 0:
            ahead[at, 1] = s[at]
            continue
        last = ahead[steps.at[t - 1]][:steps.live[t]]
        ahead[at, 0] = np.logaddexp(last[:, 0] + stay[0], last[:, 1])
        ahead[at, 1] = np.logaddexp(last[:, 0], last[:, 1] + stay[1]) + s[at]
    pairs = np.zeros(2)
    for t in range(steps.steps - 2, -1, -1):
        here, then, n = steps.at[t], steps.at[t + 1], steps.live[t + 1]
        good, bad = s[then] + back[then, 1], back[then, 0]
        b = back[here]
        b[:n, 0] = np.logaddexp(bad + stay[0], good)
        b[:n, 1] = np.logaddexp(bad, good + stay[1])
        a = ahead[here][:n]
        z = np.logaddexp(a[:, 0] + b[:n, 0], a[:, 1] + b[:n, 1])
        pairs += [np.exp(a[:, 0] + stay[0] + bad - z).sum(), np.exp(a[:, 1] + stay[1] + good - z).sum()]
    total = ahead + back
    out = np.empty(len(score))
    out[steps.index] = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))
    return out, pairs


class Model:
    """Weights of the chain; ``constant`` instead where there was nothing to tell apart."""

    def __init__(self, weights: np.ndarray | None, stay: np.ndarray | None, constant: float | None = None):
        self.weights, self.stay, self.constant = weights, stay, constant

    @classmethod
    def of(cls, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> Model:
        """Maximum likelihood by Adam; ``labels`` (0 or 1) per document."""
        if not len(labels) or labels.min() == labels.max():
            return cls(None, None, float(labels[0]) if len(labels) else 0.5)
        steps, y = Lockstep(sizes), np.repeat(labels, sizes).astype(float)
        real = np.array([((sizes - 1) * (labels == 0)).sum(), ((sizes - 1) * (labels == 1)).sum()], float)
        theta = np.zeros(x.shape[1] + 2)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for i in range(1, STEPS + 1):
            p, pairs = marginals(x @ theta[:-2], steps, theta[-2:])
            grad = np.concatenate([x.T @ (y - p), real - pairs]) / len(y) - RIDGE * theta
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
            theta = theta + RATE * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-9)
        return cls(theta[:-2], theta[-2:])

    def lines(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) and length of every line, and lines per text."""
        x, lengths, sizes = features(texts)
        if self.weights is None:
            return np.full(len(x), self.constant), lengths, sizes
        return marginals(x @ self.weights, Lockstep(sizes), self.stay)[0], lengths, sizes


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_train: int = MAX_TRAIN) -> Model:
    """Model of about ``max_train`` of the labelled ``docs``; ``labels`` has doc_id and quality."""
    labels = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("id").isNotNull())
    known = labels.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    share = min(1.0, max_train / max(1, known.count()))
    chosen = labels.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20)).join(chosen, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _, sizes = features(batch.column("text").to_pylist())
            parts = np.split(x.astype(np.float32), np.cumsum(sizes)[:-1]) if len(sizes) else []
            rows = [(i, y, k // MAX_LINES, part[k:k + MAX_LINES].tobytes()) for i, y, part in zip(
                batch.column("id").to_pylist(), batch.column("label").to_pylist(), parts) for k in range(0, len(part), MAX_LINES)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())],
                                             ["id", "label", "chain", "x"])

    chains = staged(sample.select(F.col("id").cast("bigint"), "label", "text").mapInArrow(
        run, "id bigint, label int, chain int, x binary"), "chains")
    share = min(1.0, max_train / max(1, chains.count()))
    rows = chains.filter(F.pmod(F.xxhash64("id", "chain"), F.lit(1 << 20)) < share * (1 << 20)).collect()
    rows.sort(key=lambda r: (r["id"], r["label"], r["x"]))  # the fit does not depend on the order of tasks
    if not rows:
        return Model(None, None, 0.5)
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, SIZE) for r in rows]
    return Model.of(np.concatenate(x).astype(float), np.array([len(a) for a in x]), np.array([r["label"] for r in rows]))


def document_scores(texts: list[str | None], model: Model) -> tuple[np.ndarray, list[np.ndarray]]:
    """Score of every text, and P(good) of its lines."""
    good, lengths, sizes = model.lines(texts)
    firsts = np.cumsum(sizes) - sizes
    out = np.add.reduceat(good * lengths, firsts) / np.add.reduceat(lengths, firsts)
    return np.clip(out, 0, 1), np.split(good, firsts[1:])


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` whose score reaches ``threshold``."""
    def keep(texts: list[str | None]) -> list[bool]:
        return [bool(s >= threshold) for i, j in chunked(texts) for s in document_scores(texts[i:j], model)[0]]

    return rows_kept(docs, text_col, lambda: keep)


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", threshold: float = THRESHOLD,
          lines: bool = False) -> DataFrame:
    """``keep`` columns of ``docs`` with score and predicted; ``lines`` adds P(good) of every line."""
    hidden = fresh_name(keep, "_text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    extra = ["line_scores array<double>"] if lines else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(hidden).to_pylist()
            for i, j in chunked(texts):
                out, good = document_scores(texts[i:j], model)
                part = batch.slice(i, j - i)
                arrays = [*(part.column(k) for k in keep), pa.array(out, pa.float64()), pa.array(out >= threshold).cast(pa.int32())]
                if lines:
                    arrays.append(pa.array([a.tolist() for a in good], pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays(arrays, [*keep, "score", "predicted", *(["line_scores"] if lines else [])])

    return docs.select(*keep, F.col(text_col).alias(hidden)).mapInArrow(
        run, ", ".join([*fields, "score double", "predicted int", *extra]))


def held_out():
    return crc_mod(F.col("doc_id"), 5) == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()), table(spark, sf_dir, "labels"))
    return score(docs.withColumn("held_out", held_out()), model, ["doc_id", "held_out"])


SQL = None
