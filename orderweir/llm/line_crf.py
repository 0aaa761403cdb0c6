"""Quality of documents from a linear-chain conditional random field over their lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweir.llm.common import utf8
from orderweir.llm.words import NOT_SPACE, groups, scan

#: Labelled documents the field is fitted on, at most (those of the smallest seeded hash of their id).
MAX_LABELLED = 6_000
#: Documents of more lines are scored like others but train nothing, which bounds the training rows.
MAX_TRAIN_LINES = 500
#: Steps of each measure of a line: shares of bytes, share of repeated words, bytes a word, words.
SHARES = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.4])
STEPS = [SHARES] * 6 + [np.array([0.0, 2, 4, 6, 8, 12, 20]), np.array([0.0, 1, 3, 6, 12, 25, 50]), np.array([0.5])]
BASES = np.concatenate(([0], np.cumsum([len(s) + 1 for s in STEPS])))
#: Features of one line, and the number that stands for a neighbour that does not exist.
WIDTH = int(BASES[-1]) + 1
NO_LINE = WIDTH - 1
SIZE = 3 * WIDTH

CLASSES = [
    np.array([65 <= b <= 90 for b in range(256)]),
    np.array([chr(b) in "#$%&*|<>{}=@!^~\\_+" for b in range(256)]),
    np.array([48 <= b <= 57 for b in range(256)]),
    np.array([chr(b) in ".,;:'\"-?()" for b in range(256)]),
    np.array([b >= 128 for b in range(256)]),
]
END_MARK = np.array([chr(b) in ".!?:" for b in range(256)])


@dataclass
class Lines:
    """Lines of a group of texts: text i has the lines bounds[i] to bounds[i + 1]; own: feature numbers."""

    bounds: np.ndarray
    size: np.ndarray
    own: np.ndarray


def lines_of(texts: list[bytes]) -> Lines:
    """Every line of the texts, measured over its whole length and turned into one feature per measure."""
    found = scan(texts, NOT_SPACE)
    end = np.flatnonzero(found.raw == 10)
    start = np.concatenate(([0], end[:-1] + 1))
    size = end - start
    per_byte = np.maximum(size, 1)
    within = lambda mask: (lambda c: c[end] - c[start])(np.concatenate(([0], np.cumsum(mask))))
    measures = [within(kind[found.raw]) / per_byte for kind in CLASSES]
    first, last = np.searchsorted(found.starts, start), np.searchsorted(found.starts, end)
    words = last - first
    hashes = found.hashes()
    again = np.concatenate(([0, 0], np.cumsum(hashes[1:] == hashes[:-1]))) if len(hashes) else np.zeros(1, int)
    repeated = np.where(words > 1, again[last] - again[np.minimum(first + 1, len(again) - 1)], 0)
    measures.append(repeated / np.maximum(words, 1))
    letters = np.concatenate(([0], np.cumsum(found.ends - found.starts)))
    measures.append((letters[last] - letters[first]) / np.maximum(words, 1))
    measures.append(words)
    measures.append(END_MARK[found.raw[np.maximum(end - 1, 0)]] & (size > 0))
    own = np.stack([base + np.searchsorted(s, m, "left") for base, s, m in zip(BASES, STEPS, measures)], axis=1)
    return Lines(np.searchsorted(start, found.offsets), size, own)


def with_neighbours(lines: Lines) -> np.ndarray:
    """Feature numbers of each line, the line before and the line after in the same text."""
    n, k = lines.own.shape
    before, after = np.full((n, k), NO_LINE), np.full((n, k), NO_LINE)
    before[1:], after[:-1] = lines.own[:-1], lines.own[1:]
    before[lines.bounds[:-1]] = NO_LINE
    after[lines.bounds[1:] - 1] = NO_LINE
    return np.concatenate((lines.own, before + WIDTH, after + 2 * WIDTH), axis=1)


@dataclass
class Field:
    """Weights of the features for a good line, log potentials of (line, next line), and the share of label 1."""

    weights: np.ndarray
    steps: np.ndarray
    prior: float


def _plus(x: np.ndarray, a: float, b: float, c: float, d: float) -> np.ndarray:
    """log((exp(a) + exp(x + b)) / (exp(c) + exp(x + d)))"""
    return np.logaddexp(a, x + b) - np.logaddexp(c, x + d)


def log_odds(good: np.ndarray, bounds: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds of good against bad lines, all texts in step.

    Texts go by falling number of lines, so at each step the unfinished ones are a prefix. The
    forward value of a line includes its own potential, the backward value does not.
    """
    count = np.diff(bounds)
    order = np.argsort(-count, kind="stable")
    first, count = bounds[:-1][order], count[order]
    most = int(count[0]) if len(count) else 0
    active = np.searchsorted(-count, -np.arange(1, most + 1), "right")
    ahead, back = good.astype(float).copy(), np.zeros(len(good))
    for t in range(1, most):
        at = first[: active[t]] + t
        ahead[at] += _plus(ahead[at - 1], steps[0, 1], steps[1, 1], steps[0, 0], steps[1, 0])
    for t in range(most - 1, 0, -1):
        at = first[: active[t]] + t
        back[at - 1] = _plus(good[at] + back[at], steps[1, 0], steps[1, 1], steps[0, 0], steps[0, 1])
    return ahead, back


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_field(features: np.ndarray, bounds: np.ndarray, labels: np.ndarray, rounds: int = 150) -> Field:
    """Maximum likelihood of the lines' labels (those of their documents) with L2, by Adam."""
    prior = float((labels.sum() + 1) / (len(labels) + 2))
    if not len(labels) or labels.min() == labels.max():
        return Field(np.zeros(SIZE), np.zeros((2, 2)), prior)
    count = np.diff(bounds)
    y = np.repeat(labels, count).astype(float)
    inner = np.ones(len(y), bool)
    inner[bounds[:-1]] = False
    at = np.flatnonzero(inner)  # lines with one before
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)
    value, first, second = np.zeros(SIZE + 4), np.zeros(SIZE + 4), np.zeros(SIZE + 4)
    flat = features.ravel()
    for step in range(1, rounds + 1):
        weights, steps = value[:SIZE], value[SIZE:].reshape(2, 2)
        good = weights[features].sum(axis=1)
        ahead, back = log_odds(good, bounds, steps)
        error = sigmoid(ahead + back) - y
        slope = np.bincount(flat, weights=np.repeat(error, features.shape[1]), minlength=SIZE)
        pair = np.stack([steps[i, j] + i * ahead[at - 1] + j * (good[at] + back[at]) for i in (0, 1) for j in (0, 1)])
        pair = np.exp(pair - pair.max(axis=0))
        pair = (pair / pair.sum(axis=0)).sum(axis=1) - seen.ravel()
        slope = np.concatenate((slope, pair)) / len(y) + 1e-4 * value
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        value = value - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Field(value[:SIZE], value[SIZE:].reshape(2, 2), prior)


def qualities(field: Field, texts: list[bytes]) -> np.ndarray:
    """Share of each text's bytes that stand in good lines, by the lines' marginals; the prior without any."""
    if not field.weights.any():
        return np.full(len(texts), field.prior)
    lines = lines_of(texts)
    good = field.weights[with_neighbours(lines)].sum(axis=1)
    ahead, back = log_odds(good, lines.bounds, field.steps)
    of = np.repeat(np.arange(len(texts)), np.diff(lines.bounds))
    total = np.bincount(of, weights=lines.size, minlength=len(texts))
    sound = np.bincount(of, weights=lines.size * sigmoid(ahead + back), minlength=len(texts))
    return np.where(total > 0, sound / np.maximum(total, 1), field.prior)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learned; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Field:
    """Fitted on at most `most` labelled documents that are not held out, of at most MAX_TRAIN_LINES lines."""
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    sample = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = sample.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(most)
    texts = docs.select("doc_id", utf8().alias("text")).join(F.broadcast(sample), "doc_id")  # at most `most` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            for first, texts in groups(batch, place):
                lines = lines_of(texts)
                rows = [lines.own[a:b].astype(np.uint8).tobytes() if b - a <= MAX_TRAIN_LINES else None
                        for a, b in zip(lines.bounds[:-1], lines.bounds[1:])]
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("quality").cast(pa.int32()), pa.array(rows, pa.binary())],
                    names=["doc_id", "quality", "own"],
                )

    rows = texts.mapInArrow(run, "doc_id long, quality int, own binary").where("own is not null").toArrow()
    where = np.unique(rows["doc_id"].to_numpy(), return_index=True)[1]
    own = [np.frombuffer(rows["own"][i].as_py(), np.uint8).reshape(-1, len(STEPS)).astype(np.int64) for i in where.tolist()]
    bounds = np.concatenate(([0], np.cumsum([len(o) for o in own]))).astype(np.int64)
    if not own:
        return fit_field(np.zeros((0, 0), np.int64), bounds, np.zeros(0, np.int64))
    lines = Lines(bounds, np.zeros(bounds[-1]), np.concatenate(own))
    return fit_field(with_neighbours(lines), bounds, rows["quality"].to_numpy()[where].astype(np.int64))


def score(docs: DataFrame, field: Field, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch):
                ids = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(qualities(field, texts))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), utf8().alias("text")).mapInArrow(run, "doc_id long, score double")
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher is better), predicted.

    Lines are measured (capitals, symbols, digits, punctuation, repeated words, sizes); a line
    sees its own measures and those of both neighbours. The field learns each line's label from its
    document's; forward-backward gives the probability that a line is good, and a document's
    score is the mean over its bytes.

    * null id: counts as empty text for the split; null or empty text: the share of label 1; null labels:
      not learned; ids labelled twice: the larger label; repeated rows: one result each; very long
      texts: all lines.
    * no labels: every document scores 0.5; one value only: nearly that value. Empty documents: empty
      result. Other columns are not read.
    """
    return score(docs, train(docs, labels))
