"""Toxicity by a classifier chain of linear models."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.llm.common import utf8
from orderweir.llm.words import LETTERS, MIX, NOT_SPACE, groups, scan
from orderweir.session import stored

#: Words are numbered by hash; the last 30 numbers are for the look of the text.
LOOKS = 1 << 18
FEATURES = LOOKS + 30
MASK = np.uint64(LOOKS - 1)
#: Labelled rows the chain is fitted on, at most (those of the smallest seeded hash of their id).
MAX_LABELLED = 8_000
FOLDS = 3
#: Longer words also count by their first bytes.
PREFIX = 6
#: A word enters a model if its documents' labels differ this many standard deviations from chance.
LEAST_Z = 4.0
#: No category is called on a lower probability.
LEAST_THRESHOLD = 0.25
#: The chain of the documents' labels: later categories see the probabilities of earlier ones.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}

SYMBOL = np.array([chr(b) in "#$%&*|<>{}=@!^~\\" for b in range(256)])


def features(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted feature numbers of each whole text: its words, their beginnings, and how it looks in ten steps."""
    found = scan(texts, LETTERS)
    kinds = [found.hashes() & MASK, (found.hashes(PREFIX) ^ MIX) & MASK]
    upper = np.concatenate(([0], np.cumsum((found.raw >= 65) & (found.raw <= 90))))
    marks = np.concatenate(([0], np.cumsum(SYMBOL[found.raw])))
    tokens = scan(texts, NOT_SPACE)
    hashes = tokens.hashes()
    again = np.concatenate(([0, 0], np.cumsum(hashes[1:] == hashes[:-1])))
    out = []
    for i in range(len(texts)):
        first, last = found.bounds[i : i + 2]
        start, size = found.offsets[i], max(len(texts[i]), 1)
        one, end = tokens.bounds[i : i + 2]
        looks = (
            (upper[start + len(texts[i])] - upper[start]) / size,
            (marks[start + len(texts[i])] - marks[start]) / size,
            (again[end] - again[one + 1]) / (end - one) if end > one else 0.0,
        )
        steps = [LOOKS + 10 * k + min(int(share * 20), 9) for k, share in enumerate(looks)]
        own = np.concatenate([k[first:last] for k in kinds]).astype(np.uint32)
        out.append(np.unique(np.concatenate((own, np.array(steps, np.uint32)))))
    return out


@dataclass
class Linear:
    """weights of features, of the earlier probabilities, and the intercept"""

    numbers: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def score(self, found: np.ndarray, probabilities: list[float]) -> float:
        spot = np.searchsorted(self.numbers, found)
        spot[spot == len(self.numbers)] = 0
        hit = spot[self.numbers[spot] == found] if len(self.numbers) else spot[:0]
        margin = self.intercept + float(self.weights[hit].sum()) + float(np.dot(self.earlier, probabilities))
        return 1 / (1 + np.exp(-min(max(margin, -30.0), 30.0)))


@dataclass
class Sample:
    """Labelled documents: document i has the features column[bounds[i] : bounds[i + 1]], sorted."""

    column: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def row(self, i: int) -> np.ndarray:
        return self.column[self.bounds[i] : self.bounds[i + 1]]


def sample_of(rows: list[np.ndarray]) -> Sample:
    """Without the features that are too rare to enter any model, which are most of them."""
    seen = np.zeros(FEATURES, np.int32)
    for row in rows:
        seen[row] += 1
    rows = [row[seen[row] >= LEAST_Z] for row in rows]
    bounds = np.concatenate(([0], np.cumsum([len(row) for row in rows]))).astype(np.int64)
    return Sample(np.concatenate(rows) if rows else np.empty(0, np.uint32), bounds)


def fit_linear(sample: Sample, own: np.ndarray, labels: np.ndarray, earlier: np.ndarray) -> Linear:
    """Logistic regression with L2 on the words that differ from chance; a constant if one label is missing.

    own: which documents of the sample; labels and earlier probabilities are theirs.
    """
    n = len(own)
    positive = labels.mean() if n else 0.0
    constant = float(np.log((labels.sum() + 0.5) / (n - labels.sum() + 0.5))) if n else 0.0
    if n == 0 or positive in (0.0, 1.0):
        return Linear(np.empty(0, np.uint32), np.empty(0), np.zeros(earlier.shape[1]), constant)
    seen, with_label = np.zeros(FEATURES), np.zeros(FEATURES)
    for i, label in zip(own, labels):
        seen[sample.row(i)] += 1
        with_label[sample.row(i)] += label
    z = np.abs(with_label - seen * positive) / np.sqrt(seen * positive * (1 - positive) + 1)
    numbers = np.flatnonzero(z >= LEAST_Z).astype(np.uint32)
    place = np.full(FEATURES, -1, np.int32)
    place[numbers] = np.arange(len(numbers))
    used = [place[sample.row(i)] for i in own]
    used = [p[p >= 0] for p in used]
    row = np.repeat(np.arange(n), [len(p) for p in used])
    column = np.concatenate(used)
    weights, chain, intercept = np.zeros(len(numbers)), np.zeros(earlier.shape[1]), constant
    size = len(numbers) + earlier.shape[1] + 1
    first, second = np.zeros(size), np.zeros(size)
    for step in range(1, 501):  # Adam on the whole sample
        margin = intercept + np.bincount(row, weights=weights[column], minlength=n) + earlier @ chain
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / n
        slope = np.concatenate(
            (np.bincount(column, weights=error[row], minlength=len(numbers)) + 5e-5 * weights,
             earlier.T @ error + 5e-5 * chain, [error.sum()])
        )
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights -= move[: len(numbers)]
        chain -= move[len(numbers) : -1]
        intercept -= move[-1]
    return Linear(numbers, weights, chain, float(intercept))


@dataclass
class Chain:
    names: list[str]
    models: list[Linear]
    thresholds: list[float]

    def probabilities(self, found: np.ndarray) -> list[float]:
        out: list[float] = []
        for model in self.models:
            out.append(model.score(found, out))
        return out


def fit_chain(names: list[str], sample: Sample, labels: np.ndarray, folds: np.ndarray) -> Chain:
    """labels: one column per category, NaN where unknown; folds: the fold of each document.

    A later model is trained on out-of-fold probabilities of the earlier categories, since those
    of a model's own training rows are too good. The threshold of a category is the one of
    best F1 on out-of-fold probabilities, LEAST_THRESHOLD at least.
    """
    held = np.zeros((len(sample), 0))
    models, thresholds = [], []
    for k in range(len(names)):
        known = ~np.isnan(labels[:, k])
        fit = lambda own: fit_linear(sample, own, labels[own, k], held[own])  # noqa: B023, E731
        out = np.zeros(len(sample))
        for fold in range(FOLDS):
            model = fit(np.flatnonzero(known & (folds != fold)))
            for i in np.flatnonzero(folds == fold):
                out[i] = model.score(sample.row(i), held[i])
        models.append(fit(np.flatnonzero(known)))
        thresholds.append(best_threshold(out[known], labels[known, k]))
        held = np.column_stack((held, out))
    return Chain(list(names), models, thresholds)


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(labels[order])
    if not len(order) or hits[-1] == 0:
        return 1.0
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + hits[-1])
    return float(min(max(scores[order][np.argmax(f1)], LEAST_THRESHOLD), 0.95))


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES, most: int = MAX_LABELLED) -> Chain:
    """A chain fitted on at most `most` labelled ids, which are taken by a seeded hash of the id.

    One task fits it on the features of these documents; the driver sees the finished models only. An id
    with several labels counts as positive if one of them is; of an id with several texts the one of smallest features trains.
    """
    names = list(categories)
    known = labels.where("doc_id is not null").select("doc_id", *[F.expr(e).cast("double").alias(f"y_{c}") for c, e in categories.items()])
    known = known.groupBy("doc_id").agg(*[F.max(f"y_{c}").alias(f"y_{c}") for c in names])
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(4)), "doc_id").limit(most)
    texts = docs.select("doc_id", utf8().alias("text")).join(F.broadcast(sample), "doc_id")  # at most `most` ids
    kind = "doc_id long, found binary, " + ", ".join(f"y_{c} double" for c in names)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            rows = [found.tobytes() for _, texts in groups(batch, place) for found in features(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(rows, pa.binary()), *(batch.column(f"y_{c}") for c in names)],
                names=["doc_id", "found", *(f"y_{c}" for c in names)],
            )

    shape = pa.schema([("doc_id", pa.int64()), ("found", pa.binary()), *((f"y_{c}", pa.float64()) for c in names)])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, shape)
        ids, where = np.unique(rows["doc_id"].to_numpy(), return_index=True)
        folds = np.array([zlib.crc32(b"%d" % i) % FOLDS for i in ids], int)
        columns = [rows[f"y_{c}"].to_numpy().astype(float)[where] for c in names]
        sample = sample_of([np.frombuffer(rows["found"][i].as_py(), np.uint32) for i in where.tolist()])
        chain = fit_chain(names, sample, np.stack(columns, axis=1), folds)
        # Functions and classes travel by value, so a chain comes back as the arrays it is made of.
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(astuple(chain))], pa.binary())], names=["chain"])

    rows = stored(texts.mapInArrow(found, kind).dropDuplicates(["doc_id", "found"]), "toxic-sample")
    fitted = rows.repartition(1).sortWithinPartitions("doc_id", "found").mapInArrow(fit, "chain binary").first()
    if fitted:
        names, models, thresholds = pickle.loads(fitted["chain"])
        return Chain(names, [Linear(*model) for model in models], thresholds)
    return fit_chain(names, sample_of([]), np.empty((0, len(names))), np.empty(0, int))


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, p_<category> for each, and <category>: whether its threshold is reached."""
    names = chain.names
    kind = "doc_id long, " + ", ".join([*(f"p_{c} double" for c in names), *(f"{c} boolean" for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [chain.probabilities(found) for _, texts in groups(batch) for found in features(texts)]
            columns = np.array(rows).reshape(len(rows), len(names)).T
            over = [column >= limit for column, limit in zip(columns, chain.thresholds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns), *map(pa.array, over)],
                names=["doc_id", *(f"p_{c}" for c in names), *names],
            )

    return docs.select(F.col("doc_id").cast("long"), utf8().alias("text")).mapInArrow(run, kind)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Probabilities of the categories for every document, one row each.

    Models: words (ASCII lower case, without punctuation) and the look of the whole text, in a chain
    of logistic regressions; each later one also sees the probabilities of the earlier categories.

    * null id: scored as any other; null or empty text: scored by the intercepts; null label: the
      row does not train that category; ids labelled twice: the highest label counts; repeated rows: each document is
      scored, one row per id trains, whatever the order of rows; very long texts: whole.
    * no labels, or only one value: the category's probability is constant and nothing reaches the threshold
      unless all labels say so. Empty documents: empty result. Other columns are not read.
    """
    return score(docs, train(docs, labels))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the chain does not call toxic; rows without id stay."""
    verdicts = classify(docs, labels).where("toxic and doc_id is not null").select(F.col("doc_id").alias("_toxic"))
    verdicts = stored(verdicts.distinct(), "toxic")
    return docs.join(verdicts, docs["doc_id"] == verdicts["_toxic"], "left_anti")
