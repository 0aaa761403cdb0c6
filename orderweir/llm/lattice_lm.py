"""LM scoring by subword lattice likelihood."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweir.llm.common import utf8
from orderweir.llm.words import BYTE_VALUES, NOT_SPACE, Lookup, groups, mixed, powers, scan
from orderweir.session import stored

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Frequent words whose count and probability are sent to all tasks; all others are joined.
HEAD_WORDS = 200_000
#: Pseudo-count of every piece, and the offset of the rank in the weights before training.
PRIOR, RANK_OFFSET = 0.1, 2.7
SPACE = "▁".encode()


@dataclass
class Pieces:
    """A unigram vocabulary: pieces in bytes, single bytes, and an end of text; log probabilities (natural)."""

    bodies: list[bytes]
    log_p: np.ndarray
    log_byte: np.ndarray
    log_end: float

    lookup: Lookup | None = None
    lengths: tuple[int, ...] = ()

    def prepare(self) -> Pieces:
        """The same with an index of the pieces, which is not sent to tasks but built there."""
        found = scan(self.bodies, np.arange(256) != 10)
        return replace(self, lookup=Lookup(found.hashes()), lengths=tuple(sorted({len(b) for b in self.bodies})))


def read_pieces(path: str = VOCABULARY) -> Pieces:
    """The vocabulary's pieces, weighed by the rank that its scores give them.

    Left out: pieces that no text in lower case can use, and those that go over the start of a word.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        (-model.get_score(i), model.id_to_piece(i).encode())
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    ]
    pieces = sorted(p for p in pieces if p[1] == p[1].lower() and SPACE not in p[1][1:] and b"\n" not in p[1])
    weight = 1 / (np.arange(len(pieces)) + RANK_OFFSET)
    log_p = np.log(0.95 * weight / weight.sum())
    return Pieces([b for _, b in pieces], log_p, np.full(256, np.log(0.04 / 256)), float(np.log(0.01)))


@dataclass
class Lattice:
    """All segmentations of some words; word w has the nodes first[w] to first[w] + size[w]."""

    pieces: Pieces
    buffer: np.ndarray
    first: np.ndarray
    size: np.ndarray
    edges: list[tuple[int, np.ndarray, np.ndarray]]
    alpha: np.ndarray

    def totals(self) -> np.ndarray:
        """Log probability of each word: the sum over all its segmentations."""
        return self.alpha[self.first + self.size]


def lattice(pieces: Pieces, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Lattice:
    """Forward recursion in log space over the words low[starts:ends], each with a space sign before it.

    Words go by falling size, so that at each step the unfinished ones are a prefix.
    """
    order = np.argsort(starts - ends, kind="stable")
    starts, ends = starts[order], ends[order]
    size = ends - starts + len(SPACE)
    begin = np.concatenate(([0], np.cumsum(size)))
    inside = np.arange(begin[-1]) - np.repeat(begin[:-1], size)
    source = np.repeat(starts, size) + inside - len(SPACE)
    mark = np.frombuffer(SPACE, np.uint8)
    buffer = np.where(inside < len(SPACE), mark[np.minimum(inside, len(SPACE) - 1)], low[np.maximum(source, 0)])
    up, down = powers(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[buffer] * up[: len(buffer)], out=sums[1:])
    edges = []
    for length in pieces.lengths:
        # Edges that end after byte i of the buffer and begin `length` bytes before.
        at = np.flatnonzero(inside + 1 >= length)
        left = at + 1 - length
        piece = pieces.lookup(mixed((sums[at + 1] - sums[left]) * down[left]))
        real = piece >= 0
        weight = np.full(len(buffer), -np.inf)
        weight[at[real]] = pieces.log_p[piece[real]]
        number = np.full(len(buffer), -1)
        number[at[real]] = piece[real]
        edges.append((length, weight, number))
    byte = pieces.log_byte[buffer]
    # Nodes: one more than bytes per word.
    first = begin[:-1] + np.arange(len(size))
    alpha = np.full(int(begin[-1]) + len(size), -np.inf)
    alpha[first] = 0.0
    active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), "right") if len(size) else []
    for step, count in enumerate(active, 1):
        node, end = first[:count] + step, begin[:count] + step - 1
        value = alpha[node - 1] + byte[end]
        for length, weight, _ in edges:
            if length > step:
                break
            value = np.logaddexp(value, alpha[node - length] + weight[end])
        alpha[node] = value
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    made = Lattice(pieces, buffer, first, size, edges, alpha)
    made.order, made.back, made.begin, made.byte, made.active = order, back, begin, byte, active
    return made


def log_probabilities(pieces: Pieces, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Natural log of each word's marginal probability."""
    if not len(starts):
        return np.empty(0)
    made = lattice(pieces, low, starts, ends)
    return made.totals()[made.back]


def expected(pieces: Pieces, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Expected uses of each piece, then of each byte, over n[w] copies of each word (forward-backward)."""
    out = np.zeros(len(pieces.bodies) + 256)
    if not len(starts):
        return out
    made = lattice(pieces, low, starts, ends)
    n = n[made.order].astype(float)
    total = made.totals()
    beta = np.full(len(made.alpha), -np.inf)
    beta[made.first + made.size] = 0.0
    for step in range(len(made.active), 0, -1):
        count = made.active[step - 1]
        node, end = made.first[:count] + step, made.begin[:count] + step - 1
        beta[node - 1] = np.logaddexp(beta[node - 1], beta[node] + made.byte[end])
        for length, weight, _ in made.edges:
            if length > step:
                break
            beta[node - length] = np.logaddexp(beta[node - length], beta[node] + weight[end])
    word = np.repeat(np.arange(len(made.size)), made.size)
    node = np.arange(len(made.buffer)) + word + 1
    for length, weight, number in made.edges:
        at = np.flatnonzero(number >= 0)
        share = np.exp(made.alpha[node[at] - length] + weight[at] + beta[node[at]] - total[word[at]]) * n[word[at]]
        out[: len(pieces.bodies)] += np.bincount(number[at], weights=share, minlength=len(pieces.bodies))
    share = np.exp(made.alpha[node - 1] + made.byte + beta[node] - total[word]) * n[word]
    out[len(pieces.bodies) :] += np.bincount(made.buffer, weights=share, minlength=256)
    return out


def joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words one after the other: bytes, starts and ends."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    return np.frombuffer(b"".join(words) or b"\x00", np.uint8), np.concatenate(([0], ends[:-1])), ends


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in groups(batch, 0):
            found = scan(texts, NOT_SPACE)
            hashes, where, n = np.unique(found.hashes(), return_index=True, return_counts=True)
            words = pa.array([found.word(i) for i in where.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([words, pa.array(hashes.view(np.int64)), pa.array(n)], names=["word", "hash", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, hash, n): how often each word stands in the texts, in ASCII lower case."""
    rows = texts.select(utf8().alias("text")).mapInArrow(_word_counts, "word binary, hash long, n long")
    return rows.groupBy("hash", "word").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame, ends: int, vocabulary: str = VOCABULARY) -> Pieces:
    """Piece probabilities from their expected uses in the counted words, one step from the vocabulary's ranks.

    One number per piece reaches the driver.
    """
    start = read_pieces(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, uses = start.prepare(), np.zeros(len(start.bodies) + 256)
        for batch in batches:
            for i in range(0, batch.num_rows, 20_000):
                part = batch.slice(i, 20_000)
                uses += expected(pieces, *joined(part.column(0).to_pylist()), part.column(1).to_numpy())
        spot = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(spot), pa.array(uses[spot])], names=["piece", "uses"])

    rows = counts.select("word", "n").mapInArrow(run, "piece long, uses double")
    found = rows.groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
    uses = np.full(len(start.bodies) + 256, PRIOR)
    for row in found:
        uses[row["piece"]] += row["uses"]
    total = uses.sum() + ends + PRIOR
    log_p = np.log(uses / total)
    k = len(start.bodies)
    return Pieces(start.bodies, log_p[:k], log_p[k:], float(np.log((ends + PRIOR) / total)))


def _probable(pieces: Pieces):
    """Log probability of counted words, computed in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = pieces.prepare()
        for batch in batches:
            for i in range(0, batch.num_rows, 20_000):
                part = batch.slice(i, 20_000)
                words = part.column(part.schema.get_field_index("word")).to_pylist()
                p = pa.array(log_probabilities(ready, *joined(words)))
                yield pa.RecordBatch.from_arrays([part.column("hash"), part.column("n"), p], names=["hash", "n", "p"])

    return run


TOLD = (
    "row long, doc_id long, n_tokens long, known long, head_sum double, score double,"
    " tail array<struct<hash: long, n: int>>"
)


def _told(pieces: Pieces, head: np.ndarray, head_n: np.ndarray, head_p: np.ndarray):
    """Per text: tokens, and over the head words known tokens, sum of log10(c + 1) and log10 probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, lookup = pieces.prepare(), Lookup(head)
        log_n = np.log10(head_n + 1.0)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for first, texts in groups(batch):
                found = scan(texts, NOT_SPACE)
                hashes = found.hashes()
                text = np.repeat(np.arange(len(texts)), np.diff(found.bounds))
                number = lookup(hashes)
                inside = number >= 0
                count = lambda mask, weight=None: np.bincount(text[mask], weights=weight, minlength=len(texts))  # noqa: B023, E731
                known = count(inside)
                head_sum = count(inside, log_n[number[inside]])
                total = count(inside, head_p[number[inside]])
                rest = np.flatnonzero(~inside)
                distinct, where, again = np.unique(hashes[rest], return_index=True, return_inverse=True)
                where = rest[where]
                p = log_probabilities(ready, found.low, found.starts[where], found.ends[where])
                total = total + np.bincount(text[rest], weights=p[again], minlength=len(texts))
                pairs, n = np.unique(np.stack((text[rest], again)), axis=1, return_counts=True) if len(rest) else (np.zeros((2, 0), int), np.zeros(0, int))
                offsets = np.searchsorted(pairs[0], np.arange(len(texts) + 1))
                tail = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(distinct[pairs[1]].view(np.int64)), pa.array(n, pa.int32())], names=["hash", "n"]
                    ),
                )
                log10_p = (total + ready.log_end) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(len(texts))), batch.column(0).slice(first, len(texts)),
                     pa.array(np.diff(found.bounds) + 1), pa.array(known.astype(np.int64)), pa.array(head_sum.astype(float)),
                     pa.array(log10_p), tail],
                    names=["row", "doc_id", "n_tokens", "known", "head_sum", "score", "tail"],
                )
                row += len(texts)

    return run


def score(docs: DataFrame, vocabulary: str = VOCABULARY, head_words: int = HEAD_WORDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the white-space words of the whole text in ASCII lower case and one end.

    * score: log10 probability of the text. Every word, with the sign for a space before it, is
      the sum over all its segmentations into pieces of the vocabulary and single bytes, by a
      forward recursion in log space; words and the end are drawn independently, so that the
      probabilities of all texts add up to one at most. The pieces' weights are their ranks in
      the vocabulary, then once their expected uses in the learned documents' words.
    * base_score: sum of log10((c + 1) / (N + 1 * (V + 1))) over the tokens, with counts of the
      learned documents.

    Counts are kept per distinct word, all of them. The `head_words` most frequent ones go to all
    tasks with count and probability; the rest of a document's words is joined with the counts.

    * null id: counts as empty text for the split; null or empty text: the end alone; very long texts: whole;
      repeated rows: one result each; ties do not matter but for the head, where the smaller hash goes first.
    * nothing to learn from: N and V are 0, weights stay those of the ranks. Empty table: empty
      result. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), utf8().alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    counts = stored(word_counts(rows.where("not held_out").select("text")), "lm-counts")
    ends = rows.where("not held_out").count()
    sums = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    train_tokens, distinct = sums["n"] + ends, sums["v"] + (ends > 0)
    pieces = fit(counts, ends, vocabulary) if ends else read_pieces(vocabulary)
    top = counts.orderBy(F.desc("n"), "hash").limit(head_words)
    top = stored(top, "lm-head").mapInArrow(_probable(pieces), "hash long, n long, p double").toArrow()  # head_words rows at most
    head = top["hash"].to_numpy().astype(np.int64).view(np.uint64), top["n"].to_numpy().astype(np.int64)
    head_p = top["p"].to_numpy().astype(float)
    told = stored(rows.select("doc_id", "text").mapInArrow(_told(pieces, *head, head_p), TOLD), "lm-told")
    tail = (
        told.select("row", F.explode("tail").alias("t"))
        .select("row", "t.hash", "t.n")
        .join(counts.select("hash", F.col("n").alias("c")), "hash")
        .groupBy("row")
        .agg(F.sum("n").alias("tail_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("tail_sum"))
    )
    end = float(np.log10(ends + 1.0))
    per_token = float(np.log10(train_tokens + 1.0 * (distinct + 1)))
    return (
        told.drop("tail")
        .join(tail, "row", "left")
        .select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            "n_tokens",
            (F.col("known") + F.coalesce("tail_known", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
            F.lit(train_tokens).cast("long").alias("train_tokens"),
            (F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0)) + end - F.col("n_tokens") * per_token).alias("base_score"),
            "score",
        )
    )
