"""Benchmark decontamination by template canonicalisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.llm.common import utf8
from orderweir.llm.words import LETTERS, MIX, Lookup, Scan, groups, hash_of, mixed, scan
from orderweir.session import stored

WINDOW = 5
#: So many matched tokens in a row are a leak whatever share of the item they are; of a shorter item, all.
RUN = 13
#: A benchmark is handled in blocks of items; a block's vocabulary and window keys are sent to all tasks.
BLOCK_CHARS = 4_000_000
#: Words that are a unit when they follow a number.
UNITS = """
mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams ton tons ounce ounces pound pounds
ml l liter liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month
months year years percent dollar dollars euro euros cent cents usd eur gbp mph kmh degree degrees celsius
fahrenheit watt watts kw kwh volt volts amp amps hz khz mhz ghz byte bytes kb mb gb tb
""".split()
NUMBER, UNKNOWN, UNIT, NAME, FIRST_WORD = 0, 1, 2, 3, 4
#: Template forms: numbers typed; units and names, too; nothing typed.
NUMBERS, NAMES, RAW = 0, 1, 2
#: Bytes inside a number between two digits.
POINTS = np.array([chr(b) in ".," for b in range(256)])
MARKS = np.array([chr(b) in ".!?\n" for b in range(256)])

WINDOWS = "id long, n_tokens int, form int, key long, at int, slots array<struct<p: int, v: string>>"
ARROW = pa.schema(
    [("id", pa.int64()), ("n_tokens", pa.int32()), ("form", pa.int32()), ("key", pa.int64()), ("at", pa.int32()),
     ("slots", pa.list_(pa.struct([("p", pa.int32()), ("v", pa.string())])))]
)


def vocabulary_of(texts: list[bytes]) -> np.ndarray:
    """Distinct hashes of the words; a word's number is FIRST_WORD plus its place."""
    found = scan(texts, LETTERS, POINTS, latin=True)
    return np.unique(found.hashes())


class Templates:
    """Template forms of texts over the vocabulary of a block of benchmark items."""

    def __init__(self, vocabulary: np.ndarray):
        self.number = Lookup(vocabulary)
        self.units = Lookup(np.unique(np.array([hash_of(u.encode()) for u in UNITS], np.uint64)))

    def forms(self, found: Scan) -> list[np.ndarray]:
        """Three templates of the words: numbers typed; numbers, units and names typed; nothing typed.

        A name is a word with an ASCII capital that does not open a sentence, line or text; a unit
        follows a number.
        """
        hashes = found.hashes()
        digits = np.concatenate(([0], np.cumsum((found.low >= 48) & (found.low <= 57) | POINTS[found.low])))
        number = digits[found.ends] - digits[found.starts] == found.ends - found.starts
        known = self.number(hashes)
        plain = np.where(known < 0, UNKNOWN, known + FIRST_WORD)
        plain[number] = NUMBER
        first = found.raw[found.starts]
        capital = (first >= 65) & (first <= 90)
        mark = np.concatenate(([0], np.cumsum(MARKS[found.low])))
        opens = np.ones(len(plain), bool)
        opens[1:] = mark[found.starts[1:]] > mark[found.ends[:-1]]
        after = np.zeros(len(plain), bool)
        after[1:] = number[:-1] & ~opens[1:]
        typed = plain.copy()
        typed[capital & ~opens & ~number] = NAME
        units = np.flatnonzero(after)
        typed[units[self.units(hashes[units]) >= 0]] = UNIT
        raw = np.where(known < 0, UNKNOWN, known + FIRST_WORD)
        return [plain, typed, raw]


def window_keys(ids: np.ndarray, text: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of windows in one text without unknown words; their keys; whether a word is in at least
    every second place. text: the text of each word.
    """
    unknown = np.concatenate(([0], np.cumsum(ids == UNKNOWN)))
    good = np.flatnonzero((unknown[size:] == unknown[:-size]) & (text[size - 1 :] == text[: max(len(text) - size + 1, 0)]))
    windows = np.lib.stride_tricks.sliding_window_view(ids, size)[good] if len(good) else ids[:0].reshape(0, size)
    enough = 2 * (windows >= FIRST_WORD).sum(axis=1) >= size
    windows = windows.astype(np.uint64)
    key = np.full(len(good), size, np.uint64)
    for i in range(size):
        key = (key ^ (key >> np.uint64(29))) * MIX + windows[:, i]
    return good, mixed(key).view(np.int64), enough


def matches(templates: Templates, texts: list[bytes], keys: np.ndarray | None, short: tuple = ()) -> Iterator[tuple]:
    """(text, words of the text, form, key, place, slots) of the template windows; with `keys` of those in it.

    The second form counts only where typing units and names makes a difference, the untyped one
    where numbers leave too few words, and for whole texts of less than a window. short: sizes of
    such benchmark items; without `keys` a text is an item and has its own size.
    """
    found = scan(texts, LETTERS, POINTS, latin=True)
    sizes = np.diff(found.bounds)
    text = np.repeat(np.arange(len(texts)), sizes)
    forms = templates.forms(found)
    changed = np.concatenate(([0], np.cumsum(forms[NUMBERS] != forms[NAMES])))
    few = np.ones(len(text), bool)
    for form, ids in enumerate(forms):
        at, key, enough = window_keys(ids, text)
        if form == RAW:
            wanted = few[at]
        else:
            wanted = enough if form == NUMBERS else enough & (changed[at + WINDOW] > changed[at])
            few[at[enough]] &= form == NAMES
        yield from _windows(found, text, sizes, ids, form, at[wanted], key[wanted], WINDOW, keys)
    for size in short if keys is not None else range(1, WINDOW):
        at, key, _ = window_keys(forms[RAW], text, size)
        if keys is None:
            at, key = at[sizes[text[at]] == size], key[sizes[text[at]] == size]
        yield from _windows(found, text, sizes, forms[RAW], RAW, at, key, size, keys)


def _windows(found: Scan, text: np.ndarray, sizes: np.ndarray, ids: np.ndarray, form: int, at, key, size: int, keys) -> Iterator[tuple]:
    if keys is not None:
        spot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        at, key = at[keys[spot] == key], key[keys[spot] == key]
    for i, k in zip(at.tolist(), key.tolist()):
        first = int(found.bounds[text[i]])
        slots = [
            {"p": j - first, "v": found.word(j).decode("utf-8", "replace")} for j in range(i, i + size) if ids[j] < FIRST_WORD
        ]
        yield text[i], sizes[text[i]], form, k, i - first, slots


def windowed(vocabulary: np.ndarray, keys: np.ndarray | None, short: tuple = ()):
    """A function over (id, text) batches that returns the template windows of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(vocabulary)
        for batch in batches:
            for first, texts in groups(batch):
                rows = list(zip(*matches(templates, texts, keys, short))) or [()] * len(ARROW)
                ids = batch.column(0).take(pa.array([first + int(i) for i in rows[0]], pa.int64()))
                rest = [pa.array(x, t) for x, t in zip(rows[1:], ARROW.types[1:])]
                yield pa.RecordBatch.from_arrays([ids, *rest], schema=ARROW)

    return run


#: Pairs (value of the item, value of the document) that stand: those of at least half of the value's places, and
#: the most frequent one, the value itself first. Without values that have several there is nothing to count.
USUAL = """
if(size(pairs) = size(array_distinct(pairs.i)), pairs, concat(
  filter(pairs, x -> 2 * size(filter(slots, s -> s.i = x.i and s.d = x.d)) >= size(filter(slots, s -> s.i = x.i))),
  transform(array_distinct(pairs.i), v -> array_max(transform(filter(pairs, x -> x.i = v), x -> struct(
    size(filter(slots, s -> s.i = x.i and s.d = x.d)) as n, x.d = x.i as own, x as pair))).pair)))
"""
#: The longest row of tokens that windows of one alignment cover without a gap.
LONGEST = """
aggregate(array_sort(wins.at), struct(0 as first, 0 as next, 0 as most),
  (a, at) -> if(at <= a.next and a.next > 0,
    struct(a.first as first, at + size as next, greatest(a.most, at + size - a.first) as most),
    struct(at as first, at + size as next, greatest(a.most, size) as most)),
  a -> a.most)
"""


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5, least_tokens: int = 8
) -> DataFrame:
    """(doc_id, item_id, n_tokens, covered, coverage, changed): documents that hold a benchmark item.

    Case does not count (ASCII and Latin-1 letters). Numbers become a placeholder; in a second template units after numbers and names do, too. All
    windows of five template tokens of an item are joined by hash with those of the documents; a
    window with fewer than three words left must be equal as it stands.
    On one alignment a value of the item stands for the values that half of its places have in the document,
    and for the most frequent one (itself, if that is as frequent). A changed slot that disagrees takes the
    windows that it lies in with it, and counts as one token against the item; different values may become equal.
    An item is found in a stretch of the document of one to two item lengths if its matched windows,
    less the slots that disagree, cover the share `coverage` of its tokens and `least_tokens` of them, or all
    of a shorter item; or if RUN matched tokens stand in a row, or all of a shorter item.
    `covered` and `coverage` are those of the stretch that covers most; `changed` tells that a matched slot in it has
    other values than in the benchmark (a re-parameterised question).

    The benchmark is taken in blocks of about BLOCK_CHARS characters (a longer item is a block of its own);
    each block is one pass over the documents, and only its vocabulary and window keys are sent to the tasks.

    * null ids, on either side: the row takes no part; null or empty texts match nothing; items of fewer
      than five tokens match where all their tokens stand unchanged; very long texts: whole; repeated
      rows: one result per pair of ids.
    * empty documents or benchmark: empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long"), utf8().alias("text"))
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), utf8().alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = chars // BLOCK_CHARS + 1
    found = None
    for i in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i) if blocks > 1 else items
        bodies = [bytes(row["text"]) for row in own.select("text").collect()]
        vocabulary = vocabulary_of(bodies)
        of_items = stored(own.mapInArrow(windowed(vocabulary, None), WINDOWS), "leak-items")
        own_windows = [(m[3], m[1]) for m in matches(Templates(vocabulary), bodies, None)]
        keys = np.unique(np.array([key for key, _ in own_windows], np.int64))
        if not len(keys):
            continue
        short = tuple(sorted({int(n) for _, n in own_windows if n < WINDOW}))
        of_docs = texts.mapInArrow(windowed(vocabulary, keys, short), WINDOWS)
        pairs = of_docs.alias("d").join(of_items.alias("i"), ["form", "key"]).select(
            F.col("d.id").alias("doc_id"), F.col("i.id").alias("item_id"), F.col("i.n_tokens").alias("n_tokens"),
            (F.col("d.at") - F.col("i.at")).alias("shift"), F.col("i.at").alias("at"),
            F.expr("zip_with(i.slots, d.slots, (x, y) -> struct(x.p as p, x.v as i, y.v as d))").alias("slots"),
        )
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        kind = "doc_id long, item_id long, n_tokens int, covered int, coverage double, changed boolean"
        return spark.createDataFrame([], kind)
    aligned = (
        found.groupBy("doc_id", "item_id", "n_tokens", "shift")
        .agg(F.collect_set(F.struct("at", "slots")).alias("wins"))
        .withColumn("slots", F.expr("array_distinct(flatten(wins.slots))"))
        .withColumn("pairs", F.expr("array_distinct(transform(slots, x -> struct(x.i as i, x.d as d)))"))
        .withColumn("usual", F.expr(USUAL))
        .withColumn("off", F.expr(
            "transform(filter(slots, x -> x.i <> x.d and not array_contains(usual, struct(x.i as i, x.d as d))), x -> x.p)"
        ))
        .withColumn("wins", F.expr("filter(wins, w -> not arrays_overlap(w.slots.p, off))"))
        .withColumn("size", F.least(F.col("n_tokens"), F.lit(WINDOW)))
        .select(
            "doc_id", "item_id", "n_tokens", "off",
            F.expr("array_distinct(flatten(transform(wins, w -> sequence(w.at, w.at + size - 1))))").alias("spots"),
            F.expr(LONGEST).alias("run"),
            F.expr("exists(wins, w -> exists(w.slots, x -> x.i <> x.d))").alias("changed"),
            # Stretches overlap by an item length, so alignments that are less apart share one.
            F.expr("explode(array(floor(shift / n_tokens), floor(shift / n_tokens) - 1))").alias("stretch"),
        )
        .where("size(spots) > 0")
    )
    union = lambda name: F.array_distinct(F.flatten(F.collect_set(name)))
    counted = F.col("covered") - F.col("n_off")
    full = (counted >= coverage * F.col("n_tokens")) & (counted >= F.least(F.lit(least_tokens), F.col("n_tokens")))
    return (
        aligned.groupBy("doc_id", "item_id", "n_tokens", "stretch")
        .agg(
            F.size(union("spots")).alias("covered"),
            # Tokens that another alignment of the stretch covers do not count against the item.
            F.size(F.array_except(union("off"), union("spots"))).alias("n_off"),
            F.max("run").alias("run"),
            F.max("changed").alias("changed"),
        )
        .where(full | (F.col("run") >= F.least(F.lit(RUN), F.col("n_tokens"))))
        .groupBy("doc_id", "item_id", "n_tokens")
        .agg(F.max(F.struct("covered", "changed")).alias("most"))
        .select(
            "doc_id", "item_id", "n_tokens", F.col("most.covered").alias("covered"),
            (F.col("most.covered") / F.col("n_tokens")).alias("coverage"), F.col("most.changed").alias("changed"),
        )
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark item is found; rows without id stay."""
    leaks = stored(find_leaks(docs, benchmark, **options).select(F.col("doc_id").alias("_leak")).distinct(), "leaks")
    return docs.join(leaks, docs["doc_id"] == leaks["_leak"], "left_anti")
