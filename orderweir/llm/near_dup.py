"""Near-duplicate documents: MinHash bands propose pairs, odd sketches sift them, full sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweir.llm.common import components, utf8
from orderweir.llm.words import LOWER, MIX, MIX2, NOT_SPACE, groups, mixed, runs, scan
from orderweir.session import release, stored

SHINGLE_WORDS = 5
#: 32 bands of 4 samples: a pair of similarity 0.75 shares no band with probability 5e-6.
BANDS, BAND_ROWS = 32, 4
SAMPLES = BANDS * BAND_ROWS
SKETCH_BITS = 512
#: Pairs whose estimate is this far below the wanted similarity are dropped unseen. The estimate
#: at 0.75 has a standard deviation of about 0.04 (samples and bits that cancel).
MARGIN = 0.2
#: Members of a bucket that one task call compares with as many others.
BLOCK = 1_024
#: Documents are first sifted by this many low values of their id, so that the broadcast list is bounded.
SIEVE = 1 << 20

SIGNATURE = "doc_id long, n_shingles long, content binary, bands array<long>, sketch array<long>"

def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of all runs of five words; a shorter text is one run."""
    found = scan(texts, NOT_SPACE)
    hashes = found.hashes()
    fives = runs(hashes, SHINGLE_WORDS)
    out = []
    for first, last in zip(found.bounds[:-1], found.bounds[1:]):
        words = last - first
        own = fives[first : last - SHINGLE_WORDS + 1] if words >= SHINGLE_WORDS else runs(hashes[first:last], words)
        out.append(np.unique(own) if words else np.empty(0, np.uint64))
    return out


def content_of(text: bytes) -> bytes:
    """Hash of the words of a text."""
    return xxhash.xxh3_128_digest(b" ".join(text.translate(LOWER).split()))


def permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_011)
    factors = draw.integers(0, 2**31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return factors[:, None], draw.integers(0, 2**32, SAMPLES, dtype=np.uint32)[:, None]


def minhash(values: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Smallest value under each of the permutations, in pieces so that long texts need no more memory."""
    low = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 2**32 - 1, np.uint32)
    for at in range(0, len(low), 1024):
        np.minimum(least, (low[None, at : at + 1024] * factors + shifts).min(axis=1), out=least)
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND_ROWS):
        keys = (keys ^ (keys >> np.uint64(31))) * MIX + rows[:, i]
    return mixed(keys).view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Each (sample number, value) flips one bit; equal samples cancel in the XOR of two sketches."""
    spot = (samples.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)) + MIX) * MIX2
    spot = ((spot ^ (spot >> np.uint64(32))) * MIX) >> np.uint64(55)  # 9 bits
    parity = (np.bincount(spot.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors, shifts = permutations()
    kind = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("content", pa.binary()),
         ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]
    )
    for batch in batches:
        for first, texts in groups(batch):
            counts, contents, bands, sketches = [], [], [], []
            for text, values in zip(texts, shingle_sets(texts)):
                counts.append(len(values))
                if not len(values):
                    contents.append(None), bands.append([]), sketches.append([])
                    continue
                contents.append(content_of(text))
                samples = minhash(values, factors, shifts)
                bands.append(band_keys(samples))
                sketches.append(odd_sketch(samples))
            columns = [pa.array(x, t) for x, t in zip((counts, contents, bands, sketches), kind.types[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *columns], schema=kind)


def signatures(docs: DataFrame) -> DataFrame:
    """One row per document: size of its set, hash of its words, band keys, odd sketch."""
    return docs.select(F.col("doc_id").cast("long"), utf8().alias("text")).mapInArrow(_sign, SIGNATURE)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole set, and the upper halves of its hashes, sorted."""
    for batch in batches:
        for first, texts in groups(batch):
            sets = shingle_sets(texts)
            content = pa.array([content_of(text) if len(own) else None for text, own in zip(texts, sets)], pa.binary())
            whole = pa.array([values.view(np.int64) for values in sets], pa.list_(pa.int64()))
            half = pa.array([np.unique((values >> np.uint64(32)).astype(np.uint32)).tobytes() for values in sets], pa.binary())
            ids = batch.column(0).slice(first, len(texts))
            yield pa.RecordBatch.from_arrays([ids, content, whole, half], names=["doc_id", "content", "shingles", "half"])


def near_in_bucket(rows: pa.Table, percent: int) -> pa.Table:
    """Pairs of one bucket, between two blocks of it, whose halved sets are similar and whose components differ.

    Odd sketches rule most pairs out; common hashes of the others are counted for one row against
    all at a time. A halved hash may collide, so two more common ones are allowed here; whole sets decide later.
    """
    ids, comp, n, block = (rows[c].to_numpy() for c in ("doc_id", "comp", "n_shingles", "block"))
    one, two = rows["i"][0].as_py(), rows["j"][0].as_py()
    sketch = np.stack([np.array(s, np.int64) for s in rows["sketch"].to_pylist()]).view(np.uint64)
    halves = [np.frombuffer(b, np.uint32) for b in rows["half"].to_pylist()]
    starts = np.concatenate(([0], np.cumsum([len(h) for h in halves])))
    numbers = np.unique(np.concatenate(halves), return_inverse=True)[1]
    flags = np.zeros(len(numbers) + 1, bool)
    least = percent / 100 - MARGIN
    differ = SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - least) / SKETCH_BITS))
    found = []
    for r in np.flatnonzero(block == one):
        may = (block == two) & (comp != comp[r]) & (100 * np.minimum(n, n[r]) >= percent * np.maximum(n, n[r]))
        if one == two:
            may &= ids > ids[r]
        at = np.flatnonzero(may)
        at = at[np.bitwise_count(sketch[at] ^ sketch[r]).sum(axis=1) <= differ] if len(at) else at
        if not len(at):
            continue
        own = numbers[starts[r] : starts[r + 1]]
        flags[own] = True
        common = np.add.reduceat(flags[numbers].astype(np.int64), starts[:-1])[at] + 2
        flags[own] = False
        near = at[100 * common >= percent * (n[r] + n[at] - common)]
        found += [(min(ids[r], ids[x]), max(ids[r], ids[x])) for x in near]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def similarity_estimate(a: Column, b: Column) -> Column:
    """Similarity from the number of bits in which two odd sketches differ."""
    words = SKETCH_BITS // 64
    differ = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(words)), F.lit(0))
    share = F.least(2 * differ / SKETCH_BITS, F.lit(0.999))
    return 1 + F.log(1 - share) * (SKETCH_BITS / (4 * SAMPLES))


def _plausible(percent: int) -> Column:
    """Sizes allow the similarity, and the sketches do not rule it out."""
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return sizes & (similarity_estimate(F.col("sketch_a"), F.col("sketch_b")) >= percent / 100 - MARGIN)


def _side(roots: DataFrame, side: str) -> DataFrame:
    return roots.select(
        F.col("doc_id").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")
    )


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def link(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, content, component_id, kept.

    Two documents are linked when their sets of five-word shingles (ASCII lower case, words apart
    by white space) have 100 * intersection >= percent * union; a component is what links reach.

    1. One pass over the texts makes 128 MinHash samples, their 32 band keys and the odd sketch.
       Documents of equal words count as one from here on.
    2. In every bucket of a band each member is paired with the smallest one, so a bucket of m
       members makes m - 1 pairs. Sizes and sketches sift the pairs, full sets decide.
    3. Where a bucket still holds several components, its members are paired with a hub drawn anew,
       and last all pairs across components are compared within tasks, by blocks of a bucket: sketches, then
       halved sets, so that only near pairs leave a task. Links inside a component change nothing, so no link that matters is lost.

    * null id: takes no part, component null and kept; null, empty or blank text: no shingles, a
      component of its own; repeated rows and equal texts: one component; very long texts: whole.
    * an id with several texts is compared by the one of smallest hash; all of them lie in its component.
    * ties: the smallest id names the component. Empty table: empty result.
    * other columns of `docs` are not read.
    """
    signs = stored(signatures(docs), "near-signs")
    named = signs.where("content is not null and doc_id is not null")
    first = stored(named.groupBy("content").agg(F.min("doc_id").alias("root")), "near-first")
    roots = (
        named.join(first, "content")
        .where("doc_id = root")
        .groupBy("doc_id")
        .agg(F.min(F.struct("content", "n_shingles", "bands", "sketch")).alias("own"))
        .select("doc_id", "own.*")
    )
    buckets = stored(_shared(roots.select("doc_id", F.explode("bands").alias("bucket"))), "near-buckets")
    members = stored(roots.drop("bands").join(buckets.select("doc_id").distinct(), "doc_id", "left_semi"), "near-members")
    sieve = F.broadcast(members.select(F.pmod("doc_id", F.lit(SIEVE)).alias("sieve")).distinct())  # SIEVE rows at most
    texts = (
        docs.select(F.col("doc_id").cast("long"), utf8().alias("text"))
        .withColumn("sieve", F.pmod("doc_id", F.lit(SIEVE)))
        .join(sieve, "sieve", "left_semi")
        .join(members.select("doc_id"), "doc_id", "left_semi")
        .select("doc_id", "text")
    )
    sets = texts.mapInArrow(_sets, "doc_id long, content binary, shingles array<long>, half binary")
    sets = sets.join(members.select("doc_id", "content"), ["doc_id", "content"], "left_semi")
    sets = stored(sets.dropDuplicates(["doc_id", "content"]).drop("content"), "near-sets")
    release(docs.sparkSession)

    def sifted(pairs: DataFrame) -> DataFrame:
        both = pairs.join(_side(members, "a"), "a").join(_side(members, "b"), "b")
        return both.where(_plausible(percent)).select("a", "b", "n_a", "n_b")

    def linked(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
        two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
        common = F.size(F.array_intersect("set_a", "set_b"))
        both = pairs.join(one, "a").join(two, "b").withColumn("common", common)
        return both.where(F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent).select("a", "b")

    tested = stored(buckets.where("doc_id <> hub").select(*_pair("doc_id", "hub")).distinct(), "near-tested")
    edges = stored(linked(sifted(tested)), "near-links")
    release(docs.sparkSession)
    comps = stored(components(edges, "near-stars"), "near-comps")

    mixed = stored(_mixed(buckets, comps), "near-mixed")
    again = (
        mixed.where(F.col("comp") != F.col("hub.comp"))
        .select(F.col("doc_id").alias("x"), F.col("hub.doc_id").alias("y"))
        .select(*_pair("x", "y"))
        .distinct()
        .join(tested, ["a", "b"], "left_anti")
    )

    def grown(more: DataFrame) -> DataFrame:
        """The components with these links too, from those found so far in fewer rounds; without any they stay as they are."""
        if more.isEmpty():
            return comps
        return components(comps.select(F.col("id").alias("a"), F.col("comp").alias("b")).unionByName(more), "near-stars")

    more = stored(linked(sifted(stored(again, "near-again"))), "near-links")
    release(docs.sparkSession)
    comps = stored(grown(more), "near-comps")

    rest = (
        _mixed(mixed, comps)
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "bucket"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .join(members, "doc_id")
        .join(sets.select("doc_id", "half"), "doc_id")
        .select("bucket", "doc_id", "comp", "n_shingles", "sketch", "half", "block",
                F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .groupBy("bucket", "i", "j")
        .applyInArrow(lambda rows: near_in_bucket(rows, percent), "a long, b long")
        .distinct()
    )
    size = lambda side: members.select(F.col("doc_id").alias(side), F.col("n_shingles").alias(f"n_{side}"))
    rest = stored(rest, "near-rest").join(size("a"), "a").join(size("b"), "b")
    comps = grown(stored(linked(rest), "near-links")).withColumnRenamed("id", "root")
    return (
        signs.select("doc_id", "n_shingles", "content")
        .join(first, "content", "left")
        .join(comps, "root", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "root", "doc_id")))
        .select(
            "doc_id",
            "n_shingles",
            "content",
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )


def _shared(buckets: DataFrame) -> DataFrame:
    """Only buckets of two members or more, each member with the smallest one as hub."""
    several = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("doc_id").alias("hub")).where("n > 1")
    return buckets.join(several.select("bucket", "hub"), "bucket").select("bucket", "doc_id", "hub")


def _mixed(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, doc_id, comp, hub, blocks) of the buckets whose members are in several components; the hub is drawn anew."""
    told = buckets.select("bucket", "doc_id").join(comps.select(F.col("id").alias("doc_id"), "comp"), "doc_id", "left").select(
        "bucket", "doc_id", F.coalesce("comp", "doc_id").alias("comp")
    )
    drawn = F.col("doc_id").bitwiseXOR(F.xxhash64("bucket", F.lit(1)))
    several = (
        told.groupBy("bucket")
        .agg(
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
            F.min(F.struct(drawn.alias("drawn"), "doc_id", "comp")).alias("hub"),
            F.ceil(F.count("*") / BLOCK).alias("blocks"),
        )
        .where("low < high")
    )
    return told.join(several.select("bucket", "hub", "blocks"), "bucket")


def drop_near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The documents without near duplicates: of each component the row of the smallest id.

    Rows of a null id stay; rows repeated with the same id and text become one.
    """
    keep = link(docs, percent).where("kept and doc_id is not null").select(F.col("doc_id").alias("_keep")).distinct()
    named = docs.join(keep, docs["doc_id"] == keep["_keep"], "left_semi")
    return named.dropDuplicates(["doc_id", "text"]).union(docs.where("doc_id is null"))
