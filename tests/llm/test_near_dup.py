import random
import re

import numpy as np

from pyspark.sql import functions as F

from orderweir.llm import common, near_dup
from orderweir.session import stored
from tests_llm_help import none, odd, prose  # noqa: F401


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    own = {i: sets(t) for i, t in rows}
    root = {i: i for i in own}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(own)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(own[a] & own[b])
            if both and 100 * both >= 75 * (len(own[a]) + len(own[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(own[i]), find(i)) for i in ids}


def edited(text, draw, edits):
    words = text.split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = "changed%d" % draw.randrange(10**6)
    return " ".join(words)


def test_components_equal_brute_force_also_for_chains_and_a_large_group(spark):
    draw = random.Random(7)
    rows, at = [], 0
    for seed in range(12):
        base = prose(seed, draw.choice([6, 60, 120]))
        for _ in range(draw.choice([1, 2, 12])):
            rows.append((at, edited(base, draw, draw.choice([0, 1, 2, 3]))))
            at += 1
    text = prose(99, 150)
    for _ in range(30):  # a chain: each one edit away from the one before
        text = edited(text, draw, 1)
        rows.append((at, text.upper() if at % 2 else text))
        at += 1
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.link(docs).collect()}
    assert got == brute(rows)
    kept = {r["doc_id"] for r in near_dup.drop_near_duplicates(docs).collect()}
    assert kept == {i for i, (_, c) in got.items() if c == i}


def test_odd_rows(odd, none):
    rows = near_dup.link(odd).collect()
    assert len(rows) == odd.count()
    told = {(r["doc_id"], r["component_id"], r["kept"]) for r in rows}
    assert {(1, 1, True), (7, 1, False), (2, 2, True), (3, 3, True), (4, 4, True), (None, None, True)} <= told
    assert {r["doc_id"]: r["n_shingles"] for r in rows}[8] == 1
    kept = near_dup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(None) == 2 and 7 not in ids
    assert near_dup.link(none).count() == 0


def test_odd_sketch_estimates_high_similarity():
    draw = np.random.default_rng(1)
    for share in (0.6, 0.75, 0.9, 1.0):
        errors = []
        for _ in range(40):
            pool = draw.integers(0, 2**64, 1000, dtype=np.uint64)
            common = int(1000 * share)
            extra = (1000 - common) // 2
            a, b = pool[: common + extra], np.concatenate((pool[:common], pool[common + extra :]))
            sketches = [near_dup.odd_sketch(near_dup.minhash(np.unique(x), *near_dup.permutations())) for x in (a, b)]
            z = sum(bin(int(v) & (2**64 - 1)).count("1") for v in sketches[0] ^ sketches[1])
            estimate = 1 + np.log(max(1 - 2 * z / near_dup.SKETCH_BITS, 0.001)) * near_dup.SKETCH_BITS / (4 * near_dup.SAMPLES)
            errors.append(estimate - share)
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < near_dup.MARGIN


def test_components_shuffle_little_per_round(spark, monkeypatch):
    """Chains, stars and a ring against union-find; every shuffle costs the driver a thread, so a round has few."""
    from orderweir.llm import common

    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += [(draw.randrange(300, 360), draw.randrange(300, 360)) for _ in range(40)] + [(7, 7)]
    root = {i: i for pair in edges for i in pair}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    want = sorted((i, top(i)) for i in {i for a, b in edges if a != b for i in (a, b)})
    rounds, written = [], common.stored
    monkeypatch.setattr(common, "stored", lambda df, purpose: (rounds.append(1), written(df, purpose))[1])
    shuffles = lambda: spark.sparkContext._jsc.sc().newShuffleId()
    began = shuffles()
    found = common.components(spark.createDataFrame(edges, "a long, b long"), "test-stars")
    used = shuffles() - began - 1
    assert sorted(tuple(r) for r in found.collect()) == want
    assert used <= 1 + 4 * (len(rounds) - 1), (used, len(rounds) - 1)  # joins are broadcast here


def test_the_driver_collects_its_garbage_after_every_round(spark):
    """A heap left to grow until it is full kept its size: the driver came close to its limit."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    whole = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    began = whole()
    edges = spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")
    assert {tuple(row) for row in common.components(edges, "collected").collect()} == {(i, 0) for i in range(10)}
    assert whole() > began


def test_a_stored_frame_takes_one_job(spark):
    """Its schema is known, so that no job reads it from the files."""
    spark.sparkContext.setJobGroup("stored-once", "")
    again = stored(spark.range(5).withColumn("x", F.lit("a").cast("string")), "stored-once")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("stored-once")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    assert sorted(map(tuple, again.collect())) == [(i, "a") for i in range(5)]
