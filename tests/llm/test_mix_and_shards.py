import random
from collections import Counter, defaultdict

import pytest

from orderweir.llm import mixing, sharding
from tests_llm_help import none, odd  # noqa: F401


def order(docs, **options):
    mixed = mixing.mix(docs, **options)
    return sorted((r["mix_block"], r["mix_row"], r["source"], r["doc_id"]) for r in mixed.collect())


def test_blocks_follow_the_weights_with_less_than_one_block_of_deviation(spark):
    weights = {"a": 5.0, "b": 3.0, "c": 1.5, "d": 0.5}
    rows = [(i, f"t{i}", s) for i, s in enumerate(s for s in "abcd" for _ in range(400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = order(docs, weights=weights, block_rows=2, round_slots=20)
    assert len(got) == len(rows) and len({g[3] for g in got}) == len(rows)
    blocks = [s for b, s in sorted({(b, s) for b, _, s, _ in got})]
    assert [b for b, _ in sorted({(b, s) for b, _, s, _ in got})] == list(range(len(blocks)))
    share = {"a": 10, "b": 6, "c": 3, "d": 1}
    done = Counter()
    for t, s in enumerate(blocks, 1):
        done[s] += 1
        if t <= 20 * (200 // 10):  # no source has ended yet
            assert all(abs(done[x] - t * share[x] / 20) < 1 for x in share), (t, done)


DRAWN = random.Random(7)
MIXTURES = {
    "999 to 1": [(999, 6_000), (1, 9)],
    "one of 500 weighs 100": [(100, 700), *[(1, 7)] * 499],
    "half and many": [(499, 1_500), *[(1, 4)] * 499],
    "equal": [(1, 40)] * 40,
    "one source": [(3, 700)],
    **{
        f"drawn {k}": [(max(1, int(10 ** DRAWN.uniform(0, 6))), DRAWN.randint(1, 900)) for _ in range(DRAWN.randint(2, 25))]
        for k in range(6)
    },
}


@pytest.mark.parametrize("name", list(MIXTURES))
def test_the_bound_holds_for_any_weights(spark, name):
    """Every block once; at every slot of a phase each source within less than one block of its unrounded share."""
    sources = {f"s{i:03}": am for i, am in enumerate(MIXTURES[name])}
    strata = spark.createDataFrame([(s, a, m) for s, (a, m) in sources.items()], "s string, a long, m long")
    got = sorted((r["slot"], r["s"], r["j"]) for r in mixing.schedule_of(strata, 256).collect())
    if len(sources) < 100:
        assert got == sorted((r["slot"], r["s"], r["j"]) for r in mixing.schedule_of(strata, 19).collect())
    assert [g[0] for g in got] == list(range(sum(m for _, m in sources.values())))
    done = Counter()
    left, since, before = dict(sources), 0, Counter()
    for slot, s, j in got:
        assert j == done[s]
        done[s] += 1
        total, t = sum(a for a, _ in left.values()), slot + 1 - since
        last = min((m - before[x]) * total // a for x, (a, m) in left.items())
        if t <= last:
            # Counted in whole numbers: |placed * total - t * weight| < total.
            assert all(abs((done[x] - before[x]) * total - t * a) < total for x, (a, _) in left.items()), (slot, s)
        ending = [x for x, (a, m) in left.items() if (m - before[x]) * total // a == last]
        if t >= last and all(done[x] == left[x][1] for x in ending):
            left = {x: am for x, am in left.items() if done[x] < am[1]}
            since, before = slot + 1, Counter(done)
    assert all(done[s] == m for s, (_, m) in sources.items()) and not left


def test_cells_do_not_change_the_mixture(spark, monkeypatch):
    from orderweir.llm import common

    rows = [(i, f"t{i}", f"s{i % 4}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = order(docs, block_rows=3)
    monkeypatch.setattr(common, "CELL_ROWS", 16)
    monkeypatch.setattr(common, "BLOCK_CELLS", 4)
    assert order(docs, block_rows=3) == one


def test_rows_of_one_id_are_spread_over_cells(spark, monkeypatch):
    from orderweir.llm import common

    monkeypatch.setattr(common, "CELL_ROWS", 64)
    rows = [(None if i % 3 else 1, f"t{i}", "hot") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    _, starts = common.celled(docs, 4000, "mix", "doc_id", "source", common.tie_break(docs, "text"))
    assert max(r["_n"] for r in starts.collect()) < 150
    assert len({(r["mix_block"], r["mix_row"]) for r in mixing.mix(docs).collect()}) == 4000


def test_every_row_is_placed_once_for_odd_rows(odd, none):
    got = order(odd, block_rows=3, round_slots=7)
    assert len(got) == odd.count() and len({g[:2] for g in got}) == len(got)
    assert mixing.mix(odd).columns == [*odd.columns, "mix_block", "mix_row"]
    assert mixing.mix(none).count() == 0


def test_order_does_not_depend_on_partitions(odd):
    narrow = odd.where("doc_id > 10")
    assert order(narrow, block_rows=2) == order(narrow.repartition(7), block_rows=2)


def test_shards_have_equal_counts_and_the_mixture(spark):
    rows = [(i, f"t{i}", "hot" if i % 3 else f"s{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sharding.interleave(docs, shards=8).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(8))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own))) and len(own) == 375
        counts = Counter(r["source"] for r in own)
        for s, n in Counter(r[2] for r in rows).items():
            assert abs(counts[s] - n / 8) <= 2


def test_cells_do_not_change_the_result(spark, monkeypatch):
    from orderweir.llm import common

    rows = [(i, f"t{i}", f"s{i % 4}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    place = lambda: sorted((r["doc_id"], r["shard"], r["slot"]) for r in sharding.interleave(docs).collect())
    one = place()
    monkeypatch.setattr(common, "CELL_ROWS", 16)
    monkeypatch.setattr(common, "BLOCK_CELLS", 4)
    assert place() == one


def test_shards_of_odd_rows(odd, none):
    got = sharding.interleave(odd)
    assert got.columns == [c for c in odd.columns if c != "shard"] + ["shard", "slot"]
    rows = got.collect()
    assert len(rows) == odd.count()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert sharding.interleave(none).count() == 0


def test_sizes_of_texts(odd):
    rows = {r["doc_id"]: r for r in sharding.measured(odd).where("doc_id in (2, 3, 8)").collect()}
    assert rows[2]["size"] == rows[3]["size"] == 8 and rows[2]["text_crc32"] == 0 and rows[8]["size"] == 11
