from collections import defaultdict

import check
import corpus_pipeline
import pytest

from orderweir.llm.oracles import ORACLES
from orderweir.llm.queries import QUERIES
from tests_llm_help import none, odd  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_equal_their_sql(spark, name):
    good, note = check.compare(spark, check.connect(FOLDER), name, FOLDER)
    assert good, note


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_keep_columns_and_odd_rows(spark, odd):  # noqa: F811
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, FOLDER), "test-stage")
        if name in ("mixing", "sharding"):
            assert after.count() == docs.count()
        if name != "sharding":
            assert after.columns == docs.columns
        docs = after
    ids = [r["doc_id"] for r in docs.collect()]
    assert ids.count(1) == 1 and 7 not in ids and ids.count(None) == 2 and set(range(20, 60)) <= set(ids)
    assert {"shard", "slot"} <= set(docs.columns)


def test_stages_on_an_empty_table(spark, none):  # noqa: F811
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, FOLDER).count() == 0


def test_whole_pipeline(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    ids = [r["doc_id"] for r in rows.collect()]
    assert len(ids) == len(set(ids)) and len(ids) > 100


def test_the_mixture_reaches_the_shards(spark):
    """Without the mixing stage the result is another; with it every shard follows the weights, two blocks to one."""
    rows = [(i, f"t{i}", "en", "small" if i % 5 == 0 else "big", 2) for i in range(5 * 67 * 64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    stages = dict(corpus_pipeline.STAGES)
    mixed = corpus_pipeline.stored(stages["mixing"](spark, docs, FOLDER), "test-stage").repartition(7)
    place = lambda frame: {r["doc_id"]: (r["shard"], r["slot"], r["source"]) for r in stages["sharding"](spark, frame, FOLDER).collect()}
    got, without = place(mixed), place(docs)
    assert len(got) == len(rows) and got != without
    shards = defaultdict(list)
    for shard, slot, source in sorted(got.values()):
        assert slot == len(shards[shard])
        shards[shard].append(source)
    assert sorted(shards) == list(range(24)) and {len(s) for s in shards.values()} == {893, 894}
    for own in shards.values():
        assert abs(own.count("small") - 67 * 64 / 24) <= 2
        # No source has ended yet: off by a block, by the part of one that t cuts, and by rows at the ends of the dealing.
        for t in range(1, 520):
            assert abs(own[:t].count("small") - t / 3) < 2 * 64 / 24 + 3, t
