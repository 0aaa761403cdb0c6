import os
import random

import numpy as np
import pytest

from orderweir.llm import toxicity
from tests_llm_help import none, odd, prose  # noqa: F401

INSULTS = ["idiot", "moron", "trash", "scum"]


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(3)
    docs, labels = [], []
    for i in range(900):
        body = prose(1000 + i, 60).split()
        toxic, junk = i % 6 == 0, i % 7 == 0
        if toxic:
            for word in draw.sample(INSULTS, 2):
                body.insert(draw.randrange(len(body)), word + draw.choice([",", "!", ""]))
        if junk:
            body = [w.upper() + "!!" for w in body]
        docs.append((i, " ".join(body)))
        if i % 3:
            labels.append((i, int(not junk), int(toxic)))
        elif i % 2 == 0:
            labels.append((i, int(not junk), int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int"),
    )


def test_unlabelled_documents_are_told_apart(labelled):
    docs, labels = labelled
    rows = {r["doc_id"]: r for r in toxicity.classify(docs, labels).collect()}
    assert len(rows) == 900
    truth = {i: i % 6 == 0 for i in rows}
    assert sum(rows[i]["toxic"] == truth[i] for i in rows) >= 890
    left = {r["doc_id"] for r in toxicity.drop_toxic(docs, labels).collect()}
    assert left == {i for i, r in rows.items() if not r["toxic"]}


def test_one_task_fits_the_chain_and_the_driver_does_not(labelled, monkeypatch):
    """Labels of one id in either order make the same chain."""
    docs, labels = labelled
    driver, fit = os.getpid(), toxicity.fit_chain

    def elsewhere(*given):
        assert os.getpid() != driver
        return fit(*given)

    monkeypatch.setattr(toxicity, "fit_chain", elsewhere)
    again = labels.withColumns({"quality": labels.quality * 0 + 1, "toxic": labels.toxic * 0})
    one, two = (toxicity.train(docs, a.unionByName(b)) for a, b in ((labels, again), (again, labels)))
    assert one.thresholds == two.thresholds
    assert all((a.weights == b.weights).all() for a, b in zip(one.models, two.models))


def test_the_chain_uses_the_earlier_category():
    draw = np.random.default_rng(2)
    first = draw.random(600) < 0.4
    rows = [np.array([1 if f else 2, *sorted(draw.choice(np.arange(10, 60), 5, replace=False))], np.uint32) for f in first]
    labels = np.stack((first, first ^ (draw.random(600) < 0.02)), axis=1).astype(float)
    labels[:50, 1] = np.nan
    chain = toxicity.fit_chain(["one", "two"], toxicity.sample_of(rows), labels, np.arange(600) % toxicity.FOLDS)
    assert chain.models[1].earlier[0] > 0
    assert all((chain.probabilities(r)[1] > 0.5) == f for r, f in zip(rows, first))


def test_rare_words_enter_no_model():
    rows = [np.array([i + 100, 7], np.uint32) for i in range(50)]
    assert toxicity.sample_of(rows).column.tolist() == [7] * 50


def test_odd_rows_and_missing_labels(spark, odd, none):  # noqa: F811
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (20, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("false"), labels.where("toxic = 0")):
        rows = toxicity.classify(odd, known).collect()
        assert len(rows) == odd.count() and all(0 <= r["p_toxic"] <= 1 for r in rows)
    assert not any(r["toxic"] for r in toxicity.classify(odd, labels.where("false")).collect())
    left = toxicity.drop_toxic(odd, labels)
    assert left.columns == odd.columns and left.where("doc_id is null").count() == 2
    assert toxicity.classify(none, labels).count() == 0
