import itertools
import random

import numpy as np

from orderweir.llm import line_crf
from tests_llm_help import none, odd, prose  # noqa: F401


def test_marginals_equal_the_sum_over_all_labellings():
    draw = np.random.default_rng(5)
    sizes = [1, 4, 3, 6]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    good, steps = draw.normal(size=bounds[-1]), draw.normal(size=(2, 2))
    ahead, back = line_crf.log_odds(good, bounds, steps)
    for a, b in zip(bounds[:-1], bounds[1:]):
        total, on = 0.0, np.zeros(b - a)
        for y in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(good[a + t] * v for t, v in enumerate(y)) + sum(steps[p, q] for p, q in zip(y, y[1:])))
            total, on = total + w, on + w * np.array(y)
        assert np.allclose(line_crf.sigmoid(ahead + back)[a:b], on / total)


def test_lines_are_measured_whole():
    lines = line_crf.lines_of([b"ABC def\n\nxx xx xx\n", b"", b"one"])
    assert np.diff(lines.bounds).tolist() == [4, 1, 1] and lines.size.tolist() == [7, 0, 8, 0, 0, 3]
    features = line_crf.with_neighbours(lines)
    k = lines.own.shape[1]
    assert (features[0, k : 2 * k] == line_crf.NO_LINE + line_crf.WIDTH).all()
    assert (features[1, k : 2 * k] == lines.own[0] + line_crf.WIDTH).all()


def test_junk_is_told_from_prose_on_held_out_documents(spark):
    draw = random.Random(1)
    docs, labels = [], []
    for i in range(500):
        lines = [prose(i * 10 + k, 12).capitalize() + "." for k in range(draw.randint(1, 6))]
        junk = i % 4 == 0
        if junk:
            kind = draw.randrange(3)
            mess = [lambda x: x.upper() + "!!", lambda x: x.replace(" ", " | "), lambda x: " ".join([x.split()[0]] * 12)][kind]
            lines = [line if k == 0 and len(lines) > 3 else mess(line) for k, line in enumerate(lines)]
        docs.append((i, "\n".join(lines)))
        labels.append((i, int(not junk)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    rows = line_crf.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and sum(r["predicted"] == (r["doc_id"] % 4 != 0) for r in held) >= 0.97 * len(held)
    assert all((r["score"] >= 0.3) == bool(r["predicted"]) for r in rows)


def test_odd_rows_and_missing_labels(spark, odd, none):  # noqa: F811
    labels = spark.createDataFrame([(1, 1), (20, 0), (20, 1), (21, 0), (None, 0), (22, None)], "doc_id long, quality int")
    for known in (labels, labels.where("false"), labels.where("quality = 1")):
        rows = line_crf.classify(odd, known).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
    assert line_crf.classify(none, labels).count() == 0
