import collections
import math
import re
import zlib

import numpy as np
import pytest

from orderweir.llm import lattice_lm as lm
from tests_llm_help import none, odd, prose  # noqa: F401


@pytest.fixture(scope="module")
def pieces():
    return lm.read_pieces().prepare()


def brute(pieces, word):
    """Sum over all segmentations, in plain numbers."""
    p = {b: math.exp(x) for b, x in zip(pieces.bodies, pieces.log_p)}
    text = lm.SPACE + word
    ways = [1.0] + [0.0] * len(text)
    for j in range(1, len(text) + 1):
        ways[j] = ways[j - 1] * math.exp(pieces.log_byte[text[j - 1]])
        ways[j] += sum(ways[i] * p[text[i:j]] for i in range(j) if text[i:j] in p)
    return math.log(ways[-1])


def test_forward_recursion_equals_brute_force(pieces):
    words = [b"hello", b"a", "éx".encode(), "日本語".encode(), b"the" * 15, b"x"]
    got = lm.log_probabilities(pieces, *lm.joined(words))
    assert np.allclose(got, [brute(pieces, w) for w in words])


def test_probabilities_add_up_to_one(pieces):
    mass = np.exp(pieces.log_p).sum() + np.exp(pieces.log_byte).sum() + math.exp(pieces.log_end)
    assert abs(mass - 1) < 1e-9


def test_expected_uses_spell_all_bytes(pieces):
    words, n = [b"hello", b"the" * 7, "ñandú".encode()], np.array([3, 1, 2])
    uses = lm.expected(pieces, *lm.joined(words), n)
    sizes = np.array([len(b) for b in pieces.bodies] + [1] * 256)
    assert np.isclose((uses * sizes).sum(), sum((len(w) + len(lm.SPACE)) * k for w, k in zip(words, n)))


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


@pytest.mark.parametrize("head", [0, 5, 200_000])
def test_counts_and_baseline_equal_brute_force_for_any_head(spark, head):
    texts = [prose(i % 40, 30) + " Común" for i in range(60)] + [None, "", " \t"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "Común x"), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.score(docs, head_words=head).collect()
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    counts = collections.Counter()
    for i, t in rows:
        if not out(i):
            counts.update([*tokens(t), "\n"])
    total, kinds = sum(counts.values()), len(counts)
    by = {}
    for i, t in rows:
        own = [*tokens(t), "\n"]
        base = sum(math.log10((counts[w] + 1) / (total + 1 * (kinds + 1))) for w in own)
        by[i] = (out(i), len(own), sum(counts[w] > 0 for w in own), total, base)
    assert len(got) == len(rows)
    for r in got:
        want = by[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:4]
        assert math.isclose(r["base_score"], want[4], rel_tol=1e-9) and r["score"] < 0


def test_learning_raises_the_likelihood(spark):
    texts = [(i, prose(i, 60)) for i in range(80)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    plain, pieces = 0.0, lm.read_pieces().prepare()
    learned = {r["doc_id"]: r for r in lm.score(docs).collect()}
    for i, t in texts:
        p = lm.log_probabilities(pieces, *lm.joined([w.encode() for w in tokens(t)])).sum() + pieces.log_end
        plain += p / math.log(10) if learned[i]["held_out"] else 0
    held = [r for r in learned.values() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > plain


def test_odd_rows(odd, none):  # noqa: F811
    rows = lm.score(odd).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {1}
    assert lm.score(none).count() == 0
    assert lm.score(odd.where("doc_id = 2")).count() == 1
