"""Cuts against plain re, an exact round trip, and odd inputs."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderweir.llm.fill_middle import UNITS, fill_in_middle, restored
from tests_llm_help import none, odd  # noqa: F401


def plain(doc_id, text):
    """One row by the stated rule, tokens found one by one."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = "".join(tokens[:one]), "".join(tokens[one:two]), "".join(tokens[two:])
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return doc_id, n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


TEXTS = [
    "", "a", "ab cd", "x<P", "<", "<S", "S>M>", "tail <M", "é𝄞 naïvé\n\r\n\t", "<P>", "a<M>b", "1<S>", "日本語 text 日本",
    "\x00zero", "line sep", "<<P<S<M", ">" * 50, "word " * 3_000,
]


def test_rows_equal_the_plain_rule_and_restore(spark):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(40 * len(TEXTS))] + [(None, "no id here"), (-5, "negative id"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = fill_in_middle(docs).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    key = lambda row: tuple((x is None, x) for x in row)
    assert sorted((tuple(r)[:6] for r in made), key=key) == sorted((plain(*row) for row in rows), key=key)
    texts = sorted(text or "" for _, text in rows)
    assert sorted(r["back"] for r in made) == texts
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}


@given(st.text(alphabet="ab<>PSM 1é\n𝄞", max_size=60))
@settings(max_examples=300, deadline=None)
def test_one_match_keeps_every_token_end(text):
    ends = UNITS.fullmatch(text).ends(1)
    assert ends == [m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]


def test_a_very_long_text(spark):
    text = ("Long words and 12 numbers, " * 200_000) + "end"
    row = fill_in_middle(spark.createDataFrame([(11, text)], "doc_id long, text string")).collect()[0]
    assert tuple(row) == plain(11, text)


def test_odd_rows(spark, odd, none):  # noqa: F811
    made = fill_in_middle(odd).collect()
    key = lambda row: tuple((x is None, x) for x in row)
    assert sorted(map(tuple, made), key=key) == sorted((plain(r["doc_id"], r["text"]) for r in odd.collect()), key=key)
    assert fill_in_middle(none).count() == 0


def test_no_shuffle(spark, odd):  # noqa: F811
    plan = fill_in_middle(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
