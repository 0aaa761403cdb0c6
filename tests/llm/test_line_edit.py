import random

import pytest

from orderweir.llm import line_edit
from tests_llm_help import none, odd  # noqa: F401


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def edited(draw, text, edits, letters):
    out = list(text)
    for _ in range(edits):
        k, kind = draw.randrange(len(out) + 1), draw.random()
        if kind < 0.4:
            out.insert(k, draw.choice(letters))
        elif out and kind < 0.7:
            out.pop(min(k, len(out) - 1))
        elif out:
            out[min(k, len(out) - 1)] = draw.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("edits", [0, 1, 2, 4])
def test_banded_distance_equals_brute_force(spark, edits):
    draw = random.Random(edits)
    pairs = []
    for _ in range(200):
        a = "".join(draw.choice("abé") for _ in range(draw.randint(0, 14)))
        pairs.append((a, edited(draw, a, draw.randint(0, 5), "abé")))
    got = line_edit.with_distance(spark.createDataFrame(pairs, "a string, b string"), "a", "b", edits).collect()
    assert len(got) == 200
    for r in got:
        d = distance(r["a"], r["b"])
        assert r["distance"] == (d if d <= edits else -1)


def brute(rows, tiers):
    lines = sorted({(d, i, x) for d, t in rows if d is not None for i, x in enumerate((t or "").split("\n")) if x})
    texts = sorted({x for _, _, x in lines})
    root, links = {x: x for x in texts}, dict.fromkeys(texts, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(texts):
        for b in texts[:n]:
            edits = sum(min(len(a), len(b)) >= least for least in tiers)
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                root[find(a)] = find(b)
                links[a] += 1
                links[b] += 1
    first = {}
    for d, i, x in lines:
        first.setdefault(find(x), (d, i))
    return {(d, i): (*first[find(x)], links[x]) for d, i, x in lines}


def classes(docs, tiers):
    return {(r["doc_id"], r["line_no"]): (r["class_doc"], r["class_line"], r["n_links"]) for r in line_edit.link_lines(docs, tiers).collect()}


@pytest.mark.parametrize("tiers,hot", [((), 0), ((20,), -1), ((20, 24), 100_000), ((20, 24), -1), ((6, 10, 16), -1)])
def test_classes_equal_brute_force_also_when_all_segments_are_hot(spark, monkeypatch, tiers, hot):
    monkeypatch.setattr(line_edit, "HOT_PAIRS", hot)
    draw = random.Random(9)
    base = ["".join(draw.choice("abcdefgh ") for _ in range(draw.choice([1, 2, 4, 7, 11, *range(17, 28)]))) for _ in range(18)]
    most = len(tiers) + 1
    rows = [(i, "\n".join(edited(draw, draw.choice(base), draw.randint(0, most), "abxyz") for _ in range(draw.randint(0, 5)))) for i in range(50)]
    rows += [(None, "x" * 30), (70, None), (71, ""), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(docs, tiers) == brute(rows, tiers)


@pytest.mark.parametrize("tiers", [(20,), (20, 20), (20, 20, 20)])
def test_a_segment_that_many_lines_share_is_cut_again(spark, monkeypatch, tiers):
    monkeypatch.setattr(line_edit, "HOT_PAIRS", 60)
    draw = random.Random(4)
    stem = "entry {} of the list that every page of this site shows"
    rows = [(i, edited(draw, stem.format(draw.randint(1, 40_000)), draw.choice([0, 0, 1]), "xyz")) for i in range(90)]
    rows += [(100 + i, stem.format(i)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(docs, tiers) == brute(rows, tiers)


def test_equal_short_lines_are_one_class(spark):
    docs = spark.createDataFrame([(1, "Read more\nRead mor"), (2, "Read more\n\nx"), (3, "x")], "doc_id long, text string")
    got = {(r["doc_id"], r["line_no"]): (r["class_doc"], r["class_line"], r["kept"]) for r in line_edit.link_lines(docs).collect()}
    assert got == {(1, 0): (1, 0, True), (1, 1): (1, 1, True), (2, 0): (1, 0, False), (2, 2): (2, 2, True), (3, 0): (2, 2, False)}


def test_more_edits_need_longer_lines(spark):
    short, long = "a line of thirty characters ok", "a line of some more characters, which may differ in two"
    rows = [(1, short), (2, short.replace("li", "xy")), (3, long), (4, long.replace("li", "xy")), (5, short.replace("l", "x", 1))]
    got = {r["doc_id"]: r["class_doc"] for r in line_edit.link_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 1}  # 2 reaches 1 through 5 only


def test_later_copies_of_a_line_go(spark):
    line = "a line that stands in many documents"
    rows = [(1, f"short\n{line}\n\nlast"), (2, f"{line}!\nshort\n\nits own line, which is long"), (3, line)]
    got = {r["doc_id"]: r["text"] for r in line_edit.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\nits own line, which is long", 3: ""}


def test_odd_rows(odd, none):  # noqa: F811
    rows = line_edit.link_lines(odd).collect()
    whole = {r["doc_id"]: r for r in rows}
    assert whole[7]["class_doc"] == 1 and not whole[7]["kept"] and {2, 3, None}.isdisjoint(whole)
    assert [r["n_chars"] for r in sorted(rows, key=lambda r: r["line_no"]) if r["doc_id"] == 4] == [1, 2]  # blanks are lines, too
    assert sum(r["doc_id"] == 1 and r["kept"] for r in rows) == 2
    assert line_edit.link_lines(none).count() == 0
