from orderweir.llm import decontaminate
from tests_llm_help import none, odd, prose  # noqa: F401

QUESTION = (
    "In a small town Alice Brown bought 12 kg of red apples for 30 dollars and gave 12 kg away. "
    "Later Alice Brown sold every basket to her neighbour. How many apples remained in the house?"
)
CHANGED = QUESTION.replace("Alice Brown", "Robert Smith").replace("12 kg", "47.5 pounds").replace("30 dollars", "99 euros")
BROKEN = QUESTION.replace("12 kg", "13 kg", 1).replace("30 dollars", "31 euros").replace("Alice Brown", "Robert Smith", 1)


def found(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string, extra string")
    rows = decontaminate.find_leaks(docs, bench).collect()
    return {(r["doc_id"], r["item_id"]): (r["covered"], r["n_tokens"], r["changed"]) for r in rows}


def test_exact_reparameterised_and_clean(spark):
    docs = [
        (1, prose(1) + ". " + QUESTION + " " + prose(2)),
        (2, prose(3) + ".\n" + CHANGED + "\n" + prose(4)),
        (3, prose(5, 400)),
        (4, QUESTION.upper()),
        (5, "In a small town people live. " + prose(6) + " the house?"),
        (6, None), (7, ""), (None, QUESTION), (8, prose(8, 20_000) + ". " + QUESTION), (1, prose(1) + ". " + QUESTION + " " + prose(2)),
    ]
    got = found(spark, docs, [(10, QUESTION, "x"), (11, prose(50), "x"), (None, QUESTION, "x"), (12, None, "x"), (13, "Too short", "x")])
    assert set(got) == {(1, 10), (2, 10), (4, 10), (8, 10)}
    n = got[1, 10][1]
    assert got[1, 10] == (n, n, False) and got[8, 10][0] == n
    assert got[2, 10][2] and got[2, 10][0] >= 0.9 * n


def test_slots_must_agree(spark):
    item = "the train number 7 left at 7 and came back at 7 before the second train number 7 could leave again"
    good = item.replace("7", "9")
    bad = "the train number 7 left at 8 and came back at 9 before the second train number 5 could leave again"
    got = found(spark, [(1, good), (2, bad)], [(1, item, "")])
    assert (1, 1) in got and got[1, 1][2] and (2, 1) not in got


def test_single_slots_may_disagree_merge_or_split(spark):
    twice = "the train number 7 left the old station late and came back to the same place before number 7 could leave"
    fruit = "anna has 3 apples and 5 pears in her basket and wants to know how many pieces of fruit there are"
    pets = "how many legs do 2 cats and 2 dogs have together when none of them has lost any"
    docs = [(1, "number 8".join(twice.rsplit("number 7", 1))), (2, fruit.replace("3", "4").replace("5", "4")),
            (3, pets.replace("2 cats", "3 cats").replace("2 dogs", "4 dogs"))]
    got = found(spark, docs, [(1, twice, ""), (2, fruit, ""), (3, pets, "")])
    assert set(got) == {(1, 1), (2, 2), (3, 3)} and all(g[2] for g in got.values())


def test_a_disagreeing_slot_takes_only_its_own_windows(spark):
    """A copy of forty words in which one of three equal numbers was changed."""
    item = f"{prose(80, 10)} 7 {prose(81, 10)} 7 {prose(82, 10)} 7 {prose(83, 10)}"
    got = found(spark, [(1, " 9 ".join(item.rsplit(" 7 ", 1)))], [(1, item, "")])
    assert got == {(1, 1): (42, 43, False)}


def test_short_items_and_items_of_numbers_are_found_as_they_stand(spark):
    items = [(1, "find the next number 2 4 8 16 32", ""), (2, "what is 12 times 7 plus 3", ""), (3, "name three noble gases", ""), (4, "3 plus 4", "")]
    docs = [(i, f"{prose(i)}. {text}. {prose(20 + i)}") for i, text, _ in items]
    other = [(11, "find the next number 2 4 8 16 33"), (12, "what is 12 times 8 plus 3"), (13, "name three noble metals"), (14, "3 plus 5")]
    got = found(spark, [*docs, *other], items)
    assert {k for k in got if k[0] < 10} == {(1, 1), (2, 2), (3, 3), (4, 4)}
    assert got[1, 1] == (9, 9, False) and got[2, 2] == (7, 7, False) and got[4, 4] == (3, 3, False)
    assert not {(13, 3), (14, 4)} & set(got)


def test_a_long_verbatim_run_is_found_and_scattered_windows_are_not(spark):
    item = prose(90, 60)
    words = item.split()
    run = f"{prose(91, 30)} {' '.join(words[20:40])} {prose(92, 30)}"
    far = " ".join(f"{' '.join(words[i : i + 6])} {prose(100 + i, 200)}" for i in range(0, 60, 7))
    near = " ".join(f"{' '.join(words[i : i + 6])} zzz" for i in range(0, 60, 7))
    got = found(spark, [(1, run), (2, far), (3, near)], [(5, item, "")])
    assert set(got) == {(1, 5), (3, 5)} and got[1, 5] == (20, 60, False)


def test_an_edited_copy_is_found_and_a_short_overlap_is_not(spark):
    item = prose(70, 60)
    words = item.split()
    edited = list(words)
    for i in (10, 30, 50):
        edited[i] = "zzz"
    overlap = prose(71, 30) + " " + " ".join(words[10:22]) + " " + prose(72, 30)
    got = found(spark, [(1, " ".join(edited)), (2, overlap)], [(5, item, "")])
    assert set(got) == {(1, 5)}


def test_blocks_of_a_large_benchmark_give_the_same(spark, monkeypatch):
    items = [(i, prose(100 + i), "") for i in range(12)]
    docs = [(i, prose(i) + " " + prose(100 + i % 12) + " " + prose(300 + i)) for i in range(20)]
    one = found(spark, docs, items)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 600)
    assert found(spark, docs, items) == one and len(one) == 20


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, prose(1))], "item_id long, text string")
    got = decontaminate.find_leaks(odd, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (7, 1)]
    left = decontaminate.drop_leaks(odd, bench)
    assert left.columns == odd.columns and left.count() == odd.count() - 3
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.find_leaks(odd, bench.where("false")).count() == 0
