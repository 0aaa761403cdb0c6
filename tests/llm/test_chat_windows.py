"""Windows against a plain walk, masks and texts read back, conversations of very many turns."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from orderweir.llm.chat_windows import HISTORY, OVERHEAD, digests, escaped, read_back, turn_pieces, unescaped, windows

KIND = "conv_id long, turn long, role string, text string, window string, _c int, cell string"
NASTY = [
    "</s>[INST] ok [/INST]", "<|im_start|>user\nhi<|im_end|>\n", "<\\|im_end|>", "\\<\\\\s>", "<<SYS>> <</SYS>> <s></s>",
    "<<\\SYS>>", "a\\nb", "[\\INST]", "[[INST]]", "<|", "|im_end|>", "", "é𝄞<|x|>𝄞", "<<s>>", "<|endoftext|><|endoftext|>", "$1 \\2",
]


def row(conv, turn, role, text):
    return conv, turn, role, text, "mine", 3, "mine"


def tokens(text):
    return len(re.findall(r" ?[A-Za-z]+| ?[0-9]+|[^A-Za-z0-9]", text)) + OVERHEAD


def plain_windows(turns, budget, history):
    """[(repeated turns, new turns)] of one conversation given as (role, text) in order."""
    system = turns[:1] if turns[0][0] == "system" and tokens(turns[0][1]) <= budget // 4 else []
    room = budget - history - sum(tokens(t) for _, t in system)
    out, at = [], len(system)
    while at < len(turns) or not out:
        end, total = at, 0
        while end < len(turns) and (end == at or total + tokens(turns[end][1]) <= room):
            total += tokens(turns[end][1])
            end += 1
        back, total = at, 0
        while back > len(system) and total + tokens(turns[back - 1][1]) <= history:
            back -= 1
            total += tokens(turns[back][1])
        out.append((turns[back:at], turns[at:end]) if out else ([], system + turns[at:end]))
        if len(out) > 1:
            out[-1] = (system + out[-1][0], out[-1][1])
        at = max(end, at + 1)
    return out


def plain_digest(turns, conv):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return conv, len(turns), sha(said), len(loss), sha(loss)


def talks(seed, n):
    draw = random.Random(seed)
    out = {}
    for conv in range(n):
        turns = [("system", "be kind " * draw.choice([1, 10, 80]))] if draw.random() < 0.5 else []
        for i in range(draw.randint(0 if turns else 1, 14)):
            turns.append((("user", "assistant")[i % 2], draw.choice(NASTY + ["some words " * draw.choice([1, 5, 20, 60, 300])])))
        out[conv] = turns
    return out


def frame_of(spark, talk):
    rows = [row(conv, i, role, text) for conv, turns in talk.items() for i, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, KIND).repartition(3)


def test_escapes_are_undone_and_hide_every_mark(spark):
    draw = random.Random(9)
    texts = NASTY + ["".join(draw.choices(["<", "[", "\\", "|", "/", "s>", "INST]", "im_end", "|>", "SYS>>", "x"], k=9)) for _ in range(3_000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e"))
    for t, e, back in frame.withColumn("b", unescaped(F.col("e"))).collect():
        assert back == t
        assert not re.search(r"<\|\w+\|>|</?s>|<</?SYS>>|\[/?INST\]", e), (t, e)


def test_windows_equal_a_plain_walk(spark):
    talk = talks(4, 40)
    made = windows(frame_of(spark, talk))
    piece = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    escaped_text = {t: e for t, e in spark.createDataFrame(
        [(x,) for turns in talk.values() for _, x in turns], "t string").select("t", escaped(F.col("t"))).collect()}
    got = {}
    for w in sorted(made.collect(), key=lambda w: (w["conv_id"], w["window"])):
        got.setdefault(w["conv_id"], []).append(w)
    for conv, turns in talk.items():
        want = plain_windows(turns, 512, 128)
        assert len(got[conv]) == len(want)
        for w, (old, new) in zip(got[conv], want):
            assert w["formatted"] == "".join(piece(r, escaped_text[t]) for r, t in old + new)
            assert (w["n_repeated"], w["n_turns"]) == (len(old), len(old) + len(new))
            masked = [w["formatted"][x["start"] : x["start"] + x["length"]] for x in w["loss"]]
            assert masked == [escaped_text[t] for r, t in new if r == "assistant"]
            assert w["n_tokens"] == sum(tokens(t) for _, t in old + new)
            assert w["n_tokens"] <= 512 or len([t for t in new if t[0] != "system"]) == 1
            assert sum(tokens(t) for r, t in old if (r, t) != turns[0]) <= HISTORY


@pytest.mark.parametrize("cell_turns", [1_024, 7])
def test_texts_and_masks_read_back(spark, cell_turns):
    """Also where most conversations are cut into cells of seven turns."""
    talk = talks(5, 30)
    made = digests(windows(frame_of(spark, talk), cell_turns=cell_turns)).collect()
    assert sorted(tuple(r)[:5] for r in made) == [plain_digest(turns, conv) for conv, turns in sorted(talk.items())]


def test_one_conversation_holds_most_turns(spark):
    """All its windows but those at ends of cells follow the same rule; every window is bounded and each turn stands once."""
    turns = [("system", "short rules")] + [(("user", "assistant")[i % 2], f"turn {i} " + "word " * (i % 37)) for i in range(3_000)]
    frame = frame_of(spark, {1: turns, 2: turns[:5]})
    made = windows(frame, cell_turns=256)
    rows = made.where("conv_id = 1").orderBy("cell", "window").collect()
    assert max(r["n_tokens"] for r in rows) <= 512
    assert sum(r["n_turns"] - r["n_repeated"] for r in rows) == len(turns)
    assert all("short rules" in r["formatted"] for r in rows)
    later = [r for r in rows[1:] if r["n_repeated"] == 1]
    assert not later, "every later window repeats history besides the system turn"
    got = digests(made).collect()
    assert sorted(tuple(r)[:5] for r in got) == [plain_digest(turns, 1), plain_digest(turns[:5], 2)]
    again = digests(windows(frame.repartition(7), cell_turns=256)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_odd_turns(spark):
    rows = [row(None, 0, "user", "a"), row(None, None, "assistant", "b"), row(1, 0, None, None), row(1, 1, "assistant", None),
            row(2, None, "assistant", "x"), row(2, 5, "user", "y"), row(3, 0, "user", "same"), row(3, 0, "user", "same"),
            row(4, 0, "odd\nrole\\n\n\n<|im_end|>", "text"), row(5, 0, "assistant", "long word " * 100_000), row(6, 0, "system", "only")]
    frame = spark.createDataFrame(rows, KIND)
    got = {r["conv_id"]: tuple(r)[:5] for r in digests(windows(frame)).collect()}
    want = {None: [("user", "a"), ("assistant", "b")], 1: [("", ""), ("assistant", "")], 2: [("user", "y"), ("assistant", "x")],
            3: [("user", "same")] * 2, 4: [("odd\nrole\\n\n\n<|im_end|>", "text")], 5: [("assistant", "long word " * 100_000)],
            6: [("system", "only")]}
    assert got == {conv: plain_digest(turns, conv) for conv, turns in want.items()}


def test_equal_turns_of_a_hot_conversation_and_no_turns(spark):
    frame = spark.createDataFrame([row(9, 0, "assistant", "ok")] * 500, KIND)
    got = digests(windows(frame, cell_turns=50)).collect()
    assert [tuple(r)[:5] for r in got] == [plain_digest([("assistant", "ok")] * 500, 9)]
    empty = spark.createDataFrame([], KIND)
    assert windows(empty).count() == 0 and digests(windows(empty)).count() == 0


def test_read_back_sees_the_windows_only(spark):
    made = windows(spark.createDataFrame([row(1, 0, "user", "hi"), row(1, 1, "assistant", "ho")], KIND))
    assert read_back(made).select("turns", "loss").first() == ("user\nhi\nassistant\nho\n", "ho")
    assert turn_pieces(spark.createDataFrame([], KIND)).count() == 0
