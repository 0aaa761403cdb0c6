"""Chat formatting: conversations as training windows within a token budget, with a loss mask."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderweir.llm.common import stratum_key
from orderweir.operators.hotkeys import SLICE, slice_by_rows
from orderweir.session import stored

#: Marks of a turn (fixed values of a public chat format): start, role, line end, text, end.
START, END = "<|im_start|>", "<|im_end|>\n"
#: Strings that a tokenizer may read as control marks: a first character and a rest. A backslash is
#: put between the two, one more than there are, so that taking one away restores every text.
CONTROL = r"([<\[])(\\*)((?:\|[A-Za-z0-9_]+\|>)|(?:/?s>)|(?:</?SYS>>)|(?:/?INST\]))"
ESCAPED = r"([<\[])\\(\\*)((?:\|[A-Za-z0-9_]+\|>)|(?:/?s>)|(?:</?SYS>>)|(?:/?INST\]))"
#: A token: a run of ASCII letters or digits with one space before it, or any other code point.
TOKEN = "(?: ?[A-Za-z]+| ?[0-9]+|[^A-Za-z0-9])"
#: Tokens of a turn's marks and role.
OVERHEAD = 8

BUDGET, HISTORY = 512, 128
#: A cell is what one row of the grouping holds: turns, and code points apart from the last turn's.
CELL_TURNS, CELL_CHARS = 1_024, 1 << 24

DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"$1$2$3")


def _role(role: Column) -> Column:
    """A role in one line: backslash and line end are written with a backslash."""
    plain = F.coalesce(role.cast("string"), F.lit(""))
    return escaped(F.replace(F.replace(plain, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_back(role: Column) -> Column:
    """Line ends first, where the backslash is not itself written with one."""
    line = F.regexp_replace(unescaped(role), r"((?:^|[^\\])(?:\\\\)*)\\n", "$1\n")
    line = F.regexp_replace(line, r"((?:^|[^\\])(?:\\\\)*)\\n", "$1\n")  # two in a row share a character
    return F.replace(line, F.lit("\\\\"), F.lit("\\"))


def turn_pieces(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every turn as its piece of output, with its tokens, lengths in code points and whether it is a target."""
    body = escaped(F.coalesce(text, F.lit("")))
    head = F.concat(F.lit(START), _role(F.col(role)), F.lit("\n"))
    spelled = F.regexp_replace(F.coalesce(text, F.lit("")), TOKEN, "x")
    return turns.select(
        F.col(conv).cast("long").alias("conv_id"),
        stratum_key(F.col(conv)).alias("_c"),
        F.col(turn).isNull().alias("late"),
        F.col(turn).cast("long").alias("turn"),
        F.concat(head, body, F.lit(END)).alias("piece"),
        (F.length(spelled) + OVERHEAD).cast("long").alias("tokens"),
        F.length(head).cast("long").alias("head"),
        F.length(body).cast("long").alias("body"),
        F.coalesce(F.col(role) == "assistant", F.lit(False)).alias("target"),
        F.coalesce(F.col(role) == "system", F.lit(False)).alias("system"),
    ).withColumn("chars", F.length("piece").cast("long"))


def _whole_and_cut(pieces: DataFrame, budget: int, history: int, cell_turns: int, cell_chars: int) -> DataFrame:
    """Adds `cell` and `lent`: conversations of usual size are cell 0, others are cut into cells along their turns.

    Cells follow from turn counts and lengths alone. Every later cell is lent the system turn (lent 2) and the
    turns before it that may be its history (lent 1).
    """
    sizes = pieces.groupBy("_c").agg(F.count("*").alias("_n"), F.sum("chars").alias("_m"))
    large = stored(sizes.where((F.col("_n") > cell_turns) | (F.col("_m") > cell_chars)).select("_c"), "chat-large")
    usual = pieces.join(large, "_c", "left_anti").withColumns({"cell": F.lit(0).cast("long"), "lent": F.lit(0)})

    # Equal rows are interchangeable; a number keeps them from sharing one slice.
    order = ["late", "turn", "piece", "_row"]
    numbered = pieces.join(large, "_c", "left_semi").withColumn("_row", F.monotonically_increasing_id())
    slices = slice_by_rows(numbered, "_c", order, cell_turns)
    per = slices.groupBy("_c", SLICE).agg(F.count("*").alias("_n"), F.sum("chars").alias("_m"))
    earlier = W.partitionBy("_c").orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    before = per.select("_c", SLICE, *[F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(x) for x in ("_n", "_m")])
    within = W.partitionBy("_c", SLICE).orderBy(*order)
    so_far = F.coalesce(F.sum("chars").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = (
        slices.withColumns({"_pos": F.row_number().over(within) - 1, "_at": so_far})
        .join(before, ["_c", SLICE])
        .withColumn("pos", F.col("_n") + F.col("_pos"))
        .withColumn("cell", F.floor(F.col("pos") / cell_turns) + F.floor((F.col("_m") + F.col("_at")) / cell_chars))
        .select(*pieces.columns, "pos", "cell")
    )
    rows = stored(rows, "chat-cells")
    head = (F.col("pos") == 0) & F.col("system") & (F.col("tokens") <= budget // 4)
    firsts = rows.groupBy("_c", "cell").agg(F.min("pos").alias("first")).where("first > 0")
    wanted = firsts.select(
        "_c", F.col("cell").alias("to"), F.explode(F.sequence(F.greatest(F.lit(0), F.col("first") - history // OVERHEAD), F.col("first") - 1)).alias("pos")
    )
    own = rows.drop("pos").withColumn("lent", F.lit(0))
    tail = rows.where(~head).join(wanted, ["_c", "pos"]).drop("pos", "cell").withColumnRenamed("to", "cell")
    heads = rows.where(head).drop("pos", "cell").join(firsts.select("_c", "cell"), "_c")
    lent = tail.withColumn("lent", F.lit(1)).unionByName(heads.withColumn("lent", F.lit(2)))
    return usual.unionByName(own).unionByName(lent)


def windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text", cell_turns: int = CELL_TURNS, cell_chars: int = CELL_CHARS,
) -> DataFrame:
    """Training windows: conv_id, cell, window, formatted, n_turns, n_repeated, n_tokens, loss (start and length of each target).

    Turns stand in the order of their number, equal ones by their written form, nulls last. Prefix sums of
    tokens choose the spans: each window takes turns while the sum since its start stays within the budget less
    `history` and the system turn. In front of them it repeats the system turn (a first turn of that role, of a quarter of the budget at most; a longer one is a
    usual turn) and the last earlier turns of up to `history` tokens. `loss` masks the texts
    of the assistant's turns, in code points of `formatted`, without repeated ones.

    * A turn longer than the span is a window of its own, longer than the budget; nothing is cut or left out.
    * null text: empty; null role: empty, no target; null turn: after all others; null conv_id: a conversation.
    * repeated rows: each is a turn. Empty table: empty result. Other columns are not read.
    * A conversation of very many turns is cut into cells, which only end windows early.
    """
    pieces = turn_pieces(turns, conv, turn, role, text)
    cells = _whole_and_cut(pieces, budget, history, cell_turns, cell_chars)
    first = F.when(F.col("lent") == 2, 0).when(F.col("lent") == 1, 1).otherwise(2)
    item = F.struct(first.alias("rank"), "late", "turn", "piece", "tokens", "head", "body", "target", "system", "chars")
    grouped = cells.groupBy("_c", "cell").agg(
        F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(item)).alias("t"), F.count_if(F.col("lent") > 0).alias("lent")
    )
    sums = lambda name: F.aggregate(
        f"t.{name}", F.array(F.lit(0).cast("long")), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x))
    )
    top = F.col("t")[0]
    retained = (top["rank"] == 0) | ((F.col("cell") == 0) & (F.col("lent") == 0) & top["system"] & (top["tokens"] <= budget // 4))
    col = F.col
    known = grouped.withColumns({"p": sums("tokens"), "c": sums("chars"), "n": F.size("t"), "s": retained.cast("int")})
    known = known.withColumn("o", F.greatest(col("s"), col("lent").cast("int")))
    room = F.lit(budget - history) - col("p")[col("s")]
    # Places of turns that start a window: a turn that would end beyond the room starts the next one.
    starts = F.aggregate(
        F.when(col("n") > col("o"), F.sequence(col("o"), col("n") - 1)).otherwise(F.array(col("o"))),
        F.array(col("o")),
        lambda done, i: F.when(
            (i > F.element_at(done, -1)) & (F.get("p", i + 1) - F.get("p", F.element_at(done, -1)) > room),
            F.concat(done, F.array(i)),
        ).otherwise(done),
    )
    known = known.withColumn("starts", starts)

    def window(f: Column, i: Column) -> Column:
        end = F.coalesce(F.get("starts", i + 1), col("n"))
        far = F.filter(F.slice("p", col("s") + 1, f - col("s")), lambda x: F.get("p", f) - x > history)
        h = col("s") + F.size(far)
        system_chars = F.get("c", col("s"))
        opening = (col("lent") == 0) & (i == 0)  # here the system turn is new
        loss = F.transform(
            F.filter(F.sequence(f, F.greatest(end - 1, f)), lambda j: F.coalesce(F.get("t", j)["target"], F.lit(False))),
            lambda j: F.struct(
                (system_chars + F.get("c", j) - F.get("c", h) + F.get("t", j)["head"]).alias("start"),
                F.get("t", j)["body"].alias("length"),
            ),
        )
        pieces = F.concat(F.slice("t.piece", F.lit(1), col("s")), F.slice("t.piece", h + 1, end - h))
        return F.struct(
            i.alias("window"),
            F.array_join(pieces, "").alias("formatted"),
            F.size(pieces).alias("n_turns"),
            (f - h + F.when(opening, 0).otherwise(col("s"))).alias("n_repeated"),
            (F.get("p", col("s")) + F.get("p", end) - F.get("p", h)).alias("n_tokens"),
            loss.alias("loss"),
        )

    return known.select("conv_id", "_c", "cell", F.explode(F.transform("starts", window)).alias("w")).select(
        "conv_id", "_c", "cell", "w.*"
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """From windows alone: (conv_id, _c, cell, window, formatted_chars, n_new, turns, loss), the last two as texts.

    `turns`: role, line end, text, line end of each turn that is not repeated; `loss`: what lies under the mask.
    """
    turns = F.slice(F.split("formatted", F.lit("<\\|im_start\\|>"), -1), F.col("n_repeated") + 2, F.col("n_turns"))

    def turn(piece: Column) -> Column:
        line = F.position(F.lit("\n"), piece)
        role = F.substr(piece, F.lit(1), line - 1)
        text = F.substr(piece, line + 1, F.length(piece) - line - len(END))
        return F.concat(_role_back(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    masked = F.transform("loss", lambda x: unescaped(F.substr(F.col("formatted"), x["start"].cast("int") + 1, x["length"].cast("int"))))
    return formatted.select(
        "conv_id",
        "_c",
        "cell",
        "window",
        F.length("formatted").cast("long").alias("formatted_chars"),
        (F.col("n_turns") - F.col("n_repeated")).cast("long").alias("n_new"),
        F.array_join(F.transform(turns, turn), "").alias("turns"),
        F.array_join(masked, "").alias("loss"),
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running checksums; rows come by conversation, cell and window, and only one conversation is open at a time."""
    key, state, done = None, None, []

    def closed() -> None:
        if state is not None:
            conv, n, turns, chars, loss, size = state
            done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))

    names = [part.split()[0] for part in DIGEST.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    batch_of = lambda: pa.RecordBatch.from_arrays(
        [pa.array(list(values), kind) for values, kind in zip(zip(*done), kinds)], names=names
    )
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            mark, conv, size, new, turns, loss = row
            if mark != key:
                closed()
                key, state = mark, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[1] += new
            state[2].update(turns.encode())
            state[3] += len(loss)
            state[4].update(loss.encode())
            state[5] += size
        if done:
            yield batch_of()
            done.clear()
    closed()
    if done:
        yield batch_of()


def digests(formatted: DataFrame) -> DataFrame:
    """Checksums of each conversation's turns and of its text under the loss mask, read back from the windows.

    A checksum runs through a conversation from its first turn to its last, so one task streams it, holding
    one batch of windows however many there are.
    """
    parts = read_back(formatted).repartition("_c").sortWithinPartitions("_c", "cell", "window")
    return parts.select("_c", "conv_id", "formatted_chars", "n_new", "turns", "loss").mapInArrow(_digest, DIGEST)
