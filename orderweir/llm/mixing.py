"""Mixing sources to target weights by Pfair scheduling.

A source of weight a beside sources that weigh W together releases its block j at j*W/a (rounded down) and must have it
placed by (j+1)*W/a (rounded up). Earliest deadline first over these windows keeps every source within less than one
block of its share. The slots are cut into rounds that are scheduled apart: what each source has placed at a round's
start follows from the weights and the time alone (`_ahead`), so a round needs no other round's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.llm.common import celled, neutral, rank_in_cell, stratum_key, tie_break
from orderweir.session import stored

#: Rounds that one row stands for before it is spread over the tasks.
GROUPED = 16


def _let(name: str, value: str, body: str) -> str:
    """SQL of `body` in which `name` stands for `value`, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _shares(active: str, at: str, total: str) -> str:
    """For each active source its share of the slots up to `at`: whole blocks (`whole`) and the rest (`f`, of `total`)."""
    exact = f"(cast({at} as decimal(19,0)) * cast(z.a as decimal(19,0)))"
    return (
        f"transform({active}, z -> struct(z.i as i, z.a as a, {exact} div {total} as whole,"
        f" cast({exact} % {total} as bigint) as f))"
    )


def _ahead(shares: str, total: str) -> str:
    """Numbers of the sources that have placed one block more than the whole part of their share.

    Each source with a rest has one block whose window is open: released `age` slots ago, due in `due` slots. Taken by
    deadline, a block is placed if the slots since its release have room: of the last u slots, blocks whose whole window
    lies in them need their own. The sum of the rests says how many are placed. This is where earliest deadline first
    over all slots from the phase's start would be.
    """
    opened = (
        f"array_sort(transform(filter({shares}, z -> z.f > 0), z -> struct("
        f"({total} - z.f + z.a - 1) div z.a as due, z.i as i, (z.f + z.a - 1) div z.a as age)))"
    )
    room = (
        "transform(filter(sequence(0L, coalesce(array_max(transform(op, o -> o.age)), 1L) - 1), u -> u > 0), u -> struct(u as u,"
        f" u - aggregate({shares}, 0L, (m, z) -> m + greatest(u * z.a - z.f, 0L) div {total}) as x))"
    )
    taken = (
        f"aggregate(op, struct({room} as room, cast(array() as array<int>) as taken,"
        f" aggregate({shares}, 0L, (m, z) -> m + z.f) div {total} as most),"
        " (g, o) -> if(size(g.taken) >= g.most or exists(g.room, r -> r.u >= o.age and r.x <= 0), g,"
        " struct(transform(g.room, r -> struct(r.u as u, if(r.u >= o.age, r.x - 1, r.x) as x)) as room,"
        " concat(g.taken, array(o.i)) as taken, g.most as most)), g -> g.taken)"
    )
    return _let("op", opened, taken)


def _phases() -> str:
    """SQL: of `strata` (s, a, m) the phases (base, slots, total, active (i, a, first), late).

    A phase lasts while the same sources have blocks left: until the first one's share reaches its last block.
    That block, if it is not placed by then, comes right after (`late`). `first` is what a source had placed before.
    """
    active = "filter(transform(strata, (z, i) -> struct(i as i, z.a as a, p.done[i] as first, z.m - p.done[i] as left)), z -> z.left > 0)"
    reach = "cast(y.left as decimal(19,0)) * cast(w as decimal(19,0))"
    slots = f"array_min(transform(act, y -> ({reach}) div y.a))"
    after = (
        "transform(p.done, (x, i) -> x + coalesce("
        " get(filter(sh, z -> z.i = i), 0).whole + if(array_contains(ah, i), 1, 0), 0L))"
    )
    ended = f"filter(act, y -> ({reach}) div y.a = t and dn[y.i] < strata[y.i].m)"
    step = (
        "struct(transform(dn, (x, i) -> x + if(exists(lt, y -> y.i = i), 1L, 0L)) as done, p.base + t + size(lt) as base,"
        " concat(p.made, array(struct(p.base as base, t as slots, w as total,"
        " transform(act, y -> struct(y.i as i, y.a as a, y.first as first)) as active,"
        " transform(lt, y -> struct(y.i as i, dn[y.i] as j)) as late))) as made)"
    )
    step = _let("lt", ended, step)
    step = _let("dn", after, step)
    step = _let("ah", _ahead("sh", "w"), step)
    step = _let("sh", _shares("act", "t", "w"), step)
    step = _let("t", slots, step)
    step = _let("w", "aggregate(act, 0L, (m, y) -> m + y.a)", step)
    step = f"if(size(act) = 0, p, {step})"
    step = _let("act", active, step)
    empty = (
        "cast(array() as array<struct<base: bigint, slots: bigint, total: bigint,"
        " active: array<struct<i: int, a: bigint, first: bigint>>, late: array<struct<i: int, j: bigint>>>>)"
    )
    start = f"struct(transform(strata, z -> 0L) as done, 0L as base, {empty} as made)"
    return f"aggregate(sequence(1, size(strata)), {start}, (p, k) -> {step}, p -> p.made)"


def _runs() -> str:
    """SQL: of a round's columns (active, start, len, total) what each source places in it.

    i: its number; a: its weight; f: its rest at the start; blocks `now` to before `upto`, counted from block `whole`.
    """
    runs = (
        "transform(fr, (z, k) -> struct(z.i as i, z.a as a, z.f as f, active[k].first + z.whole as whole,"
        " if(array_contains(bf, z.i), 1L, 0L) as now, un[k].whole - z.whole + if(array_contains(af, z.i), 1L, 0L) as upto))"
    )
    runs = _let("bf", _ahead("fr", "total"), _let("af", _ahead("un", "total"), runs))
    return _let("fr", _shares("active", "start", "total"), _let("un", _shares("active", "(start + len)", "total"), runs))


#: SQL: earliest deadline first over a round's slots, ties to the source that sorts first.
EDF = """
aggregate(sequence(0L, len - 1),
  struct(transform(runs, r -> r.now) as now, cast(array() as array<struct<k: int, j: bigint>>) as made),
  (e, t) -> transform(array(array_min(filter(
      transform(runs, (r, k) -> struct(
        ((e.now[k] + 1) * total - r.f + r.a - 1) div r.a as due, k as k,
        e.now[k] < r.upto and e.now[k] * total < r.f + (t + 1) * r.a as ready)),
      b -> b.ready))),
    b -> struct(transform(e.now, (x, k) -> if(k = b.k, x + 1, x)) as now,
                concat(e.made, array(struct(b.k as k, e.now[b.k] as j))) as made))[0],
  e -> e.made)
"""


def strata_of(docs: DataFrame, stratum: str, weights: dict[str, float] | None, block_rows: int) -> DataFrame:
    """(s, a, m): the weight as a whole number and the blocks of each source."""
    sizes = docs.groupBy(stratum_key(F.col(stratum)).alias("s")).agg(F.count("*").alias("n"))
    if weights is None:
        parts = F.floor(F.sqrt(F.col("n").cast("double")) * 1000)
    else:
        given = [F.when(F.col("s") == f"={name}", F.lit(round(w * 1e6))) for name, w in weights.items()]
        parts = F.coalesce(*given, F.lit(1_000_000))
    return sizes.select(
        "s",
        F.greatest(parts.cast("long"), F.lit(1).cast("long")).alias("a"),
        F.expr(f"(n + {block_rows - 1}) div {block_rows}").alias("m"),
    )


def schedule_of(strata: DataFrame, round_slots: int) -> DataFrame:
    """(s, j, slot): the slot of every block j of every source.

    One row per block, made round by round; the sources themselves are one row.
    """
    one = strata.groupBy().agg(F.array_sort(F.collect_list(F.struct("s", "a", "m"))).alias("strata")).where("size(strata) > 0")
    phases = one.select(F.expr("transform(strata, z -> z.s)").alias("names"), F.explode(F.expr(_phases())).alias("p"))
    phases = stored(phases.select("names", "p.*"), "mix-phases")
    groups = phases.where("slots > 0").withColumn(
        "group", F.explode(F.expr(f"sequence(0L, (slots - 1) div {round_slots * GROUPED}L)"))
    )
    rounds = (
        groups.repartition("base", "group")
        .withColumn("start", F.explode(F.expr(f"transform(sequence(0L, {GROUPED - 1}L), k -> (group * {GROUPED} + k) * {round_slots}L)")))
        .where("start < slots")
        .withColumn("len", F.expr(f"least({round_slots}L, slots - start)"))
        .withColumn("runs", F.expr(_runs()))
        .select("names", "base", "start", "runs", F.posexplode(F.expr(EDF)).alias("slot", "made"))
    )
    placed = rounds.select(
        F.expr("names[runs[made.k].i]").alias("s"),
        F.expr("runs[made.k].whole + made.j").alias("j"),
        F.expr("base + start + slot").alias("slot"),
    )
    late = phases.select("names", "base", "slots", F.posexplode("late").alias("k", "l"))
    return placed.unionByName(
        late.select(F.expr("names[l.i]").alias("s"), F.expr("l.j").alias("j"), F.expr("base + slots + k").alias("slot"))
    )


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block_rows: int = 64,
    round_slots: int = 256,
    seed: str = "mix",
    id_col: str = "doc_id",
    stratum: str = "source",
    tie: str = "text",
    rank: str | None = None,
) -> DataFrame:
    """Adds `mix_block` and `mix_row`: all rows in one order whose sources follow the weights.

    Each source is shuffled by the seed and cut into blocks of `block_rows` rows (its last one may be shorter). From its
    target weight every block has a release time and a deadline, and earliest deadline first interleaves the blocks: at
    every slot each source has had its share by the weights themselves, give or take less than one block, however many
    blocks there are. Nothing is dropped or repeated: when a source has ended the others share its slots by their
    weights, counted from there on. Without `weights` a source weighs the square root of its rows; a source that
    `weights` does not name weighs 1. Weights count to a millionth.
    `rank` names a column for the row's place within its source (from 1), for steps that go on with the order.

    `round_slots` slots are scheduled at a time, each such round apart from the others; the result does not depend on it. The
    schedule has one row per block and reaches the rows as one list per cell of their seeded order. A round's work grows
    with the number of sources times the slots between two blocks of the lightest one: this is for mixtures of up to some
    hundred sources whose weights are no less than about 0.0001 of the whole; lighter ones are right but slow.

    * null id: seeded like an empty one; null source: a source of its own; texts only break ties;
      repeated rows: each is placed, equal ones in any order (ties go by id, then by the CRC-32 of `tie`,
      or by `tie` itself if it is a number).
    * empty table: empty result. Existing columns `mix_block` and `mix_row` are replaced.
    """
    docs, names, restored = neutral(docs)
    restored = [c for c, name in zip(restored, names) if name not in ("mix_block", "mix_row", rank)]
    extra = [F.col("_rank").alias(rank)] if rank else []
    id_col, stratum, tie = names[id_col], names[stratum], tie_break(docs, names[tie])
    schedule = schedule_of(stored(strata_of(docs, stratum, weights, block_rows), "mix"), round_slots)
    keyed, starts = celled(docs, docs.count(), seed, id_col, stratum, tie)
    spans = starts.withColumn("_first", F.expr(f"_start div {block_rows}"))
    wanted = spans.withColumn("_j", F.explode(F.expr(f"sequence(_first, (_start + _n - 1) div {block_rows})")))
    lists = (
        wanted.join(schedule.toDF("_s", "_j", "_slot"), ["_s", "_j"])
        .groupBy("_s", "_cell", "_start", "_first")
        .agg(F.expr("transform(array_sort(collect_list(struct(_j, _slot))), x -> x._slot)").alias("_slots"))
    )
    return (
        rank_in_cell(keyed, stored(lists, "mix"), id_col, tie)
        .withColumn("mix_block", F.expr(f"_slots[cast((_rank - 1) div {block_rows} - _first as int)]"))
        .withColumn("mix_row", F.expr(f"cast((_rank - 1) % {block_rows} as int)"))
        .select(*restored, "mix_block", "mix_row", *extra)
    )
