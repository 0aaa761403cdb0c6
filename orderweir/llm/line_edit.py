"""Line de-duplication: a segment-partition edit join, verified by banded bit-parallel edit distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweir.llm.common import components
from orderweir.session import stored

#: Characters of the shorter line from which one more edit links two lines; below the first, only equal lines are one.
TIERS = (20, 40)
#: A segment whose lines make more pairs than this is cut again within its group before any pair is made.
HOT_PAIRS = 100_000
#: Candidate lines are first sifted by this many low bits of their id, so that the broadcast list is bounded.
SIEVE = 1 << 20
#: Letters that are counted, modulo 16, to sift candidates.
COUNTED = "etaoinsrhldcumfp"


def letter_counts(line: Column) -> Column:
    """Counts of sixteen letters modulo 16 in one number."""
    size = F.octet_length(line)
    counts = [(size - F.octet_length(F.replace(line, F.lit(c)))).bitwiseAND(F.lit(15)) for c in COUNTED]
    out = F.lit(0).cast("long")
    for i, count in enumerate(counts):
        out = out.bitwiseOR(F.shiftleft(count.cast("long"), 4 * i))
    return out


def letters_apart(a: Column, b: Column) -> Column:
    """At least this many letters are more or fewer in one of the lines: an edit changes two counts at most."""
    apart = F.lit(0)
    for i in range(len(COUNTED)):
        low = lambda x: F.shiftright(x, 4 * i).bitwiseAND(F.lit(15).cast("long"))  # noqa: B023, E731
        d = (low(a) - low(b)).bitwiseAND(F.lit(15).cast("long"))
        apart = apart + F.least(d, 16 - d)
    return apart


def segments(size: Column, edits: int) -> list[tuple[Column, Column]]:
    """(start from 0, length) of edits + 1 segments of a line; the last ones take what is left over."""
    parts = edits + 1
    short = F.floor(size / parts).cast("int")
    extra = size % parts
    return [
        (short * i + F.greatest(extra - (parts - i), F.lit(0)), short + F.when(extra >= parts - i, 1).otherwise(0))
        for i in range(parts)
    ]


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(characters fewer, segment, shift) at which a line looks for segments of lines as long or shorter.

    If two lines are within the edits, one of these places holds a segment of the shorter line unchanged. (0, segment, 0) is
    the segment itself.
    """
    found = []
    for fewer in range(edits + 1):
        for i in range(edits + 1):
            low = max(-i, fewer - (edits - i))
            high = min(i, fewer + (edits - i))
            found += [(fewer, i, shift) for shift in range(low, high + 1)]
    return found


def split_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line): every line of every whole text; null text has one empty line. Rows without id go."""
    return docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line_no", "line")
    )


def allowed(size: Column, tiers: tuple[int, ...]) -> Column:
    """Edits that link a line of this many characters with one as long or longer."""
    return sum((F.when(size >= least, 1).otherwise(0) for least in tiers), F.lit(0))


def all_probes(tiers: tuple[int, ...]) -> list[tuple[int, int, int, int]]:
    """(edits, characters fewer, segment, shift) of every number of edits that the tiers know."""
    return [(edits, *probe) for edits in range(1, len(tiers) + 1) for probe in probes(edits)]


def place_of(number: Column, size: Column, tiers: tuple[int, ...]) -> tuple[Column, Column]:
    """(start from 0, length) in a line of `size` characters of the segment that a probe looks for."""
    start, length = F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, (edits, fewer, segment, shift) in enumerate(all_probes(tiers)):
        at, chars = segments(size - fewer, edits)[segment]
        start, length = F.when(number == i, at + shift).otherwise(start), F.when(number == i, chars).otherwise(length)
    return start.cast("int"), length.cast("int")


def signed(lines: DataFrame, tiers: tuple[int, ...]) -> DataFrame:
    """(id, n, p0, p1, ...): every non-empty line with a key for each of `all_probes`, null where its length has no such probe."""
    keys = []
    for number, (edits, fewer, i, shift) in enumerate(all_probes(tiers)):
        size = F.col("n") - fewer
        start, length = segments(size, edits)[i]
        key = F.xxhash64(F.lit(edits), F.lit(i), size, F.substring("line", start + (shift + 1), length))
        keys.append(F.when(allowed(size, tiers) == edits, key).alias(f"p{number}"))
    sized = lines.select(F.xxhash64("line").alias("id"), F.char_length("line").alias("n"), "line").where("n > 0")
    return sized.select("id", "n", *keys)


def with_distance(pairs: DataFrame, a: str, b: str, edits: int) -> DataFrame:
    """Adds `distance`: the edit distance of two columns if it is at most `edits`, else -1.

    What the texts have in common at both ends is left off first. Bit k of row d, after j characters
    of b, says that the first j + k - edits characters of a become them with d edits; the rows are
    words of 2 x edits + 1 bits, one per number of edits. A step keeps matching bits, and takes from the row above a replaced character (same bit), one more of b
    (one bit down) and one more of a (one bit up).
    """
    band = range(2 * edits + 1)
    match = " + ".join(f"if(get(x.ca, j + {k - edits}) <=> get(x.cb, j), {1 << k}, 0)" for k in band)
    valid = " + ".join(f"if(j + 1 + {k - edits} between 0 and x.na, {1 << k}, 0)" for k in band)
    rows = ", ".join(str(sum(1 << k for k in range(edits, edits + d + 1))) for d in range(edits + 1))
    step = (
        "transform(array(struct(" + match + " as m, " + valid + " as v)), w -> "
        f"aggregate(sequence(1, {edits}), array(r[0] & w.m & w.v), (out, d) -> concat(out, array("
        "((r[d] & w.m) | r[d - 1] | shiftright(r[d - 1], 1) | shiftleft(out[d - 1], 1)) & w.v))))[0]"
    ) if edits else "transform(array(" + match + "), m -> array(r[0] & m))[0]"
    last = f"x.na - x.nb + {edits}"
    told = (
        f"if(abs(x.na - x.nb) > {edits}, -1, "
        f"aggregate(if(x.nb = 0, array(), sequence(0, x.nb - 1)), array({rows}), "
        f"(r, j) -> if(exists(r, y -> y <> 0), {step}, r), "
        f"r -> cast(array_position(transform(r, y -> shiftright(y, {last}) & 1), 1) - 1 as int)))"
    )
    # Each `_let` computes a value once for all its uses, wherever the optimiser moves the whole.
    core = lambda c: f"substring({c}, h + 1, char_length({c}) - h - t)"
    chars = lambda c: f"if(char_length({c}) > 0, split({c}, ''), cast(array() as array<string>))"
    told = _let("x", f"struct({chars('q.a')} as ca, {chars('q.b')} as cb, char_length(q.a) as na, char_length(q.b) as nb)", told)
    told = _let("q", f"struct({core(a)} as a, {core(b)} as b)", told)
    told = _let("t", _shared("e.a", "e.b", "least(char_length(e.a), char_length(e.b))"), told)
    told = _let("e", f"struct(reverse(substring({a}, h + 1)) as a, reverse(substring({b}, h + 1)) as b)", told)
    told = _let("h", _shared(a, b, f"least(char_length({a}), char_length({b}))"), told)
    return pairs.withColumn("distance", F.expr(told))


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _shared(a: str, b: str, most: str) -> str:
    """SQL for the number of characters at the start in which two texts agree, by halving steps."""
    return (
        f"aggregate(filter(transform(sequence(0, 30), i -> shiftleft(1, 30 - i)), k -> k <= {most}), 0, (p, k) -> "
        f"if(p + k <= {most} and substring({a}, p + 1, k) = substring({b}, p + 1, k), p + k, p))"
    )


def link_lines(docs: DataFrame, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per non-empty line: doc_id, line_no, n_chars, class_doc, class_line, n_links, kept.

    Lines are compared as they stand. Two different lines are linked if one becomes the other by as many
    characters put in, left out or replaced as `tiers` allows for the shorter one: one edit from the first length on, two
    from the second, and so on (three at most). A class is what equal lines and links reach. It is named by its first
    line, in order of doc_id and line number, which is the one that is kept. n_links counts the
    different lines that this one is linked with.

    Every distinct line is cut into edits + 1 segments, of which one at least is unchanged in a linked line.
    Segments are keyed by their number, the length of the line and their text, and a line probes for
    lines as long or shorter at all places that the edits allow. The lines of a segment that very many share
    are cut again (`_halved`) until few lines share what is unchanged, so that pairs follow the links.
    Candidates are sifted by letter counts and verified on the text.

    * null id: no part; null or empty lines: no row, never removed; lines of blanks: lines like others;
      short lines: equal ones are one class;
      very long lines: whole; repeated rows: equal results, both kept or both not. Empty table: empty result. Other
      columns are not read.
    """
    if len(tiers) > 3:
        raise ValueError("three edits at most")
    numbered = all_probes(tiers)
    keys = [f"p{i}" for i in range(len(numbered))]
    whole = split_lines(docs)
    marks = whole.select("doc_id", "line_no", F.char_length("line").alias("n_chars"), F.xxhash64("line").alias("id")).where("n_chars > 0")
    marks = stored(marks, "line-marks")
    links = stored(_links(docs, keys, numbered, tiers) if keys else marks.selectExpr("id as a", "id as b").where("false"), "line-links")
    comps = components(links, "line-stars")
    counts = (
        links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).groupBy("id").agg(F.count("*").alias("n_links"))
    )
    told = comps.join(counts, "id", "left")
    placed = marks.join(told, "id", "left").withColumn("class", F.coalesce("comp", "id"))
    firsts = placed.groupBy("class").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    return placed.join(firsts, "class").select(
        "doc_id",
        "line_no",
        "n_chars",
        F.col("first.doc_id").alias("class_doc"),
        F.col("first.line_no").alias("class_line"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))).alias("kept"),
    )


def _links(docs: DataFrame, keys: list[str], numbered: list[tuple[int, int, int, int]], tiers: tuple[int, ...]) -> DataFrame:
    """(a, b): ids of linked lines, a < b."""
    lines = signed(split_lines(docs), tiers).where(F.col("n") >= tiers[0])
    lines = stored(lines.groupBy("id").agg(F.first("n").alias("n"), *[F.first(k).alias(k) for k in keys]), "lines")
    own = [i for i, (_, fewer, _, shift) in enumerate(numbered) if not fewer and not shift]
    roles = lines.select("id", F.posexplode(F.array(*keys)).alias("probe", "key")).where("key is not null")
    roles = roles.withColumn("role", F.when(F.col("probe").isin(own), 0).otherwise(1))
    sizes = roles.groupBy("key").agg(F.sum(1 - F.col("role")).alias("n_own"), F.sum("role").alias("n_rest"))
    sizes = sizes.where("n_own > 1 or (n_own > 0 and n_rest > 0)").select("key", (F.expr("n_own * (n_own + n_rest)") > HOT_PAIRS).alias("hot"))
    members = stored(roles.join(sizes, "key"), "line-members")
    needed = stored(members.select("id").distinct(), "line-needed")
    sieve = F.broadcast(needed.select(F.pmod("id", F.lit(SIEVE)).alias("sieve")).distinct())  # SIEVE rows at most
    texts = (
        split_lines(docs)
        .select(F.xxhash64("line").alias("id"), "line")
        .withColumn("sieve", F.pmod("id", F.lit(SIEVE)))
        .join(sieve, "sieve", "left_semi")
        .join(needed, "id", "left_semi")
        .dropDuplicates(["id"])
        .select("id", "line", letter_counts(F.col("line")).alias("letters"), F.char_length("line").alias("n"))
    )
    texts = stored(texts, "line-texts")
    edits = F.array(*[F.lit(edits) for edits, *_ in numbered])
    usual = members.where("not hot").select("id", "key", "role", F.get(edits, F.col("probe")).alias("edits"))
    pairs = _candidates(usual.join(texts.select("id", "letters"), "id"))
    hot = members.where("hot")
    if not hot.isEmpty():
        pairs = pairs.unionByName(_hot_pairs(hot, texts, edits, tiers))
    pairs = pairs.distinct()
    texts = texts.select("id", "line", "n")
    both = pairs.join(texts.toDF("a", "line_a", "n_a"), "a").join(texts.toDF("b", "line_b", "n_b"), "b")
    told = with_distance(both, "line_a", "line_b", len(tiers))
    return told.where((F.col("distance") >= 0) & (F.col("distance") <= allowed(F.least("n_a", "n_b"), tiers))).select("a", "b")


def _candidates(members: DataFrame) -> DataFrame:
    """(a, b): pairs of one key, one of them of role 0, whose letters agree well enough; pairs may come twice."""
    found = members.where("role = 0").select("key", "edits", F.col("id").alias("a"), F.col("letters").alias("letters_a"))
    by = members.select(F.col("key").alias("other"), F.col("id").alias("b"), F.col("letters").alias("letters_b"))
    few = letters_apart(F.col("letters_a"), F.col("letters_b")) <= 2 * F.col("edits")
    near = [F.col("key") == F.col("other"), F.col("a") != F.col("b"), few]
    return found.join(by, near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _hot_pairs(hot: DataFrame, texts: DataFrame, edits: Column, tiers: tuple[int, ...]) -> DataFrame:
    """Candidates within segments that very many lines share, cut again until few share a key.

    Every line goes on with what is left of it beside the segment, once as the one that is looked for (role 0) and once as
    the one that looks (role 1). `m` is the length of what is left of those of role 0, equal for a key, and `spare` the
    edits that may lie in it. Each level halves it.
    """
    rows = hot.join(texts, "id")
    start, length = place_of(F.col("probe"), F.col("n"), tiers)
    rest = F.concat(F.substring("line", F.lit(1), start), F.substring("line", start + length + 1, F.col("n")))
    fewer = F.get(F.array(*[F.lit(fewer) for _, fewer, _, _ in all_probes(tiers)]), F.col("probe"))
    rows = rows.select(
        "id", "key", F.explode(F.when(F.col("role") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))).alias("role"),
        F.get(edits, F.col("probe")).alias("edits"), F.get(edits, F.col("probe")).alias("spare"), (F.col("n") - fewer - length).cast("int").alias("m"), rest.alias("rest"), "letters",
    )
    pairs = []
    while True:
        rows = _halved(rows)
        sizes = rows.groupBy("key").agg(
            F.sum(1 - F.col("role")).alias("n_own"), F.sum("role").alias("n_rest"), F.min("id").alias("low"), F.max("id").alias("high")
        )
        sizes = sizes.where("n_own > 0 and n_rest > 0 and low < high")
        sizes = sizes.select("key", (F.expr("n_own * n_rest") > HOT_PAIRS).alias("hot"))
        rows = stored(rows.join(sizes, "key").withColumn("hot", F.expr("hot and m > spare")), "line-halves")
        # What is not hot any more, and lines that differ in as few characters as they may, which are links.
        pairs.append(_candidates(rows.where("not hot")))
        rows = rows.where("hot").drop("hot")
        if rows.isEmpty():
            break
    out = pairs[0]
    for more in pairs[1:]:
        out = out.unionByName(more)
    return stored(out.distinct(), "line-hot-pairs")


def _halved(rows: DataFrame) -> DataFrame:
    """The rows once more for every way in which a half of what is left can agree.

    Of the edits between two texts, cut at the middle of the one of role 0, none lies in the first half (P), none in the last (S), or one
    half has one and the other the remaining ones (left: L, right: R). A half with one edit agrees when one
    character is left out of both at the same place, or out of the longer one.
    """
    half, other = "cast(m div 2 as int)", "(m - cast(m div 2 as int))"
    n = "char_length(rest)"
    made = "struct(xxhash64(key, '{kind}', {agreed}) as key, {rest} as rest, {m} as m, {spare} as spare)"
    less = lambda x: f"concat(left({x}, i - 1), substring({x}, i + 1))"
    first = lambda k: f"left(rest, {k})"
    last = lambda k: f"substring(rest, {n} - ({k}) + 1)"

    def one(kind: str, agreed: str, rest: str, m: str) -> str:
        return "array(" + made.format(kind=kind, agreed=agreed, rest=rest, m=m, spare="spare") + ")"

    def variants(kind: str, part: str, size: str, rest: str, m: str, placed: bool) -> str:
        agreed = ("i, " if placed else "") + less(part)
        each = made.format(kind=kind, agreed=agreed, rest=rest, m=m, spare="spare - 1")
        return f"if({size} < 1, array(), array_distinct(transform(sequence(1, {size}), i -> {each})))"

    def near(kind: str, part, rest, size: str, m: str) -> list[str]:
        """One edit in the half that `part` cuts off; role 1 may cut one character more or less."""
        same = variants(f"{kind}=", part(size), size, rest(size), m, True)
        alone = lambda k, name: "array(" + made.format(kind=name, agreed=part(k), rest=rest(k), m=m, spare="spare - 1") + ")"
        longer = f"if(role = 0, {alone(size, kind + '+')}, {variants(kind + '+', part(f'{size} + 1'), f'{size} + 1', rest(f'{size} + 1'), m, False)})"
        shorter = f"if(role = 0, {variants(kind + '-', part(size), size, rest(size), m, False)}, if({size} < 1, array(), {alone(f'{size} - 1', kind + '-')}))"
        return [same, f"if(role = 1 and {n} <= {size}, array(), {longer})", shorter]

    after = lambda k: f"substring(rest, ({k}) + 1)"
    before = lambda k: f"left(rest, {n} - ({k}))"
    plain = [one("P", first(half), after(half), other), one("S", last(other), before(other), half)]
    left = near("L", first, after, half, other)
    right = near("R", last, before, other, half)
    split = f"if(spare < 2, array(), concat({', '.join(left)}))"
    # With two edits, one in either half, the left way finds all.
    turned = f"if(spare < 3, array(), concat({', '.join(right)}))"
    ways = f"concat({', '.join(plain)}, {split}, {turned})"
    return (
        rows.select("id", "role", "letters", "edits", F.explode(F.expr(ways)).alias("way"))
        .select("id", "role", "letters", "edits", "way.*")
        .where(F.expr("role = 0 or abs(char_length(rest) - m) <= spare"))
    )


def drop_repeated_lines(docs: DataFrame, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """(doc_id, text): the documents without the lines that `link_lines` does not keep; rows without id go."""
    gone = link_lines(docs, tiers).where("not kept").select("doc_id", "line_no").distinct()
    left = split_lines(docs).distinct().join(gone, ["doc_id", "line_no"], "left_anti")
    rebuilt = left.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("lines"))
    whole = docs.where("doc_id is not null").select(F.col("doc_id").cast("long")).distinct()
    return whole.join(rebuilt, "doc_id", "left").select("doc_id", F.coalesce(F.array_join(F.col("lines.line"), "\n"), F.lit("")).alias("text"))
