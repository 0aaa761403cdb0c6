"""Fill-in-the-middle: texts are cut at two drawn token ends and written as prefix, suffix, middle."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweir.llm.common import utf8
from orderweir.llm.words import groups

#: Marks before the prefix, the suffix and the middle (fixed values).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: One token. Possessive: a text is matched in one way only, and nothing is kept for a second try.
UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")

CUT = "doc_id long, n long, form string, prefix string, middle string, suffix string"


def _number(digest: Column, group: int) -> Column:
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def draws(id_col: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers h1 to h4 from seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [_number(digest, i).alias(f"h{i + 1}") for i in range(4)]


def _cut(batches: Iterator[pa.RecordBatch], percent: int, suffix_first: int) -> Iterator[pa.RecordBatch]:
    """One match of the repeated unit keeps the end of every repetition; both cuts are looked up there."""
    for batch in batches:
        h1, h2, h3, h4 = (batch.column(i).to_numpy() for i in range(2, 6))
        for first, bodies in groups(batch):
            rows = []
            for i, body in enumerate(bodies, first):
                text = body.decode("utf-8", "replace")
                ends = UNITS.fullmatch(text).ends(1)
                n = len(ends)
                if not n or any(mark in text for mark in MARKS) or h3[i] % 100 >= percent:
                    rows.append((n, "plain", text, None, None))
                    continue
                one, two = sorted((h1[i] % (n + 1), h2[i] % (n + 1)))
                low, high = (ends[c - 1] if c else 0 for c in (one, two))
                form = "spm" if h4[i] % 100 < suffix_first else "psm"
                rows.append((n, form, text[:low], text[low:high], text[high:]))
            columns = [batch.column(0).slice(first, len(bodies))]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            columns += [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix", "middle", "suffix"])


def joined(form: str = "form") -> Column:
    """The training text of a row: plain text, or the three parts behind their marks."""
    part = lambda mark, name: F.concat(F.lit(mark), F.col(name))
    prefix, suffix, middle = part(PREFIX, "prefix"), part(SUFFIX, "suffix"), part(MIDDLE, "middle")
    return (
        F.when(F.col(form) == "psm", F.concat(prefix, suffix, middle))
        .when(F.col(form) == "spm", F.concat(suffix, prefix, middle))
        .otherwise(F.col("prefix"))
    )


def restored(output: Column, form: Column) -> Column:
    """The text that a training text was made of. Cut texts hold no marks of their own, so marks part them exactly."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def fill_in_middle(
    docs: DataFrame, seed: int = 1, percent: int = 90, suffix_first: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), a row per row of `docs`.

    Tokens are runs of ASCII letters and single other code points. Draws from seed and id choose the
    two cuts, whether a text is cut (`percent` of 100) and whether its suffix comes first (`suffix_first` of 100).
    One pass without a shuffle; a task holds about 1 MB of texts, or one longer text with its token ends.

    * null and empty text: plain, empty, n 0; a text that holds a mark: plain.
    * null id: drawn as an empty one; repeated rows: each gives its own equal row; texts are cut whole, however long.
    * Empty table: empty result. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"), *draws(id_col, seed))
    cut = rows.mapInArrow(partial(_cut, percent=percent, suffix_first=suffix_first), CUT)
    whole = F.col("form") == "plain"
    chars = lambda name: F.when(~whole, F.length(name).cast("long"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        chars("prefix").alias("prefix_chars"),
        chars("middle").alias("middle_chars"),
        joined().alias("output"),
    )
