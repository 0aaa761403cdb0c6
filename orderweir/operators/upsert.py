"""Keyed merges: the merge itself as a frame, and tables that apply it in place."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderweir.operators.latest import duplicate_keys, first_per_key, latest_per_key


class DuplicateMergeKeys(ValueError):
    """The source holds a merge key more than once."""


def require_unique(source: DataFrame, keys: list[str]) -> None:
    """Fail when a merge would match a target row twice; names a few of the keys."""
    found = duplicate_keys(source, keys).orderBy(*keys).limit(5).collect()
    if found:
        named = ", ".join(str(tuple(row[key] for key in keys)) for row in found)
        raise DuplicateMergeKeys(f"merge keys {keys} repeat in the source, e.g. {named}")


def merged(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
    defaults: dict[str, Column] | None = None,
    newer_by: str | Sequence[str] | None = None,
    touch: dict[str, Column] | None = None,
    delete_when: Column | None = None,
) -> DataFrame:
    """The target after merging a source that is unique per key.

    update / insert  columns set on a match / on a new key (default: all the source has);
                     columns left out keep their value, or start as default or null
    defaults         values for inserted columns that come without one
    newer_by         a match is applied only if the source is not older in this column, or in these in turn
    touch            columns set on insert and whenever an updated column really changes
    delete_when      condition on the source: a match is removed, a new key is not inserted
    """
    offered = [name for name in target.columns if name in source.columns]
    update = [name for name in (offered if update is None else update) if name not in keys]
    insert = list(offered if insert is None else insert)
    defaults, touch = defaults or {}, touch or {}

    new = source
    if delete_when is not None:
        new = new.withColumn("_remove", F.coalesce(delete_when, F.lit(False)))
    else:
        new = new.withColumn("_remove", F.lit(False))
    new = new.select(
        *[F.col(key).alias(f"_key_{key}") for key in keys],
        F.struct(*[F.col(name) for name in source.columns], "_remove").alias("new"),
    )
    old = target.select(
        *[F.col(key).alias(f"_old_{key}") for key in keys],
        F.struct(*[F.col(name) for name in target.columns]).alias("old"),
    )
    same_key = reduce(Column.__and__, [F.col(f"_old_{key}") == F.col(f"_key_{key}") for key in keys])
    both = old.join(new, same_key, "full_outer")

    is_new, is_kept = F.col("old").isNull(), F.col("new").isNull()
    applies = F.lit(True)
    if newer_by:
        guard = [newer_by] if isinstance(newer_by, str) else list(newer_by)
        offered_at, stored_at = (F.struct(*[F.col(f"{side}.{name}") for name in guard]) for side in ("new", "old"))
        first = guard[0]
        applies = F.col(f"old.{first}").isNull() | (F.col(f"new.{first}").isNotNull() & (offered_at >= stored_at))
        applies = F.coalesce(applies, F.lit(False))
    if delete_when is not None:
        removed = F.coalesce(F.col("new._remove"), F.lit(False)) & (is_new | applies)
        both = both.filter(~removed)

    changed = F.lit(False)
    for name in update:
        changed = changed | ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))

    out = []
    for field in target.schema.fields:
        name = field.name
        kept = F.col(f"old.{name}")
        if name in touch:
            inserted, updated = touch[name], F.when(applies & changed, touch[name]).otherwise(kept)
        else:
            offer = F.col(f"new.{name}").cast(field.dataType) if name in source.columns else None
            updated = F.when(applies, offer).otherwise(kept) if name in update else kept
            inserted = offer if name in insert and offer is not None else F.lit(None).cast(field.dataType)
            if name in defaults:
                inserted = F.coalesce(inserted, defaults[name].cast(field.dataType))
        out.append(F.when(is_kept, kept).when(is_new, inserted).otherwise(updated).alias(name))
    return both.select(*out)


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str], defaults: dict[str, Column] | None = None
) -> DataFrame:
    """The rows to append: the first source row of every key the target does not have."""
    fresh = first_per_key(source, keys, order).join(target.select(*keys), keys, "left_anti")
    defaults = defaults or {}
    columns = []
    for field in target.schema.fields:
        value = F.col(field.name) if field.name in source.columns else F.lit(None)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name])
        columns.append(value.cast(field.dataType).alias(field.name))
    return fresh.select(*columns)


class KeyedTable:
    """A Parquet folder with one row per key, in a sub-folder per bucket of the key.

    A merge is `merged` followed by an ordinary dynamic partition overwrite: buckets are staged and swapped in when
    the write is done, and a merge that failed may simply be run again. One writer per table; read it anew after a
    merge. Rows without a whole key are not merged. Removed keys stay as marked rows where a time guard may need them.

    A merge costs a pass over the table: it is for batches that touch much of it. Streams append to logs that are
    read by the last row of each key (`sinks.merge_topic`), and a table format has its own MERGE (`merge_into`).
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], schema: StructType | str | None = None, buckets: int = 8
    ):
        """buckets: of a new table; one that has rows keeps its number, which is part of its folders."""
        self.spark, self.path, self.keys, self.buckets = spark, path, keys, buckets
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _rows(self) -> DataFrame:
        fields = StructType([*self.schema.fields]).add("_removed", "boolean")
        return self.spark.read.schema(fields.add("_of", "integer").add("_bucket", "integer")).parquet(self.path)

    def _number(self) -> int:
        first = self._rows().select("_of").first()
        return first[0] if first else self.buckets

    def _write(self, rows: DataFrame, number: int, mode: str = "overwrite") -> None:
        """Rows are partitioned by the hash that names the buckets already, so a bucket is one task's file."""
        placed = rows.withColumns({"_of": F.lit(number), "_bucket": F.pmod(F.hash(*self.keys), F.lit(number))})
        writer = placed.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_of", "_bucket").parquet(self.path)

    def create(self, rows: DataFrame) -> KeyedTable:
        """Write the table; `rows` must be unique per key."""
        self.schema = rows.schema
        self._write(rows.withColumn("_removed", F.lit(False)).repartition(self.buckets, *self.keys), self.buckets)
        return self

    def read(self) -> DataFrame:
        return self._rows().filter("not _removed").drop("_removed", "_of", "_bucket")

    def upsert(self, source: DataFrame, order: list[str] | None = None, strict: bool = False, **rules) -> KeyedTable:
        """Merge a batch; see `merged` for the rules.

        The latest row per key by `order` is merged. With `strict`, repeated keys are an error instead.
        """
        source = source.dropna(subset=self.keys)
        if strict:
            require_unique(source, self.keys)
        elif order:
            source = latest_per_key(source, self.keys, order)
        delete_when = rules.pop("delete_when", None)
        removed = F.lit(False) if delete_when is None else F.coalesce(delete_when, F.lit(False))
        for rule in ("update", "insert"):
            if rules.get(rule) is not None:
                rules[rule] = [*rules[rule], "_removed"]
        number = self._number()
        old = self._rows().drop("_of", "_bucket")
        if not rules.get("newer_by"):
            # A bucket without another row is not written; the marked rows it keeps are no part of the table.
            old = old.filter("not _removed")
        # Partitioned alike, the two sides join and are written without another shuffle.
        old = old.repartition(number, *self.keys)
        new = source.withColumn("_removed", removed).repartition(number, *self.keys)
        self._write(merged(old, new, self.keys, **rules), number)
        return self

    def append_absent(self, source: DataFrame, order: list[str], defaults: dict[str, Column] | None = None) -> KeyedTable:
        """Append the first row of every key that is not there yet; existing rows stay untouched where they are."""
        number = self._number()
        known = self._rows().drop("_removed", "_of", "_bucket")
        fresh = insert_if_absent(known, source.dropna(subset=self.keys), self.keys, order, defaults)
        self._write(fresh.withColumn("_removed", F.lit(False)).repartition(number, *self.keys), number, "append")
        return self


def merge_into(source: DataFrame, table: str, keys: list[str], update: list[str], insert: list[str]) -> None:
    """The same merge on a catalog table whose format supports MERGE."""
    match = reduce(Column.__and__, [F.col(f"{table}.{key}") == F.col(f"source.{key}") for key in keys])
    (
        source.alias("source")
        .mergeInto(table, match)
        .whenMatched()
        .update({name: F.col(f"source.{name}") for name in update})
        .whenNotMatched()
        .insert({name: F.col(f"source.{name}") for name in insert})
        .merge()
    )
