"""From raw documents to training shards, in five stages.

Each stage takes (spark, docs, folder) and returns a frame; `run` writes every stage's result to the
shared folder and reads it back, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderweir.llm import decontaminate, mixing, near_dup, sharding, toxicity
from orderweir.llm.common import neutral, table, tie_break
from orderweir.session import configure, stored

#: Mark in the metadata of the column `source`: the rows are mixed, and with these options of `mixing.mix`.
MIXTURE, MIX_OPTIONS = "mixture", {"seed": "mix", "block_rows": 64}


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    return toxicity.drop_toxic(docs, table(configure(spark), folder, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    configure(spark)
    return near_dup.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(configure(spark), folder, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, in the order of the mixture: the result is sorted by it from file to file.

    Files do not promise an order when they are read, so the column `source` is marked with the
    options of the mixture, from which the sharding makes the same order again.
    """
    configure(spark)
    flat, names, restored = neutral(docs)
    mixed = mixing.mix(flat, id_col=names["doc_id"], stratum=names["source"], tie=names["text"], **MIX_OPTIONS)
    ordered = mixed.repartitionByRange("mix_block", "mix_row").sortWithinPartitions("mix_block", "mix_row")
    return ordered.select(*restored).withMetadata("source", {MIXTURE: MIX_OPTIONS})


def cut_shards(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document with its shard and its slot in it; of mixed documents each shard follows the mixture."""
    configure(spark)
    options = docs.schema["source"].metadata.get(MIXTURE)
    if not options:
        return sharding.interleave(docs)
    flat, names, restored = neutral(docs)
    restored = [c for c, name in zip(restored, names) if name not in ("shard", "slot")]
    # The tie's number goes along instead of the text, so that counting passes leave the texts out.
    flat = flat.withColumn("mix_tie", tie_break(flat, names["text"]))
    columns = {"id_col": names["doc_id"], "stratum": names["source"], "tie": "mix_tie"}
    mixed = stored(mixing.mix(flat, **columns, rank="mix_rank", **options), "shard-order")
    return sharding.interleave(mixed, **columns, order=("mix_rank", "mix_block", "mix_row")).select(*restored, "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]

#: The classifier is trained, so SQL cannot express the whole. Tests hold near duplicates against brute force, mixing and
#: sharding against SQL; toxicity and decontamination are tested on planted documents only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
