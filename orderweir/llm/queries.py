"""The dealt operators as queries: (spark, folder) to a frame, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderweir.llm import centroids, chat_windows, decontaminate, fill_middle, lattice_lm, license_scan, line_crf, line_edit, mixing, near_dup, nn_descent, sharding, toxicity
from orderweir.llm.common import table
from orderweir.session import configure, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(configure(spark), folder)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


@query
def op1_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in the order of a mixture in which sources weigh the square root of their rows."""
    docs = sharding.measured(table(spark, folder, "documents")).select("doc_id", "source", "text_crc32")
    return mixing.mix(stored(docs, "mix-rows"), tie="text_crc32").select("doc_id", "source", "mix_block", "mix_row")


@query
def op2_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers, names or units."""
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op4_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document by a classifier chain fitted on labelled ones."""
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_odd_sketch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return near_dup.link(table(spark, folder, "documents")).drop("content")


@query
def op9_stratified_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards of the same mixture, counts at most one apart."""
    docs = sharding.measured(table(spark, folder, "documents")).select("doc_id", "source", "size", "text_crc32")
    return sharding.interleave(stored(docs, "shard-rows"), tie="text_crc32").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and passages of every document."""
    found = license_scan.find_licences(table(spark, folder, "documents"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "found.label")).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max("found.score"), F.lit(0.0))).alias("score"),
    )


@query
def op5_lattice_score(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of every document under the subword lattice, and its word-count baseline."""
    return lattice_lm.score(table(spark, folder, "documents"))


@query
def op7_line_field_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document by a conditional random field over its lines."""
    return line_crf.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_nn_descent_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 rows of largest inner product for every twentieth vector."""
    vectors = table(spark, folder, "embeddings")
    return nn_descent.neighbours(vectors, vectors.where("vec_id % 20 = 0"))


@query
def op10_line_edit_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Class of every non-empty line among all lines: equal, one edit apart from 20 characters on, two from 40 on."""
    return line_edit.link_lines(table(spark, folder, "documents"))


@query
def op11_orchard_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every vector after ten rounds from eight drawn centroids."""
    return centroids.described(*centroids.cluster(table(spark, folder, "embeddings")))


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as fill-in-the-middle text, and the text restored from it."""
    made = fill_middle.fill_in_middle(table(spark, folder, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


@query
def op13_budgeted_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations as windows of 512 tokens, and what their turns and loss masks read back as."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat_windows.digests(chat_windows.windows(turns.unionByName(extra)))
