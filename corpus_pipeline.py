"""From raw documents to shards of a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on; every
result is written as Parquet and read again before the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import decontamination, language_id, mixing, near_dedup, sharding
from quern.llm.shipping import ship
from quern.session import materialize

SHARDS = 8
#: Nats a letter by which a text may fall behind chance: rare letters do, in a small corpus.
LEAST_EVIDENCE = -1.0


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without an identified language; fill in missing languages.

    A document goes when it has no letter (NULL, empty or of other characters), or when
    every mixture of the known languages explains its letters far worse than chance.  How
    many languages it mixes does not matter.  The languages are learned from the column
    ``lang``; if no row has one, nothing can be told and all rows stay.  Repeated rows,
    rows without or with equal doc_ids and very long texts are judged by their whole
    text like any other; an empty table gives an empty one; all columns pass through.
    """
    ship(spark)
    model = language_id.Model.learn(docs)
    if not model.languages:
        return docs
    found = language_id.identify(docs, model)
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("evidence") > LEAST_EVIDENCE)
    return (
        found.filter(known)
        .withColumn("lang", F.coalesce("lang", "lang_pred"))
        .select(*docs.columns)
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document with the smallest doc_id of each near-duplicate class.

    Texts without words are in no class and stay.  Of rows that repeat doc_id and text
    one stays; a NULL doc_id is larger than all others, and of rows with one id that with
    the smaller text hash stays.  Very long texts are compared whole; an empty table
    gives an empty one; all columns pass through.
    """
    ship(spark)
    classes = near_dedup.near_duplicates(docs, width=5, percent=80)
    least = F.col("doc_id").eqNullSafe(F.col("component_id")) & (
        F.col("text_key") == F.col("component_key")
    )
    stays = (
        classes.filter(least)
        .groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    # A NULL or repeated doc_id does not tell rows apart, so the text has to match too.
    kept = docs.join(
        stays, (F.xxhash64("text") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    )
    once = kept.filter("__n = 1").select(*docs.columns)
    repeated = kept.filter("__n > 1").select(*docs.columns)
    return once.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a test item's question and answer.

    NULL and empty texts hold none and stay; every row is judged by its whole text, so
    repeated rows and equal ids do not matter; items without words are ignored; empty
    tables of either kind drop nothing; all columns pass through.
    """
    ship(spark)
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words that a mix with weights 3, 1, 2 takes, pass by pass.

    A document is taken at most twice, whole or in part: one row per pass, so doc_ids
    repeat with different texts.  NULL and empty texts have no words and are never taken;
    NULL is a source, the last by name; rows with equal doc_id and text each get what is
    taken of any of them; an empty table gives an empty one; all columns pass through,
    ``text`` and ``n_chars`` as far as words were taken.
    """
    return mixing.mixed_documents(docs, mixing.alternating())


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their text, in shards of near equal bytes.

    Adds ``size``, ``text_crc32``, ``vslot``, ``shard`` and ``slot``, the row's gapless
    place in its shard, and replaces columns of these names.  NULL text has size 1; rows
    without an id or with equal ids spread by their text; an empty table gives an empty
    one; the other columns pass through.
    """
    placed, _ = sharding.place(docs, SHARDS)
    return placed


STAGES = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix_sources),
    ("shard", shard),
]

#: The tokens of language models and signatures are not expressible in SQL; the stages
#: are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
