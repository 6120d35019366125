"""Stages of a training-corpus pipeline: functions (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of ``docs``. Decisions on a document depend on its own text,
so they are taken once a distinct text and joined back by a key of the text, whether doc_ids are
null or repeat. No two texts share a key (:func:`text_keys`).
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import decontaminate, langid, line_dedup, mixing, near_dedup
from vigil.llm.base import delete_tables, materialize, scoped_tables, set_batch_rows

# near duplicates of the corpus share four fifths of their 5-word shingles (op1 has bounds of its own)
WIDTH, ALIKE = 5, 80

_left: list[str] = []    # tables of the stage that ran last


def _stage(fn):
    """A stage's tables live until the next stage begins, when its output has been written."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_tables(spark, _left)
        with scoped_tables() as made:
            out = fn(spark, docs, sf_dir)
        _left.extend(made)
        return out
    return run_stage


def text_keys(docs: DataFrame, short: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``docs`` with a column ``_cp_key``: a 64-bit number for each distinct text, null included.

    The key is a short hash of the text. Texts are told apart by their MD5 digests (128 bits): of
    texts that share a short hash, all but one get another key, until no two texts share one. As
    a rule there are none, and the key costs no join.
    """
    name = F.coalesce(F.unhex(F.md5("text")), F.lit(b""))
    key = F.coalesce(short(F.col("text")).cast("long"), F.lit(0))
    hashed = materialize(docs.select(name.alias("name"), key.alias("key")).distinct(), "text-keys")
    keys = hashed
    for salt in itertools.count(1):
        crowded = keys.groupBy("key").count().filter("count > 1").select("key")
        if crowded.isEmpty():
            break
        holders = keys.join(crowded, "key", "left_semi").groupBy("key").agg(F.min("name").alias("holder"))
        keys = materialize(keys.join(holders, "key", "left").select("name", F.when(
            F.col("name") > F.col("holder"), F.xxhash64("name", F.lit(salt))).otherwise(F.col("key")).alias("key")), "text-keys")
    if keys is hashed:
        return docs.withColumn("_cp_key", key)
    moved = (keys.join(hashed.withColumnRenamed("key", "was"), "name").filter("key <> was")
             .select(F.col("name").alias("_cp_name"), F.col("key").alias("_cp_moved")))
    return (docs.withColumn("_cp_name", name).join(moved, "_cp_name", "left")
            .withColumn("_cp_key", F.coalesce("_cp_moved", key)).drop("_cp_name", "_cp_moved"))


def _judged(keyed: DataFrame) -> DataFrame:
    """(doc_id, text) with the key of the text as doc_id."""
    return keyed.select(F.col("_cp_key").alias("doc_id"), "text")


def _only(keyed: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows whose text is in ``decisions`` on :func:`_judged` rows."""
    keys = decisions.select(F.col("doc_id").alias("_cp_key")).distinct()
    return keyed.join(keys, "_cp_key", "left_semi").drop("_cp_key")


@_stage
def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those far from every centroid go.

    Each row is judged by its own text, also when its doc_id is null or repeats; an empty table
    stays empty.
    """
    set_batch_rows(spark)
    keyed = text_keys(docs)
    return _only(keyed, langid.identify(_judged(keyed), langid.fit(docs)).filter(~F.col("rejected"))).select(docs.columns)


@_stage
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; those left without a line go.

    Rows of a null or repeated doc_id are documents of their own; of rows of equal doc_id and
    text one stays, if the text has a line.
    """
    set_batch_rows(spark)
    return line_dedup.dedup_lines(docs)


@_stage
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest doc_id (null last).

    Each row is judged by its own text, also when its doc_id is null or repeats. Texts without
    a word copy nothing; of such rows only repeats of one doc_id and text go.
    """
    set_batch_rows(spark)
    keyed = text_keys(docs)
    groups = materialize(near_dedup.near_duplicates(_judged(keyed), width=WIDTH, num=ALIKE)
                         .select(F.col("doc_id").alias("_cp_key"), "n_shingles", "component_id").distinct(), "near-groups")
    words = groups.filter("n_shingles > 0")
    first = (keyed.select(F.col("doc_id").cast("long").alias("id"), "_cp_key")
             .join(words, "_cp_key").groupBy("component_id")
             .agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "_cp_key")).alias("f"))
             .select(F.col("f.id").alias("_cp_id"), F.col("f._cp_key").alias("_cp_text")))
    chosen = (keyed.join(first, (F.col("_cp_key") == F.col("_cp_text"))
                         & F.col("doc_id").cast("long").eqNullSafe(F.col("_cp_id")), "left_semi")
              .dropDuplicates(["doc_id", "_cp_key"]))
    blank = keyed.join(groups.filter("n_shingles = 0"), "_cp_key", "left_semi")
    named = blank.filter("doc_id is not null").dropDuplicates(["doc_id", "_cp_key"])
    return chosen.unionByName(named).unionByName(blank.filter("doc_id is null")).drop("_cp_key").select(docs.columns)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``; each row is judged by its own text."""
    set_batch_rows(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = text_keys(docs)
    return _only(keyed, decontaminate.decontaminate(_judged(keyed), benchmark).filter(~F.col("contaminated"))).select(docs.columns)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, copies, taken.

    Documents of which the mix takes nothing are left out.
    """
    return mixing.mix_sources(docs).filter("copies > 0").select("doc_id", "source", "size", "copies", "taken")
