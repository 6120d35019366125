"""Mixing sources to target weights by Pareto order sampling. DataFrame operations only.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share 150 % of
all words; a target stops at twice its source's words and the excess is reshared by weight.
That is ``least(cap, level * weight)`` for one level, found from running sums over the sources
ordered by ``cap / weight``.

Taking: documents of a source have unequal expected copies. They are proportional to the bits of
the document's size (1 for 1 word, 10 for 512 to 1,023), so that longer documents are preferred
mildly; none expects more than ``most`` copies, and a source's expected words are its target. The
whole part of the expectation gives certain copies. Its remainder p is the inclusion probability
of a Pareto sample: documents are ranked by random odds ``u / (1 - u)`` divided by inclusion odds
``p / (1 - p)`` and taken in that order up to the size that comes nearest to the rest of the
target. ``u`` is a hash of doc_id and text, so reruns agree.

The order is cut without sorting a source in one task: ranks fall in bins, whose number follows
the input, bins are summed, and only the bin in which the target is reached is ordered row by row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.base import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
LEAST_BINS = 4096


def n_words(text: Column) -> Column:
    """Number of runs of ``[^\\x20\\x09-\\x0D]``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size, target) for a table with columns source and size.

    Works on one row per source; the windows below run over sources, not documents.
    """
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
           .withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                         (F.col("k") % len(weights) + 1).cast("int"))))
    cap = F.col("source_size") * F.lit(float(most))
    order = Window.orderBy(cap / F.col("w"), "k")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    # with the first j sources at their caps, the others share what is left by weight
    level = ((F.col("total") - F.col("caps") + F.col("cap")) / F.col("w_left"))
    return (per.withColumn("cap", cap)
            .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
            .withColumn("caps", F.sum("cap").over(upto))
            .withColumn("w_left", F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            .withColumn("level", level)
            .withColumn("open", F.col("level") * F.col("w") < F.col("cap"))
            # the first open source has the largest level: later ones count its cap as spent
            .withColumn("final", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
            .select("source", "source_size",
                    F.coalesce(F.least("cap", F.col("final") * F.col("w")), F.col("cap")).alias("target")))


def expected_copies(sizes: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """(source, bits, source_size, target, copies) for tables of (source, size, bits) and of targets.

    ``copies``, the expected copies of a document, is ``least(most, level * bits)`` with one level
    per source, for which its words come to the target. One row per source and bit length: the
    windows below run over at most 63 rows of a source.
    """
    per = (sizes.filter("size > 0").groupBy("source", "bits").agg(F.sum("size").alias("words"))
           .join(targets.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2"))
    longest = Window.partitionBy("source").orderBy(F.col("bits").desc())
    # with all longer documents at the most copies, the others share what is left by bits
    spent = F.coalesce(F.sum("words").over(longest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * F.lit(float(most))
    share = F.sum(F.col("words") * F.col("bits")).over(longest.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (per.withColumn("level", (F.col("target") - spent) / share)
            .withColumn("level", F.max(F.when(F.col("level") * F.col("bits") < most, F.col("level")))
                        .over(Window.partitionBy("source")))
            .select("source", "bits", "words", "source_size", "target",
                    F.coalesce(F.least(F.lit(float(most)), F.col("level") * F.col("bits")), F.lit(float(most))).alias("copies")))


def unit_hash(key: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the key's MD5."""
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 52))


def mix_sources(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                most: float = MOST) -> DataFrame:
    """What the mix takes of every document.

    Returns one row per input row: doc_id, source, size, source_size, target, copies, taken
    (= copies * size). Copies are whole, at most ``ceil(most)`` (2).

    Edge cases: null text has size 0; documents of size 0 are not taken; null is a source of its
    own, last in order; null doc_id hashes as an empty key, together with the text, so documents
    without or with equal ids have numbers of their own; rows that tie in rank are ordered by
    doc_id and size, and of wholly equal rows any may be the one taken once more; a source without
    words has target 0 and takes nothing; an empty table gives an empty result.
    """
    text = F.col("text")
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    sized = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                                    n_words(text).alias("size"), unit_hash(key).alias("u"))
                        .withColumn("bits", F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0)), "mix-sizes")
    # rows per source and size class, written first: of known size, they are broadcast when small
    # and else joined by shuffle, where AQE splits a hot source
    targets = materialize(source_targets(sized, weights, share, most), "mix-targets")
    classes = materialize(expected_copies(sized, targets, most), "mix-classes")
    whole = F.floor(F.col("copies") + 1e-12)
    bins_of = max(LEAST_BINS, math.isqrt(sized.count()))
    odds = F.col("u") / (1 - F.col("u")) * (1 - F.col("p")) / F.col("p")
    per_class = (classes.withColumn("whole", whole).withColumn("p", F.greatest(F.col("copies") - F.col("whole"), F.lit(0.0)))
                 .select(F.col("source").alias("s2"), F.col("bits").alias("b2"), "whole", "p"))
    ranked = (sized.join(per_class, F.col("source").eqNullSafe(F.col("s2")) & (F.col("bits") == F.col("b2")), "left")
              .drop("s2", "b2").fillna(0, ["whole", "p"])
              # odds in (0, infinity) as a rank in (0, 1)
              .withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds)))
              .withColumn("bin", F.when(F.col("p") > 0, F.least(F.floor(F.col("rank") * bins_of), F.lit(bins_of - 1)).cast("int"))))
    rests = (classes.groupBy("source").agg((F.max("target") - F.sum(whole * F.col("words"))).alias("rest"))
             .withColumnRenamed("source", "s2"))
    bins = (ranked.filter("bin is not null").groupBy("source", "bin").agg(F.sum("size").alias("in_bin"))
            .join(rests, F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
            .withColumn("before", F.sum("in_bin").over(
                Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)))
            .fillna(0, ["before"]))
    cut = materialize(bins.filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("in_bin") >= F.col("rest")))
                      .groupBy("source").agg(F.min("bin").alias("cut_bin"), F.min("before").alias("before"),
                                             F.min("rest").alias("rest")), "mix-cuts")
    by_source = cut.join(targets.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2")), "right").drop("source")
    placed = ranked.join(by_source, F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2")
    # only the rows of one bin of each source are ordered; all others are one partition key each
    at_cut = F.col("bin") == F.col("cut_bin")
    inside = placed.filter(at_cut)
    run = Window.partitionBy("source").orderBy("rank", F.col("doc_id").asc_nulls_last(), "size") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("before") + F.sum("size").over(run)
    # the document that crosses the target is taken if that comes nearer than stopping before it
    start = end - F.col("size")
    near = (start < F.col("rest")) & ((end - F.col("rest")) <= (F.col("rest") - start))
    inside = inside.withColumn("extra", F.when((end <= F.col("rest")) | near, 1).otherwise(0))
    outside = (placed.filter(~F.coalesce(at_cut, F.lit(False)))
               .withColumn("extra", F.when(F.col("bin").isNull(), 0)
                           .when(F.col("cut_bin").isNull(), 1)
                           .when(F.col("bin") < F.col("cut_bin"), 1).otherwise(0)))
    copies = (F.col("whole") + F.col("extra")).cast("long")
    return (inside.unionByName(outside)
            .select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken")))
