"""Document fingerprints: threshold-scaled sketches. DataFrame operations only.

The sketch of a text is the set of its word-shingle hashes below a fixed fraction
(1 / :data:`SCALE`) of the hash range. Sketches of parts merge by union, and because the
fraction does not depend on the length, containment and Jaccard of very unequal documents are
estimated without bias. A text whose sketch would be empty keeps its smallest hash, so that
short texts can be compared too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.common import evaluate_once

WIDTH = 5
SCALE = 8
RANGES = 1024   # ranges of doc_id between which the order is cut
_MIN = -(2 ** 63)


def _words(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.filter(words, lambda w: w != "")


def with_sketch(df: DataFrame, text: str, out: str, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """Add array column ``out``: the sketch of column ``text`` (empty for a text without words)."""
    keep = df.columns
    split = evaluate_once(df.withColumn("_w", _words(F.col(text))))
    n = F.size("_w")
    starts = F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col("_w"), i + j) for j in range(width)]))
    hashed = evaluate_once(split.select(*keep, F.when(n > 0, hashes).otherwise(F.array().cast("array<bigint>")).alias("_h")))
    below = F.filter(F.col("_h"), lambda h: h < F.lit(_MIN + 2 ** 64 // scale))
    kept = evaluate_once(hashed.select(*keep, F.array_sort(F.array_distinct(below)).alias("_b"),
                                       F.array_min("_h").alias("_m")))
    return kept.select(*keep, F.when((F.size("_b") == 0) & F.col("_m").isNotNull(), F.array("_m"))
                       .otherwise(F.col("_b")).alias(out))


def as_text(sketch: Column) -> Column:
    """The sketch as a string: its hashes in order, 16 hex digits each."""
    return F.concat_ws("", F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")))


def jaccard(a: Column, b: Column) -> Column:
    """Estimated Jaccard of two sketches; two empty sketches are alike (1)."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first sketch's text that the second has."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merge(a: Column, b: Column) -> Column:
    """Sketch of two texts together."""
    return F.array_sort(F.array_union(a, b))


def _in_descending_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """Docs with (range, ghost): ranges of doc_id in descending order, each followed by a ghost
    copy of the next range's first document (after the last: the first of all).

    Range borders are quantiles of doc_id and one first id per range: at most ``ranges``
    numbers each reach the driver. One scan and no global sort of the texts.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(_MIN))
    cuts = docs.select(key.alias("k")).agg(F.percentile_approx(
        "k", F.expr(f"array({', '.join(f'{i / ranges}D' for i in range(1, max(2, ranges)))})"))).first()[0]
    cuts = sorted(set(cuts or []))
    step = max(1, round(len(cuts) ** 0.5))
    coarse = cuts[::step]
    fine = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    lit = lambda xs: F.expr(f"array({', '.join(f'cast({x} as bigint)' for x in xs)})")
    if cuts:
        # position among the cuts: first among every step-th, then within that run
        c = F.size(F.filter(lit(coarse), lambda x: x < key))
        runs = ", ".join("array(" + ", ".join(f"cast({x} as bigint)" for x in f) + ")" for f in fine)
        run = F.element_at(F.expr(f"array({runs})"), F.greatest(c, F.lit(1)))
        at = F.when(c == 0, F.lit(0)).otherwise((c - 1) * step + F.size(F.filter(run, lambda x: x < key)))
    else:
        at = F.lit(0)
    ranged = docs.withColumn("range", at.cast("int"))
    firsts = sorted(((r[0], r[1]) for r in ranged.groupBy("range").agg(F.max(key)).collect()), reverse=True)
    if not firsts:
        return ranged.withColumn("ghost", F.lit(False))
    # the first document of a range also stands, as a ghost, at the end of the range above
    above = {firsts[i][0]: firsts[i - 1][0] for i in range(len(firsts))}
    first_id = dict(firsts)
    slots = range(len(cuts) + 1)
    is_first = key == F.element_at(lit([first_id.get(i, _MIN) for i in slots]), F.col("range") + 1)
    own = F.array(F.struct(F.col("range"), F.lit(False).alias("ghost")))
    ghost = F.array(F.struct(F.element_at(lit([above.get(i, -1) for i in slots]), F.col("range") + 1).cast("int").alias("range"),
                             F.lit(True).alias("ghost")))
    placed = F.when(is_first, F.concat(own, ghost)).otherwise(own)
    return ranged.withColumn("_p", placed).drop("range").select("*", F.inline("_p")).drop("_p")


def fingerprint_edits(docs: DataFrame, width: int = WIDTH, scale: int = SCALE, ranges: int = RANGES) -> DataFrame:
    """Fingerprint every text and its edited text, and compare both and the next document.

    Edited: the last floor(n_chars / 2) code points replaced by the first as many (or all) of
    the next document in descending doc_id (after the last: the first). Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (estimated
    Jaccard), part_in_edited, part_in_next (estimated containment of the document).

    Edge cases: null text is empty; texts without words have an empty fingerprint and are
    alike; null doc_id sorts below all numbers; rows of equal doc_id are ordered by text; a
    single row is its own next; other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = with_sketch(_in_descending_ranges(base, ranges), "text", "sketch", width, scale)
    order = Window.partitionBy("range").orderBy(
        F.col("ghost"), F.col("doc_id").desc_nulls_last(), F.col("text"))
    led = (ranged.withColumn("next_text", F.lead("text").over(order))
           .withColumn("next_sketch", F.lead("sketch").over(order))
           .filter(~F.col("ghost")))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = evaluate_once(led.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "sketch", "next_sketch",
        F.concat(F.substring("text", F.lit(1), F.length("text") - half),
                 F.substring("next_text", F.lit(1), half)).alias("edited")))
    both = evaluate_once(with_sketch(edited, "edited", "edited_sketch", width, scale))
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        jaccard(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        jaccard(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("part_in_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("part_in_next"))
