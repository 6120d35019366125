"""Near-duplicate documents: bottom-k sketches, inverted lists, union-sketch filter, exact Jaccard.

Method. One hash function over word shingles; a document's sketch is its ``k`` smallest
shingle hashes. Retained values form inverted lists. Two documents with Jaccard >= 0.85 share
at least ``overlap_floor`` of their retained values except with negligible probability (see
:func:`least_share`), so it is enough to list each sketch under its rarest values (prefix filter;
any global order is valid, rarity only shortens the lists). Pairs from the lists are filtered
by the Jaccard estimate of the union sketch and confirmed on the full shingle sets.

Large groups. Equal shingle sets are collapsed to one representative first. Pairs are then
made in two rounds. Every list first links its members to one pivot (linear): its most central
member, whose values are the most shared. After components are known, only pairs of
*different* components of a list are still open. Their documents are joined anew on their
full sets, again by prefixes of the rarest shingles, with the exact threshold and the position
of the match bounding the overlap: a copy with many edits has its own shingles in its prefix
and meets few others. Nothing is capped: the second round is the exact way for all that the
first leaves open.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.base import WordHash, map_rows, materialize, shingle_hashes, space_words
from vigil.llm.components import connected_components

K = 64
DEVIATIONS = 6


def least_share(num: int, den: int, k: int) -> float:
    """Least share of the union sketch that a pair at the threshold has in common.

    The count is hypergeometric with mean t * k and deviation below sqrt(t * (1 - t) * k); the
    share lies six deviations below (probability under 1e-7 a pair): 0.58 at 0.85, 0.50 at 0.8.
    """
    t = num / den
    return max(0.0, math.floor(100 * (t - DEVIATIONS * math.sqrt(t * (1 - t) / k)) + 1e-9) / 100)


def _sketches(width: int, k: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        memo = WordHash()
        for b in batches:
            out = {"doc_id": b["doc_id"], "n": [], "set_key": [], "sketch": []}
            for text in b["text"]:
                s = np.unique(shingle_hashes(memo.of(space_words(text)), width))
                out["n"].append(len(s))
                out["set_key"].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                out["sketch"].append(s[:k].view(np.int64))
            memo.trim()
            yield out
    return run


def _jaccard_linked(width: int, num: int, den: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        memo, last = WordHash(), (None, None)
        for b in batches:
            out: dict = {"a": [], "b": []}
            for a, i, ta, tb in zip(b["a"], b["b"], b["text_a"], b["text_b"], strict=True):
                if last[0] != ta:
                    last = (ta, np.unique(shingle_hashes(memo.of(space_words(ta)), width)))
                sa, sb = last[1], np.unique(shingle_hashes(memo.of(space_words(tb)), width))
                inter = len(np.intersect1d(sa, sb, assume_unique=True))
                if den * inter >= num * (len(sa) + len(sb) - inter) and inter:
                    out["a"].append(a)
                    out["b"].append(i)
            memo.trim()
            yield out
    return run


def _shingles(width: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        memo = WordHash()
        for b in batches:
            sets = [np.unique(shingle_hashes(memo.of(space_words(t)), width)).view(np.int64) for t in b["text"]]
            memo.trim()
            yield {"node": np.repeat(np.array(b["doc_id"], np.int64), [len(x) for x in sets]),
                   "h": np.concatenate(sets)}
    return run


def _sizes_fit(a: Column, b: Column, num: int, den: int) -> Column:
    return (F.lit(den) * F.least(a, b)) >= (F.lit(num) * F.greatest(a, b))


def _confirm(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int, k: int,
             num: int, den: int, texts: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of representatives whose full shingle sets reach the threshold."""
    sk = lambda c: reps.select(F.col("node").alias(c), F.col("sketch").alias(f"sk_{c}"))
    est = (pairs.join(sk("a"), "a").join(sk("b"), "b")
           .withColumn("u", F.slice(F.array_sort(F.array_union("sk_a", "sk_b")), 1, k))
           .withColumn("common", F.size(F.array_intersect(F.array_intersect("sk_a", "sk_b"), F.col("u"))))
           .filter(F.col("common") >= F.lit(least_share(num, den, k)) * F.size("u"))
           .select("a", "b"))
    cand = materialize(est, "near-candidates")
    # texts of the candidates only; the hot side of a pair (a pivot) is spread by a salt
    if texts is None:
        texts = _texts_of(docs, cand.select(F.explode(F.array("a", "b")).alias("doc_id")))
    salts = cand.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 256).cast("int").alias("salts"))
    spread = (texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
              .join(salts, "a")
              .select("a", "text_a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    salted = cand.join(salts, "a").withColumn(
        "salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int")).select("a", "b", "salt")
    full = (salted.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(spread, ["a", "salt"])
            .select("a", "b", "text_a", "text_b"))
    return map_rows(full, _jaccard_linked(width, num, den), "a long, b long")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return materialize(docs.join(ids.distinct(), "doc_id", "left_semi"), "near-texts")


def near_duplicates(docs: DataFrame, width: int = 3, num: int = 85, den: int = 100,
                    k: int = K) -> DataFrame:
    """Components of documents linked by ``den * |A & B| >= num * |A | B|`` on word shingles.

    Returns (doc_id, n_shingles, component_id, kept), one row per input row. Words are
    ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text of fewer than ``width`` words is one
    shingle. Shingles are 64-bit hashes.

    Edge cases: null or blank text has no shingle and links with nothing (component_id =
    doc_id). Rows are judged by their own text, also when a doc_id repeats; equal rows get equal
    results. A row with null doc_id takes the component of its copies; alone its component is
    null and it is kept. Other columns of
    ``docs`` are ignored. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sk = materialize(map_rows(docs, _sketches(width, k),
                              "doc_id long, n long, set_key binary, sketch array<long>"), "near-sketches")
    rep_of = materialize(sk.filter("set_key is not null").groupBy("set_key")
                         .agg(F.min("doc_id").alias("node")).filter("node is not null"), "near-reps")
    reps = materialize(sk.filter("n > 0")
                       .join(rep_of.select("set_key", F.col("node").alias("doc_id")), ["set_key", "doc_id"])
                       .select(F.col("doc_id").alias("node"), "n", "sketch").dropDuplicates(["node", "n"]),
                       "near-distinct")
    listed = reps.select("node", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    df = listed.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # values found in one sketch only come first in the order and need no list
    share = F.when(F.col("n") * den <= F.lit(k * num), F.lit(num / den)).otherwise(F.lit(least_share(num, den, k)))
    prefix_len = F.col("m") - F.ceil(share * F.col("m") - 1e-9) + 1
    prefix = materialize(
        listed.join(df, "value").groupBy("node", "n", "m")
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"))
        .withColumn("left", (prefix_len - (F.col("m") - F.size("shared"))).cast("int"))
        # how far from the centre of its group: values of its own, then how little shared
        .withColumn("off", F.struct((F.col("m") - F.size("shared")).alias("own"),
                                    F.aggregate("shared", F.lit(0).cast("long"), lambda t, v: t - v["df"]).alias("less")))
        .filter("left > 0")
        .select("node", "n", "off", F.explode(F.expr("slice(shared, 1, left)")).alias("s"))
        .select("node", "n", "off", F.col("s.value").alias("value")), "near-lists")

    # round 1: every list against its most central member
    pivot = materialize(prefix.groupBy("value").agg(F.min(F.struct("off", "node", "n")).alias("p"),
                                                    F.count(F.lit(1)).alias("c"))
                        .filter("c > 1").select("value", F.col("p.node").alias("a"), F.col("p.n").alias("na")), "near-pivots")
    first = (prefix.join(pivot, "value")
             .filter((F.col("node") != F.col("a")) & _sizes_fit(F.col("na"), F.col("n"), num, den))
             .select("a", F.col("node").alias("b")).distinct())
    edges = materialize(_confirm(first, reps, docs, width, k, num, den), "near-edges")
    comp = connected_components(edges)

    # round 2: what is still apart within a list, pivots aside
    placed = materialize(
        prefix.drop("off").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        .join(pivot, "value").filter("node <> a").drop("a", "na"), "near-placed")
    apart = (placed.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo <> hi").select("value"))
    open_nodes = materialize(placed.join(apart, "value", "left_semi").select("node", "n", "comp").distinct(), "near-open")
    texts = _texts_of(docs, open_nodes.select(F.col("node").alias("doc_id")))
    full = map_rows(texts, _shingles(width), "node long, h long")
    common = full.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # shingles of no other open document come first in the order; then the rarest
    ordered = materialize(
        full.join(common, "h").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("shared"))
        .join(open_nodes, "node")
        .withColumn("own", F.col("n") - F.size("shared"))
        .withColumn("left", (F.col("n") - F.ceil(F.col("n") * num / F.lit(den)) + 1 - F.col("own")).cast("int"))
        .filter("left > 0")
        .select("node", "n", "comp", "own", F.posexplode(F.expr("slice(shared, 1, left)")))
        .select("node", "n", "comp", F.col("col.h").alias("h"), (F.col("own") + F.col("pos")).alias("pos")), "near-ordered")
    # a shingle joins components first, then members of different ones: no pair inside a component
    # is formed, however many of its members hold the shingle
    holders = ordered.groupBy("h", "comp").agg(F.max(F.col("n") - F.col("pos")).alias("reach"), F.min("n").alias("n"))
    held = lambda c: holders.select("h", *[F.col(k).alias(f"{k}_{c}") for k in ("comp", "reach", "n")])
    # at the first shingle in common, what is left of both must still hold the overlap needed
    fits = lambda x, y: F.lit(num + den) * F.least(x, y) >= F.lit(num) * (F.col("n_x") + F.col("n_y"))
    meet = (held("x").join(held("y"), "h")
            .filter((F.col("comp_x") < F.col("comp_y")) & fits(F.col("reach_x"), F.col("reach_y")))
            .select("h", "comp_x", "comp_y"))
    side = lambda c: ordered.select("h", *[F.col(k).alias(f"{k}_{c}") for k in ("node", "n", "comp", "pos")])
    second = (meet.join(side("x"), ["h", "comp_x"]).join(side("y"), ["h", "comp_y"])
              .filter(fits(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y")))
              .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct())
    more = materialize(_confirm(second, reps, docs, width, k, num, den, texts), "near-edges")
    if not more.isEmpty():
        comp = connected_components(
            comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(more))

    member = (sk.select("doc_id", F.col("n").alias("n_shingles"), "set_key")
              .join(rep_of, "set_key", "left").join(comp, "node", "left"))
    by_id = F.coalesce("comp", "node", "doc_id")
    return (member.select("doc_id", "n_shingles", by_id.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
