"""Line dedup: lines within one word edit of an earlier line go; deletion-neighbourhood join.

Lines are compared by their words (A-Z lower-cased, white space collapsed). The edit bound is
one word (inserted, deleted or replaced) for lines of at least :data:`LEAST_WORDS` words and
zero for shorter ones. A line is removed when an earlier line - by (doc_id, digest of the text,
line number), null doc_ids last - lies within the bound, whether or not that line is itself
kept. Blank lines stay. Rows of one doc_id and different texts are so documents of their own;
rows of equal doc_id and text are one document that stands there several times, and only the
first of them keeps lines.

Method. Every line in question emits the hashed keys of its deletion variants: the line
itself and the line without its word i. Two lines are within one edit exactly if they share a
key with equal i (replacement), or one line's whole key is a variant of the other (insertion
or deletion). So, per key, the earliest line of each i and the whole line suffice: members are
joined with these minima, never with each other, and a group of any size stays linear. Joined
lines are verified by word edit distance. Keys of variants are polynomials in the hashes of the
words, so each follows from running sums and a line of n words costs n steps.

Lines in question are found without loss first: two lines one edit apart have equal first
halves or equal last halves, so a line whose half keys no other distinct line has is settled.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.base import map_rows, materialize, mix64, space_words

LEAST_WORDS = 5
ROW_BYTES = 25           # of a row key: null flag, doc_id, digest of the text
VARIANTS = 100_000       # rows of variants after which a task hands them on
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_INVERSES = tuple(np.uint64(pow(int(m), -1, 2 ** 64)) for m in _FACTORS)


def line_key(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def half_keys(words: list[bytes]) -> list[int]:
    """Keys of the first and last halves that a line one edit away must have too."""
    n = len(words)
    keys = []
    for h in {n // 2, (n - 1) // 2}:
        for side, part in ((b"<", words[:h]), (b">", words[n - h:])):
            keys.append(xxhash.xxh3_64_intdigest(side + b"%d " % h + b" ".join(part)) - 2 ** 63)
    return keys


def variant_keys(words: list[bytes]) -> list[bytes]:
    """Keys of the line and of each one-word deletion of it, in order of the deleted word.

    Two 64-bit sums of word hash times power of its position: without word i, the sum of the
    words before it and that of the words after it, one power lower.
    """
    n = len(words)
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").astype(np.uint64).reshape(n, 2)
    out = np.empty((n + 1, 2), np.uint64)
    size = np.full(n + 1, n - 1, np.uint64)
    size[0] = n
    for c, (factor, inverse) in enumerate(zip(_FACTORS, _INVERSES, strict=True)):
        power = np.full(n, factor)
        power[:1] = 1
        upto = np.cumsum(digests[:, c] * np.multiply.accumulate(power), dtype=np.uint64)
        out[0, c] = upto[-1] if n else 0
        before = np.concatenate([np.zeros(min(n, 1), np.uint64), upto[:-1]])
        out[1:, c] = before + (out[0, c] - upto) * inverse
        out[:, c] = mix64(out[:, c] + size)
    raw = out.astype(">u8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Word edit distance at most one, from the common prefix and suffix."""
    if abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    i = 0
    while i < short and a[i] == b[i]:
        i += 1
    j = 0
    while j < short - i and a[len(a) - 1 - j] == b[len(b) - 1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 1


def row_key(doc_id: Column, text: Column) -> Column:
    """Null flag, doc_id and digest of the text: rows in their order, as bytes that sort so."""
    number = F.coalesce(doc_id.cast("long"), F.lit(0)).bitwiseXOR(F.lit(-2 ** 63).cast("long"))
    return F.unhex(F.concat(F.when(doc_id.isNull(), "01").otherwise("00"), F.lpad(F.hex(number), 16, "0"),
                            F.md5(F.coalesce(text, F.lit("")))))


def _lines_of(least: int):
    """One row per document and distinct line: key, all its line numbers, half keys."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            out: dict = {k: [] for k in ("row", "doc_id", "n_lines", "key", "line_nos", "halves")}
            for row, doc, text in zip(b["row"], b["doc_id"], b["text"], strict=True):
                seen: dict[bytes, tuple[list[int], list[bytes]]] = {}
                lines = text.split(b"\n") if text else []
                for no, line in enumerate(lines):
                    if words := space_words(line):
                        k = line_key(words)
                        if k in seen:
                            seen[k][0].append(no)
                        else:
                            seen[k] = ([no], half_keys(words) if len(words) >= least else [])
                # the first row of a document carries its number of lines
                rows = seen.items() or [(None, ([], []))]
                out["row"] += [row] * len(rows)
                out["doc_id"] += [doc] * len(rows)
                out["n_lines"] += [len(lines)] + [None] * (len(rows) - 1)
                out["key"] += [k for k, _ in rows]
                out["line_nos"] += [v[0] for _, v in rows]
                out["halves"] += [v[1] for _, v in rows]
            yield out
    return run


def _fetch(batches: Iterator[dict]) -> Iterator[dict]:
    """The asked-for lines of each document, as joined words."""
    for b in batches:
        out: dict = {"at": [], "line": []}
        for row, text, wanted in zip(b["row"], b["text"], b["wanted"], strict=True):
            lines = (text or b"").split(b"\n")
            for no in wanted:
                out["at"].append(row + struct.pack(">i", no))
                out["line"].append(b" ".join(space_words(lines[no])))
        yield out


def _variants(batches: Iterator[dict]) -> Iterator[dict]:
    out: dict = {"vkey": [], "pos": [], "at": []}
    for b in batches:
        for at, line in zip(b["at"], b["line"], strict=True):
            keys = variant_keys(line.split(b" "))
            for i in range(0, len(keys), VARIANTS):
                part = keys[i:i + VARIANTS]
                out["vkey"] += part
                out["pos"] += range(i - 1, i - 1 + len(part))
                out["at"] += [at] * len(part)
                if len(out["at"]) >= VARIANTS:
                    yield out
                    out = {"vkey": [], "pos": [], "at": []}
    yield out


def _verify(batches: Iterator[dict]) -> Iterator[dict]:
    for b in batches:
        near = [x for x, p, q in zip(b["x"], b["line_x"], b["line_y"], strict=True)
                if within_one_edit(p.split(b" "), q.split(b" "))]
        yield {"x": near}


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")


def _flagged(docs: DataFrame, least: int) -> DataFrame:
    """All (row key, distinct line) rows: row, doc_id, n_lines, key, line_nos, gone (whole line goes)."""
    base = _rows(docs)
    lines = materialize(map_rows(base, _lines_of(least), "row binary, doc_id long, n_lines int, key binary, "
                                 "line_nos array<int>, halves array<long>"), "line-rows")
    rows = lines.filter("key is not null")
    # a short id stands for the key here: a collision only puts one more line in question
    half = rows.select(F.xxhash64("key").alias("id"), F.explode("halves").alias("half"))
    common = (half.groupBy("half").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
              .filter("lo <> hi").select("half"))
    in_question = half.join(common, "half").select("id").distinct()
    # place of a line: its row, then its number, as bytes that sort so
    place = F.concat("row", F.unhex(F.lpad(F.hex(F.element_at("line_nos", 1)), 8, "0")))
    asked = materialize(
        rows.select("key", place.alias("at"))
        .join(in_question, F.xxhash64("key") == F.col("id"), "left_semi").groupBy("key").agg(F.min("at").alias("at")), "line-asked")
    number = F.conv(F.hex(F.substring("at", ROW_BYTES + 1, 4)), 16, 10).cast("int")
    # a text has as many lines to fetch as it has lines at most
    per_row = asked.groupBy(F.substring("at", 1, ROW_BYTES).alias("row")).agg(F.collect_set(number).alias("wanted"))
    # the lines asked for grow with the documents, so the texts meet them by shuffle at any size
    found = map_rows(base.drop("doc_id").join(per_row.hint("merge"), "row"), _fetch, "at binary, line string")
    texts = materialize(found.dropDuplicates(["at"]), "line-texts")
    at_type = "binary"
    var = materialize(map_rows(texts, _variants, f"vkey binary, pos int, at {at_type}"), "line-variants")
    met = var.groupBy(F.xxhash64("vkey").alias("short")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("short")
    var = materialize(var.join(met, F.xxhash64("vkey") == F.col("short"), "left_semi"), "line-met")
    same = var.groupBy("vkey", "pos").agg(F.min("at").alias("y"))
    whole = var.filter("pos = -1").select("vkey", F.col("at").alias("y"))
    part = var.filter("pos >= 0").groupBy("vkey").agg(F.min("at").alias("y"))
    pairs = (var.join(same, ["vkey", "pos"]).select(F.col("at").alias("x"), "y")
             .unionByName(var.filter("pos >= 0").join(whole, "vkey").select(F.col("at").alias("x"), "y"))
             .unionByName(var.filter("pos = -1").join(part, "vkey").select(F.col("at").alias("x"), "y"))
             .filter("y < x").distinct())
    side = lambda c: texts.select(F.col("at").alias(c), F.col("line").alias(f"line_{c}"))
    near = map_rows(pairs.join(side("x"), "x").join(side("y"), "y"), _verify, f"x {at_type}").distinct()
    near_keys = asked.select("key", F.col("at").alias("x")).join(near, "x", "left_semi").select("key")
    # only keys of several documents or with an earlier near line decide anything; written on
    # its own, so that the join below is the only one of its stage and a hot line can be split
    deciding = materialize(
        rows.select("key", "row", F.lit(False).alias("near"))
        .unionByName(near_keys.select("key", F.lit(None).cast("binary").alias("row"), F.lit(True).alias("near")))
        .groupBy("key").agg(F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.max("near").alias("near"))
        .filter("near or first_row < last_row").drop("last_row"), "line-deciding")
    return (lines.drop("halves").join(deciding, "key", "left")
            .withColumn("gone", F.coalesce((F.col("first_row") < F.col("row")) | F.col("near"), F.lit(False)))
            .drop("first_row", "near"))


def duplicate_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Which lines of every document go.

    Returns one row per distinct doc_id and text: doc_id, n_rows (how often it stands in
    ``docs``), n_lines, n_kept, removed_lines (sorted line numbers from 0): lines within the
    bound of an earlier line, and repeats within the document. Of the ``n_rows`` rows only one
    keeps the lines kept; in the others every line but the blank ones goes.

    Edge cases: null or empty text has no lines (n_lines 0), and the two are one document;
    blank lines stay; rows of one doc_id and different texts are ordered by the MD5 digest of
    the text; null doc_ids are last in order, each text of them a document of its own; so
    nothing ties but rows of equal doc_id and text; other columns are ignored.
    """
    # line_nos of one document's lines differ, so the set only folds its repeated rows
    per = (_flagged(docs, least_words)
           .withColumn("out", F.when(F.col("gone"), F.col("line_nos"))
                       .otherwise(F.slice("line_nos", 2, 2 ** 31 - 1)))
           .groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.count("n_lines").alias("n_rows"),
                               F.max("n_lines").cast("long").alias("n_lines"),
                               F.array_sort(F.flatten(F.collect_set("out"))).alias("removed_lines")))
    return per.select("doc_id", "n_rows", "n_lines",
                      (F.col("n_lines") - F.size("removed_lines")).alias("n_kept"), "removed_lines")


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` without the lines that :func:`duplicate_lines` removes.

    All columns stay; ``text`` is rewritten and ``n_chars``, if present, is its new length.
    Documents whose every non-blank line went are left out; documents that had none stay, also
    repeated ones. Of rows of equal doc_id and text that have a line, one stays (any of them).
    """
    import pyarrow as pa

    # a text has as many removed keys as it has lines at most
    per_row = (_flagged(docs, least_words).filter("gone").groupBy(F.col("row").alias("_ld_row"))
               .agg(F.collect_set("key").alias("_ld_gone")))
    keyed = docs.withColumn("_ld_row", row_key(F.col("doc_id"), F.col("text")))
    worded = F.coalesce(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    blank = docs.filter(~worded)
    joined = keyed.filter(worded).dropDuplicates(["_ld_row"]).join(per_row, "_ld_row", "left").drop("_ld_row")
    count = "n_chars" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            texts = t.column("text").combine_chunks().cast(pa.binary()).to_pylist()
            gone = t.column("_ld_gone").to_pylist()
            new, stay = [], []
            for text, keys in zip(texts, gone, strict=True):
                keys, seen, kept, left = set(keys or ()), set(), [], False
                for line in text.split(b"\n"):
                    words = space_words(line)
                    if words:
                        k = line_key(words)
                        if k in keys or k in seen:
                            continue
                        seen.add(k)
                        left = True
                    kept.append(line)
                new.append(b"\n".join(kept).decode("utf-8", "replace"))
                stay.append(left)
            t = t.drop_columns(["_ld_gone"])
            t = t.set_column(t.schema.get_field_index("text"), "text", pa.array(new, t.schema.field("text").type))
            if count:
                f = t.schema.field("n_chars")
                t = t.set_column(t.schema.get_field_index("n_chars"), "n_chars",
                                 pa.array([len(x) for x in new], pa.int64()).cast(f.type))
            yield from t.filter(pa.array(stay)).to_batches()

    return joined.mapInArrow(run, docs.schema).unionByName(blank)
