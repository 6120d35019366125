"""WARC archives: writing, and reading by boundary-chain verification.

Writing. One record per page through Spark's own text writer, whose line separator is the
blank line pair that ends a WARC record; file commits and retries are Spark's. Of equal
payloads of at least 1000 bytes the page with the largest id is a ``response``; the others
are ``revisit`` records without a body that refer to it.

Reading. Files are read in splits cut at the version line, wherever it occurs - payloads may
contain it. Every piece is a candidate record; tasks emit its offset and its successor's
(header length + Content-Length + 4). Within a split chains are followed to their exit;
pointer jumping over the exits then finds, from offset 0 of each file, the entry of every
split in a logarithmic number of rounds. Only records on the chain are kept: a version line
inside a payload is never a successor of a record.

A payload that contains version lines comes in several pieces. Those records, once verified,
are read again piecewise; all others are digested where they are first read, so no payload is
shuffled.
"""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.base import map_rows, materialize

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
LEAST_REVISIT = 1000
DATE = "1970-01-01T00:00:00Z"
PIECES = 64     # least number of splits of an archive, so that two readings split alike


# -- writing ---------------------------------------------------------------------------------

def write_warc(pages: DataFrame, path: str, least_revisit: int = LEAST_REVISIT, date: str = DATE) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) as WARC files under ``path``.

    Null html is an empty payload; null url omits the target; line breaks in a url are
    percent-encoded. Rows of equal page_id and payload get equal records. Null page_id counts
    as the smallest id. An empty table writes no record.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")) \
        .withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    ids = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("digest"),
                       F.octet_length(payload).alias("bytes"))
    # payloads that occur again, by digest and length: small, so the join rarely shuffles html
    again = materialize(ids.filter(F.col("bytes") >= least_revisit).groupBy("digest", "bytes")
                        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("c"))
                        .filter("c > 1").drop("c"), "warc-again")
    joined = rows.join(again, ["digest", "bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">\r\n"))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(VERSION),
        F.when(revisit, F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        F.lit("WARC-Record-ID: "), name(F.col("page_id")),
        F.lit(f"WARC-Date: {date}\r\n"),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n"))).otherwise(F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("first")),
                                 F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")))
        .otherwise(F.lit("")),
        F.lit("Content-Type: text/html\r\nContent-Length: "),
        F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string")), F.lit(END),
        F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    joined.select(record.alias("value")).write.option("lineSep", END).text(path)


# -- reading ---------------------------------------------------------------------------------

def parse_header(piece: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """({lower-case name: value}, bytes up to the body) of a piece after its version line."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return (fields, end + 4) if fields.get(b"content-length", b"").isdigit() else None


def _id(urn: bytes | None) -> int | None:
    text = (urn or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(text) if text.lstrip(b"-").isdigit() else None


CANDIDATE = ("file string, block long, is_split boolean, off long, nxt long, exit long, clean boolean, "
             "page_id long, rec_type string, uri string, refers_to long, declared string, payload_bytes long, sha1 string")


def _candidates(version: bytes):
    """Candidate records of each split, offsets counted from its first piece.

    One ``is_split`` row per split carries its length in ``nxt``; it is emitted with the next
    split's first rows or at the end.
    """
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        names = [f.split(" ")[0] for f in CANDIDATE.split(", ")]
        cur, pos, found = None, 0, []

        def flush() -> dict:
            starts = {r["off"]: r for r in found}
            for r in reversed(found):     # exits: follow the chain while it stays in the split
                to = starts.get(r["nxt"])
                r["exit"] = to["exit"] if to else r["nxt"]
            split = dict.fromkeys(names) | {"file": cur[0], "block": cur[1], "is_split": True, "nxt": pos}
            return {n: [r[n] for r in [split, *found]] for n in names}

        for b in batches:
            for file, block, piece in zip(b["file"], b["block"], b["value"], strict=True):
                if (file, block) != cur:
                    if cur:
                        yield flush()
                    cur, pos, found = (file, block), 0, []
                    if block == 0:        # what stands before the first version line
                        pos = len(piece) + len(version)
                        continue
                start = pos - len(version)
                pos += len(piece) + len(version)
                if (head := parse_header(piece)) is None:
                    continue
                fields, body = head
                size = int(fields[b"content-length"])
                clean = body + size + 4 == len(piece) or (body + size <= len(piece) <= body + size + 4
                                                          and not piece[body + size:].strip(b"\r\n"))
                text = lambda k: fields[k].decode("utf-8", "replace") if k in fields else None  # noqa: B023, E731
                found.append({
                    "file": file, "block": block, "is_split": False, "off": start,
                    "nxt": start + len(version) + body + size + 4, "exit": None, "clean": clean,
                    "page_id": _id(fields.get(b"warc-record-id")), "rec_type": text(b"warc-type"),
                    "uri": text(b"warc-target-uri"), "refers_to": _id(fields.get(b"warc-refers-to")),
                    "declared": text(b"warc-payload-digest"), "payload_bytes": size,
                    "sha1": hashlib.sha1(piece[body:body + size]).hexdigest() if clean else None})
        if cur:
            yield flush()
    return run


@contextlib.contextmanager
def _fixed_splits(spark: SparkSession):
    """Let the number of splits not depend on the executors of the moment."""
    key = "spark.sql.files.minPartitionNum"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(PIECES))
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def _pieces(spark: SparkSession, path: str, version: str) -> DataFrame:
    return (spark.read.option("lineSep", version).text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), "value"))


def reachable_entries(jumps: DataFrame) -> DataFrame:
    """(file, off): what is reached from offset 0 of each file over (file, off, exit).

    Pointer jumping: each round doubles the length of the jumps, so the rounds are the
    logarithm of the number of splits of a file.
    """
    jumps = materialize(jumps.select("file", "off", "exit").distinct(), "warc-jumps")
    seen = materialize(jumps.select("file").distinct().select("file", F.lit(0).cast("long").alias("off")), "warc-seen")
    n = seen.count()
    while True:
        seen = materialize(seen.unionByName(seen.join(jumps, ["file", "off"])
                                            .select("file", F.col("exit").alias("off"))).distinct(), "warc-seen")
        if (m := seen.count()) == n:
            return seen
        n = m
        onward = jumps.select("file", F.col("off").alias("exit"), F.col("exit").alias("onward"))
        jumps = materialize(jumps.join(onward, ["file", "exit"], "left")
                            .select("file", "off", F.coalesce("onward", "exit").alias("exit")), "warc-jumps")


def _walk(left, right=None):
    """Records of one split on the chain from its entries."""
    rows = left.sort_values("off")
    nxt = dict(zip(rows["off"], rows["nxt"], strict=True))
    on = set()
    for off in rows.loc[rows["entry"], "off"]:
        while off in nxt and off not in on:
            on.add(off)
            off = nxt[off]
    return rows[rows["off"].isin(on)][["file", "block", "off"]]


def read_warc(spark: SparkSession, path: str, version: str = VERSION) -> DataFrame:
    """The records of all archives under ``path``.

    Returns one row per record: file, off (byte offset), page_id, rec_type, uri, refers_to,
    declared (the header's digest), payload_bytes, sha1 (of the bytes read), whole (the
    payload is complete). Archives that do not begin with a record yield none; a record cut
    off at the end of a file is returned with whole = false.
    """
    ver = version.encode()
    with _fixed_splits(spark):
        found = materialize(map_rows(_pieces(spark, path, version), _candidates(ver), CANDIDATE), "warc-candidates")
    sums = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = (found.filter("is_split").select("file", "block", "nxt")
            .withColumn("base", F.coalesce(F.sum("nxt").over(sums), F.lit(0))).drop("nxt"))
    records = materialize(
        found.filter("not is_split").drop("is_split").join(base, ["file", "block"])
        .withColumn("rel", F.col("off"))
        .withColumn("off", F.col("off") + F.col("base")).withColumn("nxt", F.col("nxt") + F.col("base"))
        .withColumn("exit", F.col("exit") + F.col("base")), "warc-records")
    # only offsets that some chain leaves a split to can be entries
    targets = records.select("file", F.col("exit").alias("off")).distinct().unionByName(
        records.select("file", F.lit(0).cast("long").alias("off")).distinct())
    jumps = records.select("file", "off", "exit").join(targets.distinct(), ["file", "off"], "left_semi")
    entries = reachable_entries(jumps).withColumn("entry", F.lit(True))
    marked = (records.select("file", "block", "off", "nxt").join(entries, ["file", "off"], "left")
              .withColumn("entry", F.coalesce("entry", F.lit(False))))
    on_chain = marked.groupBy("file", "block").applyInPandas(
        lambda pdf: _walk(pdf), "file string, block long, off long")
    kept = materialize(records.join(on_chain, ["file", "block", "off"], "left_semi"), "warc-kept")
    out = ["file", "off", "page_id", "rec_type", "uri", "refers_to", "declared", "payload_bytes"]
    clean = kept.filter("clean").select(*out, "sha1", F.lit(True).alias("whole"))
    broken = kept.filter("not clean")
    if broken.isEmpty():
        return clean
    return clean.unionByName(_joined_pieces(spark, path, version, records, kept).join(
        broken.select(*out), ["file", "off"]).select(*out, "sha1", "whole"))


def _joined_pieces(spark: SparkSession, path: str, version: str, records: DataFrame, kept: DataFrame) -> DataFrame:
    """(file, off, sha1, whole) of verified records whose payload contains version lines."""
    spans = kept.filter("not clean").select("file", F.col("off").alias("owner"), F.col("nxt").alias("stop"))
    starts = kept.select("file", "off", F.lit(True).alias("own"))
    upto = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ver = version.encode()

    def pieces(batches: Iterator[dict]) -> Iterator[dict]:
        cur, pos = None, 0
        for b in batches:
            out = {"file": b["file"], "block": b["block"], "rel": [], "piece": b["value"]}
            for file, block, piece in zip(b["file"], b["block"], b["value"], strict=True):
                if (file, block) != cur:
                    cur, pos = (file, block), 0
                out["rel"].append(pos - len(ver))
                pos += len(piece) + len(ver)
            yield out

    # every piece of the files concerned, with the record that it lies in
    with _fixed_splits(spark):
        all_pieces = map_rows(_pieces(spark, path, version)
                              .join(spans.select("file").distinct(), "file", "left_semi"),
                              pieces, "file string, block long, rel long, piece binary")
        base = records.groupBy("file", "block").agg(F.first("base").alias("base"))
        placed = materialize(all_pieces.join(base, ["file", "block"], "left")
                             .withColumn("off", F.col("rel") + F.col("base")), "warc-pieces")
    owned = (placed.join(starts, ["file", "off"], "left")
             .withColumn("owner", F.last(F.when(F.col("own"), F.col("off")), True).over(upto))
             .join(spans, ["file", "owner"]).filter(F.col("off") < F.col("stop")))

    def digest(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            out: dict = {"file": b["file"], "off": b["owner"], "sha1": [], "whole": []}
            for parts in b["parts"]:
                whole = ver.join(p["piece"] for p in parts)
                fields, body = parse_header(whole)
                size = int(fields[b"content-length"])
                out["sha1"].append(hashlib.sha1(whole[body:body + size]).hexdigest())
                out["whole"].append(len(whole) >= body + size)
            yield out

    grouped = owned.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("off", "piece"))).alias("parts"))
    return map_rows(grouped, digest, "file string, off long, sha1 string, whole boolean")


def archive_report(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` under ``path``, read the archives back and report each page.

    Returns page_id, payload_bytes, payload_digest (hex SHA-1; both of the full payload),
    record_type, refers_to. A revisit takes length and digest from the response it refers to,
    which is the one of that page_id and of the digest in its own header: page_ids may repeat
    or be null. Rows of the largest page_id of a payload are all responses.
    """
    spark = pages.sparkSession
    write_warc(pages, path)
    records = materialize(read_warc(spark, path).select("page_id", "rec_type", "refers_to", "declared", "payload_bytes", "sha1"), "warc-read")
    full = records.filter("rec_type = 'response'").select(
        "page_id", F.col("payload_bytes"), F.col("sha1").alias("payload_digest"),
        F.col("rec_type").alias("record_type"), F.col("refers_to"))
    original = (full.select(F.col("page_id").alias("original"), "payload_bytes", "payload_digest")
                .dropDuplicates(["original", "payload_digest"]))
    back = (records.filter("rec_type = 'revisit'")
            .select("page_id", F.col("rec_type").alias("record_type"), "refers_to",
                    F.regexp_replace("declared", "^sha1:", "").alias("digest"))
            .join(original, F.col("refers_to").eqNullSafe(F.col("original"))
                  & (F.col("digest") == F.col("payload_digest")), "left"))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return full.select(cols).unionByName(back.select(cols))
