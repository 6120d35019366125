"""Keyed Parquet tables with three idempotent write modes, on any Hadoop file system.

* ``insert_if_absent`` (K5/K6/K7/J3): rows whose key is not yet stored, written to the
  batch's own ``batch_id=N`` folder; a replay of batch N overwrites that folder and is
  anti-joined against every *other* batch, so a replay never duplicates and never loses.
  Keys of merged batches are looked up in narrow tables bucketed by key hash, so that a batch
  opens only the buckets its own keys fall in.
* ``replace_partitions`` (K10-K12): staged then swapped partition folders; partitions named
  in the scope but absent from the data are cleared too (an empty result empties them).
* ``upsert`` (K13/K14/J4): full-outer merge of the current snapshot with the incoming rows,
  written as a new numbered snapshot (for small dimension and ledger tables). A snapshot is
  published under a number that no other writer has taken; the loser merges again.

Only file-system metadata calls run on the driver; every row moves in Spark tasks.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_ROWS = 100_000   # keys of a bucket of a keys table, about
MOST_BUCKETS = 1 << 16
ATTEMPTS = 50           # of an upsert that other writers overtake


POINT_COLUMNS = ("patient_id",)     # single keys that readers ask for: sorted in files, with Bloom filters


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------------ paths
    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _exists(self, p: str) -> bool:
        return self._fs.exists(self._Path(p))

    def _delete(self, p: str) -> None:
        if self._exists(p):
            self._fs.delete(self._Path(p), True)

    def _children(self, p: str) -> list[str]:
        if not self._exists(p):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._Path(p)) if s.isDirectory()]

    def _has_data(self, p: str) -> bool:
        if not self._exists(p):
            return False
        it = self._fs.listFiles(self._Path(p), True)
        while it.hasNext():
            name = it.next().getPath().getName()
            if name.endswith(".parquet"):
                return True
        return False

    def _staging(self) -> str:
        """A fresh folder beside the tables: leftovers of a crash are never part of one."""
        return self.path(f"_staging/{uuid.uuid4().hex}")

    def _move(self, src: str, dst: str) -> None:
        """Rename, or raise before the caller deletes anything further."""
        self._fs.mkdirs(self._Path(dst).getParent())
        if not self._fs.rename(self._Path(src), self._Path(dst)):
            raise OSError(f"could not move {src} to {dst}")

    def _versions(self, p: str) -> list[str]:
        """Whole snapshots of an upsert table, oldest first; a torn one has no _SUCCESS."""
        return sorted(c for c in self._children(p) if c.startswith("v=") and self._exists(f"{p}/{c}/_SUCCESS"))

    # ------------------------------------------------------------------ reads
    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """Current contents; an empty frame with ``schema`` if nothing was written yet."""
        p = self.path(table)
        versions = self._versions(p)
        if versions:
            return self.spark.read.parquet(f"{p}/{versions[-1]}")
        if self._has_data(p):
            reader = self.spark.read.option("basePath", p)
            return reader.parquet(p)
        if schema is None:
            raise FileNotFoundError(p)
        return self.spark.createDataFrame([], schema)

    # ------------------------------------------------------------------ insert-if-absent
    def insert_if_absent(self, df: DataFrame, table: str, keys: Sequence[str], batch_id: int,
                         order: Sequence[str] = (), prune_cols: Sequence[str] = (),
                         layout_cols: Sequence[str] = ()) -> int:
        """Write the rows of ``df`` whose ``keys`` are not stored yet; return that count.

        Within the batch the first row per key (by ``order``, then all columns) wins.
        ``prune_cols`` are partition columns that are functions of the key (e.g. the event
        date of a window). Rows are stored as ``batch_id=N/<prune_cols>=v``, and the anti
        join reads only the stored partitions whose values occur in this batch (a handful
        of dates per micro-batch) instead of the whole history. ``layout_cols`` are partition
        columns that are not a function of the key: they shape the folders for readers but
        prune nothing; the anti join then reads the key columns of the whole table.
        """
        from vigil.operators.events import dedup_first

        keys, prune_cols, layout_cols = list(keys), list(prune_cols), list(layout_cols)
        p = self.path(table)
        batch = dedup_first(df, keys + prune_cols, list(order) or keys)
        for stored in self._stored_keys(table, batch, keys, prune_cols, batch_id):
            batch = batch.join(stored.distinct(), on=[*keys, *prune_cols], how="left_anti")
        target = f"{p}/batch_id={batch_id}"
        staging = self._staging()
        n = self._write(batch, staging, [*prune_cols, *layout_cols])
        self._delete(target)
        self._move(staging, target)
        return n

    def _write(self, df: DataFrame, path: str, part_cols: Sequence[str] = ()) -> int:
        """Write Parquet and count the rows while they are written (no read afterwards)."""
        seen = Observation()
        point = [c for c in POINT_COLUMNS if c in df.columns]
        rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
        # rows of one key stand together, so that a read of it skips all other pages and row groups
        rows = rows.sortWithinPartitions(*part_cols, *point) if point else rows
        writer = rows.write.mode("overwrite").options(**{f"parquet.bloom.filter.enabled#{c}": "true" for c in point})
        (writer.partitionBy(*part_cols) if part_cols else writer).parquet(path)
        return seen.get["n"]

    def _runs(self, table: str) -> list[tuple[int, int, str]]:
        """Keys tables: (last batch they cover, buckets, path), oldest first."""
        root = f"{self.root}/_keys/{table}"
        found = []
        for name in self._children(root):
            upto, _, buckets = name.removeprefix("run=").partition("-")
            if self._exists(f"{root}/{name}/_SUCCESS"):
                found.append((int(upto), int(buckets), f"{root}/{name}"))
        return sorted(found)

    def _stored_keys(self, table: str, batch: DataFrame, keys: list[str], prune_cols: list[str],
                     batch_id: int) -> list[DataFrame]:
        """Frames that hold every stored key the batch could repeat, of other batches."""
        p = self.path(table)
        out = []
        runs = self._runs(table) if not prune_cols else []
        covered = runs[-1][0] if runs else -1
        # folders that no keys table covers: the batches since the last compaction
        tail = [c for c in self._children(p) if c.startswith("batch_id=") and int(c[9:]) != batch_id
                and not -(covered + 1) <= int(c[9:]) < 0 and self._has_data(f"{p}/{c}")]
        if tail:
            stored = self.spark.read.option("basePath", p).parquet(*[f"{p}/{c}" for c in tail])
            if prune_cols:
                # distinct partition values of one batch: a few rows, used as static filters
                values = batch.select(*prune_cols).distinct().collect()
                for c in prune_cols:
                    stored = stored.filter(F.col(c).isin(sorted({v[c] for v in values if v[c] is not None})))
            out.append(stored.select(*keys, *prune_cols))
        if runs:
            # hash classes of the batch's keys: a bounded number, whatever the batch holds
            most = max(b for _, b, _ in runs)
            classes = [r[0] for r in batch.select(F.pmod(F.xxhash64(*keys), F.lit(most)).cast("int")).distinct().collect()]
            for _, buckets, path in runs:
                wanted = sorted({c % buckets for c in classes})
                out.append(self.spark.read.parquet(path).filter(F.col("bucket").isin(wanted)).select(*keys))
        return out

    def compact(self, table: str, keys: Sequence[str], up_to_batch: int,
                order: Sequence[str] = (), prune_cols: Sequence[str] = (), layout_cols: Sequence[str] = (),
                bucket_rows: int = BUCKET_ROWS) -> int:
        """Merge the batches since the last compaction, up to ``up_to_batch``, into one folder.

        Micro-batches leave one small folder each; they are rewritten (first row per key) as
        ``batch_id=-(up_to_batch+1)``, which is moved in before the merged folders are deleted.
        Earlier merged folders stay as they are, so a compaction reads what is new. A batch
        that is already merged but still there (an interrupted compaction, or a replay) is
        merged again, without keys that are stored.

        A table without ``prune_cols`` also gets a keys table of the merged rows, laid out by
        ``pmod(xxhash64(keys), B)`` with about ``bucket_rows`` keys a bucket: B, a power of two,
        grows with the rows, and the bytes that a batch reads do not. Keys tables are merged when
        they are as large as the next older one together, so their number is logarithmic.
        Returns the number of folders merged.
        """
        from vigil.operators.events import dedup_first

        keys, prune_cols = list(keys), list(prune_cols)
        p = self.path(table)
        ids = sorted(int(c[9:]) for c in self._children(p) if c.startswith("batch_id="))
        done = max([-i - 1 for i in ids if i < 0], default=-1)
        merged = [i for i in ids if 0 <= i <= up_to_batch]
        if len(merged) < 2 or up_to_batch <= done:
            return 0
        paths = [f"{p}/batch_id={i}" for i in merged if self._has_data(f"{p}/batch_id={i}")]
        if paths:
            rows = self.spark.read.option("basePath", p).parquet(*paths).drop("batch_id")
            compacted = dedup_first(rows, keys + prune_cols, list(order) or keys)
            if merged[0] <= done:
                old = [f"{p}/batch_id={i}" for i in ids if i < 0 and self._has_data(f"{p}/batch_id={i}")]
                stored = self.spark.read.option("basePath", p).parquet(*old).select(*keys, *prune_cols)
                compacted = compacted.join(stored, on=[*keys, *prune_cols], how="left_anti")
            staging = self._staging()
            self._write(compacted, staging, [*prune_cols, *layout_cols])
            target = f"{p}/batch_id={-(up_to_batch + 1)}"
            self._delete(target)
            self._move(staging, target)
            if not prune_cols:
                self._add_keys(table, keys, up_to_batch, bucket_rows)
        for i in merged:
            self._delete(f"{p}/batch_id={i}")
        return len(merged)

    def _add_keys(self, table: str, keys: list[str], upto: int, bucket_rows: int) -> None:
        """A keys table of the merged folders that none covers yet, merged with smaller ones."""
        p, runs = self.path(table), self._runs(table)
        covered = runs[-1][0] if runs else -1
        fresh = [f"{p}/{c}" for c in self._children(p) if c.startswith("batch_id=-") and int(c[9:]) < -(covered + 1)
                 and self._has_data(f"{p}/{c}")]
        if not fresh:
            return
        frame = self.spark.read.option("basePath", p).parquet(*fresh).select(*keys)
        n, joined = frame.count(), []
        for run in reversed(runs):      # counts come from file footers
            size = self.spark.read.parquet(run[2]).count()
            if size > n:
                break
            frame, n = frame.unionByName(self.spark.read.parquet(run[2]).select(*keys)), n + size
            joined.append(run[2])
        buckets = 1
        while buckets * bucket_rows < n and buckets < MOST_BUCKETS:
            buckets *= 2
        staging = self._staging()
        (frame.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
         .repartition(buckets, "bucket").sortWithinPartitions("bucket", *keys)
         .write.partitionBy("bucket").parquet(staging))
        self._move(staging, f"{self.root}/_keys/{table}/run={upto}-{buckets}")
        for path in joined:             # the new run covers them; a leftover is only read twice
            self._delete(path)

    # ------------------------------------------------------------------ replace partitions
    def replace_partitions(self, df: DataFrame, table: str, part_cols: Sequence[str],
                           scope: Iterable[dict]) -> dict:
        """Make the partitions in ``scope`` hold exactly the matching rows of ``df``.

        ``scope`` lists partition values (dicts over ``part_cols``); rows of ``df`` outside
        it are not written. Returns ``{"deleted": n_old_rows, "inserted": n_new_rows}``.
        """
        part_cols = list(part_cols)
        scope = [dict(s) for s in scope]
        p = self.path(table)
        dirs = ["/".join(f"{c}={s[c]}" for c in part_cols) for s in scope]
        if not dirs:
            return {"deleted": 0, "inserted": 0}
        # one key of partition columns alone, so it prunes folders
        cond = F.concat_ws("/", *[F.col(c).cast("string") for c in part_cols]).isin(
            ["/".join(str(s[c]) for c in part_cols) for s in scope])
        deleted = 0
        if self._has_data(p):
            deleted = self.spark.read.parquet(p).filter(cond).count()    # from file footers
        staging, aside = self._staging(), self._staging()
        inserted = self._write(df.filter(cond), staging, part_cols)
        for d in dirs:
            # the old partition stands aside until the new one is in its place
            had = self._exists(f"{p}/{d}")
            if had:
                self._move(f"{p}/{d}", f"{aside}/{d}")
            if self._exists(f"{staging}/{d}"):
                try:
                    self._move(f"{staging}/{d}", f"{p}/{d}")
                except Exception:
                    if had:
                        self._move(f"{aside}/{d}", f"{p}/{d}")
                    raise
        self._delete(aside)
        self._delete(staging)
        return {"deleted": deleted, "inserted": inserted}

    # ------------------------------------------------------------------ upsert
    def upsert(self, df: DataFrame, table: str, keys: Sequence[str],
               keep_first: Sequence[str] = (), order: str | None = None,
               keep_versions: int = 2) -> None:
        """Insert new keys, update existing ones; ``keep_first`` columns keep their stored
        value. Within ``df`` the last row per key by ``order`` wins, without it the greatest.

        The snapshot is written aside first and then takes the next number; when another writer
        has taken it, the rows are merged anew with that writer's snapshot.
        """
        keys = list(keys)
        incoming = latest_per_key(df, keys, order).drop(order) if order else greatest_per_key(df, keys)
        p = self.path(table)
        for _ in range(ATTEMPTS):
            self._settle(p)
            versions = self._versions(p)
            merged, nxt = incoming, 1
            if versions:
                current = self.spark.read.parquet(f"{p}/{versions[-1]}")
                merged, nxt = merge_upsert(current, incoming, keys, keep_first), int(versions[-1][2:]) + 1
            staging = self._staging()
            try:
                merged.write.parquet(staging)
            except Exception:
                if self._versions(p) == versions:
                    raise
                continue                # the snapshot read has been replaced and cleared away since
            self._set_torn_aside(f"{p}/v={nxt:08d}")
            if self._claim(p, nxt, staging):
                self._settle(p)
                for old in self._versions(p)[:-keep_versions]:
                    self._delete(f"{p}/{old}")
                return
            self._delete(staging)
        raise OSError(f"{p}: other writers were faster {ATTEMPTS} times")

    def _set_torn_aside(self, path: str) -> None:
        """A folder without _SUCCESS in a snapshot's place is left of a crash."""
        if self._exists(path) and not self._exists(f"{path}/_SUCCESS"):
            aside = self._staging()
            self._move(path, aside)
            if self._exists(f"{aside}/_SUCCESS"):   # another writer's snapshot came between
                self._move(aside, path)
            else:
                self._delete(aside)

    def _claim(self, p: str, version: int, staging: str) -> bool:
        """Take a snapshot number for a written snapshot; False if it is taken. This is the commit:
        the file names the snapshot, so that anybody can move it into place."""
        name = f"{p}/_commits/v={version:08d}"
        at = self._Path(name)
        if self._fs.getUri().getScheme() == "file":
            # a local file system looks first and creates then; only this is one step there
            self._fs.mkdirs(at.getParent())
            try:
                open(f"{at.getParent().toUri().getPath()}/.taken-{version:08d}", "x").close()
            except FileExistsError:
                return False
        try:
            out = self._fs.create(at, False)
        except Py4JJavaError as exc:
            if "AlreadyExists" in exc.java_exception.getClass().getName():
                return False
            raise
        out.writeBytes(staging)
        out.close()
        return self._exists(name)

    def _settle(self, p: str) -> None:
        """Move the last claimed snapshot into place, if its writer has not done so.

        A claim that names a snapshot is never deleted, so its number is not given out again.
        """
        claims = self._Path(f"{p}/_commits")
        if not self._fs.exists(claims):
            return
        name, size = None, 0
        for _ in range(100):
            # read anew each time: other writers may have gone on, and cleared an older snapshot away
            name = max((n for n in (s.getPath().getName() for s in self._fs.listStatus(claims))
                        if n.startswith("v=")), default=None)
            if name is None or self._exists(f"{p}/{name}/_SUCCESS"):
                return
            at = self._Path(f"{p}/_commits/{name}")
            size = self._fs.getFileStatus(at).getLen()
            if size:
                stream = self._fs.open(at)
                staging = bytes(stream.readNBytes(size)).decode()
                stream.close()
                try:
                    self._fs.rename(self._Path(staging), self._Path(f"{p}/{name}"))
                except Py4JJavaError:   # moved by another writer meanwhile
                    pass
            else:
                time.sleep(0.1)         # its writer is about to name the snapshot
        if not size and not self._exists(f"{p}/{name}/_SUCCESS"):
            # claimed by a writer that ended before it named a snapshot
            self._delete(f"{p}/_commits/{name}")
            self._delete(f"{p}/_commits/.taken-{name[2:]}")


def new_rows(batch: DataFrame, stored_keys: DataFrame, keys: Sequence[str],
             order: Sequence[str] = ()) -> DataFrame:
    """The rows an insert-if-absent would write: first row per key within the batch,
    minus keys already stored (``left_anti``)."""
    from vigil.operators.events import dedup_first
    keys = list(keys)
    first = dedup_first(batch, keys, list(order) or keys)
    return first.join(stored_keys.select(*keys).distinct(), on=keys, how="left_anti")


def greatest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by its other columns in order, so that reruns agree."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return (df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row"))
            .select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns]))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last row per key by ``order`` (a partial aggregate, skew-safe)."""
    rest = [c for c in df.columns if c not in keys and c != order]
    packed = F.max(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("__row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col("__row." + c).alias(c) for c in rest],
                                                F.col("__row." + order).alias(order))


def merge_upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
                 keep_first: Sequence[str] = ()) -> DataFrame:
    """Full-outer merge; incoming values win except ``keep_first`` columns."""
    keys = list(keys)
    cols = [c for c in current.columns if c not in keys]
    a = current.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in cols], F.lit(True).alias("__old"))
    b = incoming.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in cols if c in incoming.columns],
                        F.lit(True).alias("__new"))
    j = a.join(b, on=keys, how="full_outer")
    out = []
    for c in cols:
        if c not in incoming.columns:
            out.append(F.col(f"__old_{c}").alias(c))
        elif c in keep_first:
            out.append(F.when(F.col("__old").isNotNull(), F.col(f"__old_{c}"))
                       .otherwise(F.col(f"__new_{c}")).alias(c))
        else:
            out.append(F.when(F.col("__new").isNotNull(), F.col(f"__new_{c}"))
                       .otherwise(F.col(f"__old_{c}")).alias(c))
    return j.select(*keys, *out)
