"""Shared helpers: folder for cut lineage, word splitting and hashing inside tasks."""

from __future__ import annotations

import contextlib
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from vigil.session import checkpoint_dir

# Rows per Arrow batch: texts may be long, so a batch is kept to some MB.
BATCH_ROWS = 256

_UPPER = bytes(range(0x41, 0x5B))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
# [a-z0-9] and every byte of a multi-byte character stay, all other ASCII becomes a space.
ALNUM = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
              for b in range(256))

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# paths that the open scope has written; without a scope tables stay
_scope: list[str] | None = None


@contextlib.contextmanager
def scoped_tables() -> Iterator[list[str]]:
    """Note the tables that are written inside, so that their owner can delete them later."""
    global _scope
    outer, _scope = _scope, []
    try:
        yield _scope
    finally:
        _scope = outer


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    paths.clear()


def keep_tables(paths: list[str]) -> None:
    """Leave tables of an inner scope to the open one."""
    if _scope is not None:
        _scope.extend(paths)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that are over, which it does when the driver collects garbage."""
    for _ in range(2):      # what the first leaves to be forgotten the second frees
        gc.collect()
        spark._jvm.System.gc()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    Unlike ``checkpoint()`` this computes the plan once; lost executors only repeat tasks.
    """
    path = table_path(df.sparkSession, name)
    df.write.parquet(path)
    if _scope is not None:
        _scope.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_batch_rows(spark: SparkSession) -> None:
    """Bound the Arrow batches that carry whole texts to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str,
             rows_out: int = 4096) -> DataFrame:
    """``mapInArrow`` over dictionaries of column lists.

    ``fn`` gets an iterator of ``{column: list}`` batches (strings as UTF-8 bytes) and yields
    ``{column: list}`` batches of the output schema.
    """
    import pyspark.sql.types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(as_lists(batches)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out_schema)


def as_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Batches as ``{column: list}``; string columns come as their UTF-8 bytes."""
    for b in batches:
        if b.num_rows:
            yield {f.name: (b.column(i).cast(pa.binary()) if pa.types.is_string(f.type)
                            else b.column(i)).to_pylist() for i, f in enumerate(b.schema)}


class WordHash(dict):
    """64-bit hash of a word, remembered; ``trim`` bounds the memory."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def trim(self, most: int = 300_000) -> None:
        if len(self) > most:
            self.clear()

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def space_words(text: bytes | None) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]`` of the text with A-Z lower-cased; null has none."""
    return text.translate(LOWER).split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of the text with A-Z lower-cased."""
    return text.translate(LOWER).translate(ALNUM).split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` word hashes; a shorter non-empty text is one shingle."""
    n = len(h)
    if n == 0:
        return h
    w = min(width, n)
    acc = h[: n - w + 1].copy()
    for j in range(1, w):
        acc = acc * _MULT + h[j: n - w + 1 + j]
    return mix64(acc + np.uint64(w))
