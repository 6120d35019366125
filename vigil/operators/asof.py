"""As-of join: for each probe row, the latest fact row of the same key at or before its time.

Spark has no as-of join operator. A single ``last(..) over (partition by key order by ts)``
sorts every row of a key in one task, which a hot key (a third of all rows) turns into one
straggler. This version is exact and bounded per task:

1. Facts and probes get a coarse time bucket ``b = floor(ts / bucket)``.
2. *Inside a bucket*: probes and facts of the same (key, b) are unioned and the latest fact
   at or before each probe is carried forward with ``last(.., ignorenulls)``; a group is at
   most one bucket of one key.
3. *Earlier buckets*: the windowed rows are reduced to the latest fact per (key, b)
   (``max_by``; the rows are already partitioned by (key, b), so no shuffle), then a
   carry-forward over one row per (key, bucket) gives the latest fact of any earlier bucket.
4. The in-bucket match wins when present (it is always later); otherwise the earlier one.

All steps are hash-partitioned shuffles with no per-key list on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _bucket(ts_col: str, bucket_seconds: int):
    return F.floor(F.unix_micros(F.col(ts_col)) / F.lit(bucket_seconds * 1_000_000)).cast("long")


def asof_join(probes: DataFrame, facts: DataFrame, by: Sequence[str], probe_ts: str,
              fact_ts: str, fact_cols: Sequence[str], bucket_seconds: int = 86400,
              matched_col: str = "matched") -> DataFrame:
    """Left as-of join: every probe row, plus ``fact_cols`` of the latest fact with
    ``fact_ts <= probe_ts`` and equal ``by`` keys (NULLs and ``matched`` = false if none).

    Ties on ``fact_ts`` are broken by the fact columns (largest wins), deterministically.
    """
    by = list(by)
    fact_cols = list(fact_cols)
    probe_cols = probes.columns
    payload = F.struct(*[F.col(c).alias(c) for c in [fact_ts] + [c for c in fact_cols if c != fact_ts]])
    probe_struct = F.struct(*[F.col(c) for c in probe_cols])

    f = facts.select(*by, _bucket(fact_ts, bucket_seconds).alias("__b"), F.col(fact_ts).alias("__t"),
                     F.lit(0).alias("__is_probe"), payload.alias("__fact"))
    p = probes.select(*by, _bucket(probe_ts, bucket_seconds).alias("__b"), F.col(probe_ts).alias("__t"),
                      F.lit(1).alias("__is_probe"), probe_struct.alias("__probe"))
    fact_type, probe_type = f.schema["__fact"].dataType, p.schema["__probe"].dataType
    rows = (p.withColumn("__fact", F.lit(None).cast(fact_type))
            .unionByName(f.withColumn("__probe", F.lit(None).cast(probe_type))))

    # step 2: in-bucket carry-forward; facts sort before probes at equal time (inclusive)
    w_in = (Window.partitionBy(*by, "__b").orderBy("__t", "__is_probe", "__fact")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = rows.withColumn("__in", F.last("__fact", ignorenulls=True).over(w_in))

    # step 3: one summary row per (key, bucket), then the latest fact of earlier buckets
    summary = carried.groupBy(*by, "__b").agg(
        # the carried value at the bucket's last row (window order) is its latest fact
        F.max_by("__in", F.struct("__t", "__is_probe", "__fact")).alias("__last"),
        F.max(F.col("__is_probe")).alias("__has_probe"))
    w_out = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (summary.withColumn("__prev", F.last("__last", ignorenulls=True).over(w_out))
               .filter(F.col("__has_probe") == 1).select(*by, "__b", "__prev"))

    inner = carried.filter(F.col("__is_probe") == 1).select(*by, "__b", "__probe", "__in")
    joined = inner.join(earlier, on=[*by, "__b"], how="left")
    best = F.coalesce(F.col("__in"), F.col("__prev"))
    return joined.select(*[F.col("__probe." + c).alias(c) for c in probe_cols],
                         *[best.getField(c).alias(c) for c in fact_cols if c not in probe_cols],
                         best.isNotNull().alias(matched_col))
