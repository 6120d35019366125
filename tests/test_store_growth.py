"""Bucketed keys, compaction that heals, counts while writing, and writers at the same time."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from vigil.sources.store import TableStore


def _events(spark, ids, day=dt.date(2026, 9, 28)):
    return spark.createDataFrame([(f"E{i}", i, day) for i in ids], "event_id string, v long, event_date date")


def _insert(st, df, batch):
    return st.insert_if_absent(df, "raw", ["event_id"], batch, order=["v"], layout_cols=["event_date"])


def _compact(st, upto, rows=50):
    return st.compact("raw", ["event_id"], upto, order=["v"], layout_cols=["event_date"], bucket_rows=rows)


def test_same_id_on_two_dates_is_stored_once(spark, workdir):
    st = TableStore(spark, workdir)
    assert _insert(st, _events(spark, range(100)), 0) == 100
    assert _insert(st, _events(spark, range(50, 150), dt.date(2026, 9, 29)), 1) == 50
    assert _compact(st, 1) == 2
    assert _insert(st, _events(spark, range(140, 160), dt.date(2026, 9, 30)), 2) == 10
    assert _insert(st, _events(spark, range(140, 160), dt.date(2026, 9, 30)), 2) == 10      # a replay
    assert _insert(st, _events(spark, range(150), dt.date(2026, 10, 1)), 1) == 0            # of a merged batch
    rows = st.read("raw")
    assert rows.count() == 160 == rows.select("event_id").distinct().count()


def test_keys_read_for_a_batch_do_not_grow_with_history(spark, workdir):
    st = TableStore(spark, workdir)
    probe = _events(spark, [7, 10 ** 6])
    read, buckets, batch = [], [], 0
    for size in (200, 800, 3200):
        for part in range(2):
            ids = range(batch * 10_000, batch * 10_000 + size // 2)
            _insert(st, _events(spark, [*ids, 7] if batch == 0 else ids), batch)
            batch += 1
        assert _compact(st, batch - 1) == 2
        frames = st._stored_keys("raw", probe, ["event_id"], [], batch)
        plan = frames[-1]._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
        read.append(sum(f.count() for f in frames))
        buckets.append(sum(b for _, b, _ in st._runs("raw")))
        assert sum(st.spark.read.parquet(path).count() for _, _, path in st._runs("raw")) == st.read("raw").count()
    assert len(st._runs("raw")) <= 2 and buckets[-1] > 8 * buckets[0]
    assert max(read) <= 4 * 50 * 2 and read[-1] <= 2 * read[0], read    # two buckets of a run, a few runs
    assert _insert(st, probe, batch) == 1


def test_interrupted_compaction_heals(spark, workdir):
    st = TableStore(spark, workdir)
    for b in range(3):
        _insert(st, _events(spark, range(b * 10, b * 10 + 12)), b)
    before = sorted(r.event_id for r in st.read("raw").collect())
    keep, st._delete = st._delete, lambda p: None if "batch_id=" in p and "-" not in p.rsplit("batch_id=", 1)[1] else keep(p)
    assert _compact(st, 2) == 3          # ends before it has deleted what it merged
    st._delete = keep
    for b in (3, 4):
        _insert(st, _events(spark, range(b * 10, b * 10 + 12)), b)
    assert _compact(st, 4) == 5
    after = [r.event_id for r in st.read("raw").collect()]
    assert len(after) == len(set(after)) == 52 and set(before) < set(after)


@pytest.mark.parametrize("prune", [[], ["event_date"]])
def test_inserts_are_counted_while_written(spark, workdir, prune):
    st = TableStore(spark, workdir)
    df = _events(spark, [1, 1, 2])
    assert st.insert_if_absent(df, "t", ["event_id"], 0, order=["v"], prune_cols=prune) == 2
    assert st.insert_if_absent(df.limit(0), "t", ["event_id"], 1, prune_cols=prune) == 0
    assert st.insert_if_absent(df, "t", ["event_id"], 2, prune_cols=prune) == 0


def test_writers_at_the_same_time_lose_no_row(spark, workdir):
    stores = [TableStore(spark, workdir) for _ in range(4)]
    errors = []

    def write(k):
        try:
            for n in range(3):
                df = spark.createDataFrame([(f"{k}-{n}", k), ("shared", k)], "id string, v int")
                stores[k].upsert(df, "ledger", ["id"])
        except Exception as exc:  # noqa: BLE001 - shown by the assertion
            errors.append(exc)
    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors, errors
    rows = stores[0].read("ledger")
    assert {r.id for r in rows.collect()} == {f"{k}-{n}" for k in range(4) for n in range(3)} | {"shared"}
    assert rows.count() == 13


def test_claimed_snapshot_of_an_ended_writer_is_kept(spark, workdir):
    st = TableStore(spark, workdir)
    st.upsert(spark.createDataFrame([(1, "a")], "id int, v string"), "t", ["id"])
    staging = st._staging()
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.parquet(staging)
    assert st._claim(st.path("t"), 2, staging) and not st._claim(st.path("t"), 2, "elsewhere")
    st.upsert(spark.createDataFrame([(3, "c")], "id int, v string"), "t", ["id"])
    assert sorted((r.id, r.v) for r in st.read("t").collect()) == [(1, "a"), (2, "b"), (3, "c")]
    st._fs.create(st._Path(f"{st.path('t')}/_commits/v=00000004"), False).close()   # ended before it named one
    st.upsert(spark.createDataFrame([(4, "d"), (4, "c")], "id int, v string"), "t", ["id"])
    assert sorted((r.id, r.v) for r in st.read("t").collect())[-1] == (4, "d")


def test_failed_swap_restores_the_old_partition(spark, workdir):
    st = TableStore(spark, workdir)
    day = dt.date(2026, 9, 28)
    df = spark.createDataFrame([(day, "old")], "sim_date date, x string")
    st.replace_partitions(df, "t", ["sim_date"], [{"sim_date": day}])
    move = st._move
    st._failed = False

    def once(a, b):
        if b.endswith(f"/t/sim_date={day}") and not st._failed:
            st._failed = True
            raise OSError("lost")
        move(a, b)
    st._move = once
    with pytest.raises(OSError):
        st.replace_partitions(df.withColumn("x", F.lit("new")), "t", ["sim_date"], [{"sim_date": day}])
    assert [r.x for r in st.read("t").collect()] == ["old"]
