"""Keyed landing: late and replayed files land once, a replayed batch adds nothing."""
import datetime

from pyspark.sql import functions as F

from lapforge.plans.streams import EVENT_SCHEMA, merge_user_deltas, user_delta
from lapforge.streaming.keyed import land_keyed, read_deltas, read_landed
from lapforge.sinks.versions import store_of


def _e(i, day, user=1, hour=0, kind="view"):
    ts = None if day is None else datetime.datetime(2024, 1, day, hour)
    return (i, ts, user, kind, (i or 0) / 4)


def _drop(spark, path, rows):
    spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _land(spark, base, **kw):
    land_keyed(spark, f"{base}/in", f"{base}/raw", f"{base}/ck", EVENT_SCHEMA, ["event_id"], "ts",
               deltas=(user_delta, f"{base}/deltas"), **kw)


def _got(spark, base):
    return sorted(((r.event_id, r.ts and r.ts.day) for r in read_landed(spark, f"{base}/raw", EVENT_SCHEMA).collect()),
                  key=str)


def _mart(spark, base):
    return {r.user_id: (r.events, r.cents) for r in read_deltas(spark, f"{base}/deltas", merge_user_deltas).collect()}


def test_late_replayed_and_odd_rows_land_once(spark, tmp_dir):
    _drop(spark, f"{tmp_dir}/in", [_e(i, 1 + i, hour=h) for i, h in ((0, 1), (1, 1), (2, 1))] + [_e(2, 3, hour=1)])
    _land(spark, tmp_dir)
    assert _got(spark, tmp_dir) == [(0, 1), (1, 2), (2, 3)]
    _drop(spark, f"{tmp_dir}/in", [_e(9, 20), _e(9, 20), _e(2, 3, hour=1)])           # far ahead, with repeats
    _land(spark, tmp_dir)
    # late new ones (twice), late repeats of both lanes' rows, no id, no time
    _drop(spark, f"{tmp_dir}/in", [_e(5, 2), _e(5, 2), _e(0, 1, hour=1), _e(9, 20), _e(None, 4), _e(None, 4),
                                   _e(7, None), _e(7, None)])
    _land(spark, tmp_dir)
    _drop(spark, f"{tmp_dir}/in", [_e(5, 2), _e(None, 4), _e(7, None), _e(30, 21)])   # replayed once more
    _land(spark, tmp_dir)
    want = [(0, 1), (1, 2), (2, 3), (30, 21), (5, 2), (7, None), (9, 20), (None, 4)]
    assert _got(spark, tmp_dir) == want
    lanes = {r.event_id: r.lane for r in read_landed(spark, f"{tmp_dir}/raw", EVENT_SCHEMA).collect()}
    assert lanes[0] == lanes[9] == lanes[30] == "on_time" and lanes[5] == lanes[7] == lanes[None] == "late"
    assert _mart(spark, tmp_dir) == {1: (8, sum(round(i * 25) for i, _ in want if i is not None))}


def test_files_in_any_order(spark, tmp_dir):
    """One file a batch, days in mixed order and each file twice: the rows are those of one pass."""
    for day in (5, 1, 9, 5, 3, 1, 9, 2):
        _drop(spark, f"{tmp_dir}/in", [_e(100 * day + i, day, user=i % 3, hour=i) for i in range(20)])
    _land(spark, tmp_dir, files_per_trigger=1)
    assert _got(spark, tmp_dir) == sorted(((100 * d + i, d) for d in (1, 2, 3, 5, 9) for i in range(20)), key=str)
    assert sum(n for n, _ in _mart(spark, tmp_dir).values()) == 100


def test_batch_replayed_after_a_lost_driver(spark, tmp_dir):
    """The driver is lost after a batch was written and before it was committed."""
    _drop(spark, f"{tmp_dir}/in", [_e(1, 1), _e(2, 8)])
    _land(spark, tmp_dir)
    _drop(spark, f"{tmp_dir}/in", [_e(3, 2), _e(4, 9), _e(1, 1)])
    _land(spark, tmp_dir)
    before, mart = _got(spark, tmp_dir), _mart(spark, tmp_dir)
    commits, store = store_of(spark, f"{tmp_dir}/ck/commits")
    ids = sorted(int(s.getPath().getName()) for s in store.listStatus(commits) if s.getPath().getName().isdigit())
    store.delete(store_of(spark, f"{tmp_dir}/ck/commits/{ids[-1]}")[0], False)
    _land(spark, tmp_dir)
    assert _got(spark, tmp_dir) == before == [(1, 1), (2, 8), (3, 2), (4, 9)]
    assert _mart(spark, tmp_dir) == mart
    assert read_landed(spark, f"{tmp_dir}/raw", EVENT_SCHEMA).filter(F.col("lane") == "late").count() == 1
