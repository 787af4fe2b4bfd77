"""Landing stream drops repeats; mart refresh is replay-safe."""
from pyspark.sql import functions as F

from lapforge.sinks import read_evolved
from lapforge.streaming import RAW_RESULT_SCHEMA, land_stream, refresh_mart_stream


def _rows(spark, rows):
    return spark.createDataFrame(rows, RAW_RESULT_SCHEMA)


def _r(race, season, drv, pos, pts, day):
    import datetime
    return (race, season, 1, 1, drv, pos, pts, "Finished", datetime.datetime(season, 1, day))


def test_land_then_refresh_and_replay(spark, tmp_dir):
    inc, raw, mart = f"{tmp_dir}/in", f"{tmp_dir}/raw", f"{tmp_dir}/mart"
    batch1 = [_r(1, 2000, 7, 1, 25, 1), _r(1, 2000, 8, 2, 18, 1), _r(2, 2001, 7, 3, 15, 2)]
    _rows(spark, batch1).write.mode("append").parquet(inc)
    _rows(spark, batch1[:1]).write.mode("append").parquet(inc)  # a repeated record
    land_stream(spark, inc, raw, f"{tmp_dir}/ck1")
    assert spark.read.parquet(raw).count() == 3
    refresh_mart_stream(spark, raw, mart, f"{tmp_dir}/ck2")
    got = {(r.season, r.driver_id): (r.points, r.races, r.wins)
           for r in read_evolved(spark, mart).collect()}
    assert got == {(2000, 7): (25, 1, 1), (2000, 8): (18, 1, 0), (2001, 7): (15, 1, 0)}

    # new arrival for 2001 plus another repeat: only 2001 changes
    _rows(spark, [_r(3, 2001, 8, 1, 25, 3), batch1[1]]).write.mode("append").parquet(inc)
    land_stream(spark, inc, raw, f"{tmp_dir}/ck1")
    assert spark.read.parquet(raw).count() == 4
    refresh_mart_stream(spark, raw, mart, f"{tmp_dir}/ck2")
    got2 = {(r.season, r.driver_id): (r.points, r.races, r.wins)
            for r in read_evolved(spark, mart).collect()}
    assert got2 == {**got, (2001, 8): (25, 1, 1)}

    # replaying a whole refresh from scratch changes nothing
    refresh_mart_stream(spark, raw, mart, f"{tmp_dir}/ck3")
    got3 = {(r.season, r.driver_id): (r.points, r.races, r.wins)
            for r in read_evolved(spark, mart).collect()}
    assert got3 == got2
    assert read_evolved(spark, mart).filter(F.col("season") == 2001).count() == 2
