"""Write paths: overwrite, append count, versioned merge, schema evolution, CSV."""
import pytest
from pyspark.sql import functions as F

from lapforge.sinks import (KeyCollision, append_load, export, land, merge_mart, read_evolved,
                            write_overwrite)
from lapforge.sources.files import read_raw_csv


def _mart(spark, rows):
    return spark.createDataFrame(rows, "season int, driver_id int, points bigint")


def test_merge_upserts_touched_seasons_and_is_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/mart"
    merge_mart(spark, path, _mart(spark, [(2000, 1, 10), (2000, 2, 5), (2001, 1, 7)]),
               ["season", "driver_id"])
    new = _mart(spark, [(2001, 1, 9), (2001, 3, 4)])
    merge_mart(spark, path, new, ["season", "driver_id"])
    first = sorted(tuple(r) for r in read_evolved(spark, path)
                   .select("season", "driver_id", "points").collect())
    assert first == [(2000, 1, 10), (2000, 2, 5), (2001, 1, 9), (2001, 3, 4)]
    merge_mart(spark, path, new, ["season", "driver_id"])  # replay
    again = sorted(tuple(r) for r in read_evolved(spark, path)
                   .select("season", "driver_id", "points").collect())
    assert again == first


def test_merge_rejects_key_collision(spark, tmp_dir):
    two_teams = _mart(spark, [(2000, 1, 10), (2000, 1, 3)])  # same key twice
    with pytest.raises(KeyCollision):
        merge_mart(spark, f"{tmp_dir}/m", two_teams, ["season", "driver_id"])


def test_merge_adds_columns(spark, tmp_dir):
    path = f"{tmp_dir}/mart"
    merge_mart(spark, path, _mart(spark, [(2000, 1, 10)]), ["season", "driver_id"])
    wider = spark.createDataFrame([(2001, 1, 3, 1)], "season int, driver_id int, points bigint, "
                                                     "wins bigint")
    merge_mart(spark, path, wider, ["season", "driver_id"])
    got = {r.season: r.wins for r in read_evolved(spark, path).collect()}
    assert got == {2000: None, 2001: 1}


def test_append_counts_rows_written(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert append_load(spark.range(5), path) == 5
    assert append_load(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 8


def test_overwrite_replaces_schema_and_land_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/o"
    write_overwrite(spark.range(3), path)
    write_overwrite(spark.range(2).withColumn("x", F.lit("a")), path)
    assert spark.read.parquet(path).columns == ["id", "x"]
    land(_mart(spark, [(2000, 1, 1), (2001, 2, 2)]), f"{tmp_dir}/l")
    pruned = spark.read.parquet(f"{tmp_dir}/l").filter("season = 2001")
    assert pruned.count() == 1


def test_csv_roundtrip_strings(spark, tmp_dir):
    df = spark.createDataFrame([(1, " a "), (2, None)], "k int, s string")
    export(df, f"{tmp_dir}/c", "csv")
    back = read_raw_csv(spark, f"{tmp_dir}/c")
    assert dict(back.dtypes) == {"k": "string", "s": "string"}
    assert sorted((r.k, r.s) for r in back.collect() if r.s) == [("1", " a ")]
