"""Versions of a table: all or nothing, replay, conflicts, replaced schemas."""
import pytest
from pyspark.sql import functions as F

from lapforge.sinks import merge_mart, read_evolved, versions

SCHEMA = "season int, driver_id int, points bigint"
KEYS = ["season", "driver_id"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_job_that_dies_before_the_switch_changes_nothing(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/mart"
    merge_mart(spark, path, spark.createDataFrame([(2000, 1, 10), (2001, 1, 7), (None, 3, 1)], SCHEMA), KEYS)
    before = rows(read_evolved(spark, path))
    new = spark.createDataFrame([(2001, 1, 9), (2002, 4, 4)], SCHEMA)

    def dies(*_):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", dies)  # the batch is written, the manifest is not
        with pytest.raises(RuntimeError):
            merge_mart(spark, path, new, KEYS)
    assert rows(read_evolved(spark, path)) == before
    merge_mart(spark, path, new, KEYS)
    after = [(2000, 1, 10), (2001, 1, 9), (2002, 4, 4), (None, 3, 1)]
    assert rows(read_evolved(spark, path).select(*KEYS, "points")) == sorted(after, key=str)
    merge_mart(spark, path, new, KEYS)  # replay
    assert rows(read_evolved(spark, path).select(*KEYS, "points")) == sorted(after, key=str)
    assert read_evolved(spark, path).where("season = 2000").count() == 1


def test_untouched_partitions_are_not_written_again(spark, tmp_dir):
    path = f"{tmp_dir}/mart"
    merge_mart(spark, path, spark.createDataFrame([(2000, 1, 10), (2001, 1, 7)], SCHEMA), KEYS)
    first = versions.current(spark, path)[2]
    merge_mart(spark, path, spark.createDataFrame([(2001, 2, 9)], SCHEMA), KEYS)
    second = versions.current(spark, path)[2]
    assert second["season=2000"] == first["season=2000"] and second["season=2001"] != first["season=2001"]


def test_of_two_writers_the_second_fails(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    versions.overwrite(spark.range(3).toDF("a"), path)
    base = versions.current(spark, path)
    late = versions.write_batch(spark.range(9).toDF("a"), path)
    versions.overwrite(spark.range(5).toDF("a"), path)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, base[0] + 1, base[1], late)
    assert versions.read_version(spark, path).count() == 5


def test_overwrite_replaces_rows_and_schema(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    versions.overwrite(spark.range(3).toDF("a"), path)
    versions.overwrite(spark.range(2).select(F.lit("x").alias("b"), F.col("id").alias("season")), path, "season")
    got = versions.read_version(spark, path)
    assert dict(got.dtypes) == {"b": "string", "season": "bigint"} and got.count() == 2
    versions.overwrite(spark.createDataFrame([], SCHEMA), path, "season")
    assert versions.read_version(spark, path).columns == ["season", "driver_id", "points"]
    assert versions.read_version(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, f"{tmp_dir}/none")
