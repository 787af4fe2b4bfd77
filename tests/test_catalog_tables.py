"""Catalog tables: partitions added by each landing, replaced ones, NULL, pruning by the catalog."""
import uuid

from lapforge.sinks.catalog import inventory, land_table, partitions, quoted


def test_landings_add_and_replace_partitions(spark, tmp_dir):
    db, path = "db_" + uuid.uuid4().hex, f"{tmp_dir}/t's"
    schema = "id bigint, name string, season int"
    land_table(spark.createDataFrame([(1, "a", 2000), (2, "b", 2001)], schema), db, "t", path)
    land_table(spark.createDataFrame([(3, "c", 2001), (4, None, None), (5, "e", 2002)], schema), db, "t", path)
    t = spark.table(quoted(db, "t"))
    want = {(1, "a", 2000), (3, "c", 2001), (4, None, None), (5, "e", 2002)}
    assert {tuple(r) for r in t.collect()} == want
    assert partitions(spark, db, "t").count() == 4
    land_table(spark.createDataFrame([(3, "c", 2001)], schema), db, "t", path)  # repeated
    assert {tuple(r) for r in spark.table(quoted(db, "t")).collect()} == want
    plan = t.filter("season = 2001")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
    land_table(spark.createDataFrame([(9, "a b/c'=%")], "id bigint, season string"), db, "u", f"{tmp_dir}/u")
    assert spark.table(quoted(db, "u")).collect()[0].season == "a b/c'=%"
    land_table(spark.createDataFrame([], schema), db, "none", f"{tmp_dir}/none")
    assert {tuple(r) for r in inventory(spark, db).collect()} == {("t", 4, 4), ("u", 1, 1), ("none", 0, 0)}


def test_empty_database(spark):
    db = "db_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {db}")
    assert inventory(spark, db).count() == 0
