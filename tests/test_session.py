"""The shared folder comes from the session; it is set only where unset."""
from lapforge.session import cluster_defaults, configure, ensure_checkpoint_dir, scratch_path


def test_existing_checkpoint_dir_is_kept(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert before
    assert ensure_checkpoint_dir(spark) == before
    configure(spark)
    assert spark.sparkContext.getCheckpointDir() == before


def test_scratch_paths_are_fresh_and_under_the_shared_folder(spark):
    base = ensure_checkpoint_dir(spark).rstrip("/")
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b and a.startswith(base + "/scratch/") and b.startswith(base + "/scratch/")


def test_local_session_keeps_shuffle_defaults(spark):
    # cluster-only defaults are not applied on a local master
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                          None) in (None, "")
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_range_sort_sends_a_bounded_sample_of_its_keys(spark):
    s = spark.newSession()
    cluster_defaults(s)
    configure(s)
    parts = int(s.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    points = int(s.conf.get("spark.sql.execution.rangeExchange.sampleSizePerPartition"))
    assert 3 * parts * points <= 100_000  # Spark samples three times the points
    few = spark.newSession()
    few.conf.set("spark.sql.shuffle.partitions", "8")
    configure(few)
    assert few.conf.get("spark.sql.execution.rangeExchange.sampleSizePerPartition") == "100"


def test_the_size_of_a_scan_counts_compression(spark, tmp_dir):
    spark.range(10_000).write.parquet(f"{tmp_dir}/t")
    plain, ours = spark.newSession(), spark.newSession()
    configure(ours)

    def size(s):
        return int(str(s.read.parquet(f"{tmp_dir}/t")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

    assert size(ours) == 4 * size(plain)


def test_tasks_that_sort_what_they_read_read_little(spark):
    s = spark.newSession()
    cluster_defaults(s)
    assert int(s.conf.get("spark.sql.files.maxPartitionBytes")) <= 16 << 20
    assert int(s.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 64 << 20
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "32m")
    cluster_defaults(own)
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
