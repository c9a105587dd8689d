import time

from pyspark.sql import functions as F

from millrace import session


class Unnamed:
    """A session that names no folder but has a warehouse."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return "/shared/warehouse/" if key == session.WAREHOUSE_KEY else default

    class sparkContext:
        @staticmethod
        def getConf():
            return Unnamed.conf


def test_without_a_named_folder_the_warehouse_is_used():
    assert session.shared_dir(Unnamed()) == "/shared/warehouse/_work"


def test_the_named_folder_is_used(spark):
    named = spark.sparkContext.getConf().get(session.CHECKPOINT_KEY)
    if named:
        assert session.shared_dir(spark) == named.rstrip("/")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_bucketed_tables_join_without_moving(spark):
    left = session.write_bucketed(spark.range(1000), "left_test", "id")
    right = session.write_bucketed(spark.range(500, 1500), "right_test", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.table.join(right.table, "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left.release()
    right.release()
    assert not spark.catalog.tableExists(left.name)


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """Only the rows that were written stay; files of shuffles do not add up over the steps of a job."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {name for name in blocks.getAllBlocks().mkString(" ").split() if name.startswith("shuffle_")}

    before = shuffled()
    counts = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert session.write_and_read(counts, str(tmp_path / "counts")).count() == 10
    assert spark.conf.get(session.FREE_KEY) == "false"
    for _ in range(100):
        # The files go after the query, not with it. Those of the count above stay, and have one name each.
        if len(left := {name for name in shuffled() - before if name.endswith(".data")}) <= 1:
            break
        time.sleep(0.1)
    assert len(left) <= 1
