"""Session construction and the shared folder that iterative jobs write to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
WAREHOUSE_KEY = "spark.sql.warehouse.dir"
# With it Spark removes the shuffle files of a query when the query has ended, not when the driver collects its garbage.
FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; ``conf`` entries win over them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one that the session names, else one in the warehouse."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    return named.rstrip("/") if named else f"{spark.conf.get(WAREHOUSE_KEY).rstrip('/')}/_work"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files. For writes, whose results are read from where they were written."""
    before = spark.conf.get(FREE_KEY, None)
    spark.conf.set(FREE_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_KEY)
        else:
            spark.conf.set(FREE_KEY, before)


class Bucketed(NamedTuple):
    """A table in the shared folder, bucketed so that joins on its keys do not move it again."""

    name: str
    table: DataFrame

    def release(self) -> None:
        """Forget the table's name; its files stay."""
        self.table.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def in_buckets(df: DataFrame, *keys: str) -> DataFrame:
    """Move rows to the partition of their bucket, in as many buckets as shuffles have partitions."""
    return df.repartition(shuffle_partitions(df.sparkSession), *keys)


def write_bucketed(df: DataFrame, label: str, *keys: str, placed: bool = False) -> Bucketed:
    """Write ``df`` bucketed by the keys.

    This cuts the lineage and survives the loss of executors. Rows are moved to their bucket first,
    unless they are ``placed`` there already, so there is one file per bucket.
    """
    spark = df.sparkSession
    buckets = shuffle_partitions(spark)
    path = fresh_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    with freeing_shuffles(spark):
        (
            (df if placed else in_buckets(df, *keys))
            .write.mode("overwrite")
            .format("parquet")
            .option("path", path)
            .bucketBy(buckets, *keys)
            .sortBy(*keys)
            .saveAsTable(name)
        )
    return Bucketed(name, spark.table(name))


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: cuts the lineage and survives the loss of executors."""
    with freeing_shuffles(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
