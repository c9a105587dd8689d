"""Relational tables, read either from delimited text or from Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column order of the delimited files.
TBL_COLUMNS = {
    "region": "r_regionkey int, r_name string, r_comment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int, n_comment string",
    "customer": "c_custkey bigint, c_name string, c_address string, c_nationkey int, c_phone string, "
    "c_acctbal double, c_mktsegment string, c_comment string",
    "supplier": "s_suppkey bigint, s_name string, s_address string, s_nationkey int, s_phone string, "
    "s_acctbal double, s_comment string",
    "part": "p_partkey bigint, p_name string, p_mfgr string, p_brand string, p_type string, p_size int, "
    "p_container string, p_retailprice double, p_comment string",
    "partsupp": "ps_partkey bigint, ps_suppkey bigint, ps_availqty int, ps_supplycost double, ps_comment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, "
    "o_orderpriority string, o_clerk string, o_shippriority int, o_comment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate date, l_commitdate date, l_receiptdate date, l_shipinstruct string, l_shipmode string, "
    "l_comment string",
}

FORMATS = ("parquet", "tbl")
SCAN_TASKS = "spark.millrace.scan.tasks"


def tbl_schema(name: str) -> T.StructType:
    """Declared schema of a delimited table."""
    return T.StructType.fromDDL(TBL_COLUMNS[name])


def read_tbl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read ``|``-delimited lines by position.

    A ``|`` may or may not end the line: the extra column catches what follows it, and because it
    is never selected the parser prunes it. A field that does not parse fails the read.
    """
    padded = T.StructType(schema.fields + [T.StructField("_after_last", T.StringType())])
    rows = (
        spark.read.schema(padded)
        .option("sep", "|")
        .option("quote", "")
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )
    return rows.select(*schema.fieldNames())


def read_table(spark: SparkSession, directory: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Read table ``name`` below ``directory``; the same query runs over either format."""
    if fmt == "parquet":
        return spark.read.parquet(f"{directory}/{name}.parquet")
    if fmt == "tbl":
        return read_tbl(spark, f"{directory}/{name}.tbl", tbl_schema(name))
    raise ValueError(f"unknown table format {fmt!r}; expected one of {FORMATS}")


def to_tbl_layout(df: DataFrame, name: str) -> DataFrame:
    """Arrange a table in the column order of the delimited files, absent columns being null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(field.name) if field.name in have else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in tbl_schema(name).fields
        ]
    )


def dealt_out(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan to as many tasks as the session asks for by ``SCAN_TASKS``; unset, scans stay as they are.

    Meant for jobs that turn each row into many, over files too few to keep all cores busy. Whoever runs them knows.
    """
    tasks = df.sparkSession.conf.get(SCAN_TASKS, None)
    return df.repartition(int(tasks)) if tasks else df
