import pytest
from pyspark.sql import functions as F

from millrace.plans import catalog, relational
from millrace.sinks.files import write_sorted, write_tbl, write_text
from millrace.sources.tables import SCAN_TASKS, dealt_out, read_table

NATIONS = ["3|CANADA|1|nice|", "24|UNITED STATES|1|with, \"marks\"|"]


@pytest.mark.parametrize("end", ["|", ""])
def test_lines_may_end_in_a_separator(spark, tmp_path, rows, end):
    (tmp_path / "nation.tbl").write_text("\n".join(line[:-1] + end for line in NATIONS) + "\n")
    table = read_table(spark, str(tmp_path), "nation", "tbl")
    assert rows(table) == [(3, "CANADA", 1, "nice"), (24, "UNITED STATES", 1, 'with, "marks"')]
    assert rows(table.select("n_name")) == [("CANADA",), ("UNITED STATES",)]


def test_a_field_that_does_not_parse_fails(spark, tmp_path):
    (tmp_path / "nation.tbl").write_text("x|CANADA|1|nice|\n")
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path), "nation", "tbl").select("n_nationkey").collect()


def test_unknown_format(spark, small):
    with pytest.raises(ValueError, match="unknown table format"):
        read_table(spark, small, "nation", "orc")


def test_tables_survive_the_round_trip(spark, small, tmp_path, rows):
    for name in ("customer", "part"):
        table = read_table(spark, small, name)
        write_tbl(table, str(tmp_path), name)
        assert rows(read_table(spark, str(tmp_path), name, "tbl").select(*table.columns)) == rows(table)


@pytest.mark.parametrize("name", sorted(catalog._reports("parquet")))
def test_reports_are_the_same_from_text(spark, small, name):
    jobs = catalog.report_jobs()
    parquet = [tuple(r) for r in jobs[name](spark, small).collect()]
    text = [tuple(r) for r in jobs[name + "_text"](spark, small).collect()]
    assert parquet
    if name.startswith("q6"):
        parquet, text = sorted(parquet), sorted(text)
    assert parquet == text


def test_clerk_and_priority_are_shown_where_there_are_any(spark, tmp_path):
    (tmp_path / "lineitem.tbl").write_text(
        "7|1|1|1|2|100|0.1|0.05|N|O|1996-11-05|||||x|\n"
        "7|1|1|2|2|100|0.1|0.05|N|O|1996-11-06|||||x|\n"
        "8|1|1|1|2|500|0.1|0.05|N|O|1995-11-06|||||x|\n"
    )
    (tmp_path / "orders.tbl").write_text(
        "7|5|O|200|1996-10-01|1-URGENT|Clerk#1|0|x|\n8|5|O|500|1995-10-01|1-URGENT|Clerk#2|2|x|\n"
    )
    (tmp_path / "customer.tbl").write_text("5|Customer#5|addr|3|phone|1.5|SEG|x|\n")
    where = str(tmp_path)
    q2 = relational.q2_orders_of_date(spark, where, "1996-11", fmt="tbl").collect()
    assert [tuple(r) for r in q2] == [("Clerk#1", 7)]
    fanned = relational.q2_orders_of_date(spark, where, "1996-11", fanout=True, fmt="tbl").collect()
    assert [tuple(r) for r in fanned] == [("Clerk#1", 7)] * 2
    q7 = relational.q7_top_unshipped(spark, where, "1996-11-01", fmt="tbl").collect()
    assert [tuple(r) for r in q7] == [("Customer#5", 7, 180.0, "1996-10-01", 0)]


def test_large_joins_are_not_broadcast_by_hint(spark, small):
    plan = relational.q7_top_unshipped(spark, small, "1996-11-01")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()


def test_scans_are_dealt_out_on_request_only(spark, small):
    table = read_table(spark, small, "documents")
    assert "Exchange" not in dealt_out(table)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(SCAN_TASKS, "6")
    try:
        dealt = dealt_out(table)
        assert "RoundRobinPartitioning(6)" in dealt._jdf.queryExecution().executedPlan().toString()
        assert dealt.count() == table.count()
    finally:
        spark.conf.unset(SCAN_TASKS)


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, None), ("a", 1, 0.5)], "k string, n int, v double")
    write_text(df, str(tmp_path / "out"))
    write_text(df, str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(lines) == ["a\t1\t0.5", "b\t2\tnull"]
    write_sorted(df, str(tmp_path / "sorted"), "k")
    assert [r.value for r in spark.read.text(str(tmp_path / "sorted")).orderBy(F.col("_metadata.file_name")).collect()] == [
        "a\t1\t0.5",
        "b\t2\tnull",
    ]
