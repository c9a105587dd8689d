import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from millrace.functions import dates, regions, scores
from millrace.functions.sql import register_functions
from millrace.functions.tokens import bigram_array, leading_distinct, tokenize
from millrace.sources.text import explode_lines

TEXTS = [
    "Don't stop",
    "--x-- 123 a1b É élan naïve",
    "",
    "   ",
    "a\tb\x0cc\rd",
    "well-known o'clock 'quoted' (x) 4th 5G g5",
    "ΟΔΟΣ abc İstanbul ß end.",
]


def test_tokens_equal_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, s string")
    got = {r.i: r.t for r in df.select("i", tokenize(F.col("s")).alias("t")).collect()}
    assert got == {i: brute.tokens(s) for i, s in enumerate(TEXTS)}
    assert got[0] == ["don't", "stop"]
    assert got[1][:3] == ["x", "a1b", "lan"]


def test_generated_tokens_equal_plain_python(spark):
    letters = "aZ1'-é \t\n."
    texts = ["".join(letters[(i * k * k + 3 * k) % len(letters)] for k in range(40)) for i in range(1, 200)]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select("s", tokenize(F.col("s")).alias("t"))
    assert all(r.t == brute.tokens(r.s) for r in df.collect())


def test_cut_comes_before_distinct(spark):
    line = " ".join(["same"] * 39 + ["last", "beyond"])
    words = tokenize(F.col("s"))
    df = spark.createDataFrame([(line,)], "s string").select(leading_distinct(words, 40).alias("t"), leading_distinct(words).alias("all"))
    assert df.first().t == ["same", "last"]
    assert df.first().all == ["same", "last", "beyond"]


def test_bigrams_of_short_lines(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [[tuple(p) for p in r.b] for r in df.select(bigram_array(F.col("t")).alias("b")).collect()]
    assert got == [[("a", "b"), ("b", "c")], [], []]


def test_lines_are_cut_as_a_file_reader_cuts_them(spark, tmp_path):
    texts = ["a\nb", "a\nb\n", "a\n\n", "", "\n", "a\r\nb\rc"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {}
    for r in explode_lines(df, "text", "i").orderBy("i", "line_no").collect():
        got.setdefault(r.i, []).append(r.line)
    for i, text in enumerate(texts):
        path = tmp_path / f"f{i}"
        path.write_bytes(text.encode())
        assert got.get(i, []) == [r.value for r in spark.read.text(str(path)).collect()]


DAYS = [dt.date(1996, 1, 1) + dt.timedelta(days=k) for k in range(0, 1200, 7)]
PIECES = ["1996", "1996-11", "1996-11-05", "11", "-1", "19", "1997-02-30", "1996-13", "96-1", "", "x", "1998-12"]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_date_predicates_equal_text_comparisons(spark, kind):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date").select(F.col("d").cast(kind).alias("d"))
    for piece in PIECES:
        found = df.select(
            F.date_format("d", "yyyy-MM-dd").alias("iso"),
            dates.date_contains(F.col("d"), piece).alias("has"),
            dates.date_after(F.col("d"), piece).alias("after"),
            dates.date_before(F.col("d"), piece).alias("before"),
        ).collect()
        assert all((piece in r.iso) == r.has for r in found), piece
        assert all((r.iso > piece) == r.after for r in found), piece
        assert all((r.iso < piece) == r.before for r in found), piece


@given(st.dates(dt.date(1000, 1, 1), dt.date(9998, 12, 31)), st.integers(0, 10), st.integers(0, 10))
def test_period_holds_exactly_the_days_it_names(day, start, end):
    piece = day.isoformat()[start:end]
    period = dates.iso_period(piece)
    if period:
        first, beyond = period
        assert first <= day < beyond
        assert first.isoformat().startswith(piece) and not beyond.isoformat().startswith(piece)
        assert (beyond - dt.timedelta(days=1)).isoformat().startswith(piece)


def test_period_is_a_pushed_range(spark, small):
    from millrace.plans.relational import q1_shipped_count

    plan = q1_shipped_count(spark, small, "1996-11")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan


def test_regions_are_open_and_the_first_one_wins(spark):
    boxes = (regions.Region("a", "A", 0, 10, 0, 10), regions.Region("b", "B", 5, 20, 5, 20))
    points = [(1.0, 1.0), (0.0, 5.0), (10.0, 7.0), (6.0, 6.0), (15.0, 15.0), (30.0, 1.0), (5.0, 5.0)]
    df = spark.createDataFrame(points, "x double, y double")
    got = [r.r for r in df.select(regions.region_of(F.col("x"), F.col("y"), boxes).alias("r")).collect()]
    assert got == ["a", None, "b", "a", "b", None, "a"]


def test_scores(spark):
    df = spark.createDataFrame([(0.0,), (1e-9,), (-800.0,), (800.0,)], "s double")
    got = df.select(scores.label_of(F.col("s")).alias("l"), scores.sigmoid(F.col("s")).alias("p")).collect()
    assert [r.l for r in got] == ["ham", "spam", "ham", "spam"]
    assert [round(r.p, 6) for r in got] == [0.5, 0.5, 0.0, 1.0]


def test_functions_of_sql_text_equal_the_columns(spark):
    register_functions(spark)
    register_functions(spark)
    df = spark.createDataFrame([("It's  a\tTEST-case, 'x1y'.\n",), ("",), (None,)], "s string")
    got = spark.sql("SELECT tokenize_words(s) AS w, count_words(s) AS n FROM {df}", df=df).collect()
    want = df.select(tokenize(F.col("s")).alias("w")).collect()
    assert [r.w for r in got] == [r.w for r in want] == [["it's", "a", "test-case", "x1y"], [], None]
    assert [r.n for r in got][:2] == [4, 0]
    plan = spark.sql("SELECT tokenize_words(s) FROM {df}", df=df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
