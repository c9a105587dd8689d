from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import brute
import check
from millrace.operators import counts, pmi, skew
from millrace.plans import catalog, oracles, retrieval, text

LINES = [
    " ".join(f"w{chr(97 + k % 26)}{'x' * (k // 26)}" for k in range(45)),
    "alone",
    "",
    "same same same same",
    "the cat and the dog",
    "The dog, the cat!",
    "a perfect game a perfect day a perfect game",
    "perfect",
    "game perfect game",
]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(line,) for line in LINES], "line string")


def test_word_count(spark, rows):
    df = spark.createDataFrame([("\n".join(LINES),)], "text string")
    assert dict(rows(counts.word_count(df))) == Counter(w for line in LINES for w in brute.tokens(line))


def test_successors(lines, rows):
    assert rows(counts.successor_count(lines, "perfect")) == [("game", 3)]
    assert rows(counts.successor_count(lines, "perfect", 1)) == [("day", 1), ("game", 3)]


def expected_shares():
    pairs = brute.bigrams(LINES)
    totals = Counter()
    for (left, _), n in pairs.items():
        totals[left] += n
    return {pair: n / totals[pair[0]] for pair, n in pairs.items()}, totals


@pytest.mark.parametrize("rows_per_split", [skew.ROWS_PER_SPLIT, 2])
def test_relative_frequency_pairs(lines, rows, rows_per_split):
    shares, totals = expected_shares()
    got = {(a, b): v for a, b, v in rows(counts.relative_frequency_pairs(lines, rows_per_split))}
    assert got == {**shares, **{(w, "*"): float(n) for w, n in totals.items()}}


@pytest.mark.parametrize("segments", [1, 16])
def test_relative_frequency_stripes(lines, segments):
    shares, _ = expected_shares()
    found, rows_of = {}, defaultdict(int)
    for r in counts.relative_frequency_stripes(lines, segments).collect():
        rows_of[r.left] += 1
        assert 0 <= r.segment < segments
        for right, value in r.stripe.items():
            assert (r.left, right) not in found
            found[r.left, right] = value
    assert found == shares
    if segments == 1:
        assert set(rows_of.values()) == {1}
    else:
        assert rows_of["the"] > 1


def test_stripes_get_their_totals_without_joins(lines, capsys):
    """The pairs are counted once: shuffled by pair, by stripe, and the stripes by left word."""
    counts.relative_frequency_stripes(lines, 3).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan


def test_shares_of_a_left_word_add_up_to_one(lines):
    pairs = counts.relative_frequency_pairs(lines).where(F.col("right") != counts.MARGINAL)
    sums = pairs.groupBy("left").agg(F.sum("value").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-12 for r in sums)


@pytest.mark.parametrize("marginals", ["all", "multi"])
@pytest.mark.parametrize("threshold", [1, 2])
def test_pmi_pairs_and_stripes(lines, marginals, threshold):
    want = brute.pmi(LINES, threshold, multi=marginals == "multi")
    pairs = {(r.x, r.y): (r.pmi, r.n) for r in pmi.pmi_pairs(lines, threshold, marginals=marginals).collect()}
    assert pairs.keys() == want.keys()
    assert all(pairs[k][1] == want[k][1] and abs(pairs[k][0] - want[k][0]) < 1e-12 for k in want)
    assert all(pairs[x, y] == pairs[y, x] for x, y in pairs)
    for segments in (1, 4):
        flat = {}
        for r in pmi.pmi_stripes(lines, threshold, marginals=marginals, segments=segments).collect():
            assert r.stripe
            flat.update({(r.x, y): tuple(v) for y, v in r.stripe.items()})
        assert flat == pairs


def test_frequent_words_are_spread(lines):
    want = brute.pmi(LINES, 1)
    pairs = {(r.x, r.y): (r.pmi, r.n) for r in pmi.pmi_pairs(lines, rows_per_split=5).collect()}
    assert pairs.keys() == want.keys()
    assert all(pairs[k][1] == want[k][1] and abs(pairs[k][0] - want[k][0]) < 1e-12 for k in want)


@pytest.mark.parametrize(
    "job", [text.bigram_relfreq_pairs, lambda s, d: retrieval.matching_all(s, d, "from", "this"), retrieval.document_frequency]
)
def test_texts_are_read_and_counted_once(spark, small, job):
    df = job(spark, small)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("regexp_extract_all") == 1


def test_unknown_marginals(lines):
    with pytest.raises(ValueError):
        pmi.pmi_pairs(lines, marginals="some")


def test_spread_join_equals_plain_join(spark, rows):
    facts = spark.createDataFrame([("hot", k) for k in range(500)] + [(f"k{k}", k) for k in range(50)], "key string, v int")
    lookup = spark.createDataFrame([("hot", 1.0)] + [(f"k{k}", float(k)) for k in range(0, 50, 2)], "key string, w double")
    weights = facts.groupBy("key").agg(F.count("*").alias("rows"))
    hot = skew.hot_keys(weights, "key", "rows", 100)
    assert [r.rows for r in hot.collect()] == [500]
    joined = skew.join_spread(facts, lookup, "key", "v", hot, 100)
    assert rows(joined.select("key", "v", "w")) == rows(facts.join(lookup, "key").select("key", "v", "w"))
    dealt = skew.with_splits(facts, "key", hot, 100).where("key = 'hot'").select("_splits").distinct().collect()
    assert [r[0] for r in dealt] == [5]


@pytest.mark.parametrize("key", ["key", ("key", "part")])
def test_keys_of_any_length_are_listed(spark, key):
    long = "x" * 5000
    facts = spark.createDataFrame([(long, 1, k) for k in range(20)], "key string, part int, v int")
    lookup = spark.createDataFrame([(long, 1, 2.0)], "key string, part int, w double")
    if key == "key":
        lookup = lookup.drop("part")
    names = [key] if key == "key" else list(key)
    hot = skew.hot_keys(facts.groupBy(*names).agg(F.count("*").alias("rows")), key, "rows", 5)
    assert [r.rows for r in hot.collect()] == [20]
    assert skew.join_spread(facts, lookup, key, "v", hot, 5).count() == 20


def test_words_below_the_threshold_are_in_no_pair(lines):
    once = pmi.word_lines(lines)
    numbers = pmi.numbered_words(once, 2)
    lists = [r.w for r in pmi.frequent_words(lines, numbers, None, 5).collect()]
    assert {r.word for r in numbers.collect()} == {r.word for r in once.collect() if r.n >= 2 and r.word}
    frequent = {r.id for r in numbers.collect()}
    assert lists and all(set(w) <= frequent and w == sorted(w) and len(w) > 1 for w in lists)


def test_lines_end_alike_here_and_in_sql(spark, tmp_path):
    """Every kind of line end, a final one, blank lines and an empty text."""
    texts = ["a b\r\nc\r\n", "a\rb\n\nc", "", "\n", "\n\n", "one", "x\n\r\ny z\n", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("en")).coalesce(1).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = oracles.text_oracles()
    for name in ("line_tokens", "line_frequency", "bigram_counts"):
        ok, message = check.compare(spark, connection, str(tmp_path), name, catalog.text_jobs()[name], sql[name])
        assert ok, message
