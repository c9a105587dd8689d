from math import log

import pytest
from pyspark.sql import functions as F

import brute
from millrace.operators import ranking
from millrace.operators.aggregates import log_sum_exp
from millrace.plans import graph
from millrace.session import shared_dir, write_and_read
from millrace.sources.graphs import adjacency_to_graph, parse_adjacency

ADJACENCY = ["1 2 3", " 2\t3 6 ", "3 1 99", "4 1 1 5", "5", "6 ", ""]
NODES = [1, 2, 3, 4, 5, 6]
EDGES = [(1, 2), (1, 3), (2, 3), (2, 6), (3, 1), (3, 99), (4, 1), (4, 1), (4, 5)]


@pytest.fixture
def parts(spark):
    lines = spark.createDataFrame([(line,) for line in ADJACENCY], "line string")
    return adjacency_to_graph(parse_adjacency(lines))


def close(df, want):
    got = dict(tuple(r) for r in df.collect())
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_adjacency_text(parts, rows):
    nodes, edges = parts
    assert [r[0] for r in rows(nodes)] == NODES
    assert rows(edges) == sorted(EDGES)


@pytest.mark.parametrize("sources", [[1], [1, 4], [5, 2, 5]])
@pytest.mark.parametrize("edges_per_split", [1_000_000, 1])
def test_ranks(parts, sources, edges_per_split):
    got = ranking.personalized_ranks(*parts, sources, 3, edges_per_split=edges_per_split)
    close(got, brute.ranks(NODES, EDGES, sources, 3))


def test_all_rank_stays_when_no_target_is_missing(parts):
    nodes, edges = parts
    got = ranking.personalized_ranks(nodes, edges.where("dst <> 99"), [1, 4], 4)
    assert abs(got.agg(F.sum("rank")).first()[0] - 1) < 1e-12


def test_resume_from_a_snapshot(spark, parts, tmp_path):
    base = str(tmp_path / "ranks")
    ranking.personalized_ranks(*parts, [1, 4], 2, base=base)
    resumed = ranking.personalized_ranks(*parts, [1, 4], 4, base=base, start=2)
    close(resumed, brute.ranks(NODES, EDGES, [1, 4], 4))
    close(ranking.read_snapshot(spark, base, 1).select("id", "rank"), brute.ranks(NODES, EDGES, [1, 4], 1))
    assert (tmp_path / "ranks" / "iter0004").is_dir()


def test_a_step_moves_ranks_but_no_edges(spark, parts):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prepared = ranking.prepare(*parts)
        ranks = write_and_read(ranking.initial_ranks(prepared, [1]), f"{shared_dir(spark)}/step-test")
        plan = ranking.step(prepared, ranks, [1])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange each for the senders, the arriving mass, and the sum over dangling nodes.
    assert plan.count("Exchange") == 3, plan
    prepared.release()


def test_statistics(parts, rows):
    assert rows(ranking.graph_statistics(*parts)) == [(6, 9, 4)]
    assert rows(ranking.missing_targets(*parts)) == [(99, 1)]
    # 9 edges, and 2 dangling nodes times 2 sources.
    assert rows(ranking.message_statistics(*parts, [1, 4])) == [(6, 9, 13, 1)]


def test_node_defined_twice(spark, parts):
    nodes, edges = parts
    with pytest.raises(ValueError, match="node 1 is defined 2 times"):
        ranking.prepare(nodes.union(nodes.where("id = 1")), edges)


def test_no_source(parts):
    with pytest.raises(ValueError):
        ranking.personalized_ranks(*parts, [], 1)


def test_top_and_print(spark):
    ranks = spark.createDataFrame([(1, 0.25), (2, 0.5), (3, 0.25), (4, 0.0)], "id bigint, rank double")
    top = ranking.top_nodes(ranks, 3)
    assert [tuple(r) for r in top.collect()] == [(2, 0.5), (1, 0.25), (3, 0.25)]
    assert [tuple(r) for r in ranking.format_ranks(top).collect()][0] == ("0.50000", 2)


def test_small_ranks_keep_their_digits(spark):
    small = [1.23456789012e-13, 1.23456789044e-13, 1.3e-13, 0.0, 7.0]
    ranks = spark.createDataFrame(list(enumerate(small)), "id bigint, rank double")
    top = [tuple(r) for r in ranking.top_nodes(ranks, 4, 9).collect()]
    assert [i for i, _ in top] == [4, 2, 0, 1]
    assert top[1][1] == 1.3e-13 and abs(top[2][1] - 1.23456789e-13) < 1e-27
    logs = dict(tuple(r) for r in ranking.log_ranks(ranks).collect())
    assert logs[3] is None and abs(logs[2] - log(1.3e-13)) < 1e-9


def test_log_sum_exp(spark):
    values = {"a": [-1e5, -1e5 - 1, -1e5 + 2], "b": [1000.0, 1000.0], "c": [float("-inf")], "d": [float("-inf"), 0.0], "e": [511.9, 512.1, -3.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, x double")
    got = dict(tuple(r) for r in log_sum_exp(df, ["k"], "x", "s").collect())
    assert got["c"] == float("-inf") and got["d"] == 0.0
    for k in "abe":
        top = max(values[k])
        from math import exp

        assert abs(got[k] - (top + log(sum(exp(v - top) for v in values[k])))) < 1e-9


def test_log_mass_equals_plain_mass(spark, parts):
    prepared = ranking.prepare(*parts, 1)
    ranks = write_and_read(ranking.initial_ranks(prepared, [1, 4]), f"{shared_dir(spark)}/log-test")
    got = {r.id: r.log_mass for r in ranking.arriving_log_mass(prepared, ranks).collect()}
    assert abs(got[1] - log(0.5 * 2 / 3)) < 1e-12 and abs(got[2] - log(0.25)) < 1e-12
    assert got[6] == float("-inf")
    prepared.release()


def test_ids_of_kinds_do_not_meet(spark, small):
    nodes, _ = graph.order_graph(spark, small)
    assert nodes.count() == nodes.distinct().count()


def test_duplicate_nodes_are_reported(spark, rows):
    nodes = spark.createDataFrame([(1,), (2,), (2,), (3,), (3,), (3,)], "id long")
    assert rows(ranking.duplicate_nodes(nodes)) == [(2, 2), (3, 3)]
    assert rows(ranking.duplicate_nodes(nodes.distinct())) == []


def test_statistics_of_steps(spark):
    # 1 -> 2, 2 -> 3 twice and to 9, which is no node; 3 leads nowhere. Sources are 1 and 4, and 4 leads nowhere.
    nodes = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    edges = spark.createDataFrame([(1, 2), (2, 3), (2, 3), (2, 9)], "src long, dst long")
    got = ranking.step_statistics(nodes, edges, [1, 4], 3, 0.2).collect()
    assert [tuple(r)[:4] for r in got] == [(1, 4, 2, 3), (2, 4, 3, 6), (3, 4, 4, 8)]
    ranks = {1: 0.5, 2: 0.0, 3: 0.0, 4: 0.5}
    for row in got:
        lost = ranks[2] / 3
        assert row.lost_mass == pytest.approx(lost, abs=1e-12)
        dangling = ranks[3] + ranks[4]
        arrived = {1: 0.0, 2: ranks[1], 3: 2 * ranks[2] / 3, 4: 0.0}
        ranks = {k: 0.8 * (arrived[k] + (dangling / 2 if k in (1, 4) else 0)) + (0.1 if k in (1, 4) else 0) for k in ranks}


def test_metrics_cost_no_further_pass(spark):
    nodes = spark.createDataFrame([(1,), (2,)], "id long")
    edges = spark.createDataFrame([(1, 2)], "src long, dst long")
    graph, seen = ranking.prepare(nodes, edges), []
    try:
        ranks = ranking.iterate(graph, [1], 2, metrics={"n": F.count("*")}, observed=seen)
        assert seen == [{"n": 2}] * 3
        plain = ranking.iterate(graph, [1], 2)
        assert sorted(map(tuple, ranks.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        graph.release()
