"""Near copies, shared passages, contamination and the language model against plain versions."""

import random
from collections import Counter

import numpy as np
import plain
import pytest

from millrace.llm import blocks, common, decontamination, jaccard, lm, substrings
from millrace.llm import components as steps
from millrace.llm.components import components


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(row):
    return tuple((x is None, str(x)) for x in row)


def same(got, want):
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_components_of_jaccard_links(odd):
    rows = jaccard.jaccard_join(odd).rows
    same([(r.doc_id, r.n_shingles, r.component_id) for r in rows.collect()], plain.component_ids(pairs_of(odd)))


def test_one_row_of_each_component_stays(odd):
    want = {c for _, n, c in plain.component_ids(pairs_of(odd)) if n}
    kept = jaccard.distinct_documents(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    worded = [r.doc_id for r in rows if plain.spaced(r.text)]
    assert sorted(worded) == sorted(want)
    assert sum(not plain.spaced(r.text) for r in rows) == sum(not plain.spaced(t) for _, t in pairs_of(odd))


def test_joins_of_nothing(no_docs, spark):
    assert jaccard.jaccard_join(no_docs).rows.count() == 0
    assert jaccard.distinct_documents(no_docs).count() == 0
    assert substrings.substring_dedup(no_docs).count() == 0
    assert lm.score_documents(no_docs).count() == 0
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(no_docs, nothing).count() == 0


def crowd(rng, people, words):
    """Copies of one text with different words changed: some pairs are similar enough and some are not."""
    base = [f"w{i}" for i in range(words)]
    for _ in range(people):
        copy = list(base)
        for i in rng.sample(range(words), rng.choice([2, 3, 4])):
            copy[i] = f"v{rng.randrange(10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("turns", [1, 3])
def test_large_groups_of_near_copies(spark, monkeypatch, turns):
    """Small limits, so that hot signatures, split crowds, several tiles and the comparison between tiles all occur."""
    monkeypatch.setattr(jaccard, "TURNS", turns)
    monkeypatch.setattr(jaccard, "MANY_TILES", 1)
    monkeypatch.setattr(jaccard, "CROWD_ROWS", 40)
    monkeypatch.setattr(jaccard, "HOT_HOLDERS", 4)
    monkeypatch.setattr(jaccard, "CROWD", 12)
    monkeypatch.setattr(jaccard, "TILE_ROWS", 16)
    monkeypatch.setattr(jaccard, "TILE_COLUMNS", 32)
    rng = random.Random(5)
    texts = [*crowd(rng, 60, 70), *crowd(rng, 25, 40), *(" ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(20))]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_join(df).rows.collect()]
    want = plain.component_ids(rows)
    assert 3 < len({c for _, _, c in want}) < len(rows)
    same(got, want)


def test_a_tile_gives_links_between_known_components_only():
    """One for each component that is joined to another: not one for each document, of which there may be many in many tiles."""
    import pyarrow as pa

    near = list(range(100, 140))
    sets = [[i, *near] for i in range(30)] + [list(range(1000 * i, 1000 * i + 20)) for i in range(1, 4)] + [[4000, *range(3000, 3020)]]
    roots = [7] * 20 + [27] * 9 + [29, 30, 30, 32, 33]
    table = pa.table({"rep": list(range(34)), "root": roots, "shingles": pa.array(sets, pa.list_(pa.int64()))})
    links = {tuple(sorted(r.values())) for r in jaccard._compare_all(table).to_pylist()}
    assert len(links) == jaccard._compare_all(table).num_rows == 3
    assert links == {(7, 27), (7, 29), (32, 33)}


def test_similar_sets_share_more_signatures_than_can_be_spared():
    rng = np.random.default_rng(4)
    bands = jaccard.Bands(jaccard.THRESHOLD)
    for _ in range(300):
        size = int(rng.integers(1, 120))
        x = rng.integers(0, 2**63, size, dtype=np.uint64)
        gone = int(rng.integers(0, size // 4 + 1))
        new = int(rng.integers(0, size // 4 + 1))
        y = np.r_[x[gone:], rng.integers(0, 2**63, new, dtype=np.uint64)]
        x, y = np.unique(x), np.unique(y)
        both = len(np.intersect1d(x, y))
        if 4 * both < 3 * (len(x) + len(y) - both):
            continue
        band = bands.of(max(len(x), len(y)))
        spare = {b: s for b, _, _, s in bands.needed(max(len(x), len(y)))}[band]
        mine, others = dict(jaccard.signatures(x, bands)), dict(jaccard.signatures(y, bands))
        assert len(np.intersect1d(mine[band], others[band])) > spare


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 60), (60, 55), (60, 50)]])
def test_components(spark, edges):
    df = spark.createDataFrame([(b, a) for a, b in edges], "a long, b long")
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert sorted(map(tuple, components(df).collect())) == sorted((x, find(x)) for x in parent)


def test_rounds_of_few_edges_are_planned_once(spark, monkeypatch):
    """Those of many are planned again after each shuffle; both give the same components and leave the session as it was."""
    df = spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")
    key, seen = "spark.sql.adaptive.enabled", []
    stored, before = common.Scratch.stored, spark.conf.get(key)
    monkeypatch.setattr(common.Scratch, "stored", lambda self, *a: (seen.append(spark.conf.get(key)), stored(self, *a))[1])
    found = {}
    for most in (9, 5):
        seen.clear()
        monkeypatch.setattr(steps, "EDGES_A_TASK", most)
        found[most] = sorted(map(tuple, components(df).collect()))
        assert set(seen[1:]) == {"false" if most == 9 else before}
        assert spark.conf.get(key) == before
    assert found[9] == found[5] == [(i, 0) for i in range(10)]


def test_components_with_more_links(spark, monkeypatch):
    roots = components(spark.createDataFrame([(1, 2), (4, 5), (7, 8)], "a long, b long"))
    more = steps.with_links(roots, spark.createDataFrame([(5, 2), (9, 7), (3, 3)], "a long, b long"))
    assert sorted(map(tuple, more.collect())) == [(1, 1), (2, 1), (4, 1), (5, 1), (7, 7), (8, 7), (9, 7)]
    monkeypatch.setattr(steps, "components", None)  # not called without links
    assert steps.with_links(roots, spark.createDataFrame([], "a long, b long")) is roots


def test_components_of_few_edges_take_few_tasks(spark, monkeypatch):
    """However many partitions shuffles have; and the same components where edges fill more tasks than run at once."""
    edges = [(i, i + 1) for i in range(0, 60, 2)] + [(100, i) for i in range(60, 90)] + [(100, 60)] * 3
    df = spark.createDataFrame(edges, "a long, b long")
    want = [(i + k, i) for i in range(0, 60, 2) for k in (0, 1)] + [(i, 60) for i in [*range(60, 90), 100]]
    context, group = spark.sparkContext, "components of few edges"
    settings = {"spark.sql.shuffle.partitions": "80", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        context.setJobGroup(group, group)
        assert sorted(map(tuple, components(df).collect())) == want
        status = context.statusTracker()
        ran = {s: status.getStageInfo(s) for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
        tasks = [info.numTasks for info in ran.values() if info and info.numCompletedTasks]
        assert sum(n >= 80 for n in tasks) <= 1  # of all steps, only the last list of roots is not cut to a few tasks
        monkeypatch.setattr("millrace.llm.components.EDGES_A_TASK", 5)
        assert sorted(map(tuple, components(df).collect())) == want
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)


def test_words_of_earlier_documents_go(odd):
    got = substrings.substring_dedup(odd)
    assert [c for c in got.columns if c not in substrings.ADDED] == [c for c in odd.columns if c not in substrings.ADDED]
    same([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()], plain.kept_words(pairs_of(odd)))


def test_minimiser_runs_cover_every_window(odd):
    values = np.random.default_rng(1).integers(0, 50, 100).astype(np.uint64)
    for width in (1, 2, 3, 10, 100):
        want = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert substrings.run_minima(values, width).tolist() == want
    assert len(substrings.run_minima(values[:3], 4)) == 0


def test_contamination(odd, spark):
    rows = pairs_of(odd)
    long = [t for _, t in rows if len(plain.alnum(t)) > 40]
    items = [
        (1, " ".join(long[0].split()[5:30])), (2, long[1].upper()), (3, "changed"), (4, "one two"), (5, "Not, in! any"),
        (6, None), (7, "..."), (8, " ".join(long[2].split()[:14])), (10, " ".join(long[0].split()[8:21])), (None, long[3]),
        (1, long[4]),
    ]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string")
    got = decontamination.contamination(odd, benchmark)
    want = plain.hits(rows, items)
    assert any(w[4] for w in want) and not all(w[4] for w in want)
    same([(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got.collect()], want)
    nothing = decontamination.contamination(odd, benchmark.limit(0))
    assert not nothing.where("contaminated OR n_hit > 0").count()


def test_contamination_with_columns_of_any_name(spark):
    names = ["span", "item", "fp", "segment", "extra", "_row", "_hit", "row", "doc", "map", "judged", "hit", "key", "e", "n", "a.b", "ahead"]
    passage = " ".join(f"w{i}" for i in range(20))
    texts = [passage, "other words only", None]
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *[f"`{n}` string" for n in names]]))
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = decontamination.contamination(docs, benchmark)
    assert got.columns == [*docs.columns, "n_words", "n_hit", "items", "contaminated"]
    assert sorted((tuple(r)[: len(rows[0])] for r in got.collect()), key=lambda r: r[0]) == rows
    assert {r.doc_id: (r.n_words, r.n_hit, r.contaminated) for r in got.collect()} == {0: (20, 20, True), 1: (3, 0, False), 2: (0, 0, False)}


def test_a_long_text_that_is_hit_all_over(spark):
    import time

    words = [f"w{i % 977}x{i % 31}" for i in range(60)]
    benchmark = spark.createDataFrame([(1, " ".join(words)), (2, "short item")], "item_id long, text string")
    rows = [(1, " ".join(words * 900)), (2, " ".join(["short item"] * 20_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontamination.contamination(docs, benchmark).collect()}
    assert got[2] == (40_000, 40_000, ["2"])
    (want,) = plain.hits(rows[:1], [(1, " ".join(words)), (2, "short item")])
    assert got[1] == (54_000, want[2], ["1"])
    assert time.time() - began < 60


def test_blocks_that_share_nothing(spark):
    rows = [(1, " ".join(f"a{i}" for i in range(40))), (2, " ".join(f"b{i}" for i in range(40))), (3, None), (4, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.substring_dedup(docs).collect()]
    assert sorted(got) == sorted(plain.kept_words(rows))
    assert len(list(blocks.cuts(np.empty(0, np.uint64), 4))) == 0


def test_backoff_scores(odd):
    names = ["n_words", "log_score", "n_unseen", "n_order1", "n_order2", "n_order3"]
    got = [tuple(round(r[n], 6) if n == "log_score" else r[n] for n in names) for r in lm.score_documents(odd).collect()]
    want = plain.backoff(pairs_of(odd))
    assert Counter(g[:1] + g[2:] for g in got) == Counter(w[:1] + w[2:] for w in want)
    assert np.allclose(sorted(g[1] for g in got), sorted(w[1] for w in want), atol=1e-5)


def test_packed_counts_return_as_they_were():
    rng = np.random.default_rng(2)
    for keys in (np.sort(rng.integers(0, 2**63, 5, dtype=np.uint64)), np.array([3, 2**20, 2**47], dtype=np.uint64), np.array([7], dtype=np.uint64)):
        counts = rng.integers(1, 2**31, len(keys))
        again = lm.unpack_counts(lm.pack_counts(keys, counts))
        assert again[0].tolist() == keys.tolist() and again[1].tolist() == counts.tolist()
