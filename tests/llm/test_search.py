"""Ranked search against scoring every document."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import search

DOCS = "doc_id long, text string, query string, score string, rank string, ids string, terms string"
ITEMS = "item_id string, text string, query string, doc_id string, rank string"


def terms(text):
    return search.TERM.findall((text or "").translate(search.LOWER))


def plain(docs, items, k=20):
    held = [(doc, Counter(terms(text))) for doc, text in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_words = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, count), n in zip(held, sizes, strict=True):
            score = 0
            for t in terms(text):
                if count[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += weight * ((10**9 * count[t]) // (1000 * count[t] + 12 * (75 + (25 * n * n_docs) // n_words)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda s: s[:3])
        out += [(str(item), rank, str(s[3]), -s[0]) for rank, s in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, docs, items, parts=4, **more):
    d = spark.createDataFrame([(*row, *"abcde") for row in docs], DOCS).repartition(parts)
    i = spark.createDataFrame([(*row, *"abc") for row in items], ITEMS)
    df = search.ranked_search(d, i, **more)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in df.collect())


def some_docs(n, seed):
    rng = random.Random(seed)
    words = ["the", "of", "The", *[f"w{i}" for i in range(40)], *[f"rare{i}" for i in range(300)], "été", "ÉTÉ", "a-b", "x_y", "7"]
    weights = [60, 40, 20, *[4] * 40, *[0.1] * 300, 2, 2, 3, 3, 3]
    docs = [(i - 5, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 30, 200])))) for i in range(n)]
    docs += docs[:10]  # ties: equal texts and ids
    docs += [(i + 10_000, docs[12][1]) for i in range(40)]  # one text under many ids
    docs += [(None, docs[3][1]), (None, None), (None, ""), (70_000, " ,;_ "), (70_001, "the " * 60_000)]
    items = [(f"i{i}", " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 12])))) for i in range(25)]
    items += [items[0], (None, "the rare1"), ("none", None), ("empty", ""), ("unknown", "nowhere"), ("copy", docs[12][1])]
    return docs, items


def test_search_equals_scoring_everything(spark):
    docs, items = some_docs(400, 1)
    assert found(spark, docs, items) == plain(docs, items)


def test_small_blocks_and_few_results(spark, monkeypatch):
    docs, items = some_docs(150, 2)
    monkeypatch.setattr(search, "QUERY_BYTES", 300)  # several passes over the documents
    assert found(spark, docs, items, k=3) == plain(docs, items, 3)


@pytest.mark.parametrize("block", [1, 2_000])
def test_later_blocks_open_fewer_accumulators(block):
    """One task searches many blocks, whose floor it carries on."""
    import pyarrow as pa

    docs, items = some_docs(200, 3)
    docs = [d for d in docs if d[0] is not None]
    wanted = np.unique(search.text_terms([" ".join({t for _, text in items for t in terms(text)}).encode()])[0])
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], names=["doc_id", "text"])
    blocks = [b for at in range(0, len(docs), 1 if block == 1 else 40) for b in search._index(wanted)([batch.slice(at, 1 if block == 1 else 40)])]
    df = np.zeros(len(wanted), dtype=np.int64)
    for b in blocks:
        df[b.column("terms")[0].values.to_numpy()] += b.column("df")[0].values.to_numpy()
    n_docs, n_words = (sum(b.column(c)[0].as_py() for b in blocks) for c in ("docs", "words"))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()])
    queries = []
    for _, text in items:
        at = np.searchsorted(wanted, search.text_terms([(text or "").encode()])[0])
        known, times = np.unique(at, return_counts=True)
        order = np.argsort(df[known], kind="stable")
        queries.append(search.Query(known[order], times[order]))
    rows = [r for out in search._search(queries, weights, n_docs, n_words, 20)(iter(blocks)) for r in out.to_pylist()]
    got = sorted((r["query"], r["doc_id"], r["score"]) for r in rows)
    names = {i: str(item) for i, (item, _) in enumerate(items)}
    want = Counter((item, doc, score) for item, _, doc, score in plain(docs, items))
    assert Counter((names[q], str(doc), score) for q, doc, score in got) == want


@settings(max_examples=200, deadline=None)
@given(
    st.integers(1, 30).flatmap(
        lambda n: st.tuples(
            st.just(n),
            st.lists(st.dictionaries(st.integers(0, n - 1), st.integers(1, 9), min_size=1), min_size=1, max_size=6),
            st.integers(1, 8),
            st.integers(1, 25),
        )
    )
)
def test_documents_without_accumulator_are_not_among_the_best(case):
    n, lists, k, floor = case
    postings = [(np.array(sorted(p)), np.array([p[i] for i in sorted(p)])) for p in lists]
    times = np.arange(1, len(lists) + 1)
    exact = np.zeros(n, dtype=np.int64)
    for (places, parts), t in zip(postings, times, strict=True):
        exact[places] += parts * t
    sums = search.accumulate(postings, times, n, k, floor)
    assert all(s in (0, e) for s, e in zip(sums, exact, strict=True))
    kth = max(floor, sorted(exact)[-k] if k <= n else 0, 1)
    assert [i for i in range(n) if exact[i] >= kth] == [i for i in range(n) if sums[i] >= kth]


def test_accumulators_are_limited():
    rare, common = (np.array([3]), np.array([900])), (np.arange(1000), np.full(1000, 2))
    sums = search.accumulate([rare, common], np.array([1, 1]), 1000, 1, 1)
    assert np.flatnonzero(sums).tolist() == [3]
    assert sums[3] == 902


def test_empty_tables(spark):
    docs, items = some_docs(20, 4)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None), (2, "")], items) == []
