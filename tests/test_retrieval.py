import pytest
from pyspark.sql import functions as F

import brute
from millrace.operators import boolean, index
from millrace.plans import retrieval
from millrace.sinks.files import read_terms, write_index

DOCS = {
    0: "a b c a",
    3: "b c " + "long " * 30,
    4: "a c",
    9: "d",
    100: "a b c d",
    101: "A  e's \n a",
    1000: "a",
}


@pytest.fixture
def documents(spark):
    return spark.createDataFrame(list(DOCS.items()), "doc_id bigint, text string")


@pytest.fixture
def postings(documents):
    return index.term_frequency(documents)


def expected():
    out = set()
    for doc_id, text in DOCS.items():
        words = brute.tokens(text)
        out |= {(w, doc_id, words.count(w)) for w in words}
    return sorted(out)


def test_postings(postings, rows):
    assert rows(postings) == expected()


@pytest.mark.parametrize("width", [1000, 3, 1])
def test_lists_hold_all_postings_in_order(postings, rows, width):
    lists = index.posting_lists(postings, width).collect()
    flat = []
    for term in {r.term for r in lists}:
        parts = sorted((r for r in lists if r.term == term), key=lambda r: r.segment)
        ids = [p.doc_id for part in parts for p in part.postings]
        assert ids == sorted(ids)
        assert all(part.df == len(ids) for part in parts)
        assert all(len(part.postings) <= max(width, 1) for part in parts)
        assert len(parts) == 1 or len(ids) > width
        flat += [(term, p.doc_id, p.tf) for part in parts for p in part.postings]
    assert sorted(flat) == expected()


@pytest.mark.parametrize("width", [1000, 3, 1])
def test_gaps(postings, rows, width):
    lists = index.posting_lists(postings, width)
    encoded = index.gap_encode(lists)
    for term in ("a", "c", "long"):
        parts = sorted((r for r in encoded.where(F.col("term") == term).collect()), key=lambda r: r.segment)
        gaps = [g.gap for part in parts for g in part.gaps]
        ids = [d for t, d, _ in expected() if t == term]
        assert gaps == [b - a for a, b in zip([0] + ids, ids)]
    assert rows(index.gap_decode(encoded)) == expected()
    assert rows(index.flatten(lists)) == expected()


def test_index_on_disk(spark, postings, tmp_path, rows):
    path = str(tmp_path / "index")
    write_index(index.posting_lists(postings, 3), path, 3)
    stored = spark.read.parquet(path)
    found = read_terms(stored, ["c", "nowhere"])
    assert "PushedFilters: [In(term" in found._jdf.queryExecution().executedPlan().toString()
    assert [r[1] for r in rows(index.flatten(found))] == [0, 3, 4, 100]


QUERIES = ["a", "a b AND", "a d OR", "a b AND d OR", "a b c OR AND", "nowhere", "nowhere d OR", "A", "d e's OR a AND", "  a   d AND "]


def test_queries(spark, documents, postings, rows):
    got = rows(boolean.retrieve(retrieval.query_table(spark, QUERIES), postings))
    want = [(q, d) for q, query in enumerate(QUERIES) for d, text in DOCS.items() if brute.postfix(query, brute.tokens(text))]
    assert got == sorted(want)


@pytest.mark.parametrize("query", ["a b", "AND", "a AND", "a b AND OR", "a b AND c", ""])
def test_malformed_queries_fail(spark, postings, query):
    with pytest.raises(Exception, match="malformed postfix query"):
        boolean.retrieve(retrieval.query_table(spark, [query]), postings).collect()


def test_snippets(spark, documents, postings):
    found = boolean.retrieve(retrieval.query_table(spark, ["long", "d"]), postings)
    lines = {(r.qid, r.doc_id): r.line for r in boolean.with_snippets(found, documents).collect()}
    assert lines[0, 3] == DOCS[3][:80] + "..."
    assert lines[1, 9] == "d"


def test_large_tables_are_joined_not_broadcast(postings, rows, monkeypatch):
    monkeypatch.setattr(index, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(index, "BROADCAST_DOCUMENTS", 0)
    lists = index.posting_lists(postings, 2)
    assert rows(index.flatten(lists)) == expected()
    assert rows(index.gap_decode(index.gap_encode(lists))) == expected()


def test_postings_are_gathered_once_and_ids_summed_in_place(postings, rows):
    lists = index.posting_lists(postings, 3)
    assert lists._jdf.queryExecution().optimizedPlan().toString().count("collect_list") == 1
    decoded = index.gap_decode(index.gap_encode(lists))
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    # The only window is that over the segments of long terms, and no posting is a row before the sums.
    assert plan.count("Window") == 1 and "Generate" not in plan and "collect_list" not in plan
    assert rows(decoded.select("doc_id").distinct()) == sorted({(d,) for _, d, _ in expected()})


@pytest.mark.parametrize("whole, few", [(2, index.BROADCAST_TERMS), (2, 0), (1, 0)])
def test_long_terms_are_coded_in_spans(postings, rows, monkeypatch, whole, few):
    """A term's segments are in several tasks, and each span goes on from the one before."""
    monkeypatch.setattr(index, "WHOLE_TERM", whole)
    monkeypatch.setattr(index, "SPAN_SEGMENTS", 2)
    monkeypatch.setattr(index, "BROADCAST_TERMS", few)
    lists = index.posting_lists(postings, 1)
    assert max(r[0] for r in lists.select(F.floor(F.col("segment") / 2)).collect()) > 1
    encoded = index.gap_encode(lists)
    parts = sorted((r for r in encoded.collect() if r.term == "a"), key=lambda r: r.segment)
    ids = [d for t, d, _ in expected() if t == "a"]
    assert [g.gap for part in parts for g in part.gaps] == [b - a for a, b in zip([0] + ids, ids)]
    assert rows(index.gap_decode(encoded)) == expected()


def test_lists_from_elsewhere_are_coded_alike(spark, postings, tmp_path, rows):
    index.posting_lists(postings, 2).repartition(3, "segment").write.parquet(f"{tmp_path}/lists")
    lists = spark.read.parquet(f"{tmp_path}/lists")
    for placed in (True, False):
        assert rows(index.gap_decode(index.gap_encode(lists, placed), placed)) == expected()


def test_lists_are_not_moved_to_be_coded(postings):
    encoded = index.gap_encode(index.posting_lists(postings, 1))
    decoded = index.gap_decode(encoded)
    for df in (encoded, decoded):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and plan.replace("BroadcastExchange", "").count("Exchange") == 0
