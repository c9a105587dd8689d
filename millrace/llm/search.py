"""Ranked lexical search, term at a time with a limited number of accumulators.

Documents are read once into an index by block: for every term of the queries, the documents of the block that hold it
and how often. Its sums over all blocks are the statistics of the ranking. Then each block is searched by every
query, rarest term first. While an unseen document could still come among the best, a posting opens an accumulator
for its document; once the largest contributions of the remaining terms cannot add up to the kth best partial score, no
more are opened, and the remaining terms only update those that exist, exactly. The kth best score of the blocks that
a task has searched before counts too, so later blocks open fewer, or are skipped as a whole.

A task gives its best of each query, which two rounds of ranking bring together. Queries are taken in blocks of
``QUERY_BYTES`` of text, so what goes to the tasks is bounded. Terms are known by 64-bit hashes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import batches_of, forget_tables, hash_words, lower_bytes, stored, tidy

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TOP = 20
B = 25  # of 100: how much the length of a document counts
QUERY_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20
MERGES = 64
INDEX = (
    "docs long, words long, ids array<long>, lengths array<long>, terms array<int>, df array<int>, places array<int>, tf array<int>"
)
HITS = "query int, doc_id long, score long"


class Query(NamedTuple):
    """Terms of a query by number, rarest first, and how often it holds each."""

    terms: np.ndarray
    times: np.ndarray


def term_bytes() -> np.ndarray:
    """True for the bytes of terms: digits, letters, and all beyond ASCII."""
    table = np.zeros(256, dtype=bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = True
    return table


def text_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, offsets)``: terms of all texts, and where those of each text begin."""
    buf = lower_bytes()[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    inside = np.zeros(len(buf) + 1, dtype=np.int8)
    inside[1:] = term_bytes()[buf]
    change = np.diff(inside)
    starts = np.flatnonzero(change == 1)
    ends = np.flatnonzero(change == -1)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return hash_words(buf, starts, ends), np.searchsorted(starts, begins)


def _index(wanted: np.ndarray):
    """Blocks of documents, restricted to the wanted terms (sorted hashes)."""
    shift = np.uint64(44)

    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        likely = np.zeros(1 << 20, dtype=bool)
        likely[(wanted >> shift).astype(np.int64)] = True
        schema = pa.schema(
            [("docs", pa.int64()), ("words", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))]
            + [(name, pa.list_(pa.int32())) for name in ("terms", "df", "places", "tf")]
        )
        for batch in batches_of(rows, BLOCK_BYTES):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            hashes, offsets = text_terms([t or b"" for t in texts])
            lengths = np.diff(offsets)
            near = np.flatnonzero(likely[(hashes >> shift).astype(np.int64)])
            found = hashes[near]
            term = np.searchsorted(wanted, found)
            same = wanted[np.minimum(term, len(wanted) - 1)] == found if len(wanted) else np.zeros(0, dtype=bool)
            near, term = near[same], term[same]
            doc = np.searchsorted(offsets, near, side="right") - 1
            held = np.unique(doc)
            keys, tf = np.unique(term * np.int64(len(held) or 1) + np.searchsorted(held, doc), return_counts=True)
            terms, df = np.unique(keys // np.int64(len(held) or 1), return_counts=True)
            row = {
                "docs": int(np.count_nonzero(lengths)),
                "words": int(lengths.sum()),
                "ids": batch.column("doc_id").take(pa.array(held)),
                "lengths": lengths[held],
                "terms": terms,
                "df": df,
                "places": keys % np.int64(len(held) or 1),
                "tf": tf,
            }
            yield pa.RecordBatch.from_arrays(
                [_column(row[field.name], field.type) for field in schema], schema=schema
            )

    return run


def _column(value, kind):
    """One row of that value, without making Python objects of its numbers."""
    import pyarrow as pa

    if not pa.types.is_list(kind):
        return pa.array([value], kind)
    values = value if isinstance(value, pa.Array) else pa.array(value, kind.value_type)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class Best:
    """The best documents of a query so far."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = self.ids = np.empty(0, dtype=np.int64)
        self.nulls = np.empty(0, dtype=bool)

    @property
    def floor(self) -> int:
        """A score below this is not among the best."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = np.r_[self.scores, scores], np.r_[self.ids, ids], np.r_[self.nulls, nulls]
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]


def accumulate(postings: list[tuple[np.ndarray, np.ndarray]], times: np.ndarray, n_docs: int, k: int, floor: int) -> np.ndarray:
    """Scores of the documents with an accumulator; 0 for others, none of which has a place among the best.

    ``postings`` holds ``(places, contributions)`` of each term in the order they are taken in. A document without an
    accumulator scores less than ``floor``, a score that is known to be needed, or less than the kth of this block.
    """
    sums = np.zeros(n_docs, dtype=np.int64)
    most = np.array([int(c.max()) for _, c in postings], dtype=np.int64) * times
    left = np.cumsum(most[::-1])[::-1]
    opening = True
    for nth, (places, parts) in enumerate(postings):
        if opening:
            kth = np.partition(sums, n_docs - k)[n_docs - k] if n_docs > k else 0
            # A document that ends level with the kth may still win by its id.
            opening = left[nth] >= max(kth, floor)
        if not (opening or nth):
            break
        if opening:
            sums[places] += parts * times[nth]
        else:
            known = sums[places] > 0
            sums[places[known]] += parts[known] * times[nth]
    return sums


def _search(queries: list[Query], weights: np.ndarray, n_docs: int, n_words: int, k: int):
    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        best = [Best(k) for _ in queries]
        for batch in rows:
            for at in range(batch.num_rows):
                ids, lengths, terms, df, places, tf = (
                    batch.column(c).slice(at, 1).flatten() for c in ("ids", "lengths", "terms", "df", "places", "tf")
                )
                nulls = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                if not len(terms):
                    continue
                terms, df, places, tf = terms.to_numpy(), df.to_numpy(), places.to_numpy(), tf.to_numpy().astype(np.int64)
                m = 100 - B + (B * lengths.to_numpy() * n_docs) // n_words
                parts = np.repeat(weights[terms], df) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[places]))
                ends = np.cumsum(df)
                block = [(places[e - n : e], parts[e - n : e]) for e, n in zip(ends.tolist(), df.tolist(), strict=True)]
                where = np.full(len(weights), -1, dtype=np.int64)
                where[terms] = np.arange(len(terms))
                for query, top in zip(queries, best, strict=True):
                    mine = where[query.terms]
                    here = mine >= 0
                    if not here.any():
                        continue
                    sums = accumulate([block[i] for i in mine[here].tolist()], query.times[here], len(ids), k, top.floor)
                    hit = np.flatnonzero(sums >= top.floor)
                    if len(hit) > k:
                        hit = hit[sums[hit] >= np.partition(sums[hit], len(hit) - k)[len(hit) - k]]
                    if len(hit):
                        top.add(sums[hit], ids[hit], nulls[hit])
        found = [i for i, top in enumerate(best) if len(top.scores)]
        if found:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(found, [len(best[i].scores) for i in found]), pa.int32()),
                    pa.array(np.concatenate([best[i].ids for i in found]), pa.int64(), mask=np.concatenate([best[i].nulls for i in found])),
                    pa.array(np.concatenate([best[i].scores for i in found]), pa.int64()),
                ],
                names=["query", "doc_id", "score"],
            )

    return run


def _blocks(items: Iterator[Row]) -> Iterator[list[Row]]:
    """Items in blocks of about ``QUERY_BYTES``, one item at least."""
    block, size = [], 0
    for item in items:
        if block and size + len(item["text"] or "") > QUERY_BYTES:
            yield block
            block, size = [], 0
        block.append(item)
        size += len(item["text"] or "") + 100
    if block:
        yield block


def _ranked(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _search_block(rows: DataFrame, block: list[Row], k: int) -> DataFrame:
    """``(query, doc_id, score, rank)`` for the queries of one block, numbered from 0."""
    counts = [Counter(TERM.findall((item["text"] or "").translate(LOWER))) for item in block]
    words = sorted(set().union(*counts))
    hashes = text_terms([w.encode("utf-8", "surrogatepass") for w in words])[0]
    forget_tables()
    wanted = np.unique(hashes)
    number = dict(zip(words, np.searchsorted(wanted, hashes).tolist(), strict=True))
    index = stored(rows.mapInArrow(tidy(_index(wanted)), INDEX), "postings")
    sums = index.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    n_docs, n_words = sums["docs"] or 0, max(sums["words"] or 0, 1)
    df = np.zeros(len(wanted), dtype=np.int64)
    pairs = index.select(F.explode(F.arrays_zip("terms", "df")).alias("p")).groupBy("p.terms").agg(F.sum("p.df").alias("df"))
    for term, n in pairs.collect():  # one row per term of these queries at most
        df[term] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)
    queries = []
    for count in counts:
        terms = np.array([number[w] for w in count], dtype=np.int64)
        times = np.array(list(count.values()), dtype=np.int64)
        order = np.argsort(df[terms], kind="stable")
        queries.append(Query(terms[order], times[order]))
    hits = index.mapInArrow(tidy(_search(queries, weights, n_docs, n_words, k)), HITS)
    dealt = hits.withColumn("_merge", F.pmod(F.spark_partition_id(), F.lit(MERGES)))
    return _ranked(_ranked(dealt, ["query", "_merge"], k).drop("rank"), ["query"], k).drop("_merge")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of highest score above 0 for each row of ``items``.

    Takes ``docs(doc_id, text)`` and ``items(item_id, text)``; other columns are not read. Equal scores are in order of
    their ids, null last; documents that are equal in both take their ranks in any order. Every row counts, as a document or as a query, so
    repeated rows are ranked side by side. Texts that are null, empty or without terms are not found, are no part of the
    statistics, and as queries find nothing; so do queries whose terms no document holds, and all where either table is empty.
    """
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    named = items.select("item_id", items["text"].cast("string").alias("text"))
    out = spark.createDataFrame([], named.select("item_id").schema).select(
        "item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")
    )
    schema = f"query int, item_id {named.schema['item_id'].dataType.simpleString()}"
    for block in _blocks(named.toLocalIterator()):
        names = spark.createDataFrame([(i, item["item_id"]) for i, item in enumerate(block)], schema)
        found = _search_block(rows, block, k).join(F.broadcast(names), "query")  # one row per query of the block
        out = out.unionByName(found.select("item_id", "rank", "doc_id", "score"))
    return out
