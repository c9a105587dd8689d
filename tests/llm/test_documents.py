"""Packing, shards, quality rules, classifier and pipeline against plain versions."""

import heapq
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import classifier, packing, quality_rules, queries, sharding

public_tokenizers = pytest.importorskip("public_tokenizers")


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# Packing --------------------------------------------------------------------------------------------


def best_fit(lengths, size):
    """Remaining capacities after placing pieces one by one in the tightest bin."""
    left = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(left) if room >= length]
        if fits:
            left[min(fits, key=left.__getitem__)] -= length
        else:
            left.append(size - length)
    return sorted(left)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60).flatmap(lambda size: st.tuples(st.just(size), st.lists(st.integers(1, size), max_size=80))))
def test_plan_places_pieces_as_one_by_one(case):
    size, lengths = case
    plan = packing.plan_bins(Counter(lengths).items(), size)
    bins = defaultdict(list)
    for length, n in Counter(lengths).items():
        steps = sorted(p for p in plan if p[0] == length)
        for rank in range(n):
            _, first, each, bin_, offset = [p for p in steps if p[1] <= rank][-1]
            bins[bin_ + (rank - first) // each].append((offset + (rank - first) % each * length, length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
    assert sorted(size - sum(n for _, n in places) for places in bins.values()) == best_fit(lengths, size)


PIECES_OF_TEXT = ["a", "A", "B", "K", "I", "é", "É", "ß", "Σ", "ς", "1", "٣", ".", ",", "'s", "'", "<|endoftext|>", "<|", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "́", "İ", "ﬀ", "中", "😀", "‍", "ǅ", "..", "ª", "²", " ", "\x00", "\x01"]


def test_chunks_are_encoded_as_in_their_text():
    from tokenizers import Tokenizer

    path = queries.vocabulary()
    tokenizer, encoder, rng = Tokenizer.from_file(path), packing.Encoder(path), random.Random(1)
    texts = ["".join(rng.choices(PIECES_OF_TEXT, k=rng.randrange(15))) for _ in range(4000)]
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_markers_count_in_their_own_case_only():
    from tokenizers import Tokenizer

    path = queries.vocabulary()
    tokenizer, encoder, rng = Tokenizer.from_file(path), packing.Encoder(path), random.Random(2)
    markers = [f(m) for m in ("<|endoftext|>", "<|startoftext|>") for f in (str.lower, str.upper, str.title)] + ["<|EndOfText|>", "<|endofTEXT|"]
    pieces = [*markers, "a", "B", "É", ".", ",", "<|", "|>", " ", "\n", "\x01"]
    # Both orders of learning the spellings, and many in one call.
    texts = [*markers, *markers[::-1], *("".join(rng.choices(pieces, k=rng.randrange(8))) for _ in range(2000))]
    got = [encoder.ids([t])[0] for t in texts[:16]] + encoder.ids(texts[16:])
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [64, 4096])
def test_packed_documents(odd, no_docs, size):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    rows = packing.pack_documents(odd, queries.vocabulary(), size).collect()
    want = Counter()
    for doc, text in pairs_of(odd):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        for n, start in enumerate(range(0, len(ids), size)):
            part = ids[start : start + size]
            want[doc, n, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert len(sequences) == len(best_fit([r.length for r in rows], size))
    assert packing.pack_documents(no_docs, queries.vocabulary()).count() == 0


# Shards ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("count", [0, 1, 7, 8, 100, 10_000])
def test_equal_items_go_to_the_least_loaded(count):
    rng = random.Random(count)
    loads = [rng.random() * 500 for _ in range(8)]
    heap = [(load, i) for i, load in enumerate(loads)]
    heapq.heapify(heap)
    for _ in range(count):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + 3.0, i))
    dealt = sharding._deal(list(loads), 3.0, count)
    assert sum(dealt) == count
    assert np.allclose(sorted(load + 3.0 * n for load, n in zip(loads, dealt, strict=True)), sorted(load for load, _ in heap))


def test_size_classes_are_exact_below_4096(spark):
    sizes = [1, 2, 4095, 4096, 4097, 8191, 123456, 2**40 + 12345]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in sizes], "s long").select(sharding.size_class(F.col("s"))).collect()]
    assert got == [s >> max(0, s.bit_length() - 12) << max(0, s.bit_length() - 12) for s in sizes]


def test_shards(odd, no_docs):
    rows = sharding.shard_documents(odd, 4).collect()
    texts = pairs_of(odd)
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    groups, shards = defaultdict(set), defaultdict(list)
    for r in rows:
        groups[r["size"], r.text_crc32].add(r.shard)
        shards[r.shard].append(r)
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in shards.values())
    totals = Counter()
    for r in rows:
        totals[r["size"], r.text_crc32] += r["size"]
    loads = [0] * 4
    for total in sorted(totals.values(), reverse=True):
        loads[loads.index(min(loads))] += total
    # Only sizes of twelve bits and more are rounded in the plan.
    assert max(sum(r["size"] for r in s) for s in shards.values()) <= 1.001 * max(loads)
    assert sharding.shard_documents(no_docs).count() == 0


# Quality rules --------------------------------------------------------------------------------------


def test_base_counts(odd, no_docs):
    got = [tuple(r)[:7] for r in quality_rules.quality_rules(odd, with_text=False).collect()]
    want = []
    for doc, text in pairs_of(odd):
        text = text or ""
        words = plain.spaced(text)
        lines = [line for line in text.split("\n") if plain.spaced(line)]
        repeats = plain.repeated_words(words)
        failed = len(words) < 20 or 100 * repeats > 30 * len(words)
        want.append((doc, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeats, failed))
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert quality_rules.quality_rules(no_docs).count() == 0


def test_line_verdicts(spark):
    clean = " ".join(f"Sentence number {i} says something of its own." for i in range(8))
    cases = {
        clean: (True, clean),
        clean + "\nhome | about | contact | help": (True, clean),
        "Accept all cookies to go on with it.\n" + clean: (True, clean),
        " ".join(f"{w}***" for w in clean.split()): (False, ""),
        " ".join(f"{w} |" for w in clean.split()): (False, ""),
        "short text.": (False, "short text."),
        None: (False, ""),
        "\n\n": (False, "\n\n"),
        clean + "\n" + " ".join(" ".join([w] * 6) for w in ("aa", "bb", "cc", "dd")): (True, clean),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: (r.kept, r.cleaned) for r in quality_rules.quality_rules(df).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


# Classifier -----------------------------------------------------------------------------------------

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")


def held(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def test_accuracy_on_held_out_rows(labelled):
    docs, labels = labelled
    rows = queries.op10_quality_classifier(docs.sparkSession, SMALL).collect()
    assert len(rows) == docs.count() and all(r.held_out == held(r.doc_id) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    tested = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(tested) > 50 and np.mean([a == b for a, b in tested]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= queries.GOOD_SCORE) for r in rows)


def test_labels_of_held_out_rows_change_nothing(labelled):
    docs, labels = labelled
    few = docs.where("doc_id < 300")
    shape = classifier.Shape(epochs=40)
    changed = labels.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))

    def scores(given):
        found = classifier.quality_scores(few, given, shape)
        assert found.columns == [*few.columns, "score", "held_out"]
        return {r.doc_id: round(r.score, 9) for r in found.collect()}

    assert scores(labels) == scores(changed)


def test_odd_documents_are_scored(spark, odd, no_docs):
    labels = spark.createDataFrame(
        [(r.doc_id, i % 2) for i, r in enumerate(odd.collect()[:30])] + [(None, 1), (5, None), (7, 3), (10**6, 0)], "doc_id long, quality int"
    )
    shape = classifier.Shape(epochs=30)
    for given_labels in (labels, labels.where("quality = 1"), labels.limit(0)):
        rows = classifier.quality_scores(odd, given_labels, shape).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if not plain.spaced(r.text)}) == 1
        by_text = defaultdict(set)
        for r in rows:
            by_text[r.text].add(r.score)
        assert all(len(s) == 1 for s in by_text.values())
    assert classifier.quality_scores(no_docs, labels, shape).count() == 0


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    logits = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < classifier.sigmoid(logits)).astype(float)
    assert abs(classifier.fit_temperature(logits * 3, y) - 3) < 0.4


def test_contexts_do_not_depend_on_slices():
    shape = classifier.Shape(table=64, width=8)
    texts = [b"a b c a b", b"", b"x, y; a b", b"one"]
    whole, apart = (np.zeros(64 * 8, dtype=np.int64) for _ in range(2))
    classifier.context_sums(texts, shape, whole)
    for text in texts:
        classifier.context_sums([text], shape, apart)
    assert whole.any() and (whole == apart).all()


def plain_tokens(text):
    """Runs of ASCII letters and digits with what is beyond ASCII, or of other visible characters."""
    def kind(c):
        return 0 if c <= 32 else 1 if c >= 128 or chr(c).isalnum() else 2

    out, last = [], 0
    for c in text:
        c = c + 32 if 65 <= c <= 90 else c
        if kind(c):
            if kind(c) == last:
                out[-1] += bytes([c])
            else:
                out.append(bytes([c]))
        last = kind(c)
    return out


def test_scores_equal_plain_loops():
    """Contexts, pooling and the forward pass, token by token."""
    rng = random.Random(8)
    words = ["the", "The", "of", "é", "x1", "...", "<b>", "a-b", "\n", "\x7f", "中文"]
    texts = ["", "  ", *(" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(18))]
    texts = [t.encode() for t in texts]
    shape = classifier.Shape(table=16, width=8, hidden=5)

    def hash_of(token):
        return classifier.token_hashes([token])[0]

    def index(token):
        vector = [0.0] * shape.width
        for places, signs in classifier.index_vectors(hash_of(token), shape):
            vector[places[0]] += signs[0]
        return vector

    tokens = [plain_tokens(t) for t in texts]
    rows = [[0.0] * shape.width for _ in range(shape.table)]
    for line in tokens:
        for i, token in enumerate(line):
            row = rows[classifier.slots_of(hash_of(token), shape.table)[0]]
            for j in range(max(0, i - shape.reach), min(len(line), i + shape.reach + 1)):
                if j != i:
                    for k, x in enumerate(index(line[j])):
                        row[k] += x
    sums = np.zeros(shape.table * shape.width, dtype=np.int64)
    classifier.context_sums(texts, shape, sums)
    assert sums.reshape(shape.table, shape.width).tolist() == rows
    norms = [max(1.0, sum(x * x for x in row) ** 0.5) for row in rows]
    contexts = np.array([[x / n for x in row] for row, n in zip(rows, norms, strict=True)], dtype=np.float32)
    x = classifier.features(texts, contexts, shape)
    for line, got in zip(tokens, x, strict=True):
        n = len(line)
        want = [0.0] * (2 * shape.width + 3)
        for token in line:
            for k, v in enumerate(index(token)):
                want[k] += v / n / shape.nonzero**0.5
            for k, v in enumerate(contexts[classifier.slots_of(hash_of(token), shape.table)[0]]):
                want[shape.width + k] += float(v) / n
        want[-3] = sum(a == b for a, b in zip(line, line[1:], strict=False)) / max(n, 1)
        want[-2] = len(set(line)) / max(n, 1)
        want[-1] = np.log1p(n) / 10
        assert np.allclose(got, want, atol=1e-6)
    net = classifier.fit_network(x, np.arange(len(x)) % 2, classifier.Shape(width=8, hidden=5, epochs=3))
    net.temperature = 1.7
    for row, score in zip(x, net.scores(x), strict=True):
        hidden = [
            np.tanh(sum((row[i] - net.mean[i]) / net.scale[i] * net.inner[i, h] for i in range(len(row))) + net.inner_bias[h])
            for h in range(5)
        ]
        logit = sum(h * w for h, w in zip(hidden, net.outer, strict=True)) + net.outer_bias
        assert score == pytest.approx(1 / (1 + np.exp(-logit / 1.7)))


# Pipeline -------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def folder(spark, odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    texts = pairs_of(odd)
    odd.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars")).write.parquet(
        f"{path}/documents.parquet"
    )
    items = [(1, " ".join(texts[3][1].split()[2:20]) if texts[3][1] else "x"), (2, max((t or "" for _, t in texts), key=len)[:200])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(d, int(len(plain.spaced(t)) > 3), 0) for d, t in texts if d is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = pairs_of(docs)
        docs = corpus_pipeline.common.stored(stage(spark, docs, folder), "stage-test")
        if name == "best_fit_packing":
            assert {r.doc_id for r in docs.collect()} == {d for d, _ in before}
            continue
        assert docs.columns == columns
        after = pairs_of(docs)
        seen.append((name, len(after)))
        if name == "quality_classifier":
            assert Counter(after) <= Counter(before)
        elif name == "ngram_jaccard":
            assert sorted(d for d, t in after if plain.spaced(t)) == sorted({c for _, n, c in plain.component_ids(before) if n})
        elif name == "substring_dedup":
            texts = {(d, t) for d, t in before}
            want = [(d, k) if n else None for d, _, n, k in plain.kept_words(before)]
            assert all(pair in texts or pair in want for pair in after) and len(after) == len(before)
            assert sorted(map(str, filter(None, want))) == sorted(str(p) for p in after if p not in texts)
        else:
            assert Counter(after) == Counter((d, t) for (d, t), hit in zip(before, plain.hits(before, items), strict=True) if not hit[4])
    assert seen[0][1] > seen[1][1] > 0


def test_run_equals_the_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())
