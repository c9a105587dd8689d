"""Quality classifier: random-indexing word vectors pooled per document, and a small calibrated network.

Every token (a run of letters and digits, or of other characters) has a sparse random index vector, made from its
64-bit hash. The context vector of a token is the sum of the index vectors around it over all documents, kept in a table of fixed
size by the token's hash. A document is the mean of its tokens' index and context vectors, how often a token follows itself,
how many are different, and its length. The network learns from a bounded sample of labelled rows; a part of it is
set aside to fit the temperature that makes its outputs probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batches_of, hash_words, mix, tidy, tidy_group
from millrace.session import shuffle_partitions

SLICE = 1 << 20


@dataclass(frozen=True)
class Shape:
    """Sizes of the word vectors, the network and the training sample."""

    table: int = 1 << 15  # context vectors, by hash of the token
    width: int = 32
    nonzero: int = 4
    reach: int = 2
    hidden: int = 32
    sample: int = 10_000  # labelled rows that the network is fitted on, at most
    held_back: int = 5  # one row in so many of the sample fits the temperature
    epochs: int = 300
    rate: float = 0.01
    decay: float = 1e-4


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and where those of each text begin."""
    kinds = np.ones(256, dtype=np.int8)  # 0 blank, 1 letters and digits, 2 others
    kinds[:128] = [0 if c <= 32 else 1 if chr(c).isalnum() else 2 for c in range(128)]
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    buf = lower[buf]
    kind = kinds[buf]
    cut = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]])
    ends = np.r_[cut[1:], len(kind)]
    real = kind[cut] > 0
    starts, ends = cut[real], ends[real]
    begins = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
    return hash_words(buf, starts, ends), np.searchsorted(starts, begins)


def slots_of(hashes: np.ndarray, table: int) -> np.ndarray:
    """Rows of the table of contexts."""
    return (hashes >> np.uint64(20)).astype(np.int64) % table


def index_vectors(hashes: np.ndarray, shape: Shape) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and signs of the nonzero elements of the tokens' index vectors, one element of each at a time."""
    for k in range(shape.nonzero):
        draw = mix(hashes, 41 + k)
        yield (draw % np.uint64(shape.width)).astype(np.int64), (1 - 2 * ((draw >> np.uint64(40)) & np.uint64(1)).astype(np.int8)).astype(np.float64)


def context_sums(texts: list[bytes], shape: Shape, into: np.ndarray) -> None:
    """Add the index vectors around every token of the texts to the token's row."""
    hashes, offsets = token_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    rows = slots_of(hashes, shape.table) * shape.width
    sums = np.zeros(len(into))
    for places, signs in index_vectors(hashes, shape):
        for step in range(1, shape.reach + 1):
            near = doc[step:] == doc[:-step]
            for token, other in ((slice(None, -step), slice(step, None)), (slice(step, None), slice(None, -step))):
                sums += np.bincount((rows[token] + places[other])[near], signs[other][near], len(into))
    into += sums.astype(np.int64)  # sums of ones: exact


def _contexts(shape: Shape):
    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        sums = np.zeros(shape.table * shape.width, dtype=np.int64)
        for batch in batches_of(rows, 2 * SLICE):
            context_sums([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], shape, sums)
        sums = sums.reshape(shape.table, shape.width)
        used = np.flatnonzero(sums.any(axis=1))
        flat = pa.array(sums[used].ravel(), pa.int64())
        vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * shape.width, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), vectors], names=["slot", "sums"])

    return run


def _add(table):
    """The sum of the vectors of every slot in a part of the table."""
    import pyarrow as pa

    slots = table.column("slot").to_numpy()
    vectors = table.column("sums").combine_chunks().flatten().to_numpy().reshape(len(slots), -1)
    known, which = np.unique(slots, return_inverse=True)
    sums = np.zeros((len(known), vectors.shape[1]), dtype=np.int64)
    np.add.at(sums, which, vectors)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(known) + 1) * sums.shape[1], pa.int32()), pa.array(sums.ravel()))
    return pa.table({"slot": pa.array(known, pa.int64()), "sums": lists})


def context_vectors(docs: DataFrame, shape: Shape) -> np.ndarray:
    """Context vectors of all rows of the table, of length one, from all documents.

    Every task sends its sums, a table of fixed size, and only the final table comes to the driver.
    """
    parts = shuffle_partitions(docs.sparkSession)
    sums = (
        docs.select(docs["text"].cast("string").alias("text"))
        .mapInArrow(tidy(_contexts(shape)), "slot long, sums array<long>")
        .groupBy(F.pmod("slot", F.lit(parts)).alias("part"))
        .applyInArrow(tidy_group(_add), "slot long, sums array<long>")
        .toPandas()
    )
    contexts = np.zeros((shape.table, shape.width))
    if len(sums):
        contexts[sums["slot"].to_numpy()] = np.stack(sums["sums"].to_list())
    length = np.linalg.norm(contexts, axis=1, keepdims=True)
    return (contexts / np.maximum(length, 1)).astype(np.float32)


def features(texts: list[bytes], contexts: np.ndarray, shape: Shape) -> np.ndarray:
    """One row per text: mean index and context vectors, repeats, different tokens, length. An empty text is all zeros."""
    hashes, offsets = token_hashes(texts)
    n = np.diff(offsets)
    width = shape.width
    out = np.zeros((len(texts), 2 * width + 3))
    some = np.flatnonzero(n)
    if not len(some):
        return out
    doc = np.repeat(np.arange(len(texts)), n)
    for places, signs in index_vectors(hashes, shape):
        out[:, :width] += np.bincount(doc * width + places, signs, len(texts) * width).reshape(-1, width)
    out[some, :width] /= n[some, None] * np.sqrt(shape.nonzero)
    # Rows of one text are counted first: a mean over few distinct ones.
    pairs, counts = np.unique(doc * np.int64(len(contexts)) + slots_of(hashes, len(contexts)), return_counts=True)
    weighted = contexts[pairs % len(contexts)] * counts[:, None].astype(np.float32)
    firsts = np.searchsorted(pairs // len(contexts), some)
    out[some, width : 2 * width] = np.add.reduceat(weighted.astype(np.float64), firsts, axis=0) / n[some, None]
    same = np.r_[(hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1]), False]
    out[:, -3] = np.bincount(doc, same, len(texts)) / np.maximum(n, 1)
    _, first = np.unique(mix(hashes + mix(doc.astype(np.uint64), 5)), return_index=True)
    out[some, -2] = np.bincount(doc[first], minlength=len(texts))[some] / n[some]
    out[:, -1] = np.log1p(n) / 10
    return out


@dataclass
class Network:
    """Two layers on standardized features, and the temperature of the output."""

    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    temperature: float = 1.0

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.inner + self.inner_bias)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x) @ self.outer + self.outer_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit_network(x: np.ndarray, y: np.ndarray, shape: Shape) -> Network:
    """Full-batch Adam from a fixed start; labels are 0 or 1."""
    rng = np.random.default_rng(5)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    net = Network(
        mean, scale, rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], shape.hidden)), np.zeros(shape.hidden),
        rng.normal(0, 1 / np.sqrt(shape.hidden), shape.hidden), 0.0,
    )
    z = (x - mean) / scale
    names = ("inner", "inner_bias", "outer", "outer_bias")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    for step in range(1, shape.epochs + 1):
        h = np.tanh(z @ net.inner + net.inner_bias)
        error = (sigmoid(h @ net.outer + net.outer_bias) - y) / len(y)
        back = np.outer(error, net.outer) * (1 - h * h)
        slopes = {
            "inner": z.T @ back + shape.decay * net.inner,
            "inner_bias": back.sum(axis=0),
            "outer": h.T @ error + shape.decay * net.outer,
            "outer_bias": error.sum(),
        }
        for n, slope in slopes.items():
            first[n] = 0.9 * first[n] + 0.1 * slope
            second[n] = 0.999 * second[n] + 0.001 * slope**2
            rate = shape.rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            setattr(net, n, getattr(net, n) - rate * first[n] / (np.sqrt(second[n]) + 1e-8))
    return net


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest."""
    tried = np.exp(np.linspace(-2, 3, 101))
    signed = np.where(y == 1, logits, -logits)
    return float(tried[np.argmin([np.logaddexp(0, -signed / t).mean() for t in tried])])


def train(x: np.ndarray, y: np.ndarray, shape: Shape) -> Network:
    """A network with its temperature. Without labels of both kinds, one whose score is their (smoothed) mean."""
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        width = x.shape[1]
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    back = np.arange(len(y)) % shape.held_back == 0
    if len(set(y[back].tolist())) < 2 or len(set(y[~back].tolist())) < 2:
        return fit_network(x, y, shape)
    net = fit_network(x[~back], y[~back], shape)
    net.temperature = fit_temperature(net.logits(x[back]), y[back])
    return net


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _features(contexts, shape: Shape, columns: int):
    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches_of(rows, SLICE):
            x = features([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], contexts.value, shape)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * columns, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), lists], names=["doc_id", "label", "x"])

    return run


def _scores(contexts, shape: Shape, net: Network):
    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches_of(rows, SLICE):
            x = features([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], contexts.value, shape)
            table = pa.Table.from_batches([batch]).append_column("score", pa.array(net.scores(x), pa.float64()))
            yield from table.combine_chunks().to_batches()

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, shape: Shape | None = None, keep_text: bool = True) -> DataFrame:
    """All columns of ``docs(doc_id, text)`` with ``held_out`` and ``score``, the probability of label 1.

    Word vectors come from all documents. The network is fitted on at most ``shape.sample`` rows of
    ``labels(doc_id, quality)``, those with the smallest hash of their id, whose documents are not held out: the
    remainder of ``crc32`` of the id as text by 5 is 0 for those that are. A null or empty text has a score too, that of
    no words. A null id is not held out and never learned from; labels that are null or without a document are not
    used, nor are others than 0 and 1. Repeated rows get equal scores. Columns named like the added ones are replaced;
    an empty table gives no rows. Without ``keep_text`` the text is left out.
    """
    shape = shape or Shape()
    spark = docs.sparkSession
    contexts = spark.sparkContext.broadcast(context_vectors(docs, shape))  # of fixed size
    wanted = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id", "label")
        .limit(shape.sample)
    )
    labelled = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).join(
        F.broadcast(wanted), F.col("doc_id") == F.col("_id")
    )
    columns = 2 * shape.width + 3
    # Repeated rows of one document would let its label in more often than the sample's bound.
    known = (
        labelled.select("doc_id", "text", "label")
        .mapInArrow(tidy(_features(contexts, shape, columns)), "doc_id long, label double, x array<double>")
        .groupBy("doc_id", "label")
        .agg(F.min("x").alias("x"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .toPandas()
    )
    x = np.stack(known["x"].to_list()) if len(known) else np.zeros((0, columns))
    net = train(x, known["label"].to_numpy(dtype=float), shape)
    rest = [c for c in docs.columns if c not in ("held_out", "score")]
    rows = docs.select(*rest).withColumn("text", docs["text"].cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", score double"
    scored = rows.mapInArrow(tidy(_scores(contexts, shape, net)), schema).withColumn("held_out", held_out(F.col("doc_id")))
    return scored if keep_text else scored.drop("text")
