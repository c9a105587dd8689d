"""Removal of word windows that an earlier document has too, by super-k-mer partitioning.

Each window of 13 words has a minimiser, the 4-word gram of smallest hash in it. Equal windows have equal minimisers,
so only minimisers that two documents share can belong to windows that two documents share: these are found first,
and everything else stays where it is. Consecutive windows with the same minimiser then travel as one string, their
words joined by blanks, to the bucket of the minimiser. There the windows are cut out of the strings and brought
together by their words, not by a hash, and the least document id of each goes back to the blocks that asked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.llm import blocks as B
from millrace.llm.common import grams, hash_words, mix, stored, text_words, tidy, tidy_group

WINDOW = 13
GRAM = 4
LAST_ID = np.int64(2**63 - 1)
ROWS = "bucket int, block long, blob binary"


class Opened:
    """A block with the minimiser runs of its documents.

    A run is a sequence of consecutive windows of one document with the same minimiser; ``first`` and ``count`` are
    its first window (by the number of its first word in the block) and how many there are, ``doc`` its document.
    """

    def __init__(self, blob, window: int, gram: int) -> None:
        import pyarrow as pa

        self.table = pa.ipc.open_stream(blob).read_all()
        self.texts = [t or b"" for t in self.table.column("text").cast(pa.binary()).to_pylist()]
        ids = self.table.column("doc_id").to_pylist()
        self.ids = np.array([LAST_ID if i is None else i for i in ids], dtype=np.int64)
        self.buf, self.starts, self.ends, self.offsets = text_words(self.texts)
        words = hash_words(self.buf, self.starts, self.ends)
        lowest = run_minima(grams(words, gram), window - gram + 1)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(self.offsets))[: len(lowest)]
        whole = np.arange(len(lowest)) + window <= self.offsets[1:][doc]
        begins = whole & np.r_[True, (lowest[1:] != lowest[:-1]) | (doc[1:] != doc[:-1]) | ~whole[:-1]][: len(whole)]
        # A run ends where another begins or where windows cease to be whole.
        edges = np.flatnonzero(begins | ~whole)
        ends = np.r_[edges[1:], len(whole)]
        real = whole[edges]
        self.first, self.count = edges[real], (ends - edges)[real]
        self.key, self.doc = mix(lowest[self.first], 29), doc[self.first]

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct minimisers in order, and whether several documents of the block have them."""
        order = np.lexsort((self.doc, self.key))
        key, doc = self.key[order], self.doc[order]
        if not len(key):
            return key, np.empty(0, dtype=bool)
        firsts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        lasts = np.r_[firsts[1:], len(key)] - 1
        return key[firsts], doc[firsts] != doc[lasts]

    def runs(self, shared: np.ndarray, window: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Distinct strings of the runs with these minimisers, by bucket order of the minimiser; their hashes, the
        least document id of each, and the string of every such run (-1 for other runs)."""
        picked = np.flatnonzero(np.isin(self.key, shared))
        picked = picked[np.argsort(self.key[picked], kind="stable")]
        number = np.full(len(self.key), -1, dtype=np.int64)
        strings: dict[bytes, int] = {}
        least, keys = [], []
        raw, starts, ends = self.buf.tobytes(), self.starts, self.ends
        spaced = self._single_blanks()
        for i in picked.tolist():
            a, z = int(self.first[i]), int(self.first[i] + self.count[i]) + window - 2
            text = raw[starts[a] : ends[z]]
            if not spaced[z] - spaced[a] == z - a:
                text = b" ".join(text.split())
            at = strings.setdefault(text, len(strings))
            number[i] = at
            owner = self.ids[self.doc[i]]
            if at == len(least):
                least.append(owner)
                keys.append(self.key[i])
            elif owner < least[at]:
                least[at] = owner
        return list(strings), np.array(keys, dtype=np.uint64), np.array(least, dtype=np.int64), number

    def _single_blanks(self) -> np.ndarray:
        """How many words before each are followed by just one blank."""
        single = (self.starts[1:] - self.ends[:-1] == 1) & (self.buf[self.ends[:-1]] == 32)
        return np.r_[0, np.cumsum(single)]


def _rows(out: list[tuple]):
    import pyarrow as pa

    columns = list(zip(*out, strict=True)) if out else [[], [], []]
    types = (pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["bucket", "block", "blob"])


def _ask_keys(buckets: int, window: int, gram: int):
    def run(rows: Iterator) -> Iterator:
        for batch in rows:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("docs"), strict=True):
                keys, several = Opened(blob.as_buffer(), window, gram).keys()
                yield _rows(
                    [
                        (bucket, block, keys[x:y].tobytes() + np.packbits(several[x:y]).tobytes())
                        for bucket, x, y in B.cuts(keys, buckets)
                    ]
                )

    return run


def _count_keys(table):
    """Which minimisers more than one document has, for each block in the order asked."""
    import pyarrow as pa

    asked = [_keys_of(blob) for blob in table.column("blob").to_pylist()]
    keys = np.concatenate([k for k, _ in asked])
    weights = np.concatenate([1 + s for _, s in asked])
    known, which = np.unique(keys, return_inverse=True)
    several = np.bincount(which, weights, len(known)) > 1
    answers, at = [], 0
    for k, _ in asked:
        answers.append(np.packbits(several[which[at : at + len(k)]]).tobytes())
        at += len(k)
    return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "blob": pa.array(answers, pa.binary())})


def _keys_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys and one flag each: 64 and 1 bits, so the blob's length gives their number."""
    n = len(blob) * 8 // 65
    return np.frombuffer(blob, dtype=np.uint64, count=n), np.unpackbits(np.frombuffer(blob, np.uint8, offset=8 * n))[:n]


def _shared_keys(opened: Opened, answers: list, buckets: int) -> np.ndarray:
    """The minimisers of a block that were answered to be shared."""
    keys, _ = opened.keys()
    by_bucket = {a["bucket"]: a["blob"] for a in answers or ()}
    flags = np.zeros(len(keys), dtype=bool)
    for bucket, x, y in B.cuts(keys, buckets):
        flags[x:y] = np.unpackbits(np.frombuffer(by_bucket[bucket], np.uint8))[: y - x].astype(bool)
    return keys[flags]


def _ask_runs(buckets: int, window: int, gram: int):
    def run(rows: Iterator) -> Iterator:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in rows:
            for row in range(batch.num_rows):
                block = batch.column("block")[row].as_py()
                opened = Opened(batch.column("docs")[row].as_buffer(), window, gram)
                shared = _shared_keys(opened, batch.column("keys")[row].as_py(), buckets)
                strings, keys, least, _ = opened.runs(shared, window)
                yield _rows(
                    [
                        (bucket, block, squeeze.compress(_pack_strings(strings[x:y], least[x:y])))
                        for bucket, x, y in B.cuts(keys, buckets)
                    ]
                )

    return run


def _pack_strings(strings: list[bytes], ids: np.ndarray) -> bytes:
    """How many, their ids, and the strings, which have blanks but no line ends."""
    return np.int64(len(strings)).tobytes() + ids.tobytes() + b"\n".join(strings)


def _unpack_strings(data: bytes) -> tuple[list[int], list[bytes]]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    return np.frombuffer(data, np.int64, n, 8).tolist(), data[8 + 8 * n :].split(b"\n")


def _least_ids(window: int):
    def run(table):
        """The least document id of every window of every string, for each block in the order asked."""
        import pyarrow as pa
        import zstandard

        expand, squeeze = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        least: dict[bytes, int] = {}
        asked = []
        for blob in table.column("blob").to_pylist():
            ids, strings = _unpack_strings(expand.decompress(blob))
            mine = []
            for owner, string in zip(ids, strings, strict=True):
                for piece in windows_of(string, window):
                    mine.append(piece)
                    if least.get(piece, LAST_ID) >= owner:
                        least[piece] = owner
            asked.append(mine)
        answers = [
            squeeze.compress(np.array([least[piece] for piece in mine], dtype=np.int64).tobytes()) for mine in asked
        ]
        return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "blob": pa.array(answers, pa.binary())})

    return run


def windows_of(string: bytes, window: int) -> list[bytes]:
    """All windows of a string of words joined by one blank."""
    blanks = np.flatnonzero(np.frombuffer(string, np.uint8) == 32)
    starts = [0, *(blanks[: len(blanks) - window + 1] + 1).tolist()]
    ends = [*blanks[window - 1 :].tolist(), len(string)]
    return [string[a:b] for a, b in zip(starts, ends, strict=True)]


def run_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    size = len(values) - width + 1
    if size <= 0:
        return values[:0]
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:size], values[width - done : width - done + size])


def _cover(opened: Opened, keys: list, answers: list, buckets: int, window: int) -> np.ndarray:
    """Which words of a block are to go."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    shared = _shared_keys(opened, keys, buckets)
    strings, string_keys, _, number = opened.runs(shared, window)
    by_bucket = {a["bucket"]: a["blob"] for a in answers or ()}
    parts = [np.frombuffer(expand.decompress(by_bucket[b]), np.int64) for b, _, _ in B.cuts(string_keys, buckets)]
    least = np.concatenate(parts) if parts else np.empty(0, np.int64)
    sizes = np.array([s.count(b" ") + 2 - window for s in strings], dtype=np.int64)
    begins = np.r_[0, np.cumsum(sizes)]
    runs = np.flatnonzero(number >= 0)
    count = opened.count[runs]
    step = np.arange(int(count.sum())) - np.repeat(np.r_[0, np.cumsum(count)[:-1]], count) if len(runs) else np.empty(0, np.int64)
    hit = least[np.repeat(begins[number[runs]], count) + step] < np.repeat(opened.ids[opened.doc[runs]], count)
    at = (np.repeat(opened.first[runs], count) + step)[hit]
    edge = np.zeros(len(opened.starts) + window + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return np.cumsum(edge)[: len(opened.starts)] > 0


def _finish(buckets: int, window: int, gram: int):
    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in rows:
            for row in range(batch.num_rows):
                opened = Opened(batch.column("docs")[row].as_buffer(), window, gram)
                gone = _cover(opened, batch.column("keys")[row].as_py(), batch.column("answers")[row].as_py(), buckets, window)
                removed = np.add.reduceat(np.r_[gone, False].astype(np.int64), opened.offsets[:-1])
                n_words = np.diff(opened.offsets)
                removed = np.where(n_words > 0, removed, 0)
                kept = []
                for text, a, b, n in zip(opened.texts, opened.offsets, opened.offsets[1:], removed, strict=False):
                    words = text.split()
                    if n:
                        words = [w for w, out in zip(words, gone[a:b].tolist(), strict=True) if not out]
                    kept.append(b" ".join(words).decode())
                table = opened.table
                for name, column in (("n_words", n_words), ("n_removed", removed), ("kept", kept)):
                    table = table.append_column(name, pa.array(column, pa.string() if name == "kept" else pa.int64()))
                yield from table.combine_chunks().to_batches()

    return run


ADDED = ("n_words", "n_removed", "kept")


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """All columns of ``docs(doc_id, text)`` with ``n_words``, ``n_removed`` and ``kept``.

    A word goes if it lies in a window of 13 words that also begins in a document of smaller id; windows are judged
    on the texts as they come in. ``kept`` has the words that stay, joined by one blank. Texts of fewer words, empty
    and null ones lose nothing; of a null or blank text ``kept`` is empty. Rows of the same id are one document as far
    as others are concerned and take nothing from each other; a null id counts as larger than all others, and rows
    without id take nothing from each other. Columns named like the added ones are replaced. An empty table gives no
    rows.
    """
    rows = docs.drop(*ADDED).withColumns({"doc_id": docs["doc_id"].cast("long"), "text": docs["text"].cast("string")})
    blocks = B.write_blocks(rows, "substring-blocks").table
    buckets = B.bucket_count(blocks)
    keys = blocks.mapInArrow(tidy(_ask_keys(buckets, window, gram)), ROWS).groupBy("bucket").applyInArrow(tidy_group(_count_keys), ROWS)
    keys = stored(B.gathered(keys).withColumnRenamed("answers", "keys"), "substring-keys")
    known = blocks.join(keys, "block", "left")
    runs = known.mapInArrow(tidy(_ask_runs(buckets, window, gram)), ROWS).groupBy("bucket").applyInArrow(tidy_group(_least_ids(window)), ROWS)
    runs = stored(B.gathered(runs), "substring-runs")
    schema = StructType([*rows.schema.fields, *[StructField(n, StringType() if n == "kept" else LongType()) for n in ADDED]])
    return known.join(runs, "block", "left").mapInArrow(tidy(_finish(buckets, window, gram)), schema)
