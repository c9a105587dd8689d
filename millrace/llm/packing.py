"""Best-fit decreasing packing of token sequences.

Only documents longer than a sequence are cut. The packing runs over the counts of piece lengths: pieces of one
length are alike, so where the tightest open bin takes k of them, all bins of that remaining capacity do. A
segment tree over the remaining capacities finds the tightest bin in logarithmic time. The result is that of
placing the pieces one by one, while the table of lengths and the plan are bounded by the sequence length, not by
the input. Spark numbers the pieces of each length and looks their places up in the plan.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batches_of, hash_words, lower_bytes, stored, text_words, tidy, with_rank

END_ID = 1
CACHE_BYTES = 48 << 20
MAX_WORDS = 1 << 20
PER_CALL, CALLS = 256, 32
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class CapacityTree:
    """Open bins by remaining capacity, with the tightest that fits found by one descent."""

    def __init__(self, size: int) -> None:
        self.width = 1 << max(size, 1).bit_length()
        self.open = [0] * (2 * self.width)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.width)]

    def push(self, capacity: int, first: int, count: int) -> None:
        if count <= 0 or capacity <= 0:
            return
        self.runs[capacity].append((first, count))
        self._note(capacity, 1)

    def _note(self, capacity: int, change: int) -> None:
        node = capacity + self.width
        while node:
            self.open[node] += change
            node >>= 1

    def tightest(self, length: int) -> int:
        """The smallest capacity of at least ``length`` with an open bin, or 0."""
        node = length + self.width
        if self.open[node]:
            return length
        while node > 1:
            if not node & 1 and self.open[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.width
            node >>= 1
        return 0

    def pop(self, capacity: int) -> tuple[int, int]:
        self._note(capacity, -1)
        return self.runs[capacity].pop()


def plan_bins(lengths: Iterable[tuple[int, int]], size: int) -> list[tuple[int, int, int, int, int]]:
    """``(length, first, per bin, bin, offset)``: from piece ``first`` of a length on, bins that take so many each.

    ``lengths`` holds ``(length, pieces)``. Pieces are placed by decreasing length.
    """
    tree, bins, plan = CapacityTree(size), 0, []
    for length, left in sorted(lengths, reverse=True):
        at = 0
        while left:
            capacity = tree.tightest(length)
            if capacity:
                first, count = tree.pop(capacity)
            else:
                capacity, first, count = size, bins, -(-left // (size // length))
                bins += count
            each = capacity // length
            full = min(count, left // each)
            rest = min(left - full * each, each) if full < count else 0
            plan.append((length, at, each, first, size - capacity))
            at, left = at + full * each + rest, left - full * each - rest
            tree.push(capacity - each * length, first, full)
            used = full
            if rest:
                tree.push(capacity - rest * length, first + full, 1)
                used += 1
            tree.push(capacity, first + used, count - used)
    return plan


class Chunks:
    """Ids of chunks by hash: sorted hashes, and where the ids of each lie in one buffer. Bounded by bytes."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.hashes, self.begins = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.sizes, self.ids, self.used = np.empty(0, np.int64), np.empty(1 << 16, "<u4"), 0

    @property
    def size(self) -> int:
        return 24 * len(self.hashes) + 4 * self.used

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where hashes are, or would be, and whether they are there."""
        at = np.searchsorted(self.hashes, hashes)
        if not len(self.hashes):
            return at, np.zeros(len(hashes), dtype=bool)
        return at, self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Add sorted hashes that are not there yet."""
        if self.used + len(ids) > len(self.ids):
            grown = np.empty(max(2 * len(self.ids), self.used + len(ids)), "<u4")
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used : self.used + len(ids)] = ids
        at = np.searchsorted(self.hashes, hashes)
        self.begins = np.insert(self.begins, at, self.used + np.cumsum(sizes) - sizes)
        self.sizes, self.hashes = np.insert(self.sizes, at, sizes), np.insert(self.hashes, at, hashes)
        self.used += len(ids)


class Encoder:
    """Token ids of texts, remembered by the blank-separated chunks that the tokenizer never joins.

    A full stop or comma at the end of a chunk, after a letter, is a token of its own, so it is cut off. The case of A-Z does not
    count, but in added tokens, which are looked for in the text as it is: a chunk that would hold one in lower case is
    encoded as it stands. New chunks are encoded many at once, with a control character between them that has an
    id of its own. Chunks are known by 64-bit hashes, and forgotten when they take more than ``CACHE_BYTES``.
    """

    MARK = b"\x01"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark_id,) = self._encode(self.MARK)
        added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(map(re.escape, added)) or rb"(?!)")
        self.known = Chunks()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every text."""
        ids, offsets = self.encoded([t.encode() for t in texts])
        return [ids[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

    def encoded(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: ids of all texts, and where those of each text begin."""
        buf, starts, ends, offsets = text_words(texts)
        starts, ends, offsets = _without_stops(buf, starts, ends, offsets)
        buf = self._folded(buf, starts, ends)
        parts, sizes = [np.empty(0, "<u4")], [np.zeros(1, np.int64)]
        for at in range(0, len(starts), MAX_WORDS):
            part, size = self._chunks(buf, starts[at : at + MAX_WORDS], ends[at : at + MAX_WORDS])
            parts.append(part)
            sizes.append(size)
        return np.concatenate(parts), np.cumsum(np.concatenate(sizes))[offsets]

    def _folded(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A-Z in lower case but in chunks that would then hold an added token."""
        lower = lower_bytes()[buf]
        for found in self.added.finditer(lower.tobytes()):
            # A token that holds a blank is in no chunk; one that is cut off from its stop is in the chunk before.
            at = int(np.searchsorted(starts, found.start(), side="right")) - 1
            if at >= 0:
                lower[starts[at] : ends[at]] = buf[starts[at] : ends[at]]
        return lower

    def _chunks(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive chunks, and how many each has."""
        hashes, first, which = np.unique(hash_words(buf, starts, ends), return_index=True, return_inverse=True)
        if self.known.size > CACHE_BYTES:
            self.known.clear()
        new = np.flatnonzero(~self.known.places(hashes)[1])
        if len(new):
            begin = int(starts[0])
            data = buf[begin : int(ends[-1])].tobytes()
            where = first[new]
            spans = zip((starts[where] - begin).tolist(), (ends[where] - begin).tolist(), strict=True)
            self.known.add(hashes[new], *self._learned([data[a:b] for a, b in spans]))
        at = self.known.places(hashes)[0]
        sizes = self.known.sizes[at][which]
        shift = self.known.begins[at][which] - (np.cumsum(sizes) - sizes)
        return self.known.ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))], sizes

    def _learned(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks end to end, and how many each has."""
        ids, sizes = [], []
        # A chunk with the mark in it is encoded alone.
        marked = [i for i, c in enumerate(chunks) if self.MARK in c] if any(self.MARK in c for c in chunks) else []
        bounds = [-1, *marked, len(chunks)]
        for before, after in pairwise(bounds):
            run = chunks[before + 1 : after]
            parts = [run[at : at + PER_CALL] for at in range(0, len(run), PER_CALL)]
            for at in range(0, len(parts), CALLS):
                texts = [(b" " + self.MARK + b" ").join(part).decode() for part in parts[at : at + CALLS]]
                for encoding in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                    found = np.asarray(encoding.ids, dtype="<u4")
                    marks = found == self.mark_id
                    ids.append(found[~marks])
                    sizes.append(np.diff(np.r_[-1, np.flatnonzero(marks), len(found)]) - 1)
            if after < len(chunks):
                ids.append(np.asarray(self._encode(chunks[after]), dtype="<u4"))
                sizes.append(np.array([len(ids[-1])]))
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode(), add_special_tokens=False).ids


def _without_stops(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray):
    """Words with a final full stop or comma after a letter a-z cut into two."""
    last, before = buf[ends - 1], buf[np.maximum(ends - 2, 0)] | 0x20
    cut = ((last == 0x2E) | (last == 0x2C)) & (before >= 0x61) & (before <= 0x7A) & (ends - starts > 1)
    counts = 1 + cut
    second = (np.cumsum(counts) - 1)[cut]
    starts, ends, stops = np.repeat(starts, counts), np.repeat(ends, counts), ends[cut] - 1
    starts[second], ends[second - 1] = stops, stops
    return starts, ends, np.r_[0, np.cumsum(counts)][offsets]


def _pieces(path: str, size: int):
    def run(rows: Iterator) -> Iterator:
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(path)
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in batches_of(rows):
            out = []
            ids, offsets = encoder.encoded([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()])
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                data = ids[a:b].tobytes() + end
                for n, start in enumerate(range(0, len(data), 4 * size)):
                    piece = data[start : start + 4 * size]
                    out.append((doc, n, start // 4, len(piece) // 4, zlib.crc32(piece)))
            columns = list(zip(*out, strict=True))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 4096) -> DataFrame:
    """Pieces of at most ``size`` ids of every document; each document ends with id 1."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(tidy(_pieces(tokenizer, size)), PIECES)


def _place(plan: list[tuple[int, int, int, int, int]]):
    table = np.asarray(plan, dtype=np.int64).reshape(-1, 5)
    shift = np.int64(1) << np.int64(46)

    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        keys = table[:, 0] * shift + table[:, 1]
        order = np.argsort(keys)
        for batch in rows:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = table[order[np.searchsorted(keys[order], length * shift + rank, side="right") - 1]]
            nth = rank - row[:, 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array(row[:, 3] + nth // row[:, 2]), pa.array(row[:, 4] + nth % row[:, 2] * length)],
                names=[*names, "sequence_id", "offset"],
            )

    return run


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 4096) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` for ``docs(doc_id, text)``.

    A null or empty text is the end id alone. Rows with equal or null ids are documents of their own, and
    repeated rows are all packed. Other columns are not read; an empty table gives no rows. Pieces that are equal
    in every column may swap their places.
    """
    pieces = stored(token_pieces(docs, tokenizer, size), "pieces")
    counts = pieces.groupBy("length").count().collect()  # one row per length: ``size`` at most
    ranked = with_rank(pieces, "length", ["doc_id", "piece", "start", "ids_crc32"], "rank")
    return ranked.mapInArrow(tidy(_place(plan_bins([tuple(r) for r in counts], size))), PIECES + ", sequence_id long, offset long")
