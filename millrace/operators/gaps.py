"""Document ids from the gaps between them."""

from __future__ import annotations

from collections.abc import Callable, Iterator


def running_sums() -> Callable[[Iterator], Iterator]:
    """Batches of ``(term, doc_id, tf)`` from batches of ``(term, base, gaps)``; it needs nothing of this package in a task."""

    def sums(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            term, base, lists = batch.columns
            offsets = np.asarray(lists.offsets).astype(np.int64)
            entries = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            gap, tf = entries.flatten()
            lengths = np.diff(offsets)
            row = np.repeat(np.arange(len(lengths)), lengths)
            totals = np.cumsum(np.asarray(gap))
            # What the rows before have added to the running total is taken off again.
            before = np.append(0, totals)[offsets[:-1] - offsets[0]]
            ids = totals + (np.asarray(base) - before)[row]
            # A slice at a time, so that no batch holds the terms of very many entries.
            for k in range(0, len(row), 100_000):
                part = slice(k, k + 100_000)
                columns = [term.take(pa.array(row[part])), pa.array(ids[part], pa.int64()), tf.slice(k, 100_000)]
                yield pa.RecordBatch.from_arrays(columns, names=["term", "doc_id", "tf"])

    return sums
