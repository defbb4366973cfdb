"""Best-fit packing of tokenised documents (operator 3).

Method: bulk-synchronous best fit, longest first. Documents are tokenised where
they are read; only (doc_id, piece, start, length, crc) rows go on. They are
range-sorted by length and numbered within it. A length is at most ``CAPACITY``
tokens, so the sorted documents and the sorted gaps are held as runs (length or
gap, count): the table of lengths has at most CAPACITY rows whatever the
corpus. Each round takes the longest remaining length and sweeps the gaps
upwards from it: the smallest gap that fits (its successor) takes as many
documents as there are such gaps, conflicts being settled by rank, the gaps
shrink, and the sweep repeats; what no gap holds opens new sequences. A round's
result is a few runs "ranks r.. of length l go to sequences s.. at offset o".
Every row then finds its run by (length, rank). Nothing grows with the corpus
on the driver but the counters.

Defined cases: null or empty text is the end token alone. Repeated rows are
packed each. A null doc_id is kept. Only documents longer than CAPACITY are
cut; then the first piece takes what is left over and the others are full.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import sequence_number
from ..session import materialize
from . import _bytes as B
from ._ship import ready
from ._tokens import default_path, vocabulary

CAPACITY = 2048
END = 0

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def piece_bounds(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            _, off = B.buffers(batch.column(1))
            for a, b in B.slices(off):
                rows = []
                part = batch.slice(a, b - a)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = np.append(vocab.encode(text.as_py() or ""), END).astype("<u4")
                    for k, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                        rows.append((doc_id, k, start, length, zlib.crc32(ids[start:start + length].tobytes())))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def fit_runs(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Best fit over runs. counts: documents of each length. Returns rows
    (length, first rank, count, first sequence, offset) and the sequences used."""
    gaps: list[int] = []  # gap sizes that have runs, ascending
    runs: dict[int, deque[tuple[int, int]]] = {}  # gap -> (first sequence, sequences)
    out: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def add(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in runs:
                runs[gap] = deque()
                insort(gaps, gap)
            runs[gap].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (i := bisect_left(gaps, length)) < len(gaps):
            gap = gaps[i]
            first, count = runs[gap].popleft()
            take = min(count, left)
            if take < count:
                runs[gap].appendleft((first + take, count - take))
            elif not runs[gap]:
                del runs[gap], gaps[i]
            out.append((length, rank, take, first, capacity - gap))
            add(gap - length, first, take)
            rank, left = rank + take, left - take
        each = capacity // length
        for count, per in ((left // each, each), (1, left % each)):
            if count and per:
                for k in range(per):
                    out.append((length, rank + k * count, count, opened, k * length))
                add(capacity - per * length, opened, count)
                rank, opened = rank + per * count, opened + count
    return np.array(out, np.int64).reshape(-1, 5), opened


def _place(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = plan.value
        key = rows[:, 0] << 44 | rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            at = np.searchsorted(key, length << 44 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(rows[at, 3] + rank - rows[at, 1]), pa.array(rows[at, 4])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, text) rows -> one row per piece with its sequence_id and offset."""
    spark = ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = materialize(docs.mapInArrow(_pieces(tokenizer or default_path(), capacity), _PIECES)
                         .withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    rows, _ = fit_runs(counts, capacity)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    ranked = sequence_number(pieces, ["doc_id", "piece", "_row"], "rank", group_cols=["length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(_place(spark.sparkContext.broadcast(rows)), _PIECES + ", sequence_id long, offset long")
