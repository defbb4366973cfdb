"""Benchmark decontamination over training suffix arrays (operator 1).

Method. Each shard of the training text (a megabyte of whole documents)
gets a suffix array over its words; every benchmark suffix is looked up in it
by binary search, which gives the places where its first 13 words (all of them
in a shorter item) occur. Places on one diagonal are joined to the longest
verbatim matches. The array holds only suffixes whose first four words begin
some benchmark suffix, since no other can match; that loses nothing.

Documents never move: a shard is answered where it is read. The benchmark goes
to the shards in blocks of at most ``BLOCK`` segments of ``SEGMENT`` words
(about 17 MB of hashes), one pass over the documents for each; passes are
chained in one stage, and every ``PASSES`` blocks the state is written to the
shared checkpoint folder.

Defined cases: null or empty text has no words, no hits, and is clean. An item
without words has no window; an item with fewer than 13 words is one window.
Items that repeat an item_id count once; items with a null item_id hit words
but are not counted or listed. Repeated documents are judged row by row.
Columns of the documents pass through unchanged, whatever their names; with an
empty benchmark every document is clean.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sequence import sequence_number
from ..session import materialize
from . import _bytes as B
from ._ship import ready

WINDOW = 13
HEAD = 4  # words that a suffix must share with a benchmark suffix to enter the array
SEGMENT = 4096
BLOCK = 512
PASSES = 4
SHARD_BYTES = 1 << 20

_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("words", pa.int64())]))
_STATE = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("hits", pa.binary()), ("items", pa.list_(pa.int64())), ("matches", _MATCH)]
_STATE_TYPES = [T.LongType(), T.LongType(), T.BinaryType(), T.ArrayType(T.LongType()),
                T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "item_word", "doc_word", "words")]))]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items -> overlapping segments of their word hashes (no window is cut)."""
    for batch in batches:
        data, off = B.buffers(batch.column(1))
        ids = batch.column(0).to_pylist()
        rows: list[tuple] = []
        for a, b in B.slices(off):
            h, _, _, owner = B.words(data[off[a]:off[b]], off[a:b + 1] - off[a], "alnum")
            bound = np.searchsorted(owner, np.arange(b - a + 1))
            for i in range(b - a):
                w = h[bound[i]:bound[i + 1]]
                for at in range(0, max(1, len(w) - WINDOW + 1) if len(w) else 0, SEGMENT):
                    rows.append((ids[a + i], at, min(WINDOW, len(w)), w[at:at + SEGMENT + WINDOW - 1].tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
            ["item_id", "at", "width", "hashes"])


def _suffix_keys(h: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first WINDOW words of the suffixes at ``at``, as sortable byte
    strings; words from ``end`` on are zero."""
    place = at[:, None] + np.arange(WINDOW)
    key = np.where(place < end[:, None], h[np.minimum(place, len(h) - 1)], np.uint64(0))
    return np.ascontiguousarray(key.astype(">u8")).view(f"S{8 * WINDOW}").ravel()


class _Block:
    """The windows of one block of benchmark segments, ready for look-ups."""

    def __init__(self, rows: list):
        keys, items, place, width = [], [], [], []
        head: list[list[np.ndarray]] = [[] for _ in range(HEAD + 1)]
        for r in rows:
            h = np.frombuffer(r["hashes"], np.uint64)
            at = np.arange(len(h) - r["width"] + 1)
            keys.append(_suffix_keys(h, at, at + r["width"]))
            items.append(np.full(len(at), -1 if r["item_id"] is None else r["item_id"], np.int64))
            place.append(at + r["at"])
            width.append(np.full(len(at), r["width"], np.int64))
            k = min(HEAD, r["width"])
            head[k].append(B.run_hash(h, k)[: len(at)])
        key, width = np.concatenate(keys), np.concatenate(width)
        self.head = [np.unique(np.concatenate(x)) if x else np.zeros(0, np.uint64) for x in head]
        order = np.argsort(key, kind="stable")
        key, self.width = key[order], width[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (self.width[1:] != self.width[:-1])
        self.key, self.first = key[new], np.append(np.flatnonzero(new), len(key))
        self.width = self.width[new]
        self.item, self.place = np.concatenate(items)[order], np.concatenate(place)[order]
        self.bits = [np.zeros(1 << 16, bool) for _ in self.head]
        for bits, x in zip(self.bits, self.head):
            bits[(x >> np.uint64(48)).astype(np.int64)] = True
        # the look-up key above a window's last match: the same words, then the largest bytes
        pad = np.frombuffer(self.key.tobytes(), np.uint8).reshape(len(self.key), 8 * WINDOW).copy()
        pad[np.arange(8 * WINDOW)[None, :] >= 8 * self.width[:, None]] = 255
        self.above = np.ascontiguousarray(pad).view(f"S{8 * WINDOW}").ravel()

    def search(self, h: np.ndarray, owner: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, word position) pairs of a shard with word hashes ``h``."""
        keep = np.zeros(len(h), bool)
        for k in range(1, HEAD + 1):
            if not len(self.head[k]) or len(h) < k:
                continue
            x = B.run_hash(h, k)
            i = np.flatnonzero(self.bits[k][(x >> np.uint64(48)).astype(np.int64)])
            i = i[owner[i] == owner[i + k - 1]]
            keep[i[np.isin(x[i], self.head[k])]] = True
        at = np.flatnonzero(keep)
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = _suffix_keys(h, at, bound[owner[at] + 1])
        order = np.argsort(keys, kind="stable")  # the shard's suffix array
        keys, at = keys[order], at[order]
        lo = np.searchsorted(keys, self.key, side="left")
        hi = np.searchsorted(keys, self.above, side="right")
        n = hi - lo
        window = np.repeat(np.arange(len(n)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return window, at[place]


def _runs(mask_at: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Union of the word ranges [at, at + width) as (start, end) pairs."""
    order = np.argsort(mask_at, kind="stable")
    a, e = mask_at[order], np.maximum.accumulate(mask_at[order] + width[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > e[:-1]
    return np.stack([a[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]], axis=1)


def _longest(item: np.ndarray, place: np.ndarray, word: np.ndarray, width: np.ndarray) -> list[dict]:
    """Matches on one diagonal of one item that touch or overlap, joined."""
    order = np.lexsort((word, word - place, item))
    item, place, word, width = item[order], place[order], word[order], width[order]
    new = np.ones(len(item), bool)
    same = (item[1:] == item[:-1]) & (word[1:] - place[1:] == word[:-1] - place[:-1])
    new[1:] = ~(same & (word[1:] <= word[:-1] + width[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(item) - 1)
    return [{"item_id": None if item[f] < 0 else int(item[f]), "item_word": int(place[f]), "doc_word": int(word[f]),
             "words": int(word[z] + width[z] - word[f])} for f, z in zip(first, last)]


def _search_pass(block, text_at: int, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench: _Block = block.value
        for batch in batches:
            n = batch.num_rows
            width = batch.num_columns if first else batch.num_columns - len(_STATE)
            if first:
                counts, found, hits, items, matches = [0] * n, [0] * n, [None] * n, [[] for _ in range(n)], [[] for _ in range(n)]
            else:
                counts, found, hits, items, matches = (batch.column(width + k).to_pylist() for k in range(len(_STATE)))
            data, off = B.buffers(batch.column(text_at))
            for a, b in B.slices(off, SHARD_BYTES):
                h, _, _, owner = B.words(data[off[a]:off[b]], off[a:b + 1] - off[a], "alnum")
                bound = np.searchsorted(owner, np.arange(b - a + 1))
                counts[a:b] = np.diff(bound).tolist()
                window, word = bench.search(h, owner, bound)
                if not len(window):
                    continue
                order = np.argsort(owner[word], kind="stable")
                window, word = window[order], word[order]
                cut = np.searchsorted(owner[word], np.arange(b - a + 1))
                for i in np.unique(owner[word]):
                    w, at = window[cut[i]:cut[i + 1]], word[cut[i]:cut[i + 1]] - bound[i]
                    size = bench.width[w]
                    old = np.frombuffer(hits[a + i] or b"", np.int32).reshape(-1, 2).astype(np.int64)
                    runs = _runs(np.concatenate([old[:, 0], at]), np.concatenate([old[:, 1] - old[:, 0], size]))
                    found[a + i] = int((runs[:, 1] - runs[:, 0]).sum())
                    hits[a + i] = runs.astype(np.int32).tobytes()
                    many = bench.first[w + 1] - bench.first[w]
                    src = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(bench.first[w], many)
                    item = bench.item[src]
                    items[a + i] = sorted({int(x) for x in item if x >= 0} | set(items[a + i]))
                    matches[a + i] = matches[a + i] + _longest(item, bench.place[src], np.repeat(at, many), np.repeat(size, many))
            state = [pa.array(x, t) for x, (_, t) in zip((counts, found, hits, items, matches), _STATE)]
            yield pa.RecordBatch.from_arrays(batch.columns[:width] + state,
                                             [f"c{k}" for k in range(width + len(state))])

    return run


def benchmark_matches(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """Documents with their benchmark matches.

    Returns a frame whose first columns are ``docs``' own, renamed c0, c1, ...,
    and the new columns by name: n_words, n_hit, hits (word ranges, int32 pairs),
    items (sorted item_ids), matches (longest verbatim matches: item_id,
    item_word, doc_word, words)."""
    spark = ready(docs.sparkSession)
    parts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_segments, "item_id long, at long, width int, hashes binary") \
        .withColumn("_row", F.monotonically_increasing_id())
    parts = materialize(sequence_number(materialize(parts, "segments"), ["_row"], "_seq"), "segments")
    blocks = -(-parts.count() // BLOCK)
    text_at = docs.columns.index("text")
    width = len(docs.columns)
    own = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema.fields)]
    schema = T.StructType(own + [T.StructField(f"c{width + k}", t) for k, t in enumerate(_STATE_TYPES)])
    out = docs
    for k in range(max(blocks, 1)):
        rows = parts.filter((F.col("_seq") >= k * BLOCK) & (F.col("_seq") < (k + 1) * BLOCK)).collect()
        block = spark.sparkContext.broadcast(_Block(rows) if rows else _Empty())
        out = out.mapInArrow(_search_pass(block, text_at, k == 0), schema)
        if (k + 1) % PASSES == 0 and k + 1 < blocks:
            out = materialize(out, "decontaminate")
    return out, {name: F.col(f"c{width + k}") for k, (name, _) in enumerate(_STATE)}


class _Empty:
    """A block without windows."""

    def search(self, h, owner, bound):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)


def decide(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``benchmark_matches`` with n_hit, n_items and contaminated added to the
    named columns: contaminated when hit words are a twentieth or more."""
    frame, cols = benchmark_matches(docs, benchmark)
    cols |= {"n_items": F.size(cols["items"]).cast("long"),
             "contaminated": (cols["n_hit"] > 0) & (20 * cols["n_hit"] >= cols["n_words"])}
    return frame, cols


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents, columns unchanged."""
    frame, cols = decide(docs, benchmark)
    kept = frame.filter(~cols["contaminated"])
    return kept.select(*[F.col(f"c{k}").alias(name) for k, name in enumerate(docs.columns)])
