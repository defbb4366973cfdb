"""Removal of passages that occur more than once, by difference-cover anchors
(operator 13).

A window is ``WINDOW`` consecutive words of a document. Every word inside a window
that also starts anywhere else goes, at each of its places.

Method. ``COVER`` is a difference cover: any two places, shifted alike by some
number below ``PERIOD``, both fall on it modulo the period. So only the windows of
``ANCHOR`` words at such places are hashed, and two equal long windows always share
an anchor that is hashed in both. A match is then extended from its anchors.

1. Documents are packed into chunks and written once, bucketed by chunk; later
   steps read them without moving them.
2. Each anchor goes out with a hash of its surroundings, as far as a long window
   around it reaches. Anchors are range-partitioned by (hash, surroundings, place)
   and sorted: an anchor that one row in three holds is split over many tasks, which
   stream their rows. An anchor with no equal neighbour is dropped. Where the
   surroundings agree too the match extends to both sides, and every long window
   around the anchor is settled. Otherwise one place for each different surroundings
   bears witness. The first and last anchors of a task, which may go on in the next,
   bear witness in any case.
3. Back at the chunks, the long windows around a witness are hashed, 128 bits, and
   go out once for each chunk. Range-partitioned and sorted likewise, those with an
   equal neighbour occur elsewhere; the few at the border of a task are compared
   with one another.
4. The verdicts return to the chunks; covered words are cut.

Words are compared by 128-bit hashes of whole windows, in which words of over
``LONG`` bytes count by a cryptographic digest.

Defined cases: a null text has no words, as has one of white space. A text of fewer
words than a window keeps them all. Rows that repeat are separate documents, whatever
their doc_id, so that both lose what they share; a null doc_id is kept. Other columns
pass through unchanged. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_path, settle, written
from . import _bytes as B
from ._ship import ready
from .suffix_dedup import _pack, _unpack

WINDOW = 35
#: fixed values: a perfect difference set, each remainder is one difference of two
PERIOD = 21
COVER = (3, 6, 7, 12, 14)
ANCHOR = WINDOW - PERIOD + 1
LONG = 64
SEGMENT = 1 << 20  # bytes, or words, worked on at a time

TWIN, WITNESS = 1, 2

_RNG = np.random.default_rng(20261203)
_TABLES = _RNG.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
_STEPS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0x8EBC6AF09C88C6E3))
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


# --- words ------------------------------------------------------------------

def _cuts(data: np.ndarray, off: np.ndarray) -> list[int]:
    """Places that cut the bytes into segments, none of them inside a word."""
    out, n = [0], len(data)
    while out[-1] < n:
        at = min(out[-1] + SEGMENT, n)
        head = int(off[np.searchsorted(off, at)])  # the next text begins here
        while at < head:
            near = np.flatnonzero(B._SPACE[data[at:min(at + SEGMENT, head)]])
            if len(near):
                at += int(near[0])
                break
            at = min(at + SEGMENT, head)
        out.append(at)
    return out


class Words:
    """Words of a buffer of texts: place, two hashes, and their document's words."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        parts = []
        bounds = _cuts(data, off)
        for lo, hi in zip(bounds, bounds[1:]):
            part = self._segment(data[lo:hi], off[np.searchsorted(off, lo):np.searchsorted(off, hi)] - lo)
            parts.append((part[0] + lo, part[1] + lo, *part[2:]))
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        self.start, self.end, *self.hash = (np.concatenate(x) for x in zip(*(parts or [empty])))
        self.off = np.searchsorted(self.start, off)       # first word of each document
        self.size = np.diff(self.off)
        self.head = np.repeat(self.off[:-1], self.size)    # by word: its document's first word, and the end
        self.tail = np.repeat(self.off[1:], self.size)

    @staticmethod
    def _segment(data: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, ...]:
        inside = ~B._SPACE[data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        heads = heads[heads < len(data)]
        begin[heads] |= inside[heads]
        start, byte = np.flatnonzero(begin), np.flatnonzero(inside)
        if not len(start):
            return start, start, start.astype(np.uint64), start.astype(np.uint64)
        rank = np.searchsorted(byte, start)
        length = np.diff(np.append(rank, len(byte)))
        place = np.arange(len(byte)) - np.repeat(rank, length)
        letters = data[byte]
        hashes = [B.mix(np.add.reduceat(_TABLES[k][letters] * B.powers(_BASES[k], int(length.max()))[place], rank)
                        + length.astype(np.uint64)) for k in range(2)]
        for w in np.flatnonzero(length > LONG):
            digest = hashlib.blake2b(data[start[w]:start[w] + length[w]].tobytes(), digest_size=16).digest()
            hashes[0][w], hashes[1][w] = np.frombuffer(digest, np.uint64)
        return start, start + length, *hashes

    def spans(self, kind: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of the words [lo, hi) for ascending lo; spans are shorter than SEGMENT."""
        out = np.empty(len(lo), np.uint64)
        for s in range(0, len(self.start), SEGMENT):
            a, b = np.searchsorted(lo, [s, s + SEGMENT])
            if a < b:
                words = self.hash[kind][s:int(hi[a:b].max())]
                power = B.powers(_STEPS[kind], len(words))
                back = B.powers(np.uint64(pow(int(_STEPS[kind]), -1, 1 << 64)), min(len(words), SEGMENT))
                pre = np.zeros(len(words) + 1, np.uint64)
                np.cumsum(words * power, out=pre[1:])
                out[a:b] = B.mix((pre[hi[a:b] - s] - pre[lo[a:b] - s]) * back[lo[a:b] - s] + (hi[a:b] - lo[a:b]).astype(np.uint64))
        return out


def _words(rows: bytes, text_at: int) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, Words]:
    batch = _unpack(rows)
    data, off = B.buffers(batch.column(text_at))
    return batch, data, off, Words(data, off)


# --- step 2: anchors --------------------------------------------------------

_ANCHORS = "anchor long, around long, chunk long, word int"


def anchors(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash and hash of the surroundings of the anchors at cover positions."""
    word = np.arange(len(w.start))
    at = word[_IN_COVER[(word - w.head) % PERIOD] & (word + ANCHOR <= w.tail) & (w.tail - w.head >= WINDOW)]
    lo, hi = np.maximum(at - PERIOD + 1, w.head[at]), np.minimum(at + WINDOW, w.tail[at])
    # the place in its surroundings counts: it differs where a document begins
    around = B.mix(w.spans(1, lo, hi) + (at - lo).astype(np.uint64) * _STEPS[0])
    return at, w.spans(0, at, at + ANCHOR), around


def _send_anchors(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, rows in zip(batch.column("chunk").to_pylist(), batch.column("rows")):
                *_, w = _words(rows.as_buffer(), text_at)
                at, key, around = anchors(w)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(B.as_long(key)), pa.array(B.as_long(around)), pa.array(np.full(len(at), chunk)),
                     pa.array(at.astype(np.int32))], ["anchor", "around", "chunk", "word"])

    return run


def _after(other: np.ndarray) -> int:
    """Place after the last row marked."""
    at = np.flatnonzero(other)
    return int(at[-1]) + 1 if len(at) else 0


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted anchors, those with an equal neighbour: as twin, where the
    surroundings agree too, and as witness. Between batches it keeps two rows: the
    first of the current surroundings, undecided, and a second if there is one."""
    carry = np.zeros((4, 0), np.int64)   # anchor, around, chunk, word
    first: int | None = None             # the task's first anchor may have begun before it
    several = False                      # the current anchor has had other surroundings

    def decide(rows: np.ndarray, done: int, several: bool, last: bool) -> pa.RecordBatch:
        """Marks of the rows; ``done`` of them are carried and out but for the first."""
        anchor, around = rows[0], rows[1]
        new_anchor = np.ones(len(anchor), bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new = new_anchor.copy()
        new[1:] |= around[1:] != around[:-1]
        run, group = np.cumsum(new) - 1, np.cumsum(new_anchor) - 1
        twin = np.bincount(run)[run] > 1
        mixed = np.bincount(group, new)[group] > 1
        mixed |= (group == 0) & (several or anchor[0] == first)
        if last:
            mixed |= group == group[-1]
        state = twin * TWIN + (mixed & new) * WITNESS
        out = state > 0
        out[1:done] = False
        if not last:
            out[int(np.flatnonzero(new)[-1])] = False  # the first of the last run is undecided
        return pa.RecordBatch.from_arrays([pa.array(rows[2][out]), pa.array((rows[3][out] << 2 | state[out]).astype(np.int64))], ["chunk", "mark"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.concatenate([carry, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])], axis=1)
        if first is None:
            first = int(rows[0, 0])
        yield decide(rows, carry.shape[1], several, False)
        begin = _after(rows[0] != rows[0, -1])
        several = (several and begin == 0) or bool((rows[1, begin:] != rows[1, -1]).any())
        run = _after((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1]))
        carry = rows[:, run:run + 2]
    if carry.shape[1]:
        yield decide(carry, carry.shape[1], several, True)


# --- step 3: long windows around witnesses -----------------------------------

_WINDOWS = "h1 long, h2 long, chunk long, word int, asks boolean"


class Marked:
    """A chunk's words with what its marked anchors say of its windows."""

    def __init__(self, w: Words, marks: list[int] | None):
        n = len(w.start)
        mark = np.array(marks or [], np.int64)
        at, state = mark >> 2, mark & 3
        lo = np.maximum(at - PERIOD + 1, w.head[at]) if n else at
        hi = np.minimum(at, w.tail[at] - WINDOW) if n else at

        def starts(which: np.ndarray) -> np.ndarray:
            """Starts of windows that hold one of these anchors within a period of their start."""
            step = np.zeros(n + 1, np.int32)
            np.add.at(step, lo[which], 1)
            np.add.at(step, hi[which] + 1, -1)
            return np.cumsum(step[:-1]) > 0

        self.repeated = starts(state & TWIN > 0)
        word = np.flatnonzero(starts(state & WITNESS > 0))
        h1, h2 = w.spans(0, word, word + WINDOW), w.spans(1, word, word + WINDOW)
        order = np.lexsort((word, h2, h1))
        h1, h2, word = h1[order], h2[order], word[order]
        new = np.ones(len(word), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        many = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1 if len(word) else new
        self.repeated[word[many]] = True  # twice in this chunk
        self.h1, self.h2, self.word = h1[new], h2[new], word[new]
        self.asks = ~self.repeated[self.word]


def _send_windows(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, rows, marks in zip(batch.column("chunk").to_pylist(), batch.column("rows"), batch.column("marks")):
                *_, w = _words(rows.as_buffer(), text_at)
                m = Marked(w, marks.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(B.as_long(m.h1)), pa.array(B.as_long(m.h2)), pa.array(np.full(len(m.word), chunk)),
                     pa.array(m.word.astype(np.int32)), pa.array(m.asks)], ["h1", "h2", "chunk", "word", "asks"])

    return run


#: verdict on a window: it is elsewhere too; alone here, but at a border; a witness for the border
SURE, OPEN, BORDER = 0, 1, 2
_VERDICTS = "h1 long, h2 long, chunk long, word int, kind int"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted windows, those that ask and have an equal neighbour. The task's first
    and last window may have equals in other tasks; one row of each says so. Between
    batches it keeps two rows of the current window, the second one judged."""
    carry = np.zeros((5, 0), np.int64)
    first: tuple[int, int] | None = None

    def decide(rows: np.ndarray, done: int, last: bool) -> pa.RecordBatch:
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
        run = np.cumsum(new) - 1
        many = np.bincount(run)[run] > 1
        edge = (run == 0) & (rows[0, 0] == first[0]) & (rows[1, 0] == first[1])
        if last:
            edge |= run == run[-1]
        sure = many & (rows[4] > 0)
        sure[1:done] = False
        border = edge & new
        if not last:
            sure[int(np.flatnonzero(new)[-1])] = border[int(np.flatnonzero(new)[-1])] = False
        parts = [(rows[:4, sure], SURE), (rows[:4, border & ~many & (rows[4] > 0)], OPEN), (rows[:4, border & (many | (rows[4] == 0))], BORDER)]
        out = np.concatenate([p for p, _ in parts], axis=1)
        kind = np.concatenate([np.full(p.shape[1], k, np.int32) for p, k in parts])
        return pa.RecordBatch.from_arrays([*[pa.array(x) for x in out[:3]], pa.array(out[3].astype(np.int32)), pa.array(kind)],
                                          ["h1", "h2", "chunk", "word", "kind"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.concatenate([carry, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])], axis=1)
        if first is None:
            first = int(rows[0, 0]), int(rows[1, 0])
        yield decide(rows, carry.shape[1], False)
        run = _after((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1]))
        carry = rows[:, run:run + 2]
    if carry.shape[1]:
        yield decide(carry, carry.shape[1], True)


# --- step 4: cutting ---------------------------------------------------------

_NEW = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_sha256", T.StringType())]


def _kept(data: np.ndarray, off: np.ndarray, w: Words, stays: np.ndarray) -> list[bytes]:
    """Each text's words that stay, joined by one space."""
    step = np.zeros(len(data) + 1, np.int8)
    stop = np.minimum(w.end + 1, np.repeat(off[1:], w.size))  # with the white space after the word
    step[w.start[stays]] += 1
    np.add.at(step, stop[stays], -1)
    stay = np.cumsum(step[:-1], dtype=np.int8) > 0
    text = np.where(B._SPACE[data], np.uint8(32), data)[stay]
    at = np.concatenate([[0], np.cumsum(stay)])[off]
    return [text[a:b].tobytes().rstrip(b" ") for a, b in zip(at, at[1:])]


def _cut(text_at: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packed in batches:
            for rows, marks, starts in zip(packed.column("rows"), packed.column("marks"), packed.column("starts")):
                batch, data, off, w = _words(rows.as_buffer(), text_at)
                m = Marked(w, marks.as_py())
                m.repeated[np.array(starts.as_py() or [], np.int64)] = True
                step = np.zeros(len(w.start) + WINDOW + 1, np.int32)
                np.add.at(step, np.flatnonzero(m.repeated), 1)
                np.add.at(step, np.flatnonzero(m.repeated) + WINDOW, -1)
                gone = np.cumsum(step)[:len(w.start)] > 0
                kept = _kept(data, off, w, ~gone)
                removed = np.concatenate([[0], np.cumsum(gone)])
                columns = [*batch.columns, pa.array(w.size, pa.int64()), pa.array(removed[w.off[1:]] - removed[w.off[:-1]], pa.int64()),
                           pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
                if keep_text:
                    columns.append(pa.array([k.decode() for k in kept], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [f"c{k}" for k in range(len(columns))])

    return run


def remove_passages(docs: DataFrame, kept: bool = False) -> tuple[DataFrame, dict]:
    """``docs`` (text, any others) with the words of their repeated passages cut.

    Returns a written frame whose first columns are ``docs``' own, renamed c0, c1,
    ..., and the new columns by name: n_words, n_removed, kept_sha256 (of the words
    left, joined by one space) and, if asked for, those words as text: kept."""
    spark = ready(docs.sparkSession)
    mark, text_at = written(), docs.columns.index("text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"passages_{uuid.uuid4().hex}"
    (docs.mapInArrow(_pack(text_at), "chunk long, rows binary").write.format("parquet")
     .bucketBy(partitions, "chunk").option("path", scratch_path(spark, name)).saveAsTable(name))
    chunks = spark.table(name)

    def back(frame: DataFrame, value: str, into: str) -> DataFrame:
        """One list for each chunk; a chunk has at most as many entries as words."""
        return materialize(frame.groupBy("chunk").agg(F.collect_list(value).alias(into)), into)

    order = ("anchor", "around", "chunk", "word")
    marks = back(chunks.mapInArrow(_send_anchors(text_at), _ANCHORS).repartitionByRange(*order).sortWithinPartitions(*order)
                 .mapInArrow(_mark, "chunk long, mark long"), "mark", "marks")
    marked = chunks.join(marks.hint("shuffle_hash"), "chunk", "left")
    order = ("h1", "h2", "chunk", "word")
    windows = (marked.filter(F.col("marks").isNotNull()).mapInArrow(_send_windows(text_at), _WINDOWS)
               .repartitionByRange(*order).sortWithinPartitions(*order))
    verdicts = materialize(windows.mapInArrow(_judge, _VERDICTS), "verdicts")
    border = verdicts.filter(F.col("kind") > SURE)  # at most two rows for each task
    met = border.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    more = border.filter(F.col("kind") == OPEN).join(met, ["h1", "h2"])
    starts = back(verdicts.filter(F.col("kind") == SURE).select("chunk", "word").unionByName(more.select("chunk", "word")), "word", "starts")
    own = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema.fields)]
    new = _NEW + ([("kept", T.StringType())] if kept else [])
    schema = T.StructType(own + [T.StructField(f"c{len(own) + k}", t) for k, (_, t) in enumerate(new)])
    out = settle(marked.join(starts.hint("shuffle_hash"), "chunk", "left").mapInArrow(_cut(text_at, kept), schema), mark, "kept")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out, {n: F.col(f"c{len(own) + k}") for k, (n, _) in enumerate(new)}
