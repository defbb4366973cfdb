"""Removal of repeated 100-byte passages by a range-partitioned suffix array
(operator 6).

Method. Every 100-byte window names an anchor: the position of the smallest
hash among its 81 twenty-byte grams. Equal windows have the anchor at the same
place, so the suffixes that need sorting are those at anchors (about one
position in 41), each with the consecutive windows it stands for.

1. Documents are packed into chunks and written once, bucketed by chunk, so
   that later steps read them without moving them.
2. A window contains 60 bytes to the left or to the right of its anchor
   (whichever side reaches 40 bytes). Hashes of these go out as four-byte
   values, each once per chunk and side; a hash seen only once in all chunks
   rules out its windows. False agreements cost work, not correctness.
3. The suffixes that remain are range-partitioned by their leading eight bytes
   at sampled splitters. Equal leading bytes never straddle a splitter, so
   buckets need no further comparison across boundaries. A passage repeated
   within a chunk goes out once, its first place; the rest repeats for certain.
   Each bucket sorts its suffixes by multikey quicksort over eight-byte digits,
   refining ties only, drops those that share 20 bytes with no neighbour, and
   finds each window's earliest place among the rest.
4. The verdicts, one bit per window, return to the chunks; covered bytes are
   the union of the windows that start earlier elsewhere.

"Earlier" is a smaller doc_id or, in one document, an earlier start. Only one
entry per chunk leaves for a passage, however many documents share it.

Defined cases: null or empty text has no bytes; texts under 100 bytes keep all
theirs. A null doc_id comes after all others. Rows that repeat a doc_id are
separate documents, in reading order. Other columns pass through unchanged.
Window equality is that of 64-bit polynomial hashes among suffixes that share
their 20-byte gram bucket.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_tables, scratch_path
from . import _bytes as B
from ._ship import ready

WINDOW = 100
GRAM = 20
SIDE = 40  # bytes left of the anchor that decide which side of it is hashed
CHUNK_BYTES = 4 << 20
SEGMENT = 1 << 19  # window starts worked on at a time
BLOCK_WINDOWS = 1 << 19
SPLITTER_SAMPLE = 1 << 16
PARTS_PER_PARTITION = 4

_REACH = WINDOW - GRAM + 1
_PW = B.powers(B._BASE, SEGMENT + 2 * WINDOW + 1)
_INV = B.powers(np.uint64(pow(int(B._BASE), -1, 1 << 64)), SEGMENT + 2 * WINDOW + 1)
_LAST = np.iinfo(np.int64).max


def _prefix(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(B._BYTE[data] * _PW[:len(data)], out=out[1:])
    return out


def _hash_at(pre: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    return B.mix((pre[at + length] - pre[at]) * _INV[at])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def anchor_runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of a buffer of whole texts: position, first and last window
    start of its run, hashes of its left and right side (0: no such window)."""
    n = len(data)
    size = np.maximum(np.diff(off) - WINDOW + 1, 0)
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, off[:-1][size > 0], 1)
    np.add.at(step, (off[:-1] + size)[size > 0], -1)
    valid = np.cumsum(step[:-1]).astype(bool)
    out: list[tuple] = []
    for s in range(0, n, SEGMENT):
        part = data[s:s + SEGMENT + WINDOW - 1]
        starts = np.flatnonzero(valid[s:s + SEGMENT])
        if not len(starts):
            continue
        pre = _prefix(part)
        grams = _hash_at(pre, np.arange(len(part) - GRAM + 1), GRAM)
        packed = (grams & np.uint64(~((1 << 24) - 1) & (1 << 64) - 1)) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_sliding_min(packed, _REACH)[starts] & np.uint64((1 << 24) - 1)).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(starts) - 1)
        a, q1, q2 = anchor[first], starts[first], starts[last]
        left, right = np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint64)
        has = q1 <= a - SIDE
        left[has] = _hash_at(pre, a[has] - SIDE, SIDE + GRAM) | np.uint64(1)
        has = q2 >= a - SIDE
        right[has] = _hash_at(pre, a[has], WINDOW - SIDE) ^ np.uint64(0x5555555555555555) | np.uint64(1)
        out.append((a + s, q1 + s, q2 + s, left, right))
    if not out:
        e = np.zeros(0, np.int64)
        return e, e, e, e.astype(np.uint64), e.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


# --- chunks -----------------------------------------------------------------

def _pack(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, k = TaskContext.get().partitionId() << 20, 0
        for batch in batches:
            _, off = B.buffers(batch.column(text_at))
            for a, b in B.slices(off, CHUNK_BYTES):
                sink = pa.BufferOutputStream()
                part = pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([c.slice(a, b - a)]) for c in batch.columns], [f"c{i}" for i in range(batch.num_columns)])
                with pa.ipc.new_stream(sink, part.schema) as w:
                    w.write_batch(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([base + k], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "rows"])
                k += 1

    return run


def _unpack(rows: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(rows).read_next_batch()


class _Chunk:
    """A chunk's bytes, documents and anchors."""

    def __init__(self, chunk: int, rows: bytes, id_at: int, text_at: int):
        self.id, self.batch = chunk, _unpack(rows)
        self.data, self.off = B.buffers(self.batch.column(text_at))
        ids = self.batch.column(id_at).cast(pa.int64())
        self.docs = ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
        self.a, self.q1, self.q2, self.left, self.right = anchor_runs(self.data, self.off)

    def sides(self, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct side hashes: value, part, count here, and each side's index."""
        flat = np.concatenate([self.left, self.right])
        value, index, count = np.unique(flat, return_inverse=True, return_counts=True)
        part = ((value >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        return value, part, count, index

    def survivors(self, parts: int, answers: list) -> None:
        """Cut the runs to the windows whose side hash is seen elsewhere too,
        then set apart those that repeat an earlier run of this chunk whole."""
        value, part, count, index = self.sides(parts)
        seen = np.zeros(len(value), bool)
        bound = np.searchsorted(part, np.arange(parts + 1))
        for x in answers:
            lo, hi = bound[x["part"]], bound[x["part"] + 1]
            seen[lo:hi] = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=hi - lo).astype(bool)
        seen |= count > 1
        seen &= value != 0
        left, right = seen[index[:len(self.a)]], seen[index[len(self.a):]]
        q1 = np.where(left, self.q1, np.maximum(self.q1, self.a - SIDE))
        q2 = np.where(right, self.q2, np.minimum(self.q2, self.a - SIDE))
        keep = (left | right) & (q1 <= q2)
        self.a, self.q1, self.q2 = self.a[keep], q1[keep], q2[keep]
        self.doc = np.searchsorted(self.off, self.a, side="right") - 1
        # in order of doc_id and start, so that the first of equal runs is the earliest
        order = np.lexsort((self.q1, self.doc, self.docs[self.doc]))
        self.a, self.q1, self.q2, self.doc = (x[order] for x in (self.a, self.q1, self.q2, self.doc))
        name = self._names()
        _, first, index = np.unique(name, return_index=True, return_inverse=True)
        self.earliest = first[index] == np.arange(len(name))

    def _names(self) -> np.ndarray:
        """A hash for each run: its bytes, its length and its anchor's place."""
        out = np.zeros(len(self.a), np.uint64)
        length = self.q2 - self.q1 + WINDOW
        by = np.argsort(self.q1, kind="stable")
        for s in range(0, len(self.data), SEGMENT):
            i = by[np.searchsorted(self.q1[by], s):np.searchsorted(self.q1[by], s + SEGMENT)]
            if len(i):
                pre = _prefix(self.data[s:s + SEGMENT + 2 * WINDOW])
                at = self.q1[i] - s
                out[i] = (pre[at + length[i]] - pre[at]) * _INV[at]
        return B.mix(out + length.astype(np.uint64) * B._STEP + (self.a - self.q1).astype(np.uint64))

    def lead(self) -> np.ndarray:
        """The eight bytes at each anchor as one big-endian number."""
        return _digit(self.data, self.a)


def _digit(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | data[at + k]
    return out


# --- step 2: sides seen only once -------------------------------------------

_SIDES = "part int, chunk long, payload binary"


def _send_sides(parts: int, id_at: int, text_at: int, rate: float):
    limit = np.uint64(min(int(rate * 2**64), 2**64 - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                c = _Chunk(chunk, rows.as_buffer(), id_at, text_at)
                value, part, _, _ = c.sides(parts)
                low = value.astype(np.uint32)
                bound = np.searchsorted(part, np.arange(parts + 1))
                full = np.flatnonzero(np.diff(bound))
                payload = [low[bound[p]:bound[p + 1]].tobytes() for p in full]
                sample = np.unique(c.lead()[(c.left ^ c.right) * B._STEP < limit]) if len(c.a) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*full, -1], pa.int32()), pa.array([chunk] * (len(full) + 1), pa.int64()),
                     pa.array([*payload, sample.tobytes()], pa.binary())], ["part", "chunk", "payload"])

    return run


def _match_sides(table: pa.Table) -> pa.Table:
    payload = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("payload")]
    flat = np.concatenate(payload)
    value, count = np.unique(flat, return_counts=True)
    more = value[count > 1]
    bits = []
    for x in payload:
        at = np.minimum(np.searchsorted(more, x), max(len(more) - 1, 0))
        bits.append(np.packbits(more[at] == x).tobytes() if len(more) else np.packbits(np.zeros(len(x), bool)).tobytes())
    return pa.table({"chunk": table.column("chunk"), "part": table.column("part"), "bits": pa.array(bits, pa.binary())})


# --- step 3: buckets of the suffix array ------------------------------------

_ENTRIES = "bucket int, chunk long, meta binary, bytes binary"
_META = np.dtype([("doc", "<i8"), ("row", "<i4"), ("start", "<i4"), ("windows", "<i4"), ("back", "<i4")])


def _send_entries(parts: int, splitters: np.ndarray, id_at: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, rows, answers in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                c = _Chunk(chunk, rows.as_buffer(), id_at, text_at)
                c.survivors(parts, answers or [])
                for bucket, i in _by_bucket(c, splitters):
                    meta = np.zeros(len(i), _META)
                    meta["doc"], meta["row"], meta["start"] = c.docs[c.doc[i]], c.doc[i], c.q1[i] - c.off[c.doc[i]]
                    meta["windows"], meta["back"] = c.q2[i] - c.q1[i] + 1, c.a[i] - c.q1[i]
                    length = meta["windows"].astype(np.int64) + WINDOW - 1
                    src = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(c.q1[i], length)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bucket], pa.int32()), pa.array([chunk], pa.int64()), pa.array([meta.tobytes()], pa.binary()),
                         pa.array([c.data[src].tobytes()], pa.binary())], ["bucket", "chunk", "meta", "bytes"])

    return run


def _by_bucket(c: _Chunk, splitters: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Runs that leave the chunk, by bucket, in the chunk's order."""
    i = np.flatnonzero(c.earliest)
    bucket = np.searchsorted(splitters, _digit(c.data, c.a[i]), side="right")
    order = np.argsort(bucket, kind="stable")
    bucket, i = bucket[order], i[order]
    bound = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(i) else [], len(i)).astype(np.int64)
    for lo, hi in zip(bound[:-1], bound[1:]):
        yield int(bucket[lo]), i[lo:hi]


def multikey_order(data: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``at`` by their first ``depth`` bytes, and the
    number of the group of equal ones for each in that order. Eight bytes are
    compared at a time; only groups still tied are sorted again."""
    order = np.arange(len(at))
    group = np.zeros(len(at), np.int64)
    for d in range(0, depth, 8):
        tied = np.ones(len(at), bool)
        tied[1:-1] = (group[1:-1] == group[:-2]) | (group[1:-1] == group[2:])
        if len(at) > 1:
            tied[0], tied[-1] = group[0] == group[1], group[-1] == group[-2]
        i = np.flatnonzero(tied)
        if not len(i):
            break
        key = _digit(data, at[order[i]] + d)
        if depth - d < 8:
            key >>= np.uint64(8 * (8 - depth + d))
        sort = np.lexsort((key, group[i]))
        order[i], key = order[i][sort], key[sort]
        new = np.zeros(len(at), bool)
        new[1:] = group[1:] != group[:-1]
        new[i[1:]] |= (key[1:] != key[:-1]) & (group[i[1:]] == group[i[:-1]])
        group = np.cumsum(new)
    return order, group


def _later(hashes: np.ndarray) -> np.ndarray:
    """Which values, listed in order of place, occurred before."""
    n = len(hashes)
    bits = max(n - 1, 1).bit_length()
    packed = (hashes >> np.uint64(bits)) << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    packed.sort()
    place = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
    ordered = hashes[place]
    same = ordered[1:] == ordered[:-1]
    close = (packed[1:] >> np.uint64(bits)) == (packed[:-1] >> np.uint64(bits))
    out = np.zeros(n, bool)
    if (close & ~same).any():  # two values that differ in their low bits only
        place = np.argsort(hashes, kind="stable")
        same = hashes[place][1:] == hashes[place][:-1]
    out[place[1:][same]] = True
    return out


def _sort_bucket(table: pa.Table) -> pa.Table:
    metas = [np.frombuffer(x.as_buffer(), _META) for x in table.column("meta")]
    meta = np.concatenate(metas)
    chunk = np.repeat(np.asarray(table.column("chunk")), [len(m) for m in metas])
    data = np.concatenate([*(np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("bytes")), np.zeros(8, np.uint8)])
    windows = meta["windows"].astype(np.int64)
    length = windows + WINDOW - 1
    head = np.cumsum(length) - length
    flag_at = np.cumsum(windows) - windows
    flags = np.zeros(int(windows.sum()), bool)
    order, group = multikey_order(data, head + meta["back"], GRAM)
    size = np.bincount(group)
    cum = np.cumsum(np.bincount(group, weights=windows[order]))
    member = np.searchsorted(group, np.arange(len(size) + 1))
    g = 0
    while g < len(size):
        # whole groups of up to BLOCK_WINDOWS windows (one group, if larger)
        h = int(np.searchsorted(cum, (cum[g - 1] if g else 0) + BLOCK_WINDOWS, side="right"))
        h = max(h, g + 1)
        i = order[member[g]:member[h]]
        i = i[size[group[member[g]:member[h]]] > 1]
        if len(i):
            i = i[np.lexsort((meta["start"][i], meta["row"][i], chunk[i], meta["doc"][i]))]
            flags_i = _later(_window_hashes(data, head[i], windows[i]))
            src = np.arange(len(flags_i)) - np.repeat(np.cumsum(windows[i]) - windows[i], windows[i]) + np.repeat(flag_at[i], windows[i])
            flags[src] = flags_i
        g = h
    bound = np.concatenate([[0], np.cumsum([int(m["windows"].sum()) for m in metas])])
    bits = [np.packbits(flags[a:b]).tobytes() for a, b in zip(bound[:-1], bound[1:])]
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _window_hashes(data: np.ndarray, head: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Hashes of all windows of the given spans, span after span."""
    out = np.empty(int(windows.sum()), np.uint64)
    length = windows + WINDOW - 1
    done, a = 0, 0
    total = np.cumsum(length)
    while a < len(head):
        b = max(int(np.searchsorted(total, (total[a - 1] if a else 0) + SEGMENT, side="right")), a + 1)
        le, w = length[a:b], windows[a:b]
        inner = np.cumsum(le) - le
        src = np.arange(le.sum()) - np.repeat(inner, le) + np.repeat(head[a:b], le)
        pre = _prefix(data[src])
        at = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(inner, w)
        out[done:done + len(at)] = _hash_at(pre, at, WINDOW)
        done, a = done + len(at), b
    return out


# --- step 4: back to the documents ------------------------------------------

def _finish(parts: int, splitters: np.ndarray, id_at: int, text_at: int, kept: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for chunk, rows, answers, verdicts in columns:
                c = _Chunk(chunk, rows.as_buffer(), id_at, text_at)
                c.survivors(parts, answers or [])
                step = np.zeros(len(c.data) + 1, np.int32)
                again = np.flatnonzero(~c.earliest)
                np.add.at(step, c.q1[again], 1)
                np.add.at(step, c.q2[again] + WINDOW, -1)
                bits = {x["bucket"]: x["bits"] for x in verdicts or []}
                for bucket, i in _by_bucket(c, splitters):
                    w = c.q2[i] - c.q1[i] + 1
                    flags = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=int(w.sum())).astype(bool)
                    at = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(c.q1[i], w)
                    np.add.at(step, at[flags], 1)
                    np.add.at(step, at[flags] + WINDOW, -1)
                yield _documents(c, np.cumsum(step[:-1]) > 0, kept)

    return run


def _documents(c: _Chunk, gone: np.ndarray, want: str | None) -> pa.RecordBatch:
    n = len(c.off) - 1
    removed, spans, kept = [], [], []
    total = np.concatenate([[0], np.cumsum(gone)])
    for i in range(n):
        lo, hi = c.off[i], c.off[i + 1]
        k = int(total[hi] - total[lo])
        removed.append(k)
        if not k:
            spans.append(0)
            kept.append(c.data[lo:hi].tobytes())
            continue
        g = gone[lo:hi]
        spans.append(int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])))
        kept.append(c.data[lo:hi][~g].tobytes())
    new = [pa.array(np.diff(c.off), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
           pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
    if want == "bytes":
        new.append(pa.array(kept, pa.binary()))
    elif want == "text":
        new.append(pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()))
    columns = c.batch.columns + new
    return pa.RecordBatch.from_arrays(columns, [f"c{k}" for k in range(len(columns))])


_NEW = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()),
        ("kept_sha256", T.StringType())]
_KEPT = {"bytes": [("kept", T.BinaryType())], "text": [("kept", T.StringType())], None: []}


def remove_repeats(docs: DataFrame, kept: str | None = None) -> tuple[DataFrame, dict]:
    """``docs`` (doc_id, text, any others) with their repeated passages marked.

    Returns a frame whose first columns are ``docs``' own, renamed c0, c1, ...,
    and the new columns by name: n_bytes, n_removed, n_spans, kept_sha256, and,
    where ``kept`` asks for it, kept: the remaining "bytes", or them as "text"
    without those of a character that a cut has split."""
    spark = ready(docs.sparkSession)
    id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = partitions * PARTS_PER_PARTITION
    name = f"chunks_{uuid.uuid4().hex}"
    (docs.mapInArrow(_pack(text_at), "chunk long, rows binary").write.format("parquet")
     .bucketBy(partitions, "chunk").option("path", scratch_path(spark, name)).saveAsTable(name))
    chunks = spark.table(name)
    size = chunks.agg(F.sum(F.length("rows"))).first()[0] or 0
    rate = min(1.0, SPLITTER_SAMPLE / max(size / 41, 1))
    sides = chunks.mapInArrow(_send_sides(parts, id_at, text_at, rate), _SIDES)
    sides_path = scratch_path(spark, "sides")
    sides.write.parquet(sides_path)
    sides = spark.read.parquet(sides_path)
    sample = [np.frombuffer(r["payload"], np.uint64) for r in sides.filter("part = -1").select("payload").toLocalIterator()]
    sample = np.sort(np.concatenate(sample)) if sample else np.zeros(0, np.uint64)
    splitters = np.unique(sample[np.arange(1, parts) * len(sample) // parts]) if len(sample) else sample
    path = scratch_path(spark, "seen")
    (sides.filter("part >= 0").groupBy("part").applyInArrow(_match_sides, "chunk long, part int, bits binary")
     .groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias("answers")).write.parquet(path))
    seen = spark.read.parquet(path)
    drop_tables(spark, [sides_path])
    known = chunks.join(seen, "chunk", "left")
    entries = known.mapInArrow(_send_entries(parts, splitters, id_at, text_at), _ENTRIES)
    path = scratch_path(spark, "verdicts")
    (entries.groupBy("bucket").applyInArrow(_sort_bucket, "chunk long, bucket int, bits binary")
     .groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("verdicts")).write.parquet(path))
    verdicts = spark.read.parquet(path)
    own = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema.fields)]
    width, new = len(own), _NEW + _KEPT[kept]
    schema = T.StructType(own + [T.StructField(f"c{width + k}", t) for k, (_, t) in enumerate(new)])
    out = known.join(verdicts, "chunk", "left").mapInArrow(_finish(parts, splitters, id_at, text_at, kept), schema)
    return out, {n: F.col(f"c{width + k}") for k, (n, _) in enumerate(new)}
