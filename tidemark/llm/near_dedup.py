"""MinHash near-duplicate classes by tensored banding (operator 9).

Method. A document's set is its distinct five-word shingles. Equal sets are
merged first. Of every set, two groups of ``COLLECTIONS`` small hash
collections of ``HALF`` minhashes are computed; table (i, j) joins collection i
of the first group with collection j of the second, so 2 * COLLECTIONS * HALF
minhashes serve COLLECTIONS ** 2 tables of 2 * HALF minhashes. Two sets with
Jaccard 0.85 share a key unless all collections of one group differ: 3e-4; at
0.9, 9e-6.

Rows are dealt by the first half of the key only, one row for each collection
of the first group; inside such a bucket the second halves tell which tables a
pair shares, and the pair is looked at in the first of them alone. It is then
judged by the ``BOTTOM`` smallest hashes of both sets: all of them in sets of
that size or less, else an estimate (deviation 0.015) that must reach
``LEAST``. Pairs already joined by links found in the same batch are passed
over, so a group of copies yields about as many links as members, not pairs.
Links are confirmed on the full shingle sets, then contracted to components.

A bucket is streamed; its first ``CENTERS`` members are held and meet every
member. Members beyond those go through further rounds, without the pairs that
are in one component by then, until no bucket has members left that have not
met or more than one component. No pair is dropped.

Defined cases: null or empty text, or text without words: empty set, a class
of its own. Null doc_id: takes part; its component_id is the smallest non-null
doc_id of its class, or null. Repeated rows: one class, each row returned.
Extra columns are ignored by ``near_duplicates``. An empty table gives no rows.
doc_id need not name a row: ``one_of_each`` goes by class, and knows a row by
its doc_id and a 128-bit digest of its text.
"""

from __future__ import annotations

import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, settle, written
from . import _bytes as B
from ._graph import components
from ._ship import ready

SHINGLE = 5
COLLECTIONS = 12
HALF = 4
CENTERS = 2048
BOTTOM = 512
LEAST = 0.78  # estimated Jaccard of sets over BOTTOM that is looked at further
SURE = 0.93  # estimate from which a pair counts as joined while its link is unconfirmed
SIMILARITY = 85  # per cent

_HASHES = 2 * COLLECTIONS * HALF
_RNG = np.random.default_rng(97)
_XOR = _RNG.integers(0, 1 << 32, _HASHES, dtype=np.uint32)
_MUL = _RNG.integers(0, 1 << 31, _HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice."""
    h, _, _, owner = B.words(data, off, "space")
    bound = np.searchsorted(owner, np.arange(len(off)))
    runs = B.run_hash(h, SHINGLE)
    out = []
    for a, b in zip(bound[:-1], bound[1:]):
        if b - a >= SHINGLE:
            s = np.sort(runs[a:b - SHINGLE + 1])
            keep = np.ones(len(s), bool)
            keep[1:] = s[1:] != s[:-1]
            out.append(s[keep])
        elif b > a:
            out.append(np.array([B.sequence_hash(h[a:b])], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> bytes:
    """128 bits that name a set; empty for the empty set."""
    if not len(s):
        return b""
    return np.array([s.sum(dtype=np.uint64), B.mix(s).sum(dtype=np.uint64)]).tobytes()


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), _HASHES) minhash values; all sets non-empty."""
    flat = np.concatenate(sets)
    x = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    heads = np.concatenate([[0], np.cumsum([len(s) for s in sets[:-1]])]).astype(np.int64)
    out = np.empty((len(sets), _HASHES), np.uint32)
    step = 1 << 16  # of shingles, so that the work stays in the cache
    cuts = np.searchsorted(heads, np.arange(0, len(x), step))
    cuts = np.unique(np.append(cuts, len(heads)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo, hi = heads[a], heads[b] if b < len(heads) else len(x)
        part, at = x[lo:hi], heads[a:b] - lo
        for k in range(_HASHES):
            out[a:b, k] = np.minimum.reduceat((part ^ _XOR[k]) * _MUL[k], at)
    return out


_SIG_SCHEMA = "doc_id long, digest binary, n_shingles long, set_key binary, halves binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = B.buffers(batch.column(2))
        for a, b in B.slices(off):
            sets = shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a])
            full = [i for i, s in enumerate(sets) if len(s)]
            halves: list[bytes | None] = [None] * len(sets)
            if full:
                parts = _signatures([sets[i] for i in full]).reshape(len(full), 2 * COLLECTIONS, HALF).astype(np.uint64)
                h = np.zeros(parts.shape[:2], np.uint64)
                for k in range(HALF):
                    h = h * B._STEP + parts[:, :, k]
                for row, i in zip(B.mix(h), full):
                    halves[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_key(s) for s in sets], pa.binary()), pa.array(halves, pa.binary()),
            ], ["doc_id", "digest", "n_shingles", "set_key", "halves"])


def _half_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, halves) rows -> one (key, collection, node) row for each
    collection of the first group."""
    which = np.arange(COLLECTIONS, dtype=np.uint64)
    for batch in batches:
        h = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(batch.num_rows, -1)[:, :COLLECTIONS]
        keys = B.mix(h + which * B._STEP).reshape(-1)
        node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), COLLECTIONS)
        table = np.tile(np.arange(COLLECTIONS, dtype=np.int8), batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(B.as_long(keys)), pa.array(table), pa.array(node)], ["key", "collection", "node"])


_MEMBER = "node long, size long, prints binary, bottom binary, set_key binary, text string"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, halves, set_key, text) rows -> what the buckets compare."""
    for batch in batches:
        data, off = B.buffers(batch.column(3))
        for a, b in B.slices(off):
            sets = shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a])
            part = batch.slice(a, b - a)
            keep, prints, bottom = [], [], []
            for s, key, h in zip(sets, part.column(2).to_pylist(), part.column(1).to_pylist()):
                keep.append(set_key(s) == key)  # else another text of the same doc_id
                prints.append((np.frombuffer(h, np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes())
                low = np.unique((B.mix(s) >> np.uint64(32)).astype(np.uint32))
                bottom.append(low[:BOTTOM].tobytes())
            out = pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(bottom, pa.binary()), part.column(2), part.column(3)],
                ["node", "size", "prints", "bottom", "set_key", "text"])
            yield out.filter(pa.array(keep, pa.bool_()))


class _Rows:
    """Rows of one or more buckets, in key and rank order."""

    def __init__(self, key, collection, node, size, comp, prints, bottom):
        self.key, self.collection, self.node, self.size, self.comp, self.prints, self.bottom = key, collection, node, size, comp, prints, bottom

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> "_Rows":
        key, collection, node, size, comp = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
        prints = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint32).reshape(-1, 2 * COLLECTIONS)
        return cls(key, collection, node, size, comp, prints, batch.column(6).to_pylist())

    def take(self, a: int, b: int) -> "_Rows":
        return _Rows(*(x[a:b].copy() if isinstance(x, np.ndarray) else x[a:b] for x in vars(self).values()))

    def after(self, held: "_Rows") -> "_Rows":
        return _Rows(*(np.concatenate([x, y]) if isinstance(x, np.ndarray) else x + y
                       for x, y in zip(vars(held).values(), vars(self).values())))


class _Judge:
    """Estimated or exact Jaccard of pairs of rows, from their smallest hashes."""

    def __init__(self, rows: _Rows):
        lists = [np.frombuffer(x, np.uint32) for x in rows.bottom]
        self.length = np.array([len(x) for x in lists], np.int64)
        self.head = np.cumsum(self.length) - self.length
        self.value = np.concatenate(lists).astype(np.uint64)
        self.tagged = self.value | np.repeat(np.arange(len(lists), dtype=np.uint64), self.length) << np.uint64(32)
        last = self.value[self.head + self.length - 1]
        self.limit = np.where(rows.size > BOTTOM, last, np.uint64(0xFFFFFFFF))
        self.size = rows.size

    def __call__(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Jaccard of each pair, and whether it is that of the full sets."""
        out = np.zeros(len(i))
        step = max(1, (1 << 20) // BOTTOM)
        limit = np.minimum(self.limit[i], self.limit[j])
        for a in range(0, len(i), step):
            x, y, lim = i[a:a + step], j[a:a + step], limit[a:a + step]
            n = self.length[y]
            src = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.head[y], n)
            pair = np.repeat(np.arange(len(x)), n)
            value = self.value[src]
            value_ok = value <= lim[pair]
            want = value | x[pair].astype(np.uint64) << np.uint64(32)
            at = np.minimum(np.searchsorted(self.tagged, want), len(self.tagged) - 1)
            both = np.bincount(pair, (self.tagged[at] == want) & value_ok, len(x))
            of_y = np.bincount(pair, value_ok, len(x))
            of_x = np.searchsorted(self.tagged, lim | x.astype(np.uint64) << np.uint64(32), side="right") - self.head[x]
            out[a:a + step] = both / np.maximum(of_x + of_y - both, 1)
        return out, (self.size[i] <= BOTTOM) & (self.size[j] <= BOTTOM)


def _bucket_links(trust: int):
    """Rows (key, collection, node, size, comp, prints, bottom) in key and rank
    order -> (u, v, sure) pairs that are, or may be, links. trust: which pairs
    count as joined at once; 2 also those of a high estimate, 1 those judged on
    all hashes of both sets, 0 none."""

    def links(rows: _Rows, fresh: int) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """Pairs of a held or earlier member with one from ``fresh`` on."""
        n = len(rows.key)
        place = np.arange(n)
        new = np.ones(n, bool)
        new[1:] = rows.key[1:] != rows.key[:-1]
        start = np.maximum.accumulate(np.where(new, place, 0))
        judge = None
        _, name = np.unique(rows.node, return_inverse=True)
        parent = np.arange(name.max() + 1)
        root = parent[name]
        found: tuple[list, list, list] = ([], [], [])
        left, right = rows.prints[:, :COLLECTIONS], rows.prints[:, COLLECTIONS:]
        open_ = np.flatnonzero((place >= fresh) & (place > start))
        for c in range(CENTERS):
            open_ = open_[start[open_] + c < open_]
            if not len(open_):
                break
            i, j = start[open_] + c, open_
            ok = (root[i] != root[j]) & (rows.comp[i] != rows.comp[j])
            ok &= 100 * np.minimum(rows.size[i], rows.size[j]) >= SIMILARITY * np.maximum(rows.size[i], rows.size[j])
            i, j = i[ok], j[ok]
            ok = (right[i] == right[j]).any(1)
            i, j = i[ok], j[ok]
            ok = (left[i] == left[j]).argmax(1) == rows.collection[j]
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            judge = judge or _Judge(rows)
            value, exact = judge(i, j)
            link = np.where(exact, 100 * value >= SIMILARITY - 1e-6, value >= LEAST)
            sure = ((exact & (trust > 0)) | ((value >= SURE) & (trust > 1)))[link]
            i, j = i[link], j[link]
            found[0].append(rows.node[i])
            found[1].append(rows.node[j])
            found[2].append(sure)
            for a, b in zip(name[i[sure]].tolist(), name[j[sure]].tolist()):
                while parent[a] != a:
                    a = parent[a]
                while parent[b] != b:
                    b = parent[b]
                parent[max(a, b)] = min(a, b)
            if sure.any():
                while (up := parent[parent]).tobytes() != parent.tobytes():
                    parent = up
                root = parent[name]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Rows | None = None  # the first members of the last key
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, fresh = _Rows.of(batch), 0
            if held is not None and held.key[0] == rows.key[0]:
                fresh = len(held.key)
                rows = rows.after(held)
            u, v, sure = links(rows, fresh)
            if u:
                pair = np.sort(np.stack([np.concatenate(u), np.concatenate(v)]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1]), pa.array(np.concatenate(sure))], ["u", "v", "sure"])
            tail = int(np.flatnonzero(rows.key == rows.key[-1])[0])
            held = rows.take(tail, tail + CENTERS)

    return run


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = []
        for column in (3, 4):
            data, off = B.buffers(batch.column(column))
            sides.append([s for a, b in B.slices(off) for s in shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a])])
        holds = []
        for x, y in zip(*sides):
            both = len(np.intersect1d(x, y, assume_unique=True))
            holds.append(100 * both >= SIMILARITY * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(holds, pa.bool_())], ["u", "v", "sure", "holds"])


def _digest(text: Column) -> Column:
    """128 bits that, with its doc_id, name a row's text."""
    return F.unhex(F.md5(text.cast("string").cast("binary")))


def _name(doc_id: Column, digest: Column) -> Column:
    """One value for doc_id (null too) and digest, to join rows by; null without text."""
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")).cast("binary"), digest)


def _order() -> Column:
    """Rows by doc_id, nulls last, then by digest."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("digest"))


def _classes(docs: DataFrame) -> DataFrame:
    """(doc_id, text) rows -> (doc_id, digest, n_shingles, component_id, root),
    one row per input row; root names the row's class and is null for the empty
    set."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest(F.col("text")).alias("digest"),
                       F.col("text").cast("string").alias("text"))
    signed = materialize(docs.mapInArrow(_sign, _SIG_SCHEMA), "signatures")
    sets = materialize(
        signed.filter("n_shingles > 0").groupBy("set_key").agg(F.min(_order()).alias("first"), F.first("halves").alias("halves"))
        .select("set_key", "halves", F.col("first.doc_id").alias("low"), F.col("first.digest").alias("low_digest"))
        .withColumn("node", F.monotonically_increasing_id()), "sets")
    by_key = Window.partitionBy("key")
    buckets = materialize(
        sets.select("node", "halves").mapInArrow(_half_keys, "key long, collection byte, node long")
        .withColumn("n", F.count(F.lit(1)).over(by_key)).filter("n > 1")
        .withColumn("rank", F.row_number().over(by_key.orderBy("node")) - 1), "buckets")
    members = buckets.select("node").distinct().join(sets, "node").select(
        "node", "halves", "set_key", _name(F.col("low"), F.col("low_digest")).alias("name"))
    members = materialize(docs.select(_name(F.col("doc_id"), F.col("digest")).alias("name"), "text")
                          .join(members.hint("merge"), "name")  # the same plan at every size
                          .dropDuplicates(["name"])  # rows that repeat: one each, where the join has put them
                          .select("node", "halves", "set_key", "text").mapInArrow(_describe, _MEMBER), "members")
    links, labels, trust = None, None, 2
    while True:
        known = buckets if labels is None else buckets.join(labels, "node", "left")
        known = known.withColumn("comp", F.col("node") if labels is None else F.coalesce("root", "node"))
        rows = (known.join(members.select("node", "size", "prints", "bottom"), "node")
                .select("key", "collection", "node", "size", "comp", "prints", "bottom", "rank")
                .repartition("key").sortWithinPartitions("key", "rank").drop("rank"))
        pairs = materialize(rows.mapInArrow(_bucket_links(trust), "u long, v long, sure boolean")
                            .groupBy("u", "v").agg(F.max("sure").alias("sure")), "pairs")
        one = members.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
        two = members.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
        judged = materialize(pairs.join(one, "u").join(two, "v").select("u", "v", "sure", "text_u", "text_v")
                             .mapInArrow(_confirm, "u long, v long, sure boolean, holds boolean"), "confirmed")
        found = judged.filter("holds").select("u", "v").distinct()
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if not judged.filter("sure and not holds").isEmpty():
            trust -= 1  # pairs may have been passed over for a link that does not hold: once more, trusting less
            continue
        # buckets with members that no center has met, and more than one component
        rest = (buckets.filter(F.col("n") > CENTERS).filter(F.col("rank") >= CENTERS)
                .withColumn("rank", F.col("rank") - CENTERS).withColumn("n", F.col("n") - CENTERS))
        mixed = (rest.join(labels, "node", "left").groupBy("key")
                 .agg(F.min(F.coalesce("root", "node")).alias("a"), F.max(F.coalesce("root", "node")).alias("b")).filter("a != b"))
        buckets = materialize(rest.join(mixed.select("key"), "key", "left_semi"), "buckets")
        if buckets.isEmpty():
            break
    classes = sets.select("set_key", "node", "low").join(labels, "node", "left").select(
        "set_key", "low", F.coalesce("root", "node").alias("root"))
    lows = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = classes.select("set_key", "root").join(lows, "root").select("set_key", "component_id", "root")
    out = signed.select("doc_id", "digest", "n_shingles", "set_key").join(classes, "set_key", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "digest", "n_shingles", own.alias("component_id"), "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text) rows -> (doc_id, n_shingles, component_id, kept), one row
    per input row. component_id is the smallest doc_id of the class."""
    mark = written()
    out = _classes(docs)
    return settle(out.select("doc_id", "n_shingles", "component_id",
                             F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")), mark, "classes")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, columns unchanged: that of the
    smallest doc_id (nulls last), then of the smallest digest. Rows equal in
    both have one text; one of them stays. Rows of the empty set all stay."""
    mark = written()
    keys = settle(_classes(docs).filter("root IS NOT NULL").groupBy("root", "doc_id", "digest").agg(F.count(F.lit(1)).alias("rows")), mark, "keys")
    first = keys.groupBy("root").agg(F.min(_order()).alias("first"), F.sum("rows").alias("rows")).filter("rows > 1").drop("rows")
    own = f"name_{uuid.uuid4().hex}"  # no column of the table has such a name
    shared = keys.join(first, "root").select(_name(F.col("doc_id"), F.col("digest")).alias(own), "rows", (_order() == F.col("first")).alias("stays"))
    shared = materialize(shared, "shared")
    name = _name(docs["doc_id"].cast("long"), _digest(docs["text"]))
    # rows that go, and those of which several equal ones are there
    aside = shared.filter("NOT stays OR rows > 1").select(own)
    out = docs.join(aside.hint("merge"), name == aside[own], "left_anti")
    equal = shared.filter("stays AND rows > 1").select(own)
    if equal.isEmpty():
        return out
    # the documents are dealt once: both joins read the same exchange
    return out.unionByName(docs.join(equal.hint("merge"), name == equal[own]).dropDuplicates([own]).select(*[docs[c] for c in docs.columns]))
