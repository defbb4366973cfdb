"""Alignment of two tokenizers' tokens over a corpus (operator 11).

``A`` is a byte-level BPE file, ``B`` a sentencepiece model that puts a space
before each text; A encodes that space too, so both spell the same bytes. Byte
offsets where a token of A and a token of B both end cut a text into groups; the
two tokens that end a group together are a link.

Method: the identity-map fast path. An array gives for each id of A the id of B
with the same bytes. A group of one token of A and the one of B that this array
names is exact: its links are counted in a vector of the vocabulary's length,
one for each task. Only the links of other groups are shuffled as pairs.

1. Documents are read once. A text is cut before each space that follows a
   character other than white space: no token of either vocabulary crosses such a
   place, so a distinct piece is encoded and aligned once for each cache of
   ``CACHE`` pieces. A row for each document, with its exact links (A id, times)
   and its other links (pair, times), is written.
2. The vectors are summed by A id; the pairs are summed by pair, combined before
   the shuffle. The highest count for each id of B has one row for each id.
3. Exact links find their counts in the vector, sent out with the tasks (it is as
   long as a vocabulary, whatever the corpus). Other links join the pair table on
   the pair; a pair that is in every document is a skewed join, which Spark splits.

Defined cases: null and empty texts, and texts whose tokens of A or B do not spell
the space and the text (they hold U+2581, say), have no tokens: zeros and ''. Texts
that hold special strings take them as plain text. Rows that repeat count each; a
null doc_id is kept. Texts longer than ``SLICE`` characters are worked on in parts
cut at the places named above; a piece without such places is encoded whole. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import chain
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ..session import materialize
from ._ship import ready
from ._tokens import Vocabulary, default_path, vocabulary

SLICE = 1 << 20   # characters worked on at a time
CACHE = 200_000   # distinct pieces that a Python worker remembers
STACK = 100_000   # longer pieces go to the tokenizers library: tiktoken's matcher fails on long white space

#: a space that no token of either vocabulary spans from the left
_CUT = re.compile(r"(?<=\S) ")
_SPACE = "▁"


def default_piece_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Aligner:
    """Both vocabularies, the identity map and the pieces met, in one worker.

    ``number`` gives the pieces known their numbers. By number, ``name`` has a
    piece's groups as text ("a1,a2|b1;a3|b2;"), ``size`` its tokens of A and B,
    ``bad`` whether a vocabulary fails to spell it, and ``exact`` and ``other`` its
    links end to end (A ids, and A id * ``width`` + B id) with their bounds.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a: Vocabulary = vocabulary(a_path)
        self.b = SentencePieceProcessor(model_file=b_path)
        self.library: Tokenizer | None = None
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_SPACE in name.lstrip(_SPACE) for name in names):
            raise ValueError("pieces of this model hold a space inside: texts cannot be cut at spaces")
        byte = {f"<0x{k:02X}>": bytes([k]) for k in range(256)}
        fixed = {i for i in range(len(names)) if self.b.is_control(i) or self.b.is_unknown(i)}
        self.b_bytes = [b"" if i in fixed else byte[s] if self.b.is_byte(i) else s.replace(_SPACE, " ").encode()
                        for i, s in enumerate(names)]
        self.a_bytes = [b""] * (max(self.a.ids.values()) + 1)
        for raw, i in self.a.ids.items():
            self.a_bytes[i] = raw
        self.same = identity_map(self.a_bytes, self.b_bytes, {i for i in range(len(names)) if self.b.is_byte(i)})
        self.width = len(names)
        self.long_a, self.long_b = (np.array([len(x) for x in spelt], np.int64) for spelt in (self.a_bytes, self.b_bytes))
        self.shown = {end: np.array([f"{i}{end}" for i in range(max(len(self.a_bytes), self.width))], object) for end in ",|;"}
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.letters = 0
        self.name: list[str] = []
        self.size = np.zeros((0, 2), np.int64)
        self.bad = np.zeros(0, bool)
        self.exact = self.other = (np.zeros(0, np.int64), np.zeros(1, np.int64))

    def encode_a(self, text: str) -> list[int]:
        if len(text) <= STACK:
            return self.a.encoding.encode_ordinary(text)
        if self.library is None:
            self.library = Tokenizer.from_file(self.a.path)
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids

    def encode_b(self, piece: str) -> list[int]:
        return self.b.encode(piece) or [self.b.piece_to_id(_SPACE)]  # an empty piece is the space alone

    def learn(self, pieces: set[str]) -> None:
        """Number the pieces not known. Each stands for itself after a space."""
        if len(self.number) > CACHE or self.letters > 16 * SLICE:
            self.forget()
        new = list(pieces - self.number.keys())
        lost = {t for t in new if _SPACE in t}
        # a piece that ends in no white space can be followed by any other
        tied = [t for t in new if (not t or t[-1].isspace() or len(t) > SLICE // 16) and t not in lost]
        free = list(set(new) - set(tied) - lost) if tied or lost else new
        a, b = self._encode(free, True)
        if not self._spell(free, a, b):
            a, b, tied, free = [], [], free + tied, []
        good = list(free)
        for t in tied:
            x, y = self._encode([t], False)
            if self._spell([t], x, y):
                good.append(t)
                a += x
                b += y
            else:
                lost.add(t)
        if good:
            self._align(good, np.array(a, np.int64), np.array(b, np.int64))
        self._add(list(lost), [""] * len(lost), np.zeros((len(lost), 2), np.int64), True, *[(np.zeros(0, np.int64), np.zeros(len(lost), np.int64))] * 2)

    def _encode(self, pieces: list[str], at_once: bool) -> tuple[list[int], list[int]]:
        if not at_once:
            return self.encode_a(" " + pieces[0]), self.encode_b(pieces[0])
        a, b = [], []
        for k in range(0, len(pieces), 256):
            text = " ".join(pieces[k:k + 256])
            a += self.encode_a(" " + text)
            b += self.b.encode(text)
        return a, b

    def _spell(self, pieces: list[str], a: list[int], b: list[int]) -> bool:
        raw = "".join(f" {t}" for t in pieces).encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw

    def _align(self, pieces: list[str], a: np.ndarray, b: np.ndarray) -> None:
        """Cut the tokens of all pieces, end to end, into groups."""
        end_a, end_b = np.cumsum(self.long_a[a]), np.cumsum(self.long_b[b])
        last = np.cumsum([len(t.encode()) + 1 for t in pieces]).astype(np.int64)
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        stop_a, stop_b = np.searchsorted(end_a, both), np.searchsorted(end_b, both)
        n_a, n_b = np.diff(stop_a, prepend=-1), np.diff(stop_b, prepend=-1)
        exact = (n_a == 1) & (n_b == 1) & (self.same[a[stop_a]] == b[stop_b])
        piece = np.searchsorted(last, both)
        # the tokens as text, group after group: A's, a bar, B's
        shown = np.empty(len(a) + len(b), object)
        at_a = np.arange(len(a)) + np.repeat(stop_b + 1 - n_b, n_a)
        at_b = np.arange(len(b)) + np.repeat(stop_a + 1, n_b)
        shown[at_a], shown[at_b] = self.shown[","][a], self.shown[","][b]
        shown[at_a[stop_a]], shown[at_b[stop_b]] = self.shown["|"][a[stop_a]], self.shown[";"][b[stop_b]]
        stop_of = np.searchsorted(both, last)
        upto = stop_a[stop_of] + stop_b[stop_of] + 2
        tokens = shown.tolist()
        names = ["".join(tokens[i:j]) for i, j in zip([0, *upto.tolist()], upto.tolist())]
        size = np.stack([np.diff(stop_a[stop_of], prepend=-1), np.diff(stop_b[stop_of], prepend=-1)], axis=1)
        per = len(pieces)
        self._add(pieces, names, size, False,
                  (a[stop_a[exact]], np.bincount(piece[exact], minlength=per)),
                  (a[stop_a[~exact]] * self.width + b[stop_b[~exact]], np.bincount(piece[~exact], minlength=per)))

    def _add(self, pieces: list[str], names: list[str], size: np.ndarray, bad: bool, exact: tuple, other: tuple) -> None:
        self.number.update(zip(pieces, range(len(self.name), len(self.name) + len(pieces))))
        self.letters += sum(map(len, pieces))
        self.name += names
        self.size = np.concatenate([self.size, size])
        self.bad = np.concatenate([self.bad, np.full(len(pieces), bad)])
        for field, (link, n) in (("exact", exact), ("other", other)):
            had, bound = getattr(self, field)
            setattr(self, field, (np.concatenate([had, link]), np.concatenate([bound, bound[-1] + np.cumsum(n)])))


def identity_map(a_bytes: list[bytes], b_bytes: list[bytes], fallback: set[int]) -> np.ndarray:
    """For each id of A the id of B with the same bytes, or -1; of several, not
    the one that stands for a single byte that has no piece."""
    by_bytes: dict[bytes, int] = {}
    for i, raw in enumerate(b_bytes):
        if raw and (raw not in by_bytes or by_bytes[raw] in fallback):
            by_bytes[raw] = i
    return np.array([by_bytes.get(raw, -1) for raw in a_bytes], np.int64)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


# --- documents --------------------------------------------------------------

def _parts(text: str) -> Iterator[str]:
    """A long text in parts that begin and end where pieces do."""
    at = 0
    while len(text) - at > SLICE:
        cut = _CUT.search(text, at + SLICE)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of texts of at most SLICE characters, or one text."""
    a, size = 0, 0
    for k, t in enumerate(texts):
        n = len(t or "")
        if k > a and size + n > SLICE:
            yield a, k
            a, size = k, 0
        size += n
    if a < len(texts):
        yield a, len(texts)


@dataclass
class _Found:
    """Sums over the texts of one call, by text."""

    counts: np.ndarray                      # n_a, n_b, n_links in rows
    groups: list[str]
    whole: np.ndarray
    exact: tuple[np.ndarray, np.ndarray, np.ndarray]  # text, A id, times
    other: tuple[np.ndarray, np.ndarray, np.ndarray]  # text, pair, times


def _look(texts: list[str], with_: Aligner) -> _Found:
    pieces = [_CUT.split(t) for t in texts]
    with_.learn(set(chain.from_iterable(pieces)))
    index = [list(map(with_.number.__getitem__, p)) for p in pieces]
    long = np.array([len(p) for p in pieces], np.int64)
    text = np.repeat(np.arange(len(texts)), long)
    flat = np.fromiter(chain.from_iterable(index), np.int64, int(long.sum()))
    n_a, n_b = (np.bincount(text, with_.size[flat, k], len(texts)).astype(np.int64) for k in range(2))
    whole = np.bincount(text[with_.bad[flat]], minlength=len(texts)) == 0

    def spread(links: tuple[np.ndarray, np.ndarray], top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's distinct links and how often it holds them."""
        link, bound = links
        n = np.diff(bound)[flat]
        src = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bound[flat], n)
        key, times = np.unique(np.repeat(text, n) * top + link[src], return_counts=True)
        return key // top, key % top, times

    exact = spread(with_.exact, len(with_.same))
    other = spread(with_.other, len(with_.same) * with_.width)
    other = (other[0], other[1] // with_.width << 32 | other[1] % with_.width, other[2])
    n_links = sum(np.bincount(f[0], f[2], len(texts)) for f in (exact, other)).astype(np.int64)
    return _Found(np.stack([n_a, n_b, n_links]), ["".join(map(with_.name.__getitem__, i))[:-1] for i in index], whole, exact, other)


def _join(parts: list[_Found]) -> _Found:
    """One text that was worked on in parts."""
    def merge(found: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        link, at = np.unique(np.concatenate([f[1] for f in found]), return_inverse=True)
        return np.zeros(len(link), np.int64), link, np.bincount(at, np.concatenate([f[2] for f in found])).astype(np.int64)

    return _Found(sum(p.counts for p in parts), [";".join(p.groups[0] for p in parts)],
                  np.array([all(p.whole[0] for p in parts)]), merge([p.exact for p in parts]), merge([p.other for p in parts]))


def _lists(found: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, whole: np.ndarray, kind: pa.DataType) -> tuple[pa.Array, pa.Array]:
    text, link, times = found
    good = whole[text]
    text, link, times = text[good], link[good], times[good]
    off = pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32())
    return (pa.ListArray.from_arrays(off, pa.array(link, kind)), pa.ListArray.from_arrays(off, pa.array(times, pa.int32())))


_LINKS = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()),
          ("groups_sha256", T.StringType()),
          ("exact", T.ArrayType(T.IntegerType())), ("exact_times", T.ArrayType(T.IntegerType())),
          ("pairs", T.ArrayType(T.LongType())), ("pair_times", T.ArrayType(T.IntegerType()))]


def links(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row for each of ``docs`` (doc_id, text): its token, group and link
    counts, the digest of its groups, and its links: of exact groups by A id, of
    others by pair (A id << 32 | B id), with how often it holds each."""
    ready(docs.sparkSession)
    a_path, b_path = a_path or default_path(), b_path or default_piece_path()
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [T.StructField(n, t) for n, t in _LINKS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ = aligner(a_path, b_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _runs(texts):
                here = [t or "" for t in texts[a:b]]
                found = (_join([_look([p], with_) for p in _parts(here[0])])
                         if len(here) == 1 and len(here[0]) > SLICE else _look(here, with_))
                whole = found.whole & np.array([len(t) > 0 for t in here])
                n_a, n_b, n_links = (pa.array(np.where(whole, c, 0)) for c in found.counts)
                sha = [hashlib.sha256(g.encode()).hexdigest() if ok else "" for g, ok in zip(found.groups, whole)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), n_a, n_b, n_links, n_links, pa.array(sha, pa.string()),
                     *_lists(found.exact, len(here), whole, pa.int32()), *_lists(found.other, len(here), whole, pa.int64())],
                    schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _vectors(length: int):
    """Exact links of a task's documents, counted in one vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, np.int64)
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(ids, batch.column(1).flatten().to_numpy(zero_copy_only=False), length).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["a_id", "n"])

    return run


def pair_counts(found: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """How many links of the corpus hold each id pair: (a_id, b_id, n, top), with
    the highest count of the pair's B id. ``found`` is a written ``links`` table."""
    with_ = aligner(a_path or default_path(), b_path or default_piece_path())
    exact = (found.select("exact", "exact_times").mapInArrow(_vectors(len(with_.same)), "a_id long, n long")
             .groupBy("a_id").agg(F.sum("n").alias("n")))
    spark = found.sparkSession
    # as long as A's vocabulary
    same = spark.createDataFrame([(i, int(b)) for i, b in enumerate(with_.same) if b >= 0], "a_id long, b_id long")
    exact = exact.join(F.broadcast(same), "a_id").select("a_id", "b_id", "n")
    other = (found.select(F.explode(F.arrays_zip("pairs", "pair_times")).alias("x"))
             .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.pair_times").alias("n"))
             .select(F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b_id"), "n"))
    # by pair once more: a group that is not exact may end in an exact pair
    counts = materialize(exact.unionByName(other).groupBy("a_id", "b_id").agg(F.sum("n").alias("n")), "pairs")
    best = counts.groupBy("b_id").agg(F.max("n").alias("top"))  # as long as B's vocabulary
    return counts.join(F.broadcast(best), "b_id").select("a_id", "b_id", "n", "top")


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row for each of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups,
    n_links, n_best (links whose pair is as frequent in the corpus as any of its B
    id), count_sum (its links' corpus counts, summed), groups_sha256."""
    found = materialize(links(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()), "links")
    counts = materialize(pair_counts(found, a_path, b_path), "counts")
    same = aligner(a_path or default_path(), b_path or default_piece_path()).same
    named = docs.sparkSession.createDataFrame([(i, int(b)) for i, b in enumerate(same) if b >= 0], "a_id long, b_id long")
    n, best = np.zeros(len(same), np.int64), np.zeros(len(same), bool)
    for r in counts.join(F.broadcast(named), ["a_id", "b_id"]).toLocalIterator():  # as long as A's vocabulary
        n[r["a_id"]], best[r["a_id"]] = r["n"], r["n"] == r["top"]
    exact = found.drop("pairs", "pair_times").mapInArrow(
        _exact(n, best), T.StructType([f for f in found.schema.fields if f.name in _KEPT] + _SUMS))
    pair = F.shiftleft("a_id", 32).bitwiseOR(F.col("b_id")).alias("pair")
    other = (found.select("row", F.explode(F.arrays_zip("pairs", "pair_times")).alias("x"))
             .select("row", F.col("x.pairs").alias("pair"), F.col("x.pair_times").alias("times"))
             .join(counts.select(pair, "n", (F.col("n") == F.col("top")).alias("best")), "pair")
             .groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("more"),
                                 F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")))
    return exact.join(other, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("best_links") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("sum_links") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")


_KEPT = {"doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "row"}
_SUMS = [T.StructField("best_links", T.LongType()), T.StructField("sum_links", T.LongType())]


def _exact(n: np.ndarray, best: np.ndarray):
    """Counts of the exact links, from the vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("exact")
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            times = batch.column("exact_times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            total, tops = np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64)
            np.add.at(total, owner, times * n[ids])
            np.add.at(tops, owner, times * best[ids])
            kept = [c for c in batch.schema.names if c in _KEPT]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(tops), pa.array(total)],
                                             [*kept, "best_links", "sum_links"])

    return run
