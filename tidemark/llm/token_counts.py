"""Exact token counts at every prefix by dynamic programming (operator 5).

Method. A byte-level BPE never merges across words, so the count of a prefix is
that of the whole words before its end plus that of a part of one word. Within
a word: the last token of the prefix ending at byte i is the longest token t
ending there that BPE would leave next to the last token of the prefix without
t; then count[i] = count[i - len(t)] + 1. Whether two tokens may stand side by
side is decided by undoing their merges, youngest first: no pair across the
border may have a merge older than the one undone. The DP runs over all
distinct words of a slice at once, byte by byte; words of over ``WIDE`` bytes go
one by one through an Aho-Corasick automaton of the tokens, which names the
tokens that end at a byte, longest first. A worker keeps the counts of words it
has met, up to ``KEEP`` bytes of them.

``prefix_counts`` gives the count at every byte prefix of each text, as
differences; ``count_at``, ``longest_prefix`` and ``answers`` read truncation and
budget questions from it without the tokenizer.

Two places where a prefix is split into words differently from the whole text
are treated apart: the end of a run of white space (the text's next word takes
the last character, the prefix does not) and the inside of 're, 've, 'll.

Defined cases: null or empty text has no tokens and no bytes. A special string
inside a text is one token; a prefix ending inside it is ordinary text. At a
byte inside a character the count is that of the bytes up to there. Texts are
worked on in slices of a megabyte, or one text. Extra columns are ignored; a
null doc_id and repeated rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from typing import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import _bytes as B
from ._ship import ready
from ._tokens import PATTERN, Vocabulary, default_path, vocabulary

LIMIT = 1024
KEEP = 8 << 20  # of distinct words whose counts a worker keeps
KEEP_PAIRS = 1 << 20  # of pairs of tokens known to fit or not
WIDE = 48  # longer words go through the automaton
_WORDS = regex.compile(PATTERN)
_SPACES = re.compile(r"\s\s")  # two characters for which str.isspace holds
_CUT_INSIDE = (b"'re", b"'ve", b"'ll")  # fixed values: PATTERN's words that a cut turns into two


class PrefixTable:
    """Prefix counts of words under one vocabulary."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        n = max(vocab.ids.values()) + 1
        self.size = n
        self.longest = max(map(len, vocab.ids))
        self.left, self.right = np.arange(n), np.arange(n)
        pairs = np.array(vocab.merges, np.int64)
        self.left[pairs[:, 2]], self.right[pairs[:, 2]] = pairs[:, 0], pairs[:, 1]
        order = np.argsort(pairs[:, 0] * n + pairs[:, 1])
        self.pair, self.made = (pairs[:, 0] * n + pairs[:, 1])[order], pairs[order, 2]
        names, ids = list(vocab.ids), np.array(list(vocab.ids.values()), np.int64)
        size = np.array([len(x) for x in names])
        flat = np.frombuffer(b"".join(names), np.uint8)
        head = np.cumsum(size) - size
        pre = self._prefix(flat)
        h = self._hash(pre, self._inverse(len(pre)), head, size)
        order = np.argsort(h)
        self.name, self.id = h[order], ids[order]
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[(h >> np.uint64(46)).astype(np.int64)] = True
        self.known: dict[str | tuple[str, str], bytes] = {}
        self.known_bytes = 0
        self.automaton: ahocorasick.Automaton | None = None  # built for the first long word

    @staticmethod
    def _prefix(flat: np.ndarray) -> np.ndarray:
        out = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(B._BYTE[flat] * B.powers(B._BASE, len(flat)), out=out[1:])
        return out

    @staticmethod
    def _inverse(n: int) -> np.ndarray:
        return B.powers(np.uint64(pow(int(B._BASE), -1, 1 << 64)), n)

    @staticmethod
    def _hash(pre: np.ndarray, inv: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return B.mix((pre[at + size] - pre[at]) * inv[at] + size.astype(np.uint64))

    def _token(self, h: np.ndarray) -> np.ndarray:
        """Token ids of hashes; -1 where there is none."""
        out = np.full(len(h), -1, np.int64)
        i = np.flatnonzero(self.maybe[(h >> np.uint64(46)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.name, h[i]), len(self.name) - 1)
        hit = self.name[at] == h[i]
        out[i[hit]] = self.id[at[hit]]
        return out

    def adjacent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE of the joined bytes leaves tokens a and b as they are."""
        a, b = a.copy(), b.copy()
        ok = np.ones(len(a), bool)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        i = np.arange(len(a))
        while len(i):
            x, y = a[i], b[i]
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            merged = (self.pair[at] == key) & (self.made[at] < limit[i])
            ok[i[merged]] = False
            i, x, y = i[~merged], x[~merged], y[~merged]
            # undo the younger of the two merges; a byte cannot be undone
            from_left = x > y
            xl, yl = self.right[x], self.left[y]
            can_x, can_y = xl != x, yl != y
            use_x = np.where(from_left, can_x, ~can_y & can_x)
            use_y = ~use_x & can_y
            limit[i] = np.where(use_x, x, y + 1)
            a[i] = np.where(use_x, xl, x)
            b[i] = np.where(use_y, yl, y)
            i = i[use_x | use_y]
        return ok

    def counts(self, words: list[bytes]) -> list[np.ndarray]:
        """For each word the counts at its 1, 2, ... len(word) first bytes."""
        size = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        head = np.cumsum(size) - size
        pre, inv = self._prefix(flat), self._inverse(len(flat) + 1)
        count = np.zeros(len(flat), np.int32)
        last = np.zeros(len(flat), np.int64)
        by_size = np.argsort(-size, kind="stable")
        ends = np.searchsorted(-size[by_size], -np.arange(1, int(size.max()) + 1), side="right")
        for i in range(1, int(size.max()) + 1):
            open_ = by_size[:ends[i - 1]]  # words of at least i bytes, no token found yet
            for t in range(min(i, self.longest), 0, -1):
                if not len(open_):
                    break
                at = head[open_] + i - t
                token = self._token(self._hash(pre, inv, at, np.full(len(at), t)))
                k = np.flatnonzero(token >= 0)
                if t < i and len(k):
                    k = k[self.adjacent(last[at[k] - 1], token[k])]
                end = head[open_[k]] + i - 1
                last[end] = token[k]
                count[end] = (count[at[k] - 1] if t < i else 0) + 1
                keep = np.ones(len(open_), bool)
                keep[k] = False
                open_ = open_[keep]
        ends = np.cumsum(size).tolist()
        return [count[a:b] for a, b in zip([0, *ends], ends)]

    def _prepare(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for name, i in self.vocab.ids.items():
            self.automaton.add_word(name.decode("latin-1"), (i, len(name)))
        self.automaton.make_automaton()
        self.merge = dict(zip(self.pair.tolist(), self.made.tolist()))
        self.parts = self.left.tolist(), self.right.tolist()
        self.fits: dict[int, bool] = {}

    def _fit(self, a: int, b: int) -> bool:
        """``adjacent`` for one pair of tokens."""
        left, right = self.parts
        limit = self.size + 1
        while True:
            if self.merge.get(a * self.size + b, limit) < limit:
                return False
            can_a, can_b = right[a] != a, left[b] != b
            if can_a and (a > b or not can_b):  # the younger of the two merges is undone
                limit, a = a, right[a]
            elif can_b:
                limit, b = b + 1, left[b]
            else:
                return True

    def long_counts(self, word: bytes) -> np.ndarray:
        """``counts`` of one word, in time that grows with its length."""
        if self.automaton is None:
            self._prepare()
        count, last = array("i", bytes(4 * len(word))), array("i", bytes(4 * len(word)))
        fits, size = self.fits, self.size
        for end, (token, t) in self.automaton.iter(word.decode("latin-1")):
            if count[end]:
                continue  # a longer token ends here
            before = end - t
            if before >= 0:
                key = last[before] * size + token
                ok = fits.get(key)
                if ok is None:
                    if len(fits) >= KEEP_PAIRS:
                        fits.clear()
                    ok = fits[key] = self._fit(last[before], token)
                if not ok:
                    continue
            last[end] = token
            count[end] = (count[before] if before >= 0 else 0) + 1
        return np.frombuffer(count, np.int32)

    def by_word(self, words: set[str]) -> Iterator[tuple[str, np.ndarray]]:
        """The prefix counts of each word, in no particular order."""
        names = sorted(words, key=len)
        raw = [w.encode() for w in names]
        short = [k for k, x in enumerate(raw) if len(x) <= WIDE]
        for a in range(0, len(short), 50_000):
            g = short[a:a + 50_000]
            for k, c in zip(g, self.counts([raw[k] for k in g])):
                yield names[k], c
        for name, x in zip(names, raw):
            if len(x) > WIDE:
                yield name, self.long_counts(x)

    def one(self, word: bytes) -> np.ndarray:
        return self.counts([word])[0] if len(word) <= WIDE else self.long_counts(word)

    def learn(self, words: set[str]) -> None:
        """Make sure that ``known`` has the counts (as int32) of all of these words."""
        if self.known_bytes > KEEP:
            self.known.clear()
            self.known_bytes = 0
        for w, c in self.by_word(words - self.known.keys()):
            if w[0] == "'" and w.encode() in _CUT_INSIDE:
                c = c.copy()
                c[1] = sum(int(self.one(x.encode())[-1]) for x in ("'", w[1]))
            self.known[w] = c.astype("<i4", copy=False).tobytes()
            self.known_bytes += len(c)

    def after_space(self, before: str, word: str) -> bytes:
        """The counts of a word that begins with white space and follows a word
        of white space: a prefix that ends with the first character takes it
        into the run before."""
        key = before, word
        if key not in self.known:
            c = np.frombuffer(self.known[word], "<i4").copy()
            n = len(word[0].encode())
            c[:n] = self.one((before + word[0]).encode())[-n:] - np.frombuffer(self.known[before], "<i4")[-1]
            self.known[key] = c.tobytes()
            self.known_bytes += len(c)
        return self.known[key]


_tables: dict[str, PrefixTable] = {}


def table(path: str) -> PrefixTable:
    if path not in _tables:
        _tables[path] = PrefixTable(vocabulary(path))
    return _tables[path]


def _parts(t: PrefixTable, text: str) -> list[tuple[bool, str]]:
    """The text cut at its special strings: (is special, string)."""
    cut = t.vocab.split_special
    if cut is None or not cut.search(text):
        return [(False, text)]
    out, at = [], 0
    for m in cut.finditer(text):
        out += [(False, text[at:m.start()]), (True, m.group())]
        at = m.end()
    return [p for p in out + [(False, text[at:])] if p[1]]


def prefixes_of(t: PrefixTable, texts: list[str]) -> list[np.ndarray]:
    """Token count of every byte prefix of each text (len = bytes + 1)."""
    split = [_parts(t, x) for x in texts]
    words = [[[] if special else _WORDS.findall(s) for special, s in p] for p in split]
    t.learn(set().union(*(ws for p in words for ws in p)))
    return [_prefix(t, p, ws) for p, ws in zip(split, words)]


def prefixes(t: PrefixTable, text: str) -> np.ndarray:
    return prefixes_of(t, [text])[0]


def totals(t: PrefixTable, texts: list[str]) -> list[int]:
    return [int(c[-1]) for c in prefixes_of(t, texts)]


def _prefix(t: PrefixTable, split: list[tuple[bool, str]], words: list[list[str]]) -> np.ndarray:
    known = t.known.__getitem__
    out, base, before = [np.zeros(1, np.int32)], 0, None  # before: the word that ends here, if any
    for (special, s), ws in zip(split, words):
        if special:
            # a prefix that ends inside is ordinary text, read on from the word before
            lead = base - int(np.frombuffer(known(before), "<i4")[-1]) if before else base
            inside = [lead + len(t.vocab.encoding.encode_ordinary((before or "") + s[:k])) for k in range(1, len(s))]
            out.append(np.array([*inside, base + 1], np.int64))
            base, before = base + 1, None
            continue
        if not ws:
            continue
        cells = list(map(known, ws))
        size = np.fromiter(map(len, cells), np.int64, len(cells)) >> 2
        flat = np.frombuffer(b"".join(cells), "<i4")
        total = flat[np.cumsum(size) - 1].astype(np.int64)
        start = base + np.cumsum(total) - total
        blank = {w for w in set(ws) if w.isspace()} if _SPACES.search(s) else ()
        apart = [k + 1 for k, w in enumerate(ws[:-1]) if w in blank and ws[k + 1][0].isspace()] if blank else ()
        if apart:
            for k in apart:
                cells[k] = t.after_space(ws[k - 1], ws[k])
            flat = np.frombuffer(b"".join(cells), "<i4")
        out.append(flat + np.repeat(start.astype(np.int32), size))
        base, before = int(start[-1] + total[-1]), ws[-1]
    return np.concatenate(out)


def _rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table(path)
        for batch in batches:
            _, off = B.buffers(batch.column(1))
            for a, b in B.slices(off):
                texts = [x or "" for x in batch.column(1).slice(a, b - a).to_pylist()]
                cells = [np.diff(c).astype("<i2").tobytes() for c in prefixes_of(t, texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(cells, pa.large_binary()).cast(pa.binary())],
                                                 ["doc_id", "prefix"])

    return run


def _answers(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [x.as_buffer() for x in batch.column(1)]
            rows = [_totals(x, budget) for x in cells]
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_tokens", "fit_bytes"])

    return run


def prefix_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, text) rows -> doc_id, prefix: the differences between the token
    counts of adjacent byte prefixes, as little-endian int16."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_rows(tokenizer or default_path()), "doc_id long, prefix binary")


def answers(stored: DataFrame, budget: int) -> DataFrame:
    """A ``prefix_counts`` table -> doc_id, n_bytes, n_tokens, fit_bytes (bytes of
    the longest prefix of at most ``budget`` tokens) of each row."""
    ready(stored.sparkSession)
    return stored.select("doc_id", "prefix").mapInArrow(_answers(budget), "doc_id long, n_bytes long, n_tokens long, fit_bytes long")


def stored_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``prefix_counts``, written once to the shared folder and read back."""
    return materialize(prefix_counts(docs, tokenizer), "prefixes")


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, text) rows -> doc_id, n_bytes, n_tokens of each row, read from
    stored prefix counts."""
    return answers(stored_counts(docs, tokenizer), LIMIT).drop("fit_bytes")


def _totals(prefix: bytes, budget: int) -> tuple[int, int, int]:
    """Bytes, ``count_at`` their end and ``longest_prefix``, in one pass."""
    count = np.cumsum(np.frombuffer(prefix, "<i2"), dtype=np.int32)
    if not len(count) or count[-1] <= budget:
        return len(count), int(count[-1]) if len(count) else 0, len(count)
    fits = count[::-1] <= budget
    at = int(fits.argmax())
    return len(count), int(count[-1]), len(count) - at if fits[at] else 0


def count_at(prefix: bytes, n_bytes: int) -> int:
    """Tokens of the first ``n_bytes`` bytes."""
    return int(np.frombuffer(prefix, "<i2")[:n_bytes].sum(dtype=np.int64))


def longest_prefix(prefix: bytes, budget: int) -> int:
    """Bytes of the longest prefix of at most ``budget`` tokens."""
    count = np.concatenate([[0], np.cumsum(np.frombuffer(prefix, "<i2"), dtype=np.int64)])
    return int(np.flatnonzero(count <= budget)[-1])
