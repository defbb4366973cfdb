import random
import zlib

import cases
import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing as P
from tidemark.llm._tokens import default_path, vocabulary


def check(rows, pieces, capacity):
    """Every piece is right, and every sequence is gapless and within capacity."""
    t = Tokenizer.from_file(default_path())
    want = []
    for doc, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)] if len(ids) > first else [0, len(ids)]
        want += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in pieces), key=str) == sorted(want, key=str)
    ends = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= capacity
    return len(ends)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pieces_and_sequences(spark, capacity):
    rows = cases.awkward([(30, "so <|endoftext|> it goes"), (31, "a" * 9000)])
    pieces = P.pack(cases.frame(spark, rows), capacity=capacity).collect()
    used = check(rows, pieces, capacity)
    least = -(-sum(r.length for r in pieces) // capacity)
    assert used <= least + 1


def test_full_and_short_documents():
    assert P.piece_bounds(2048) == [(0, 2048)]
    assert P.piece_bounds(2049) == [(0, 1), (1, 2048)]
    assert P.piece_bounds(5000) == [(0, 904), (904, 2048), (2952, 2048)]
    assert P.piece_bounds(1) == [(0, 1)]


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [(g, k) for k, g in enumerate(gaps) if g >= n]
        if fit:
            gaps[min(fit)[1]] -= n
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_best_fit_decreasing(seed):
    rng = random.Random(seed)
    lengths = [min(100, int(rng.lognormvariate(3, 1)) + 1) for _ in range(400)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    rows, used = P.fit_runs(counts, 100)
    assert used == best_fit_decreasing(lengths, 100)
    fill = {}
    for length, rank, count, first, offset in rows.tolist():
        for k in range(count):
            fill.setdefault(first + k, []).append((offset, length))
    assert sum(len(x) for x in fill.values()) == 400
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100


def test_empty_table(spark):
    assert P.pack(cases.frame(spark, cases.awkward()).limit(0)).count() == 0


def test_ids_equal_the_library():
    t = Tokenizer.from_file(default_path())
    v = vocabulary(default_path())
    for text in ["", " ", "a  b\n\n c", "it's we'll they've I'D", "日本語　ñandú 12345", "<|endoftext|>x<|endoftext|>", "!" * 300, "é" * 50]:
        assert v.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_cut_at_words_is_the_library():
    """The way for texts that the matcher gives up on, over texts that it can do."""
    t, v, rng = Tokenizer.from_file(default_path()), vocabulary(default_path()), random.Random(7)
    parts = ["the", " ", "  ", "\n", "'s", "'re", "é", "<|endoftext|>", "##", "12", " a", "\t" * 20_000]
    for _ in range(100):
        text = "".join(rng.choice(parts) for _ in range(15))
        assert v._by_words(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_white_space_of_a_million_characters():
    """More than the fast matcher can hold: the library's own ids all the same."""
    t = Tokenizer.from_file(default_path())
    text = "a" + " " * 1_200_000 + "b<|endoftext|> c"
    assert vocabulary(default_path()).encode(text).tolist() == t.encode(text, add_special_tokens=False).ids
