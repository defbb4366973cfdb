import random

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_counts as K
from tidemark.llm._tokens import default_path, vocabulary

TOKENIZER = Tokenizer.from_file(default_path())


def library(text):
    return len(TOKENIZER.encode(text, add_special_tokens=False).ids)


def test_counts_of_awkward_rows(spark):
    rows = cases.awkward([(40, "<|endoftext|>"), (41, "a" * 3000)])
    got = sorted(map(tuple, K.token_counts(cases.frame(spark, rows)).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), library(t or "")) for i, t in rows), key=str)


PIECES = ["the", " ", "  ", "\n", "\t", "'s", "'ll", "'re", "'", "é", "日本", "12", " a", "<|endoftext|>", "##", "!", "\u3000", "xxxx", "re", "ll"]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_every_prefix(parts):
    text = "".join(parts)
    counts = K.prefixes(K.table(default_path()), text)
    for k in range(len(text) + 1):
        assert counts[len(text[:k].encode())] == library(text[:k])


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=30))
def test_whole_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert K.totals(K.table(default_path()), [text]) == [library(text)]
    assert K.prefixes(K.table(default_path()), text)[-1] == library(text)


def test_budget_questions(spark):
    text = "one two  three\nfour " * 20
    row = K.prefix_counts(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    raw = text.encode()
    for n in (0, 1, 7, 100, len(raw)):
        assert K.count_at(row.prefix, n) == library(raw[:n].decode())
    end = K.longest_prefix(row.prefix, 25)
    assert library(raw[:end].decode()) <= 25
    assert all(library(raw[:n].decode()) > 25 for n in range(end + 1, len(raw) + 1))


def test_words_forgotten_are_learned_again(monkeypatch):
    monkeypatch.setattr(K, "KEEP", 5)
    t = K.PrefixTable(vocabulary(default_path()))
    rng = random.Random(1)
    texts = [cases.prose(rng, 10) for _ in range(5)]
    for x in texts + texts:
        assert K.totals(t, [x]) == [library(x)]


LONG = ["日本語の長い文には空白がない" * 8, "ab" * 250, " " * 1000 + "x", "a" * 20_000, "the" * 400, "é" * 500]


@pytest.mark.parametrize("text", LONG, ids=range(len(LONG)))
def test_long_words(text):
    """Words of over WIDE bytes: totals of the library, and the vectorised DP's count at each prefix."""
    t = K.table(default_path())
    assert K.totals(t, [text]) == [library(text)]
    word = text.strip()[:60].encode()[:120]
    assert t.long_counts(word).tolist() == t.counts([word])[0].tolist()


def test_a_million_spaces_take_seconds():
    text = "a" + " " * 1_200_000 + "b<|endoftext|> c"
    counts = K.prefixes(K.table(default_path()), text)
    assert len(counts) == len(text) + 1 and counts[-1] == library(text)


def test_white_space_before_white_space():
    for text in ("a \tb", "a\n\n \u3000 b  c", " \t<|endoftext|> \tx", "\u3000\u3000x"):
        counts = K.prefixes(K.table(default_path()), text)
        for k in range(len(text) + 1):
            assert counts[len(text[:k].encode())] == library(text[:k])


def test_answers_from_the_stored_table(spark):
    rows = cases.awkward([(40, "word " * 3000), (41, "short")])
    got = K.answers(K.stored_counts(cases.frame(spark, rows)), 1024).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows if i in (40, 41)}
    for r in got:
        if r.doc_id in texts:
            raw = texts[r.doc_id].encode()
            assert (r.n_bytes, r.n_tokens) == (len(raw), library(texts[r.doc_id]))
            assert library(raw[:r.fit_bytes].decode()) <= 1024 and (r.fit_bytes == r.n_bytes) == (r.n_tokens <= 1024)


def test_empty_table(spark):
    assert K.token_counts(cases.frame(spark, cases.awkward()).limit(0)).count() == 0


@pytest.mark.parametrize("a,b", [("th", "e"), ("hel", "lo"), ("a", " b")])
def test_adjacent_tokens_are_those_bpe_leaves(a, b):
    import numpy as np
    t = K.table(default_path())
    x, y = t.vocab.ids[a.encode()], t.vocab.ids[b.encode()]
    kept = t.vocab.encoding._core_bpe.encode_single_piece((a + b).encode()) == [x, y]
    assert bool(t.adjacent(np.array([x]), np.array([y]))[0]) == kept


def test_answers_in_one_pass_are_those_of_the_parts():
    """Prefix counts may fall; blank runs are looked for only where two blanks meet."""
    for step in ([], [1] * 5, [1, 1, 1, -1, 1, 1, 1], [3], [1, 2, -2, 1]):
        x = np.array(step, "<i2").tobytes()
        for budget in (1, 2, 3, 9):
            assert K._totals(x, budget) == (len(step), K.count_at(x, len(step)), K.longest_prefix(x, budget))
