import random

import brute
import cases
import pytest

from tidemark.llm import near_dedup as N
from tidemark.llm._graph import components


def family(rng, n, words=150, edits=4, first=100):
    """Copies of copies: a chain-like group of near duplicates."""
    texts = [[f"w{rng.randint(0, 400)}" for _ in range(words)]]
    for _ in range(n - 1):
        t = list(rng.choice(texts))
        for _ in range(rng.randint(0, edits)):
            t[rng.randrange(len(t))] = f"e{rng.randint(0, 9999)}"
        texts.append(t)
    return [(first + k, " ".join(t)) for k, t in enumerate(texts)]


def result(docs):
    return sorted(map(tuple, N.near_duplicates(docs).collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = cases.awkward(family(rng, 60) + family(rng, 25, words=700, edits=12, first=500))
    assert result(cases.frame(spark, rows)) == sorted(brute.near_classes(rows), key=str)


def test_buckets_beyond_the_centers(spark, monkeypatch):
    """More members than centers: later rounds must find the same classes."""
    monkeypatch.setattr(N, "CENTERS", 3)
    rows = family(random.Random(4), 80, edits=3)
    assert result(cases.frame(spark, rows)) == sorted(brute.near_classes(rows), key=str)


@pytest.mark.parametrize("trust", [1, 0])
def test_less_trust_gives_the_same_links(spark, monkeypatch, trust):
    monkeypatch.setattr(N, "SURE", 2.0 if trust else N.SURE)
    monkeypatch.setattr(N, "BOTTOM", 64)  # most sets are judged by estimates
    rows = family(random.Random(8), 40, words=300, edits=5)
    assert result(cases.frame(spark, rows)) == sorted(brute.near_classes(rows), key=str)


def test_empty_table(spark):
    assert result(cases.frame(spark, []).limit(0)) == []


def test_similarity_is_found_at_the_threshold(spark):
    """Pairs at 0.85 to 0.88: none of two hundred is missed."""
    rng = random.Random(9)
    rows, pairs = [], []
    while len(pairs) < 200:
        w = [f"v{rng.randint(0, 10**6)}" for _ in range(120)]
        v = list(w)
        for k in rng.sample(range(10, 110), 2):
            v[k] = f"c{rng.randint(0, 10**6)}"
        a, b = brute.shingles(" ".join(w)), brute.shingles(" ".join(v))
        if 0.85 <= len(a & b) / len(a | b) <= 0.88:
            i = 2 * len(pairs)
            pairs.append((i, i + 1))
            rows += [(i, " ".join(w)), (i + 1, " ".join(v))]
    got = {r.doc_id: r.component_id for r in N.near_duplicates(cases.frame(spark, rows)).collect()}
    assert sum(got[b] == a for a, b in pairs) == 200


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (201, 202), (200, 202)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 30)} | {201: 200, 202: 200}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_repeated_rows_are_compared_once(spark, monkeypatch):
    """200 rows of one text and 200 of a near copy: one pair of texts is confirmed."""
    rng = random.Random(5)
    words = cases.prose(rng, 300).split()
    near = " ".join(words[:150] + ["changed"] + words[151:])
    seen, write = {}, N.materialize

    def watched(df, name="table"):
        seen[name] = write(df, name)
        return seen[name]

    monkeypatch.setattr(N, "materialize", watched)
    docs = spark.createDataFrame([(1, " ".join(words))] * 200 + [(2, near)] * 200, "doc_id long, text string")
    N._classes(docs).collect()
    assert seen["members"].count() == 2 and seen["confirmed"].count() == 1


def test_one_of_each_with_clashing_names(spark):
    text = cases.prose(random.Random(6), 40)
    docs = spark.createDataFrame([(1, text, "a", "x"), (1, text, "b", "y"), (2, "other words", "c", "z")],
                                 "doc_id long, text string, _id string, _digest string")
    out = N.one_of_each(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 2]
