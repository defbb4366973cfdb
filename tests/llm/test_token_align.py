import hashlib
import random
from collections import Counter

import cases
import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import token_align as A


def spelling():
    """Token bytes of both vocabularies, read from the files by other means."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(x): x for x in shown}
    letter |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}
    return a, b, lambda i: bytes(letter[c] for c in a.id_to_token(i)), lambda i: (
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())


def brute(texts):
    a, b, raw_a, raw_b = spelling()
    seen, total = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if not text or b"".join(map(raw_a, ids_a)) != want or b"".join(map(raw_b, ids_b)) != want:
            seen.append(None)
            continue
        ends_a, ends_b = [], []
        for ids, raw, ends in ((ids_a, raw_a, ends_a), (ids_b, raw_b, ends_b)):
            at = 0
            for i in ids:
                at += len(raw(i))
                ends.append(at)
        both = sorted(set(ends_a) & set(ends_b))
        groups, links, p, q = [], [], 0, 0
        for e in both:
            x, y = ends_a.index(e, p), ends_b.index(e, q)
            groups.append(f"{','.join(map(str, ids_a[p:x + 1]))}|{','.join(map(str, ids_b[q:y + 1]))}")
            links.append((ids_a[x], ids_b[y]))
            p, q = x + 1, y + 1
        total.update(links)
        seen.append((len(ids_a), len(ids_b), groups, links))
    top = Counter()
    for (_, y), n in total.items():
        top[y] = max(top[y], n)
    out = []
    for s in seen:
        if s is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, found = s
        out.append((n_a, n_b, len(groups), len(found), sum(total[p] == top[p[1]] for p in found),
                    sum(total[p] for p in found), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out, total


ODD = ["a  b\tc\n d", "  lead", "trail  ", "ﬁ ① ½", "A▁B", "<s> x <0x41> </s>", "é é", "​ x", "a\xa0 b", "　 x  y",
       "\0 a", " ", "  ", "it's I'll  we've", "<|endoftext|> and <|endoftext|>", "日本語の文章 とても長い", "🙂🙃 👩‍👩‍👧 !?", "x\r\n  y\x1c z",
       "1234567 89,000.5 $ %", "a" * 700 + " b", "\n\n\n a", "привет мир", "\x85 q"]


def rows():
    rng = random.Random(5)
    return [*cases.awkward(), *[(100 + k, t) for k, t in enumerate(ODD)],
            *[(200 + k, "".join(rng.choice("ab \n\t.é日1'\xa0▁"[:12]) for _ in range(rng.randint(1, 60)))) for k in range(150)]]


def answer(frame):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


def test_small_parts_and_cache(monkeypatch):
    """Texts in parts of some 300 characters, a cache that keeps running over."""
    monkeypatch.setattr(A, "SLICE", 300)
    monkeypatch.setattr(A, "CACHE", 5)
    monkeypatch.setattr(A, "_aligners", {})
    with_ = A.aligner(A.default_path(), A.default_piece_path())
    texts = [t for _, t in rows() if t]
    for text, want in zip(texts, brute(texts)[0]):
        found = A._join([A._look([p], with_) for p in A._parts(text)])
        got = (*found.counts[:, 0], hashlib.sha256(found.groups[0].encode()).hexdigest()) if found.whole[0] else (0, 0, 0, "")
        assert got == (want[0], want[1], want[3], want[6]), text
        if found.whole[0]:
            assert found.exact[2].sum() + found.other[2].sum() == want[3]


def test_against_the_libraries(spark):
    data = rows()
    want, _ = brute([t for _, t in data])
    docs = cases.frame(spark, data).repartition(3)
    assert answer(A.align(docs)) == sorted(((i, *w) for (i, _), w in zip(data, want)), key=str)


def test_pair_counts(spark):
    data = rows()
    _, total = brute([t for _, t in data])
    found = A.materialize(A.links(cases.frame(spark, data)), "t")
    got = {(r["a_id"], r["b_id"]): (r["n"], r["top"]) for r in A.pair_counts(found).collect()}
    assert {k: n for k, (n, _) in got.items()} == total
    assert all(t == max(n for (_, y), n in total.items() if y == k[1]) for k, (_, t) in got.items())


def test_most_links_take_the_identity_map(spark):
    found = A.links(cases.frame(spark, [(1, "The quick brown fox jumps over the lazy dog again and again")])).first()
    assert sum(found["exact_times"]) > sum(found["pair_times"]) > 0
    assert found["n_links"] == sum(found["exact_times"]) + sum(found["pair_times"])


def test_runs_of_white_space(spark):
    text = "a" + " " * 1_200_000 + "b c" * 10
    a, b, *_ = spelling()
    r = A.align(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["n_a"] == len(a.encode(" " + text, add_special_tokens=False).ids) and r["n_b"] == len(b.encode(text))


def test_empty_table(spark):
    assert A.align(cases.frame(spark, cases.awkward()).limit(0)).count() == 0
