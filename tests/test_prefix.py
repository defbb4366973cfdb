"""Running values in blocks against a plain loop."""

import random

import pytest

from tidemark.operators import prefix as P


@pytest.mark.parametrize("bits", [1, 2, 12])
@pytest.mark.parametrize("exclusive", [False, True])
def test_running_values(spark, monkeypatch, bits, exclusive):
    monkeypatch.setattr(P, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    axis = sorted(rng.sample(range(200), 40))
    rows = [(a, rng.randint(-5, 9), rng.choice([None, 1, 7])) for a in axis]
    df = spark.createDataFrame(rows, "e long, x long, y long")
    got = P.running(df, "e", {"s": ("sum", "x"), "hi": ("max", "y"), "lo": ("min", "x"), "p": ("last", "x")}, exclusive)
    got = {r.e: (r.s, r.hi, r.lo, r.p) for r in got.collect()}
    for k, (e, _, _) in enumerate(rows):
        seen = rows[:k] if exclusive else rows[:k + 1]
        ys = [y for _, _, y in seen if y is not None]
        want = (sum(x for _, x, _ in seen), max(ys, default=None), min((x for _, x, _ in seen), default=None),
                seen[-1][1] if seen else None)
        assert got[e] == want


def test_following_across_blocks(spark):
    """The next value of the group, in its block or the first of a later one."""
    from tidemark.operators.prefix import BLOCK_BITS, following
    at = [0, 1, (1 << BLOCK_BITS) - 1, 1 << BLOCK_BITS, 5 << BLOCK_BITS]
    rows = [(g, a) for g in ("x", None) for a in at] + [("y", 7)]
    got = {(r.g, r.a): r.nxt for r in following(spark.createDataFrame(rows, "g string, a long"), ["g"], "a", "nxt").collect()}
    want = {(g, a): n for g in ("x", None) for a, n in zip(at, [*at[1:], None])} | {("y", 7): None}
    assert got == want
