"""Documents that hold every awkward case at once, with clashing extra columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, n_words long, score double, node long, key long, c0 string, "
          "kept boolean, chunk long, rank int, length long")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 8))) for _ in range(n))


def awkward(extra=()):
    """(doc_id, text) rows: nulls, empties, ties, repeats, near copies, a long text."""
    rng = random.Random(11)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "Changed"
    long = prose(rng, 30_000)
    rows = [(0, base), (1, base.upper()), (2, " ".join(near)), (3, None), (4, ""), (5, " \n\t "), (6, "one two"),
            (7, "one two"), (8, "x" * 5000), (9, long), (10, base + " " + prose(rng, 200)), (None, base),
            (None, None), (6, "one two"), (11, "y" * 99), (12, "z" * 100), (13, "z" * 150), (14, "日本語 " * 40),
            (15, prose(rng, 100) + base[:300] + prose(rng, 50)), (16, prose(rng, 4)), (17, "!!! ... ???")]
    return rows + list(extra)


def frame(spark, rows):
    full = [(i, t, None, -1, 0.5, 7, 8, "c", None, 3, 1, 9) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)
