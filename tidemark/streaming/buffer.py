"""The rows a stream holds back, as immutable sorted runs with cursors.

Each poll's arrivals are written once, as a run sorted by buffer key. A release
takes a prefix of the buffer in that order, so what is left of a run is what lies
above its cursor: the largest bound released since the run was written. Nothing is
rewritten to release rows. Runs are merged as in a logarithmic structure: the
newest ones, once ``FAN`` of them are each no larger than those after them together.
A row that is merged then lies in a run at least twice as large, so it is written at
most log2(rows held) times more, however many polls it waits.

A run's index, a few timestamps with the rows up to them, tells how far a capped
release has to look; parquet row groups are skipped by the same bounds.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.release import BUFFER_KEY

FAN = 4
MARKS = 64          # entries of a run's index
FOREVER = 1 << 62   # above any poll: a bound that takes in every row of its timestamp

Key = tuple  # (timestamp_ms, arrival_epoch, topic, partition, offset)


@dataclass(frozen=True)
class Run:
    """A sorted run. ``rows`` are left, none at or below ``cursor``; ``first`` and
    ``last`` are the polls whose arrivals it holds. ``marks``: (timestamp, rows
    above the entry before it and up to this one), of the rows written."""

    path: str
    first: int
    last: int
    rows: int
    low: Key
    high: Key
    cursor: Key | None = None
    marks: list = field(default_factory=list)

    @property
    def floor(self) -> int:
        """No row left has a smaller timestamp."""
        return max(self.low[0], self.cursor[0]) if self.cursor else self.low[0]

    def after(self, bound: Key, taken: int) -> "Run":
        return replace(self, cursor=max(bound, self.cursor) if self.cursor else bound, rows=self.rows - taken)

    @classmethod
    def load(cls, d: dict) -> "Run":
        return cls(**d | {k: tuple(d[k]) if d[k] is not None else None for k in ("low", "high", "cursor")})

    def dump(self) -> dict:
        return asdict(self)


def above(key: Key) -> Column:
    """Rows above a buffer key; its timestamp alone reaches the parquet scan."""
    whole = F.struct(*[F.col(c) for c in BUFFER_KEY])
    return (F.col("timestamp_ms") >= F.lit(key[0])) & (whole > _literal(key))


def up_to(key: Key) -> Column:
    whole = F.struct(*[F.col(c) for c in BUFFER_KEY])
    return (F.col("timestamp_ms") <= F.lit(key[0])) & (whole <= _literal(key))


def _literal(key: Key) -> Column:
    types = ("long", "long", "string", "int", "long")
    return F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(BUFFER_KEY, key, types)])


def in_order(rows: DataFrame) -> DataFrame:
    """Rows in files of a good size, each sorted by buffer key."""
    return rows.hint("rebalance").sortWithinPartitions(*BUFFER_KEY)


def read(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    """A written table; with its schema given no job looks for it."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def describe(rows: DataFrame, path: str, epoch: int) -> Run | None:
    """The run that a poll's written arrivals are; None if there are none."""
    key = F.struct(*BUFFER_KEY)
    steps = [(k + 1) / MARKS for k in range(MARKS)]
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"),
                                     F.percentile_approx("timestamp_ms", steps, 1000).alias("at")).first()
    if not r["n"]:
        return None
    marks: dict[int, int] = {}
    for k, t in enumerate(r["at"]):
        marks[int(t)] = marks.get(int(t), 0) + (k + 1) * r["n"] // MARKS - k * r["n"] // MARKS
    return Run(path, epoch, epoch, int(r["n"]), tuple(r["low"]), tuple(r["high"]), None, sorted(marks.items()))


def rows_of(spark: SparkSession, runs: list[Run], limit: int | None = None, schema: StructType | None = None) -> DataFrame | None:
    """The rows left in these runs, up to a timestamp."""
    parts = []
    for r in runs:
        if limit is not None and r.floor > limit:
            continue
        rows = read(spark, r.path, schema)
        parts.append(rows.filter(above(r.cursor)) if r.cursor else rows)
    if not parts:
        return None
    out = reduce(DataFrame.unionByName, parts)
    return out if limit is None else out.filter(F.col("timestamp_ms") <= F.lit(limit))


def reach(runs: list[Run], limit: int, rows: int) -> list[int]:
    """Timestamps up to which to look, one after the other, for the first ``rows``
    rows with a timestamp up to ``limit``; the last one is the limit."""
    marks = sorted((t, n) for r in runs for t, n in r.marks if r.floor <= t <= limit)
    out, total, want = [], 0, 2 * rows
    for t, n in marks:
        total += n
        if total >= want:
            out.append(t)
            want = 4 * total
    return out if out and out[-1] == limit else [*out, limit]


def to_merge(runs: list[Run]) -> int:
    """How many of the newest runs to merge (0: none). ``runs`` by age, oldest first."""
    total, n = 0, 0
    for r in reversed(runs):
        if n and r.rows > total:
            break
        total, n = total + r.rows, n + 1
    return n if n >= FAN else 0


def merged(runs: list[Run], path: str) -> Run:
    """The run that the rows left in these make, written to ``path``."""
    marks = sorted((t, n) for r in runs for t, n in r.marks if t >= r.floor)
    every = -(-len(marks) // MARKS) or 1
    thin = [(marks[min(k + every, len(marks)) - 1][0], sum(n for _, n in marks[k:k + every])) for k in range(0, len(marks), every)]
    low = min(max(r.low, r.cursor) if r.cursor else r.low for r in runs)
    return Run(path, runs[0].first, runs[-1].last, sum(r.rows for r in runs), low, max(r.high for r in runs), None, thin)
