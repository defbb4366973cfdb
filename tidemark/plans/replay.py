"""A replay over a message log, built from DataFrame operators.

``Replay`` is the batch counterpart of a consumer: it resolves ranges once,
slices the log, and exposes poll-by-poll limits, release polls, and the
reports. Each property is a DataFrame; only a few scalars (the last poll, the
bounds of the limit) are brought to the driver. Tables that several plans read
are written when first asked for; ``close`` (or a ``with`` block) gives them
back.
"""

from __future__ import annotations

from functools import cached_property
from typing import Any, Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..operators import offsets as O
from ..operators import progress as P
from ..operators import release as R
from ..operators import watermark as W
from ..session import drop_written, materialize, written
from ..sources.log import DEFAULT_BATCH_SIZE
from ..sources.topics import validate_topics


class Replay:
    def __init__(self, log: DataFrame, topics: Iterable[Any] | None = None,
                 as_of_ms: int | None = None, batch_size: int | None = None,
                 ranges: DataFrame | None = None, bounded: bool = True,
                 materialized: bool = True, keep_messages: bool = False):
        if ranges is None and topics is None:
            raise ValueError("give topics (with policies) or resolved ranges")
        self.log = log
        self.spark = log.sparkSession
        self.topics = list(topics) if topics is not None else None
        self.as_of_ms = as_of_ms
        self.batch_size = int(batch_size or DEFAULT_BATCH_SIZE)
        self._ranges = ranges
        self.bounded = bounded
        # data-sized tables read several times are written to the shared
        # folder; small per-partition / per-poll tables are only persisted
        # (no extra job; a lost block is recomputed from lineage)
        self._keep = materialize if materialized else (lambda df: df)
        self._persisted: list[DataFrame] = []
        self._mark = written()
        self._small = self._hold if materialized else (lambda df: df)
        # the log is expected to be a table (an archive, or the written output
        # of log_from_events); then the consumed slice is a scan plus a
        # broadcast-join filter and is not written again unless asked
        self._keep_messages = self._keep if keep_messages else (lambda df: df)

    def _hold(self, df: DataFrame) -> DataFrame:
        self._persisted.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def close(self) -> None:
        """Give back what this replay keeps: cached tables, and the tables
        written since it was made. Its frames cannot be read afterwards."""
        while self._persisted:
            self._persisted.pop().unpersist()
        drop_written(self.spark, self._mark)

    def __enter__(self) -> "Replay":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    @cached_property
    def ranges(self) -> DataFrame:
        """One range per partition; raises where a requested topic has none."""
        if self._ranges is not None:
            return self._ranges
        out = self._small(O.resolve_offsets(self.log, self.topics, self.as_of_ms))
        present = {r["topic"] for r in out.select("topic").distinct().collect()}  # at most the requested topics
        missing = sorted(t.name for t in validate_topics(self.topics) if t.name not in present)
        if missing:
            raise ValueError("no partitions in the log for topics: " + ", ".join(missing))
        return out

    @cached_property
    def slice(self) -> DataFrame:
        return O.replay_slice(self.log, self.ranges, self.bounded)

    @cached_property
    def messages(self) -> DataFrame:
        """Consumed messages (in range, with a timestamp)."""
        return self._keep_messages(W.consumed_messages(self.slice))

    @cached_property
    def events(self) -> DataFrame:
        return self._small(W.consumption_events(self.messages, self.ranges))

    @cached_property
    def last_epoch(self) -> int:
        v = self.events.agg({"epoch": "max"}).first()[0]
        return -1 if v is None else int(v)

    @cached_property
    def limits(self) -> DataFrame:
        return self._small(W.release_limits(self.spark, self.events, self.ranges, self.last_epoch))

    @cached_property
    def released(self) -> DataFrame:
        """Every consumed message with its (uncapped) release poll; the payload
        is left behind (``poll`` joins it back)."""
        slim = self.messages.select("topic", "partition", "offset", "timestamp_ms", "arrival_epoch")
        return self._keep(R.release_epochs(slim, self.limits, self.last_epoch))

    def partition_state(self, upto_epoch: int | None = None, as_timestamp: bool = True) -> DataFrame:
        return P.partition_state(self.released, self.ranges, upto_epoch, as_timestamp)

    def progress(self) -> DataFrame:
        return P.replay_progress(self.spark, self.released, self.events, self.ranges,
                                 self.limits, self.last_epoch)

    def metrics(self) -> DataFrame:
        return P.epoch_metrics(self.spark, self.released, self.last_epoch)

    def flow(self) -> DataFrame:
        partitions = self.ranges.count()
        return P.flow_report(self.spark, self.events, self.limits, self.metrics(),
                             partitions, self.batch_size, self.last_epoch)

    def paced_counts(self) -> DataFrame:
        return R.paced_counts(self.released, self.limits, self.batch_size, self.spark, self.last_epoch)

    # --- consumer-style accessors (T1, A5-A8) -----------------------------------

    def poll(self, epoch: int) -> DataFrame:
        """The batch poll ``epoch`` returns (uncapped), in release order, with
        the fixed message schema."""
        from pyspark.sql import functions as F
        from ..schema import to_messages
        rel = R.release_order(self.released.filter(F.col("release_epoch") == epoch))
        payload = self.messages.filter(F.col("arrival_epoch") <= epoch).select("topic", "partition", "offset", "key", "value")
        return to_messages(rel.join(payload, ["topic", "partition", "offset"]), extra=["release_position"])

    def _progress_row(self, epoch: int):
        from pyspark.sql import functions as F
        return self.progress().filter(F.col("epoch") == epoch).first()

    def is_live(self, epoch: int | None = None) -> bool:
        """A5: every partition released up to its end (after poll ``epoch``)."""
        e = self.last_epoch if epoch is None else epoch
        if e < 0:
            return self.ranges.filter("replay_start_offset < replay_end_offset").limit(1).count() == 0 \
                and self.ranges.limit(1).count() > 0
        row = self._progress_row(e)
        return bool(row["is_live"]) if row is not None else False

    def get_priming_watermark(self, epoch: int) -> int | None:
        """The mark while any partition is not live, else None."""
        row = self._progress_row(epoch)
        return None if row is None else row["priming_watermark"]

    def held_message_count(self, epoch: int) -> int:
        """Consumed, not yet released after poll ``epoch``."""
        from pyspark.sql import functions as F
        row = self.metrics().filter(F.col("epoch") == epoch).first()
        return 0 if row is None else int(row["held"])

    def paused_partition_count(self, state: DataFrame | None = None) -> int:
        """Paused partitions of a state table; of the replay itself always
        0, since admission control replaces pausing."""
        return 0 if state is None else state.filter("is_paused").count()
