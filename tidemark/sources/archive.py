"""A stream of messages read from an archived log.

``write_archive`` lays a log out as parquet files by topic and partition, sorted by
offset. ``tidemark_log`` is a streaming source over such a folder: its offset is the
next message offset of every partition. Each partition starts at its own resolved
start (S9) and ends at a fixed end, or, where it is to stay live, goes on with
files that appear later. A poll admits so many messages of a partition
(``rows_per_poll`` of its range) or so many in all, shared out in proportion to
what each partition has left.

A poll is planned from the footers of files not seen before; each partition's
messages are one task, which reads the row groups that hold them as Arrow batches.
The source's last plan is kept in the ``progress`` folder, so that it goes on where
a restarted query does: Spark notes a poll's offsets before it is planned, and plans
it again if it was not finished.
"""

from __future__ import annotations

import json
from typing import Any, Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME = "tidemark_log"
GROUP_BYTES = 8 << 20  # of a row group: a poll reads those that hold its messages
_NOWHERE = 1 << 62


def write_archive(log: DataFrame, path: str) -> str:
    """The log as files by topic and partition, sorted by offset. A large partition
    is split over several tasks and files."""
    order = ("topic", "partition", "offset")
    (log.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.option("parquet.block.size", GROUP_BYTES).partitionBy("topic", "partition").parquet(path))
    return path


def read_log_stream(spark: SparkSession, archive: str, schema: StructType, ranges: DataFrame, progress: str,
                    rows_per_poll: int | None = None, stay_live: bool = False, polls: int = 1) -> DataFrame:
    """A stream of the messages in ``ranges``: topic, partition, replay_start_offset,
    replay_end_offset and, to admit so many for the partition in each poll,
    rows_per_poll. ``rows_per_poll`` given here is for all partitions together. A
    micro-batch admits what so many ``polls`` do."""
    spark.dataSource.register(LogSource)
    has = "rows_per_poll" in ranges.columns
    rows = [(r["topic"], r["partition"], r["replay_start_offset"], r["replay_end_offset"], r["rows_per_poll"] * polls if has else None)
            for r in ranges.sort("topic", "partition").collect()]  # one row for each partition
    return (spark.readStream.format(NAME).schema(schema).option("path", archive).option("ranges", json.dumps(rows))
            .option("progress", progress).option("rows_per_poll", str((rows_per_poll or 0) * polls))
            .option("stay_live", str(stay_live).lower()).load())


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "topic string, partition int, offset long, timestamp_ms long, key string, value string"

    def streamReader(self, schema: StructType) -> "LogStreamReader":
        return LogStreamReader(schema, dict(self.options))


def admit(left: dict[Any, int], quota: dict[Any, int | None], total: int) -> dict[Any, int]:
    """How many messages of each partition a poll takes, of those left: its quota, or
    its share of the total by largest remainder (one at least, while there are any)."""
    out = {p: min(n, quota[p]) if quota.get(p) else n for p, n in left.items()}
    whole = sum(out.values())
    if not total or whole <= total:
        return out
    share = {p: n * total // whole for p, n in out.items()}
    spare = total - sum(share.values())
    for p in sorted(out, key=lambda p: (-(out[p] * total % whole), p))[:spare]:
        share[p] += 1
    return share


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        from pyspark.sql.pandas.types import to_arrow_schema
        self.fields = to_arrow_schema(schema)
        self.path, self.progress = options["path"], options["progress"]
        self.total = int(options.get("rows_per_poll", "0"))
        self.live = options.get("stay_live", "false") == "true"
        self.ranges = {(t, p): (a, b) for t, p, a, b, _ in json.loads(options["ranges"])}
        self.quota = {(t, p): q for t, p, *_, q in json.loads(options["ranges"])}
        self.files: dict[tuple[str, int], dict[str, tuple[int, int]]] = {k: {} for k in self.ranges}
        self.at: dict[tuple[str, int], int] | None = None

    # --- offsets, as Spark keeps them: {topic: {partition: next offset}} ------

    def _shown(self, at: dict[tuple[str, int], int]) -> dict:
        out: dict[str, dict[str, int]] = {}
        for (t, p), o in sorted(at.items()):
            out.setdefault(t, {})[str(p)] = o
        return out

    def _offsets(self, shown: dict) -> dict[tuple[str, int], int]:
        return {(t, int(p)): o for t, parts in shown.items() for p, o in parts.items()}

    def initialOffset(self) -> dict:
        return self._shown({k: a for k, (a, _) in self.ranges.items()})

    def latestOffset(self) -> dict:
        """The end of the next poll: what is planned already, and what a poll admits."""
        at = self.at or self._planned() or self._offsets(self.initialOffset())
        left = {k: max(self._head(k) - at[k], 0) for k in at}
        take = admit(left, self.quota, self.total)
        return self._shown({k: at[k] + take[k] for k in at})

    def _head(self, key: tuple[str, int]) -> int:
        """Where a partition ends: its fixed end, as far as there are messages."""
        start, end = self.ranges[key]
        if not self.live and self.files[key] and max(b for _, b in self.files[key].values()) >= end:
            return end
        self._look(key)
        known = max((b for _, b in self.files[key].values()), default=start)
        return known if self.live else min(known, end)

    # --- files ----------------------------------------------------------------

    def _fs(self, path: str) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(path)

    def _look(self, key: tuple[str, int]) -> None:
        """Offsets of the partition's files not seen before, from their footers."""
        fs, root = self._fs(self.path)
        names = [i.base_name for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if i.base_name.startswith("topic=")]
        for name in names:
            if unquote(name.removeprefix("topic=")) != key[0]:
                continue
            for info in fs.get_file_info(pafs.FileSelector(f"{root}/{name}/partition={key[1]}", allow_not_found=True)):
                if info.base_name.endswith(".parquet") and not info.base_name.startswith(("_", ".")) and info.path not in self.files[key]:
                    span = _span(pq.ParquetFile(fs.open_input_file(info.path)))
                    if span:
                        self.files[key][info.path] = span

    # --- polls ----------------------------------------------------------------

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        a, b = self._offsets(start), self._offsets(end)
        out = []
        for key in sorted(b):
            lo, hi = a.get(key, self.ranges[key][0]), b[key]
            if lo < hi:
                if not any(y >= hi for _, y in self.files[key].values()):
                    self._look(key)
                paths = [f for f, (x, y) in sorted(self.files[key].items(), key=lambda f: f[1]) if x < hi and y > lo]
                out.append(InputPartition((*key, lo, hi, paths)))
        self.at = b
        self._plan(end)
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        topic, number, lo, hi, paths = partition.value
        fs, _ = self._fs(self.path)
        stored = [n for n in self.fields.names if n not in ("topic", "partition")]
        for path in paths:
            file = pq.ParquetFile(fs.open_input_file(path))
            groups = [k for k, (x, y) in enumerate(_groups(file)) if x < hi and y > lo]
            for batch in file.iter_batches(row_groups=groups, columns=stored):
                offset = batch.column("offset")
                keep = pa.compute.and_(pa.compute.greater_equal(offset, lo), pa.compute.less(offset, hi))
                batch = batch.filter(keep)
                if batch.num_rows:
                    n = batch.num_rows
                    own = {"topic": pa.array([topic] * n, pa.string()), "partition": pa.array([number] * n, pa.int32())}
                    yield pa.RecordBatch.from_arrays(
                        [(own[f.name] if f.name in own else batch.column(f.name)).cast(f.type) for f in self.fields], schema=self.fields)

    def commit(self, end: dict) -> None:
        pass  # S16: nothing is committed to the log

    # --- the last plan ----------------------------------------------------------

    def _planned(self) -> dict[tuple[str, int], int] | None:
        fs, root = self._fs(self.progress)
        if fs.get_file_info(f"{root}/plan.json").type == pafs.FileType.NotFound:
            return None
        with fs.open_input_stream(f"{root}/plan.json") as f:
            return self._offsets(json.loads(f.read()))

    def _plan(self, end: dict) -> None:
        fs, root = self._fs(self.progress)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/plan.draft") as f:
            f.write(json.dumps(end).encode())
        fs.move(f"{root}/plan.draft", f"{root}/plan.json")


def _groups(file: pq.ParquetFile) -> list[tuple[int, int]]:
    """Offsets [from, to) of a file's row groups."""
    at = file.schema_arrow.names.index("offset")
    out = []
    for k in range(file.metadata.num_row_groups):
        s = file.metadata.row_group(k).column(at).statistics
        out.append((s.min, s.max + 1) if s is not None and s.has_min_max else (-_NOWHERE, _NOWHERE))
    return out


def _span(file: pq.ParquetFile) -> tuple[int, int] | None:
    """Offsets [from, to) of a file; None if it has no rows."""
    if not file.metadata.num_rows:
        return None
    groups = _groups(file)
    if any(b == _NOWHERE for _, b in groups):
        offset = file.read(columns=["offset"]).column(0)
        return pa.compute.min(offset).as_py(), pa.compute.max(offset).as_py() + 1
    return min(a for a, _ in groups), max(b for _, b in groups)
