"""Stream over a folder of Parquet files that is read by ranges of time, with an overlap for late arrivals.

The offset of a batch is the newest instant served and the number of rows seen, both taken from file footers.
A batch reads from its start cursor less the overlap (without one, from its end less the backfill) up to its end
cursor. Both ends are in the stream's own offset log: a batch whose commit was lost is read again over the same
range, and an insert-only sink names its part by the batch, so nothing is stored twice. Rows of the overlap come
again by design, and the sink's keys tell which are known. Rows that arrive later than the overlap allows, and rows
without an instant, are not read.

The range is cut into chunks, each chunk into tasks of some ``ROWS_PER_TASK`` rows by the row groups that touch it;
tasks filter on the instant and read the declared columns only. Files are never changed once written: the driver
remembers the bounds of the row groups it has seen, and reads the footers of new files in each trigger. The time
column must be stored with bounds (64-bit instants, not the old 96-bit ones).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.when import span
from .cursor import fetch_chunks

ROWS_PER_TASK = 2_000_000
EPOCH = datetime(1970, 1, 1)
TICK = timedelta(microseconds=1)


@dataclass
class Group:
    """A row group: its file, its place there, its rows and the bounds of its instants."""

    path: str
    number: int
    rows: int
    low: int | None
    high: int | None


@dataclass
class Piece(InputPartition):
    """Row groups that one task reads, and the half-open range of microseconds it keeps."""

    low: int
    high: int
    groups: list[tuple[str, list[int]]]


def to_micros(at: datetime) -> int:
    naive = at.astimezone(timezone.utc).replace(tzinfo=None) if at.tzinfo else at
    return (naive - EPOCH) // TICK


def deal(groups: Sequence[Group], rows: int = ROWS_PER_TASK) -> Iterator[list[tuple[str, list[int]]]]:
    """Row groups in tasks of some ``rows`` rows; groups of one file stay next to each other."""
    taken: dict[str, list[int]] = {}
    held = 0
    for g in sorted(groups, key=lambda g: (g.path, g.number)):
        if held and held + g.rows > rows:
            yield list(taken.items())
            taken, held = {}, 0
        taken.setdefault(g.path, []).append(g.number)
        held += g.rows
    if taken:
        yield list(taken.items())


class RangeReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, path: str, ts: str, overlap: int, backfill: int, chunk: str) -> None:
        self.schema, self.path, self.ts = schema, path, ts
        self.overlap, self.backfill, self.chunk = overlap, backfill, chunk
        self.seen: dict[str, list[Group]] = {}

    def initialOffset(self) -> dict:
        return {"cursor": None, "rows": 0}

    def latestOffset(self) -> dict:
        groups = self.groups()
        newest = [g.high for g in groups if g.high is not None]
        return {"cursor": max(newest, default=None), "rows": sum(g.rows for g in groups)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if end["cursor"] is None:
            return []
        low = end["cursor"] - self.backfill if start["cursor"] is None else start["cursor"] - self.overlap
        out, groups = [], self.groups()
        for a, b in fetch_chunks(EPOCH + low * TICK, EPOCH + (end["cursor"] + 1) * TICK, self.chunk):
            first, last = to_micros(a), to_micros(b)
            touched = [g for g in groups if g.high is not None and g.high >= first and g.low < last]
            out += [Piece(first, last, task) for task in deal(touched)]
        return out

    def read(self, partition: Piece):
        import pyarrow as pa
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.schema)
        files, _ = located(self.path)
        for path, numbers in partition.groups:
            fragment = ds.ParquetFileFormat().make_fragment(path, files, row_groups=numbers)
            kind = fragment.physical_schema.field(self.ts).type
            low, high = (pa.scalar(v, pa.timestamp("us")).cast(kind) for v in (partition.low, partition.high))
            wanted = (ds.field(self.ts) >= low) & (ds.field(self.ts) < high)
            for batch in fragment.scanner(columns=target.names, filter=wanted).to_batches():
                if batch.num_rows:
                    yield from pa.Table.from_batches([batch]).cast(target).to_batches()

    def groups(self) -> list[Group]:
        """Row groups of all files there are now; footers are read once per file."""
        files, root = located(self.path)
        new = [p for p in listed(files, root) if p not in self.seen]
        with ThreadPoolExecutor(16) as pool:
            for path, found in zip(new, pool.map(lambda p: footer(files, p, self.ts), new)):
                self.seen[path] = found
        return [g for found in self.seen.values() for g in found]


def located(path: str):
    """The file system of a path and the path within it."""
    import pyarrow.fs as fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def listed(files, root: str) -> list[str]:
    """Data files below a folder; names that start with a dot or an underscore are not data."""
    import pyarrow.fs as fs

    below = files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    parts = {f.path: f.path[len(root) :].strip("/").split("/") for f in below if f.type == fs.FileType.File}
    return sorted(p for p, names in parts.items() if not any(n[:1] in "._" for n in names))


def footer(files, path: str, ts: str) -> list[Group]:
    import pyarrow.parquet as pq

    with files.open_input_file(path) as f:
        meta = pq.ParquetFile(f).metadata
    column = meta.schema.names.index(ts)
    out = []
    for i in range(meta.num_row_groups):
        part = meta.row_group(i)
        stats = part.column(column).statistics if part.column(column).physical_type != "INT96" else None
        empty = part.num_rows == 0 or (stats is not None and stats.null_count == part.num_rows)
        if not empty and (stats is None or not stats.has_min_max):
            raise ValueError(f"{path}: {ts} is stored without bounds")
        low, high = (None, None) if empty else (to_micros(stats.min), to_micros(stats.max))
        out.append(Group(path, i, part.num_rows, low, high))
    return out


class RangeSource(DataSource):
    """Format ``time_ranges``: options ``path``, ``ts``, ``overlap``, ``backfill``, ``chunk``; the schema is declared."""

    @classmethod
    def name(cls) -> str:
        return "time_ranges"

    def streamReader(self, schema: StructType) -> RangeReader:
        o = self.options
        return RangeReader(schema, o["path"], o["ts"], span(o.get("overlap", "6 hours")), span(o.get("backfill", "30 days")), o.get("chunk", "30 days"))


def range_stream(spark: SparkSession, path: str, schema: str | StructType, ts: str, overlap: str = "6 hours", backfill: str = "30 days", chunk: str = "30 days") -> DataFrame:
    """Rows of ``path`` as they come: each batch what is newer than the last one's cursor less ``overlap``."""
    spark.dataSource.register(RangeSource)
    reader = spark.readStream.format(RangeSource.name()).schema(schema)
    return reader.options(ts=ts, overlap=overlap, backfill=backfill, chunk=chunk).load(path)
