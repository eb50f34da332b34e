"""A folder of Parquet files as a stream, in the order of a time and an id.

An offset is the last (time, id) that was delivered. A batch holds the rows above its start and up to
its end; it is planned as key ranges, one for each stretch of row groups, and a range is read with a
filter that skips row groups outside it. Nothing else is remembered, so a restart from the
checkpoint goes on exactly where the last batch ended.

Folders ``<partition>=<date>`` before the start's date are not listed. Rows whose key lies below the
position when they arrive are not delivered, neither are rows without a time or an id: keep them apart, as
the load jobs do.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator, Sequence
from datetime import UTC, date, datetime, timedelta

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
RANGE_ROWS = 1_000_000  # rows of a range, by the files' footers
Key = tuple[int, str]
FIRST: Key = (-(2**62), "")  # below every key


def micros(value: datetime | int) -> int:
    """Microseconds of a time; a whole number is that already."""
    if isinstance(value, int):
        return value
    value = value if value.tzinfo else value.replace(tzinfo=UTC)
    return (value - EPOCH) // timedelta(microseconds=1)


class Range(InputPartition):
    """Row groups of a file, and the keys that are wanted of them: above ``low``, up to ``high``."""

    def __init__(self, path: str, groups: Sequence[int], low: Key, high: Key):
        self.path, self.groups, self.low, self.high = path, list(groups), low, high


class Keyed:
    """The files of a folder and the keys in them."""

    def __init__(self, path: str, time: str, key: str, partition: str):
        self.files, self.root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        self.time, self.key, self.partition = time, key, partition

    def listed(self, since: date | None) -> list[str]:
        """Data files; those in folders of earlier dates are left out without listing them."""
        out, todo = [], [self.root]
        while todo:
            for info in self.files.get_file_info(fs.FileSelector(todo.pop(), allow_not_found=True)):
                name = posixpath.basename(info.path)
                if info.type == fs.FileType.Directory:
                    if not name.startswith(("_", ".")) and not self.before(name, since):
                        todo.append(info.path)
                elif not name.startswith(("_", ".")):
                    out.append(info.path)
        return sorted(out)

    def before(self, folder: str, since: date | None) -> bool:
        name, _, value = folder.partition("=")
        if since is None or name != self.partition:
            return False
        try:
            return date.fromisoformat(value) < since
        except ValueError:  # rows without a date
            return True

    def file(self, path: str) -> pq.ParquetFile:
        return pq.ParquetFile(path, filesystem=self.files)

    def spans(self, footer: pq.FileMetaData) -> Iterator[tuple[int, int, int, int]]:
        """Row group, rows, least and largest time; groups without a time are left out."""
        for group in range(footer.num_row_groups):
            meta = footer.row_group(group)
            at = next(i for i in range(meta.num_columns) if meta.column(i).path_in_schema == self.time)
            column = meta.column(at)
            if column.physical_type == "INT96":  # Spark's default for timestamps: its order is not defined
                yield group, meta.num_rows, FIRST[0], 2**62
                continue
            stats = column.statistics
            if stats is None or not stats.has_min_max:
                if stats is None or stats.null_count < meta.num_rows:
                    yield group, meta.num_rows, FIRST[0], 2**62
                continue
            yield group, meta.num_rows, micros(stats.min), micros(stats.max)

    def newest(self, since: date | None = None) -> Key | None:
        """The largest key: of the row groups that hold the largest time, only those two columns are read."""
        spans = [(path, *span) for path in self.listed(since) for span in self.spans(self.file(path).metadata)]
        if not spans:
            return None
        top = max(least for *_, least, _ in spans)  # the largest time is not below it
        best: Key | None = None
        for path, group, _, _, most in spans:
            if most < top or best is not None and most < best[0]:
                continue
            rows = self.file(path).read_row_group(group, columns=[self.time, self.key])
            rows = rows.filter(pc.and_(pc.is_valid(rows[self.time]), pc.is_valid(rows[self.key])))
            if rows.num_rows:
                times = as_micros(rows[self.time].combine_chunks())
                latest = pc.max(times).as_py()
                ids = rows[self.key].combine_chunks().filter(pc.equal(times, latest)).cast(pa.string())
                best = max(best or FIRST, (latest, max(ids.to_pylist())))
        return best

    def ranges(self, low: Key, high: Key, rows: int) -> list[Range]:
        """Stretches of row groups that may hold keys above ``low`` and up to ``high``."""
        out: list[Range] = []
        since = (EPOCH + timedelta(microseconds=low[0])).date() if low[0] > FIRST[0] else None
        for path in self.listed(since):
            held, size = [], 0
            for group, n, least, most in self.spans(self.file(path).metadata):
                if most < low[0] or least > high[0]:
                    continue
                if held and size + n > rows:
                    out.append(Range(path, held, low, high))
                    held, size = [], 0
                held.append(group)
                size += n
            if held:
                out.append(Range(path, held, low, high))
        return out

    def rows(self, part: Range, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        columns = list(dict.fromkeys([*schema.names, self.time, self.key]))
        for batch in self.file(part.path).iter_batches(row_groups=part.groups, batch_size=10_000, columns=columns):
            at, name = as_micros(batch.column(self.time)), batch.column(self.key).cast(pa.string())
            (low, low_name), (high, high_name) = part.low, part.high
            above = pc.or_kleene(pc.greater(at, low), pc.and_kleene(pc.equal(at, low), pc.greater(name, low_name)))
            upto = pc.or_kleene(pc.less(at, high), pc.and_kleene(pc.equal(at, high), pc.less_equal(name, high_name)))
            wanted = batch.filter(pc.and_kleene(pc.and_kleene(above, upto), pc.is_valid(name)))
            if wanted.num_rows:
                values = [wanted.column(f.name).cast(f.type, safe=False) for f in schema]
                yield pa.RecordBatch.from_arrays(values, schema=schema)


def as_micros(times: pa.Array) -> pa.Array:
    if pa.types.is_integer(times.type):
        return times.cast(pa.int64())
    return times.cast(pa.timestamp("us", times.type.tz), safe=False).cast(pa.int64())


class KeysetReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema = to_arrow_schema(schema)
        self.table = Keyed(options["path"], options["time"], options["id"], options.get("partition", "event_date"))
        self.start, self.range_rows = options.get("start", "earliest"), int(options.get("rangerows", RANGE_ROWS))
        self.known: Key | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        """Only asked when a stream starts without a checkpoint."""
        if self.start == "earliest":
            return offset(FIRST)
        if self.start == "latest":
            return offset(self.table.newest() or FIRST)
        at, name = json.loads(self.start)
        return offset((micros(datetime.fromisoformat(at)), name))

    def latestOffset(self) -> dict:  # noqa: N802
        since = (EPOCH + timedelta(microseconds=self.known[0])).date() if self.known else None
        self.known = max(self.known or FIRST, self.table.newest(since) or FIRST)
        return offset(self.known)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        low, high = key_of(start), key_of(end)
        return self.table.ranges(low, high, self.range_rows) if low < high else []

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.table.rows(partition, self.schema)


def offset(key: Key) -> dict:
    return {"time": key[0], "id": key[1]}


def key_of(position: dict) -> Key:
    return position["time"], position["id"]


class KeysetSource(DataSource):
    """Format ``keyset``. Options: ``path``, ``time``, ``id``, ``start`` (earliest, latest, or a JSON array of
    an ISO time and an id), ``partition`` and ``rangeRows``."""

    @classmethod
    def name(cls) -> str:
        return "keyset"

    def streamReader(self, schema: StructType) -> KeysetReader:  # noqa: N802
        return KeysetReader(schema, {k.lower(): v for k, v in self.options.items()})


def read_keyset(
    spark: SparkSession, path: str, schema: StructType, time: str = "timestamp", key: str = "transaction_id",
    start: str | tuple[datetime, str] = "earliest", range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """The folder as a stream from ``start``: its first row, the rows that come later, or those above a key.

    ``time`` is a timestamp or a whole number of microseconds, such as ``PathTable`` keeps beside a timestamp: of
    numbers the footers know the range, of Spark's default timestamps they do not. Times without a zone are UTC.
    ``schema`` names the columns that are read.
    """
    spark.dataSource.register(KeysetSource)
    position = start if isinstance(start, str) else json.dumps([start[0].isoformat(), start[1]])
    reader = spark.readStream.format("keyset").schema(schema).option("path", path).option("time", time)
    return reader.option("id", key).option("start", position).option("rangeRows", str(range_rows)).load()
