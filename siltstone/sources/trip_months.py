"""Monthly trip files as a data source: `spark.read.format("trips").option("path", root).option("type", "yellow").load()`.

The files of a month are found by their names, and read by tasks of their own. A filter on the pickup column is compared with the least
and greatest pickup that the files' footers state, so that only months holding such trips are opened; a stray trip in another month's
file is found all the same. Spark evaluates the filter again on the rows read.

Options: `path`; `type` (yellow or green); `first` and `last` (yyyy-MM, both included) bound the files by name; `layout`, the name of a
month's file or folder below the path; `split_bytes`, the compressed bytes a task reads of a file (whole row groups, 128 MB).
Columns are all that the newest month has, in lower case, or those of `.schema(...)`; what a file lacks is NULL. Empty files and
months without any are fine; a path without any matching file is an error, as for Spark's own readers.

The path has to be one that both the driver and the workers open through Arrow: a mounted folder, or a URI of its file systems.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from .readers import check_taxi_type

LAYOUT = "{type}_tripdata_{month}.parquet"
SPLIT_BYTES = 128 << 20
MONTH = r"(?P<month>\d{4}-(?:0[1-9]|1[0-2]))"
# The pickup column of either type.
PICKUP = {"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime"}


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, filters included."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TripMonths)


def read_trip_months(spark: SparkSession, root: str, taxi_type: str, first: str | None = None, last: str | None = None, layout: str = LAYOUT) -> DataFrame:
    """All months of a type under a folder, or those from `first` to `last`."""
    check_taxi_type(taxi_type)
    register(spark)
    reader = spark.read.format("trips").option("path", root).option("type", taxi_type).option("layout", layout)
    for name, month in (("first", first), ("last", last)):
        if month:
            reader = reader.option(name, month)
    return reader.load()


def _opened(path: str):
    """File system and path in it; Hadoop writes local folders as file:/folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path)) if ":" in path else (fs.LocalFileSystem(), path)


@dataclass(frozen=True)
class MonthFile:
    month: str
    path: str


class TripMonths(DataSource):
    @classmethod
    def name(cls) -> str:
        return "trips"

    def _option(self, name: str, default: str | None = None) -> str:
        value = self.options.get(name, default)
        if value is None:
            raise ValueError(f"the trips source needs the option {name!r}")
        return value

    def files(self) -> list[MonthFile]:
        """The files of the months asked for, by month."""
        from pyarrow import fs

        taxi_type = self._option("type")
        check_taxi_type(taxi_type)
        system, root = _opened(self._option("path"))
        named = re.escape(self._option("layout", LAYOUT).replace("{type}", taxi_type)).replace(re.escape("{month}"), MONTH)
        pattern = re.compile(named + r"(?:/(?:[^/]*/)*[^/_.][^/]*)?")
        first, last = self.options.get("first") or "0000-00", self.options.get("last") or "9999-99"
        found = []
        for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
            match = pattern.fullmatch(info.path[len(root.rstrip("/")) + 1 :])
            if match and info.type == fs.FileType.File and info.size and first <= match["month"] <= last:
                found.append(MonthFile(match["month"], info.path))
        if not found:
            raise FileNotFoundError(f"no {taxi_type} month from {first} to {last} under {root}")
        return sorted(found, key=lambda f: (f.month, f.path))

    def schema(self) -> StructType:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        system, _ = _opened(self._option("path"))
        found = pq.read_schema(self.files()[-1].path, filesystem=system)
        return from_arrow_schema(_lower(found), prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> DataSourceReader:
        split = int(self.options.get("split_bytes") or SPLIT_BYTES)
        return TripMonthsReader(self._option("path"), self.files(), schema, PICKUP[self._option("type")], split)


def _lower(schema):
    import pyarrow as pa

    return pa.schema([f.with_name(f.name.lower()).remove_metadata() for f in schema])


@dataclass
class Groups(InputPartition):
    """Row groups of one month's file."""

    month: str
    path: str
    groups: tuple[int, ...]


class TripMonthsReader(DataSourceReader):
    def __init__(self, root: str, files: list[MonthFile], schema: StructType, pickup: str, split_bytes: int):
        self.root, self.files, self.schema, self.pickup, self.split_bytes = root, files, schema, pickup, split_bytes
        self.bounds: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Notes what bounds the pickup. All filters stay with Spark: the bounds choose row groups, not rows."""
        kinds = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for one in filters:
            if getattr(one, "attribute", None) == (self.pickup,):
                if type(one) in kinds:
                    self.bounds.append((kinds[type(one)], one.value))
                elif isinstance(one, In) and one.value and None not in one.value:
                    self.bounds += [(">=", min(one.value)), ("<=", max(one.value))]
            yield one

    def _may_hold(self, least, greatest) -> bool:
        def meets(kind: str, value) -> bool:
            if kind in ("<", "<="):
                return least < value if kind == "<" else least <= value
            if kind in (">", ">="):
                return greatest > value if kind == ">" else greatest >= value
            return least <= value <= greatest

        try:
            return all(meets(kind, value) for kind, value in self.bounds)
        except TypeError:  # a value of another type than the file's: Spark's filter decides
            return True

    def partitions(self) -> list[Groups]:
        """Runs of row groups that may hold a trip asked for, by the files' footers; none leaves one empty task."""
        import pyarrow.parquet as pq

        system, _ = _opened(self.root)
        out = []
        for file in self.files:
            footer = pq.read_metadata(file.path, filesystem=system)
            names = [footer.schema.column(k).path.lower() for k in range(footer.num_columns)]
            place = names.index(self.pickup) if self.pickup in names else None
            held, size = [], 0
            for number in range(footer.num_row_groups):
                group = footer.row_group(number)
                stated = group.column(place).statistics if place is not None else None
                if stated is not None and stated.has_min_max and not self._may_hold(stated.min, stated.max):
                    continue
                if held and size + group.total_byte_size > self.split_bytes:
                    out.append(Groups(file.month, file.path, tuple(held)))
                    held, size = [], 0
                held.append(number)
                size += group.total_byte_size
            if held:
                out.append(Groups(file.month, file.path, tuple(held)))
        return out or [Groups("", "", ())]

    def read(self, partition: Groups) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        if not partition.groups:
            return
        wanted = to_arrow_schema(self.schema)
        system, _ = _opened(self.root)
        with pq.ParquetFile(partition.path, filesystem=system) as file:
            names = {n.lower(): n for n in file.schema_arrow.names}
            columns = [names[f.name.lower()] for f in wanted if f.name.lower() in names]
            for batch in file.iter_batches(row_groups=list(partition.groups), columns=columns):
                arrays = [
                    batch.column(names[f.name.lower()]).cast(f.type) if f.name.lower() in names else pa.nulls(batch.num_rows, f.type)
                    for f in wanted
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=wanted)
