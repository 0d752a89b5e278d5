"""Sources that Spark has no reader for, as Python Data Sources: yearly rasters and paged answers.

Files are opened in the tasks by the address of their store (Arrow's file
systems: local, hdfs, s3, gs), a range of bytes at a time. Options say which days
or pages are wanted, and the others are never read. With pushDown = true the
reader takes them from filters too (`spark.sql.python.filterPushdown.enabled`,
which `register` sets). That is off by default: Spark 4.1 keeps one set of
pushed filters for a loaded DataFrame, so if a plan has it twice under different
filters, both branches get the same days. A DataFrame loaded for one use may
have it.
"""

from __future__ import annotations

import datetime
import json
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

MISSING_BELOW = -998.0


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme is local."""
    if path.startswith("file:/"):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    if re.match(r"^[a-z][a-z0-9+.-]*:/", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def files(path: str, name: str) -> list[tuple[str, int, re.Match]]:
    """(path, size, match) of the files at or below a path whose name matches, in order."""
    store, at = opened(path)
    found = store.get_file_info(fs.FileSelector(at, recursive=True)) if store.get_file_info(at).type == fs.FileType.Directory else [store.get_file_info(at)]
    matched = [(x, re.search(name, x.path.removeprefix(at).lstrip("/") or x.base_name)) for x in found if x.type == fs.FileType.File]
    return sorted(((x.path, x.size, m) for x, m in matched if m), key=lambda x: x[0])


class Bounds:
    """The values of a column that options (first, last) and filters leave: from, to, and a set if there is one."""

    def __init__(self, column: str, options: dict, kind: Callable[[str], object]):
        self.column, self.among, self.on = column, None, options.get("pushDown", "false").lower() == "true"
        self.low, self.high = (kind(options[x]) if options.get(x) else None for x in ("first", "last"))

    def take(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what it can of the filters, if that is on; yields the others, and strict ones too, which Spark applies once more."""
        for f in filters:
            if not self.on or getattr(f, "attribute", None) != (self.column,):
                yield f
                continue
            if isinstance(f, (EqualTo, GreaterThanOrEqual, GreaterThan)):
                self.low = f.value if self.low is None else max(self.low, f.value)
            if isinstance(f, (EqualTo, LessThanOrEqual, LessThan)):
                self.high = f.value if self.high is None else min(self.high, f.value)
            if isinstance(f, In):
                self.among = set(f.value) if self.among is None else self.among & set(f.value)
            if not isinstance(f, (EqualTo, GreaterThanOrEqual, LessThanOrEqual, In)):
                yield f

    def holds(self, v) -> bool:
        return (self.low is None or v >= self.low) and (self.high is None or v <= self.high) and (self.among is None or v in self.among)


class Days(InputPartition):
    """A run of days of one raster."""

    def __init__(self, path: str, year: int, first: int, n: int):
        super().__init__((path, first, n))
        self.path, self.year, self.first, self.n = path, year, first, n


class _RasterReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.cells = options["path"], int(options["cells"])
        self.days, self.name = int(options.get("daysPerPartition", 31)), options.get("namePattern", r"(\d{4})\.\w+$")
        self.below, self.bounds = float(options.get("missingBelow", MISSING_BELOW)), Bounds("day", options, datetime.date.fromisoformat)

    def pushFilters(self, filters):  # noqa: N802
        yield from self.bounds.take(filters)

    def partitions(self):
        """Runs of the days that are wanted; a file that isn't a whole year of whole days raises."""
        out = []
        for path, size, match in files(self.path, self.name):
            year = int(match[1])
            n, rest = divmod(size, 4 * self.cells)
            if rest or n != (datetime.date(year + 1, 1, 1) - datetime.date(year, 1, 1)).days:
                raise ValueError(f"{path}: {size} bytes aren't the days of {year} with {self.cells} cells")
            wanted = [d for d in range(n) if self.bounds.holds(datetime.date(year, 1, 1) + datetime.timedelta(d))]
            start = 0
            for k in range(1, len(wanted) + 1):
                if k == len(wanted) or wanted[k] != wanted[k - 1] + 1 or k - start == self.days:
                    out.append(Days(path, year, wanted[start], k - start))
                    start = k
        return out or [Days("", 0, 0, 0)]

    def read(self, partition):
        if not partition.n:
            return
        store, at = opened(self.path)
        with store.open_input_file(partition.path) as f:
            for d in range(partition.first, partition.first + partition.n):
                f.seek(4 * self.cells * d)
                values = np.frombuffer(f.read(4 * self.cells), "<f4").astype(np.float64)
                day = datetime.date(partition.year, 1, 1) + datetime.timedelta(d)
                arrays = [pa.array([day] * self.cells, pa.date32()), pa.array(np.arange(self.cells, dtype=np.int32)), pa.array(values, mask=~(values > self.below))]
                yield pa.RecordBatch.from_arrays(arrays, ["day", "cell", "value"])


class RasterSource(DataSource):
    """(day, cell, value) of yearly files of little-endian float32 rasters, a day after the other.

    Options: path; cells of a day; namePattern, whose first group is the year;
    daysPerPartition; missingBelow: values up to it, and NaN, are null; first
    and last day; pushDown. Days that aren't wanted aren't read.
    """

    @classmethod
    def name(cls):
        return "yearly_rasters"

    def schema(self):
        return "day date, cell int, value double"

    def reader(self, schema: StructType):
        return _RasterReader(self.options)


class Pages(InputPartition):
    """A run of pages: (path, number) of each."""

    def __init__(self, pages: list[tuple[str, int]]):
        super().__init__(pages)
        self.pages = pages


class _PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.name = options["path"], options.get("namePattern", r"(\d+)\.json$")
        self.keys, self.bounds = [k for k in options.get("listKeys", "data,content,result").split(",") if k], Bounds("page", options, int)
        self.most, self.rows = int(options.get("partitions", "256")), options.get("rows", "true").lower() == "true"

    def pushFilters(self, filters):  # noqa: N802
        yield from self.bounds.take(filters)

    def partitions(self):
        found = [(p, int(m[1])) for p, _, m in files(self.path, self.name) if self.bounds.holds(int(m[1]))]
        size = max(1, -(-len(found) // self.most))
        return [Pages(found[k : k + size]) for k in range(0, len(found), size)] or [Pages([])]

    def read(self, partition):
        store, _ = opened(self.path)
        for path, number in partition.pages:
            with store.open_input_stream(path) as f:
                answer = json.loads(f.read() or b"null")
            if isinstance(answer, dict):
                answer = next((answer[k] for k in self.keys if isinstance(answer.get(k), list)), None)
            rows = answer if isinstance(answer, list) else []
            n = len(rows)
            told = rows if self.rows else []
            k = max(len(told), 1)
            arrays = [pa.array([number] * k, pa.int32()), pa.array(range(k) if told else [None], pa.int32()), pa.array([n] * k, pa.int32()), pa.array([json.dumps(x, ensure_ascii=False) for x in told] if told else [None], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["page", "place", "n_rows", "row"])


class PageSource(DataSource):
    """(page, place, n_rows, row) of the pages of an answer, a file each; row is JSON. An empty page has one row without a place.

    Options: path; namePattern, whose first group is the page's number;
    listKeys, under which a page may hold its list; first and last page;
    pushDown; partitions: over how many at most the pages are dealt, in runs;
    rows = false: one row a page, with its n_rows only. Pages that aren't wanted
    aren't read.
    """

    @classmethod
    def name(cls):
        return "paged_answers"

    def schema(self):
        return "page int, place int, n_rows int, row string"

    def reader(self, schema: StructType):
        return _PageReader(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (RasterSource, PageSource):
        spark.dataSource.register(source)


def rasters_by_year(spark: SparkSession, path: str, cells: int, **options) -> DataFrame:
    """(day, cell, value) of the rasters below a path; options as RasterSource has them."""
    register(spark)
    return spark.read.format("yearly_rasters").options(path=path, cells=cells, **options).load()


def paged(spark: SparkSession, path: str, limit: int, **options) -> DataFrame:
    """(page, place, row) of an answer fetched page by page: the first page with fewer rows than the limit is the last; later files are of an older, longer answer."""
    register(spark)
    pages = lambda **o: spark.read.format("paged_answers").options(path=path, **options | o).load()
    short = pages(rows="false").where(F.col("n_rows") < limit).agg(F.min("page").alias("last")).first()["last"]
    if short is None:
        return pages().where("place IS NOT NULL").select("page", "place", "row")
    return pages(last=short).where("place IS NOT NULL").select("page", "place", "row")


def _put(path: str, data: bytes) -> None:
    """Writes a file under another name first, so that a task that is lost or repeated leaves a whole one."""
    store, at = opened(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    part = f"{at}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, at)


def write_rasters(values: DataFrame, path: str, cells: int, missing: float = -999.0, name: str = "rain_{}.grd") -> list[int]:
    """Writes (day, cell, value) as a raster for each year, a task a year; cells without a value hold `missing`. The years, which are few."""

    def run(table: pa.Table) -> pa.Table:
        day, cell = table.column("day").to_pylist(), table.column("cell").to_numpy()
        first = datetime.date(day[0].year, 1, 1)
        grid = np.full(((datetime.date(first.year + 1, 1, 1) - first).days, cells), missing, "<f4")
        value = table.column("value").to_numpy(zero_copy_only=False)
        grid[np.array([(d - first).days for d in day]), cell] = np.where(np.isnan(value), missing, value)
        _put(f"{path}/{name.format(first.year)}", grid.tobytes())
        return pa.table({"year": pa.array([first.year], pa.int32())})

    rows = values.select(F.col("day").cast("date"), F.col("cell").cast("int"), F.col("value").cast("double")).where("day IS NOT NULL AND cell IS NOT NULL")
    return sorted(r.year for r in rows.groupBy(F.year("day")).applyInArrow(run, "year int").collect())


def write_files(rows: DataFrame, path: str, name: str, line: str, order: str, head: bytes = b"", between: bytes = b"\n", tail: bytes = b"\n") -> int:
    """Writes the lines of each name, by their order, as one file of that name. How many files."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_order")
        called = table.column("_name")[0].as_py()
        _put(f"{path}/{called}", head + between.join((x or "").encode() for x in table.column("_line").to_pylist()) + tail)
        return pa.table({"name": pa.array([called])})

    own = rows.select(F.col(name).cast("string").alias("_name"), F.col(line).alias("_line"), F.col(order).alias("_order"))
    return own.groupBy("_name").applyInArrow(run, "name string").count()


def write_pages(rows: DataFrame, path: str, page: str, row: str, order: str) -> int:
    """Writes the JSON rows of each page as one landed answer. How many pages."""
    named = rows.withColumn("_file", F.concat(F.lit("page_"), F.col(page).cast("string"), F.lit(".json")))
    return write_files(named, path, "_file", row, order, b'{"data": [', b", ", b"]}")
