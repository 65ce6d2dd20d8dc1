"""A catalogue of CSV headers, so that files are read by column name however they are laid out.

Files of one folder, glob or list may differ in which columns they have and in what order. A
reader that takes them as one table binds the columns of all files by the position in one of
them. Here the first lines of every file are looked at first (in the executors, a task per file,
which stops after those lines), files of equal header form a group, and each group is one scan
whose columns have that header's names. The number of scans is that of the distinct headers.

What comes to the driver is a row per file (its path and its header), as Spark's own listing.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Mapping, Sequence
from typing import Any, NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Lines of a file that are looked at beyond the skipped ones: a header whose quoted names hold
#: line breaks takes several.
HEADER_LINES = 64


class Layout(NamedTuple):
    """Files with one header: the names of all columns in order, the records before the first row
    of data (the header itself is the last of them), and whether one of these takes several lines."""

    names: tuple[str, ...]
    drop: int
    broken: bool
    files: list[str]


def header_names(cells: Sequence[str]) -> tuple[str, ...]:
    """Column names from the cells of a header: an empty cell keeps its place as ``_c<position>``;
    a repeated name gets ``.1``, ``.2``, ... behind it."""
    names: list[str] = []
    for i, cell in enumerate(cells):
        name = base = cell if cell.strip() else f"_c{i}"
        k = 0
        while name in names:
            k += 1
            name = f"{base}.{k}"
        names.append(name)
    return tuple(names)


def find_header(lines: Sequence[str], skip: int) -> tuple[list[str], int, bool] | None:
    """The cells of the header after ``skip`` records; how many records a CSV reader that leaves out
    blank lines gives up to and with it; whether a record so far has a line break. None if the
    lines end before a header."""
    seen, reader = 0, csv.reader(io.StringIO("\n".join(lines)))
    for k, cells in enumerate(reader):
        seen += bool(cells)
        if k >= skip and cells:
            return cells, seen, reader.line_num > k + 1
    return None


def _heads(skip: int, one_file_a_task: bool):
    """Batches of (file, value) -> (file, cells, drop) of each file. Stops at the first file's
    header if the task has one file only."""
    schema = pa.schema([("file", pa.string()), ("cells", pa.list_(pa.string())), ("drop", pa.int32()), ("broken", pa.bool_())])
    most = skip + HEADER_LINES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: dict[str, list[str]] = {}
        for batch in batches:
            for file, line in zip(batch["file"].to_pylist(), batch["value"].to_pylist()):
                lines = head.setdefault(file, [])
                if len(lines) < most:
                    lines.append(line)
            if one_file_a_task and head and min(map(len, head.values())) >= most:
                break
        found = [(file, *h) for file, (first, *rest) in head.items() if (h := find_header([first.removeprefix("\ufeff"), *rest], skip))]
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in found], schema)

    return run


def _plain(uri: str) -> str:
    """Spark writes one file's URI in several ways: escaped or not, with one or three slashes."""
    return re.sub(r"^(\w+:)/+", r"\1/", unquote(uri))


def layouts_by(spark: SparkSession, paths: Mapping[Any, str | Sequence[str]], skip: int = 0) -> dict[Any, list[Layout]]:
    """For each name in ``paths`` the groups of files with equal headers among its path (a file,
    folder, glob or list of these), all found by one job.

    ``skip`` records, blank lines included, come before each header. Empty files are in no group."""
    # a session of its own, whose scans give every file a task, leaves the caller's settings alone
    side = spark.newSession()
    side.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    side.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))
    side.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(skip + HEADER_LINES))
    files = {name: side.read.text([path] if isinstance(path, str) else list(path)).inputFiles() for name, path in paths.items()}
    every = sorted({f for found in files.values() for f in found})
    if not every:
        return {name: [] for name in paths}
    lines = side.read.text(every).select(F.col("_metadata.file_path").alias("file"), "value")
    alone = lines.rdd.getNumPartitions() >= len(every)
    rows = lines.mapInArrow(_heads(skip, alone), "file string, cells array<string>, drop int, broken boolean").collect()
    head = {_plain(r["file"]): (header_names(r["cells"]), r["drop"], r["broken"]) for r in rows}
    out: dict[Any, list[Layout]] = {}
    for name, found in files.items():
        groups: dict[tuple, list[str]] = {}
        for f in sorted(found):
            if _plain(f) in head:
                groups.setdefault(head[_plain(f)], []).append(f)
        out[name] = [Layout(*key, own) for key, own in groups.items()]
    return out


def layouts(spark: SparkSession, path: str | Sequence[str], skip: int = 0) -> list[Layout]:
    """The groups of files with equal headers among ``path``."""
    return layouts_by(spark, {"": path}, skip)[""]


def scan(spark: SparkSession, layout: Layout, multi_line: bool = False) -> DataFrame:
    """One scan of the files of a layout: all its columns as text, under its names.

    With one record to drop (a header in the first line) files are read in splits, each from its
    own start or middle. Beyond that, or with ``multi_line`` records, a file is one task's work,
    as for any reader of such files: records are numbered within their file, and those before the
    data are left out."""
    places = [f"c{i}" for i in range(len(layout.names))]
    reader = spark.read.schema(", ".join(f"{c} STRING" for c in places)).option("escape", '"')
    if layout.drop <= 1 and not layout.broken and not multi_line:
        raw = reader.option("header", True).option("enforceSchema", True).csv(layout.files)
    else:
        raw = reader.option("multiLine", True).csv(layout.files)
        raw = raw.select("*", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__at"))
        number = F.row_number().over(Window.partitionBy("__file").orderBy("__at"))
        raw = raw.withColumn("__n", number).where(F.col("__n") > layout.drop)
    return raw.select(*[F.col(c).alias(n) for c, n in zip(places, layout.names)])

