"""Readers: CSV by name with coercion, yearly file stacks, year from file name,
preamble skipping, nested JSON flattening, pushed-down scans (S1-S6, S10)."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.coerce import na_to_null, to_date_lenient, to_long_id, to_number
from quarry.operators.columns import rename
from quarry.operators.merge import union_by_name
from quarry.sources.catalogue import header_names, layouts, layouts_by, scan


def _coerce(col: str, kind: str):
    if kind in ("double", "number"):
        return to_number(col)
    if kind == "date":
        return to_date_lenient(col)
    if kind in ("long", "id"):
        return to_long_id(col)
    if kind == "int":
        return to_long_id(col).cast("int")
    return na_to_null(col)


def _missing(kind: str):
    """A NULL of the type that a declared kind is coerced to."""
    return F.lit(None).cast({"double": "double", "number": "double", "date": "date", "long": "bigint",
                             "id": "bigint", "int": "int"}.get(kind, "string"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_YEAR = "__year"  # until the declared columns, which may have a Year of their own, are there


def _typed(raw: DataFrame, schema: Mapping[str, str], keep_extra: bool = False) -> DataFrame:
    """``raw`` by name: the declared columns coerced, absent ones as NULL of their kind."""
    have = set(raw.columns)
    cols = [(_coerce(_quoted(n), k) if n in have else _missing(k)).alias(n) for n, k in schema.items()]
    return raw.select(*cols, *[F.col(_quoted(c)) for c in raw.columns if keep_extra and c not in schema])


def _empty(spark: SparkSession, schema: Mapping[str, str]) -> DataFrame:
    return spark.range(0).select(*[_missing(k).alias(n) for n, k in schema.items()])


def read_csv_by_name(spark: SparkSession, path: str | Sequence[str], schema: Mapping[str, str],
                     keep_extra: bool = False, skip: int = 0, multi_line: bool = False) -> DataFrame:
    """CSV files with headers, every field read as text, then selected BY NAME and
    coerced to the declared kind ('string', 'double', 'date', 'long', 'int').

    ``path`` is a file, a folder, a glob or a list of these; headers may differ from file to
    file (``catalogue.layouts``: one scan per distinct header, united by name). Declared columns
    that a file lacks become typed NULLs. ``skip`` records before each header are left out;
    ``multi_line`` says that quoted fields may hold line breaks. Without any header: no rows."""
    # text columns are united first, so each column is coerced by one expression
    found = [scan(spark, x, multi_line) for x in layouts(spark, path, skip)]
    return _typed(union_by_name(found), schema, keep_extra) if found else _empty(spark, schema)


def stack_yearly(spark: SparkSession, files: Mapping[int, str | Sequence[str]], schema: Mapping[str, str],
                 renames: Mapping[str, str] | None = None, source_flag: str | None = None) -> DataFrame:
    """S3: yearly files, folders, globs or lists of these (headers may differ between and within
    years), renamed by dictionary, coerced by name, tagged with a literal Year (and a 0/1 source
    flag), united by name."""
    frames = []
    for year, found in sorted(layouts_by(spark, files).items()):
        for layout in found:
            raw = scan(spark, layout)
            raw = rename(raw, renames) if renames else raw
            frames.append(raw.select(*[F.col(_quoted(c)) for c in raw.columns if c in schema], F.lit(int(year)).alias(_YEAR)))
    if frames:
        every = union_by_name(frames)
        out = _typed(every, schema, keep_extra=True)
    else:
        out = _empty(spark, schema).withColumn(_YEAR, F.lit(None).cast("int"))
    out = out.drop(*[c for c in schema if c == "Year"]).withColumnRenamed(_YEAR, "Year")
    return out.withColumn(source_flag, F.lit(1)) if source_flag else out


def with_year_from_path(df: DataFrame, out: str = "file_year", pattern: str = r"_(\d{4})[^/]*$") -> DataFrame:
    """The year in a file name (last '_YYYY' before the extension) from the
    scan's hidden ``_metadata.file_path``."""
    y = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return df.withColumn(out, F.when(y != "", y.cast("int")))


def latest_path(paths: Sequence[str]) -> str | None:
    """Newest file by name (names carry a sortable date). Metadata only."""
    return max(paths, key=os.path.basename) if paths else None


def read_csv_after_preamble(spark: SparkSession, path: str | Sequence[str], skip: int) -> DataFrame:
    """CSV exports (files, folders, globs) with ``skip`` junk records, blank lines included,
    before each header; all fields as text.

    Quoted fields may hold commas and line breaks; an empty header cell keeps its place as
    ``_c<position>``; columns of files with other headers are united by name. A file of this kind
    is read by one task, since where a record starts is known only from the start of the file."""
    found = [scan(spark, x._replace(names=header_names([n.strip() for n in x.names])), multi_line=True) for x in layouts(spark, path, skip)]
    return union_by_name(found) if found else spark.createDataFrame([], "value string")


_TEXT = T.StringType()
#: The fields of an entity and of its address.
ENTITY = T.StructType([
    *[T.StructField(n, _TEXT) for n in ("name", "entityType", "id340B")],
    T.StructField("streetAddress", T.StructType([T.StructField(n, _TEXT) for n in ("addressLine1", "city", "state", "zip")])),
    *[T.StructField(n, _TEXT) for n in ("participatingStartDate", "certifiedDecertifiedDate")],
    T.StructField("medicaidNumbers", T.ArrayType(T.StructType([T.StructField("medicaidNumber", _TEXT)]))),
    T.StructField("participating", T.BooleanType())])


def flatten_entities(spark: SparkSession, path: str) -> DataFrame:
    """Nested entity JSON -> one flat row per entity. The root may be an object
    with ``coveredEntities`` or a bare array. Absent text fields become '';
    the first medicaid number (or '') is kept. The schema is declared, not inferred, so
    empty arrays and absent fields have their types."""
    root = T.StructType([T.StructField("coveredEntities", T.ArrayType(ENTITY)), *ENTITY.fields])
    raw = spark.read.option("multiLine", True).schema(root).json(path)
    names = [f.name for f in ENTITY.fields]
    # a row of a bare array is an entity itself; an object holds them in its list
    own = F.array(F.struct(*names))
    bare = F.greatest(*[F.col(n).isNotNull() for n in names])
    rows = raw.select(F.explode(F.when(F.col("coveredEntities").isNotNull(), F.col("coveredEntities")).when(bare, own)).alias("e")).select("e.*")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    number = F.coalesce(F.get(F.col("medicaidNumbers"), F.lit(0))["medicaidNumber"], F.lit(""))
    return rows.select(
        text("name").alias("Entity Name"), text("entityType").alias("Entity Type"), text("id340B").alias("340B ID"),
        text("streetAddress.addressLine1").alias("Street Address 1"), text("streetAddress.city").alias("Street City"),
        text("streetAddress.state").alias("Street State"), text("streetAddress.zip").alias("Street Zip"),
        text("participatingStartDate").alias("Start Date"), text("certifiedDecertifiedDate").alias("Termination Date"),
        number.alias("Medicaid Billing Number"), F.col("participating").alias("Participating"))


def pruned_scan(spark: SparkSession, path: str, column: str, values: Sequence, columns: Sequence[str]) -> DataFrame:
    """Parquet scan with an IN filter and a column subset; Catalyst pushes both
    into the scan (PushedFilters / ReadSchema)."""
    return spark.read.parquet(path).where(F.col(column).isin(*values)).select(*columns)
