"""Sinks: CSV export, Parquet stages, JSON documents, dated snapshots with a
manifest, report tables (K1-K4). Writes are distributed (one file per task); no
result passes through the driver."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.quality import manifest


def write_csv(df: DataFrame, path: str) -> None:
    """K1: full-overwrite CSV with a header; NULL stays an empty field."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json_rows(df: DataFrame, path: str) -> None:
    """JSON lines where NULL fields are written as ``null`` (keys kept), and so are the numbers
    that JSON has no word for (NaN, infinities); no rounding is applied (T30)."""
    numbers = {c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c)) for c, kind in df.dtypes if kind in ("double", "float")}
    df = df.withColumns(numbers) if numbers else df
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_baselines(average: DataFrame, recent: DataFrame, metadata: Mapping[str, object], path: str) -> None:
    """K2: baseline document as three row sets: metadata (one row),
    baseline_average/, baseline_most_recent/."""
    spark = average.sparkSession
    meta = spark.createDataFrame([tuple(metadata.values())], list(metadata.keys()))
    write_json_rows(meta, os.path.join(path, "metadata"))
    write_json_rows(average, os.path.join(path, "baseline_average"))
    write_json_rows(recent, os.path.join(path, "baseline_most_recent"))


def write_snapshot(frames: Mapping[str, DataFrame], root: str, snapshot: str) -> DataFrame:
    """K3: write each output under ``root/<name>/snapshot=<date>/`` and return the
    manifest (table, rows, snapshot) read back from the written data."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(os.path.join(root, name, f"snapshot={snapshot}"))
    spark = next(iter(frames.values())).sparkSession
    written = {name: spark.read.parquet(os.path.join(root, name, f"snapshot={snapshot}")) for name in frames}
    m = manifest(written, snapshot)
    m.write.mode("overwrite").parquet(os.path.join(root, "_manifest", f"snapshot={snapshot}"))
    return m


def write_reports(reports: Mapping[str, DataFrame], root: str) -> None:
    """K4: one table per report (Parquet and CSV); rendering is not built."""
    for name, df in reports.items():
        df.write.mode("overwrite").parquet(os.path.join(root, name))
        write_csv(df, os.path.join(root, f"{name}_csv"))
