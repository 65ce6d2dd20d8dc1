"""Published snapshots (K3, S10): tables become visible all at once, by a manifest written last.

``publish`` writes every table to a folder of its own attempt, counts what lies there (from the
footers), and only then adds one row per table to the manifest. Readers go by the manifest alone,
so a write that fails, or is still running, changes nothing for them, and the snapshot before stays
readable. Nothing is renamed or overwritten, which object stores do not do as one step.

    <root>/parts/<attempt>/<table>/[<column>=<value>/]part-*.parquet
    <root>/manifest/attempt=<attempt>/part-*.parquet
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "snapshot string, table string, path string, rows long, columns string, published timestamp"


def conform(df: DataFrame, columns: str) -> DataFrame:
    """The declared columns (DDL) of ``df``, by name, cast to their types; a missing one is an error."""
    wanted = df.sparkSession.createDataFrame([], columns).schema
    missing = [f.name for f in wanted if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns declared but not there: {', '.join(missing)}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])


def publish(frames: Mapping[str, DataFrame], root: str, snapshot: str, partition_by: Mapping[str, Sequence[str]] = {}) -> DataFrame:
    """Write ``frames`` (name -> table) as ``snapshot`` and return its manifest rows.

    A snapshot may be published again: readers see the attempt published last."""
    spark = next(iter(frames.values())).sparkSession
    attempt = uuid.uuid4().hex
    rows = []
    for name, df in frames.items():
        path = f"{root}/parts/{attempt}/{name}"
        df.write.partitionBy(*partition_by.get(name, ())).parquet(path)
        rows.append((snapshot, name, path, spark.read.schema(df.schema).parquet(path).count(), df.schema.json()))
    found = spark.createDataFrame(rows, "snapshot string, table string, path string, rows long, columns string")
    found = found.withColumn("published", F.current_timestamp())
    found.coalesce(1).write.parquet(f"{root}/manifest/attempt={attempt}")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest/attempt={attempt}")


def history(spark: SparkSession, root: str) -> DataFrame:
    """The manifest: a row per published table, with its attempt."""
    try:
        return spark.read.schema(f"{MANIFEST}, attempt string").parquet(f"{root}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{MANIFEST}, attempt string")


def _table(spark: SparkSession, row) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(json.loads(row["columns"]))).parquet(row["path"])


def published(spark: SparkSession, root: str, table: str, snapshot: str | None = None) -> DataFrame | None:
    """The table as of ``snapshot`` (the greatest, if None); None if there is none. Filters on
    partition columns prune folders."""
    rows = history(spark, root).where(F.col("table") == table)
    if snapshot is not None:
        rows = rows.where(F.col("snapshot") == snapshot)
    last = rows.orderBy(F.desc("snapshot"), F.desc("published"), "attempt").limit(1).collect()
    return _table(spark, last[0]) if last else None


def stage(spark: SparkSession, root: str, name: str, run: str, build: Callable[[], DataFrame], columns: str,
          partition_by: Sequence[str] = ()) -> DataFrame:
    """A stage of a recipe: what ``run`` has published under ``name`` already, else ``build()`` with the
    declared columns, published and read back. So a run that failed goes on where it stopped."""
    found = published(spark, root, name, run)
    if found is None:
        rows = publish({name: conform(build(), columns)}, root, run, {name: partition_by})
        found = _table(spark, rows.first())
    return found
