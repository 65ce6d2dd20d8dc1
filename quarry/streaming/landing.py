"""Incremental ingestion of landed CSV files into a Parquet stage (S3/S4 + K1)."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import ensure_checkpoint_dir
from quarry.sources.readers import _coerce


def ingest_new_files(spark: SparkSession, landing_dir: str, stage_dir: str, raw_columns: list[str],
                     schema: Mapping[str, str], renames: Mapping[str, str] | None = None,
                     name: str = "landing") -> None:
    """Append every CSV file that landed since the last run to ``stage_dir``.

    The file source needs a fixed raw schema (all text); columns are then renamed,
    coerced by name and tagged with the year parsed from the file name. Progress is
    kept in ``<spark.checkpoint.dir>/<name>`` so a rerun (or a restarted driver)
    continues where the last one stopped; ``availableNow`` processes the backlog
    and stops."""
    raw_schema = T.StructType([T.StructField(c, T.StringType()) for c in raw_columns])
    stream = (spark.readStream.schema(raw_schema).option("header", True)
              .option("enforceSchema", False)  # a header that is not raw_columns in order is an error
              .option("pathGlobFilter", "*.csv").csv(landing_dir))
    for old, new in (renames or {}).items():
        if old in raw_columns:
            stream = stream.withColumnRenamed(old, new)
    year = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d{4})[^/]*$", 1)
    cols = [_coerce(n, k).alias(n) for n, k in schema.items()]
    out = stream.select(*cols, F.when(year != "", year.cast("int")).alias("Year"))
    ckpt = os.path.join(ensure_checkpoint_dir(spark), name)
    q = (out.writeStream.format("parquet").option("path", stage_dir)
         .option("checkpointLocation", ckpt).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
