"""The corpus pipeline: language ID, quality rules, near-dedup, mixing, packing.

Every stage is written as Parquet and read again before the next one, in the shared folder
that spark.checkpoint.dir names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import language_id, mixing, near_dedup, packing, quality_rules
from quarry.llm.common import read
from quarry.session import ensure_checkpoint_dir

STAGES = [
    ("language_id", language_id.stage),
    ("quality_rules", quality_rules.stage),
    ("near_dedup", near_dedup.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]

#: Language ID and packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
