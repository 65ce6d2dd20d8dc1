"""Session helpers: local sessions for tests/bench, table loading, lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """A local session for tests and the bench. On a cluster, use the session the
    platform provides; every operator here only relies on session defaults."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, and have the context use it.

    It is the one named by ``spark.checkpoint.dir``, which is only read here; else the one given to
    ``setCheckpointDir``, whose sub-folder the context reports. With neither, only local sessions
    (tests, bench) get a scratch folder of their own; on a cluster that is an error."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if not current:
        folder = named
        if not folder:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="quarry-ckpt-")
        context.setCheckpointDir(folder)
        current = context.getCheckpointDir()
    return named or current.rstrip("/").rsplit("/", 1)[0]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never localCheckpoint:
    a lost executor must be able to recompute from durable data)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Lazy accessor: ``t = Tables(spark, dir); t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)
