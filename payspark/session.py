"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "payspark", master: str | None = None, shuffle_partitions: int | None = None):
    """A session with adaptive execution on; cluster settings already present are left alone."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # wide feature projections make methods the JVM refuses to compile; run those stage by operator instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("PAYSPARK_DRIVER_MEMORY", "12g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; ``fallback`` serves only where it is unset."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if d:
        return d
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is not set; pass a shared folder")
    return fallback


def use_checkpoints(spark: SparkSession, fallback: str | None = None) -> str:
    d = shared_dir(spark, fallback)
    spark.sparkContext.setCheckpointDir(d)
    return d


def work_path(spark: SparkSession, tag: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder serves local sessions and the warehouse serves clusters.
    """
    try:
        base = shared_dir(spark)
    except ValueError:
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        base = tempfile.mkdtemp(prefix="payspark-") if local else spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/payspark-{tag}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: work that several readers share, and a cut of its lineage."""
    path = work_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
