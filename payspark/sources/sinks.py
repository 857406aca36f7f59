"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet overwrite; partition the merged table by source so profile filters prune files."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_versioned(df: DataFrame, root: str, name: str, stamp: str, latest_name: str | None = None) -> str:
    """A stamped copy and the latest copy; the second is read back from the first, so work runs once."""
    version = f"{root}/{name}_{stamp}.parquet"
    write_table(df, version)
    write_table(df.sparkSession.read.parquet(version), f"{root}/{latest_name or name + '_latest'}.parquet")
    return version


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A small report table as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def to_report(df: DataFrame, name: str = "report") -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))
