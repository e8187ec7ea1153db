"""Plain Parquet inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.session import fresh_path


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Table ``name`` below ``base``; columns and filters are pushed into the scan by Catalyst."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def spread_small(df: DataFrame, by: str) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has cores; leave any larger one alone.

    For row-wise work that costs more than moving the rows, such as parsing or cutting text. A table of
    real size has more splits than cores, so it is never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, by) if df.rdd.getNumPartitions() < cores else df


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, where several plans start from it; ``options`` are the writer's."""
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows for a look at a table (S12)."""
    return df.limit(n)


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    fs, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()) if fs.exists(target) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a partition folder and what it holds."""
    fs, target = _at(spark, path)
    fs.delete(target, True)
