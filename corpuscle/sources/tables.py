"""Parquet tables of a scale directory and their current rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table; a file or a folder of files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def current_rows(df: DataFrame, keys: list[str], order: str = "loaded_at") -> DataFrame:
    """One row per key: the one delivered last.

    The greatest ``order`` wins, null being least; of equal ones the greatest remaining columns, so that the result is
    the same whatever the order of arrival. Null keys equal each other. Aggregated map-side before the only shuffle.
    Prune columns before calling: every column left in ``df`` travels.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    picked = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_row"))
    return picked.select(*keys, F.col(f"_row.{order}").alias(order), *[F.col(f"_row.{c}").alias(c) for c in rest])
