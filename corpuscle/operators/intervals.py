"""Overlapping, nested and gapped intervals per entity: continuous periods and the gaps between them.

Sort by start, compare each start with the running maximum of the ends before it, number the islands cumulatively,
aggregate. A single entity may hold a large part of all rows, so nothing here windows over a whole entity's rows: the time
line is cut into buckets, a bucket's running maximum is seeded with the maximum of the buckets before it, and only one
summary row per non-empty bucket goes through an entity-wide window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.operators.sequence import running_sum, with_carry

#: Width of a time bucket. An entity-wide window sees one row per non-empty bucket.
BUCKET_MS = 600_000


def to_ms(col: str | Column) -> Column:
    """Seconds to whole milliseconds; NaN and infinities, like null, are no time."""
    c = F.col(col) if isinstance(col, str) else col
    ok = c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(9.0e15))
    return F.when(ok, F.round(c * F.lit(1000.0)).cast("bigint"))


def island_marks(df: DataFrame, entity: list[str], start: str, end: str, bucket: int = BUCKET_MS) -> DataFrame:
    """Distinct starts of each entity with ``_prev_end``, the greatest end before them, and ``_new`` where a period begins.

    ``start`` and ``end`` are integers of one unit. Rows with a null bound or an end before the start hold no span. Spans
    that touch (start equal to the greatest end before) belong together. Repeated rows and equal starts collapse in a
    map-side aggregate. Null entities form one entity. An empty input gives an empty result.
    Columns: entity, ``_start``, ``_end``, ``_bucket``, ``_prev_end``, ``_new``.
    """
    spans = (
        df.select(*entity, F.col(start).alias("_start"), F.col(end).alias("_end"))
        .where("_start is not null and _end is not null and _end >= _start")
        .groupBy(*entity, "_start")
        .agg(F.max("_end").alias("_end"))
        .withColumn("_bucket", F.floor(F.col("_start") / F.lit(bucket)).cast("bigint"))
    )
    by_bucket = Window.partitionBy(*entity, "_bucket").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    seeded = with_carry(spans, entity, "_bucket", F.max("_end"), F.max, "_seed")
    prev = F.greatest(F.col("_seed"), F.max("_end").over(by_bucket))
    return seeded.withColumn("_prev_end", prev).withColumn("_new", F.col("_prev_end").isNull() | (F.col("_start") > F.col("_prev_end"))).drop("_seed")


def gaps(df: DataFrame, entity: list[str], start: str, end: str, bucket: int = BUCKET_MS) -> DataFrame:
    """Gaps between neighbouring continuous periods: entity, ``gap_start``, ``gap_end``."""
    marks = island_marks(df, entity, start, end, bucket)
    return marks.where("_new and _prev_end is not null").select(*entity, F.col("_prev_end").alias("gap_start"), F.col("_start").alias("gap_end"))


def periods(df: DataFrame, entity: list[str], start: str, end: str, bucket: int = BUCKET_MS) -> DataFrame:
    """Continuous periods, numbered from 0 in order of time: entity, ``period``, ``start``, ``end``, ``n_starts``."""
    marks = island_marks(df, entity, start, end, bucket)
    numbered = running_sum(marks, entity, "_bucket", ["_start"], F.col("_new").cast("bigint"), "_island").withColumn("period", F.col("_island") - 1)
    return numbered.groupBy(*entity, "period").agg(F.min("_start").alias("start"), F.max("_end").alias("end"), F.count("*").alias("n_starts"))
