"""Problem 6: continuous periods and gaps of sentences and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.operators.intervals import gaps, periods, to_ms
from corpuscle.sources.tables import current_rows, table


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    def level(name: str, key: str, tag: str) -> DataFrame:
        rows = current_rows(table(spark, sf_dir, name).select(key, "video_id", "start_s", "end_s", "loaded_at"), [key])
        return rows.select(F.lit(tag).alias("level"), "video_id", to_ms("start_s").alias("s"), to_ms("end_s").alias("e"))

    return level("sentences", "sent_id", "sentence").unionByName(level("windows", "window_id", "window"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = gaps(_spans(spark, sf_dir), ["level", "video_id"], "s", "e")
    return out.select("level", "video_id", F.col("gap_start").alias("gap_start_ms"), F.col("gap_end").alias("gap_end_ms"))


def p6_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periods(_spans(spark, sf_dir), ["level", "video_id"], "s", "e")
    return out.select("level", "video_id", F.col("period").cast("bigint").alias("period"), F.col("start").alias("start_ms"), F.col("end").alias("end_ms"))


_SPANS = """
spans AS (
  SELECT level, video_id, CAST(round(start_s * 1000) AS BIGINT) AS s, CAST(round(end_s * 1000) AS BIGINT) AS e
  FROM (
    SELECT 'sentence' AS level, * FROM (
      SELECT sent_id AS k, video_id, start_s, end_s, row_number() OVER (PARTITION BY sent_id ORDER BY loaded_at DESC) AS rn FROM sentences)
    UNION ALL
    SELECT 'window' AS level, * FROM (
      SELECT window_id AS k, video_id, start_s, end_s, row_number() OVER (PARTITION BY window_id ORDER BY loaded_at DESC) AS rn FROM windows)
  ) WHERE rn = 1
),
ok AS (SELECT * FROM spans WHERE s IS NOT NULL AND e IS NOT NULL AND e >= s),
seen AS (
  SELECT *, max(e) OVER (PARTITION BY level, video_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ok
),
marked AS (
  SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY level, video_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) - 1 AS island FROM seen
)
"""

QUERIES = {"p6_found": p6_found, "p6_periods": p6_periods}
SQL = {
    "p6_found": f"WITH {_SPANS} SELECT level, video_id, before AS gap_start_ms, s AS gap_end_ms FROM marked WHERE s > before",
    "p6_periods": f"WITH {_SPANS} SELECT level, video_id, CAST(island AS BIGINT) AS period, min(s) AS start_ms, max(e) AS end_ms FROM marked GROUP BY 1, 2, 3",
}
