"""The registry of quality gates and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: id, phase, kind (bound, formula, qualitative), operator, value, unit, statement, blocking, scope (per_channel, global), roles it applies to.
GATES = [
    ("profile_videos", 1, "bound", ">=", 30.0, "videos", None, True, "per_channel", "benchmark,reference"),
    ("holdout_videos", 1, "bound", ">=", 4.0, "videos", None, True, "per_channel", "benchmark"),
    ("word_ratio", 1, "bound", ">=", 0.6, "of expected words", None, True, "per_channel", "benchmark,reference"),
    ("big_windows", 2, "formula", None, None, None, "big windows = big sentences", True, "per_channel", "benchmark"),
    ("single_ratio", 2, "bound", "<=", 0.15, "single windows", None, False, "per_channel", "benchmark,reference"),
    ("window_residual", 2, "bound", "==", 0.0, "unexplained windows", None, True, "per_channel", "benchmark,reference"),
    ("window_band", 2, "formula", None, None, None, "windows a video within 4.86 a minute, 40 % up or down", True, "per_channel", "benchmark,reference"),
    ("two_functions", 2, "bound", "<=", 5.0, "of 50 windows", None, True, "per_channel", "benchmark"),
    ("cut_sentences", 2, "bound", "==", 0.0, "of 50 windows", None, True, "per_channel", "benchmark"),
    ("coverage", 3, "bound", "<=", 20.0, "of 205 windows", None, True, "global", ""),
    ("self_agreement", 4, "bound", ">=", 0.8, "alpha", None, True, "global", ""),
    ("model_agreement", 5, "bound", ">=", 0.667, "alpha", None, True, "global", ""),
    ("smoothing", 5, "bound", "<=", 0.15, "of single blocks", None, True, "per_channel", "benchmark"),
    ("profile_schema", 6, "bound", "==", 1.0, "valid", None, True, "per_channel", "benchmark"),
    ("owner_knows_channel", 7, "qualitative", None, None, None, "the owner recognises the channel", True, "per_channel", "benchmark"),
]
_SCHEMA = "gate string, phase int, kind string, op string, value double, unit string, statement string, blocking boolean, scope string, roles string"


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GATES, _SCHEMA)


def threshold() -> Column:
    """A gate's threshold as text."""
    return F.when(F.col("kind") == "bound", F.concat_ws(" ", "op", F.format_string("%.3f", "value"), "unit")).otherwise(F.col("statement"))


def report(gates: DataFrame, channels: DataFrame, measured: DataFrame) -> DataFrame:
    """gate, channel (null for global gates), ``threshold``, ``status``: one row per gate and channel.

    The registry is a short list, so the cross product has a few rows per channel; the role decides before anything measured is looked at. A bound
    without a measurement is "not measured". A formula's measurement is the number of what breaks it; qualitative gates have none.
    """
    per = gates.where("scope = 'per_channel'").crossJoin(channels.select("channel", "role"))
    per = per.withColumn("applies", F.array_contains(F.split("roles", ","), F.col("role")))
    glob = gates.where("scope = 'global'").withColumn("channel", F.lit(None).cast("string")).withColumn("role", F.lit(None).cast("string")).withColumn("applies", F.lit(True))
    m = measured.select(F.col("gate").alias("_g"), F.col("channel").alias("_c"), F.col("measured").alias("_m"))
    rows = per.unionByName(glob).join(m, (F.col("gate") == F.col("_g")) & F.col("channel").eqNullSafe(F.col("_c")), "left")
    ok = F.when(F.col("op") == ">=", F.col("_m") >= F.col("value")).when(F.col("op") == "<=", F.col("_m") <= F.col("value")).when(F.col("op") == "==", F.col("_m") == F.col("value")).when(F.col("kind") == "formula", F.col("_m") == 0)
    number = F.format_string("%.3f", F.round("_m", 3))
    status = F.when(~F.coalesce("applies", F.lit(False)), F.lit("not applicable")).when(F.col("_m").isNull() | ok.isNull(), F.lit("not measured")).when(ok, F.concat(F.lit("passed ("), number, F.lit(")"))).otherwise(F.concat(F.lit("failed ("), number, F.lit(")")))
    return rows.select("gate", "channel", threshold().alias("threshold"), status.alias("status"))


def inconsistent(gates: DataFrame, channels: DataFrame) -> DataFrame:
    """Roles of gates that no channel has, and channels whose role no gate knows: name, problem."""
    roles = gates.where("scope = 'per_channel'").select(F.explode(F.split("roles", ",")).alias("role")).where("role <> ''").distinct()
    return roles.join(channels, "role", "left_anti").select(F.col("role").alias("name"), F.lit("role without channel").alias("problem")).unionByName(channels.join(roles, "role", "left_anti").select(F.col("channel").alias("name"), F.lit("channel of unknown role").alias("problem")))


def drift(now: DataFrame, stored: DataFrame) -> DataFrame:
    """gate, channel, ``was``, ``is``: rows of two reports whose threshold or status differ; null where a report lacks the row."""
    said = F.concat_ws(": ", "threshold", "status")
    a = now.select("gate", "channel", said.alias("is"))
    b = stored.select(F.col("gate").alias("_g"), F.col("channel").alias("_c"), said.alias("was"))
    both = a.join(b, F.col("gate").eqNullSafe(F.col("_g")) & F.col("channel").eqNullSafe(F.col("_c")), "full_outer")
    return both.where(~F.col("is").eqNullSafe(F.col("was"))).select(F.coalesce("gate", "_g").alias("gate"), F.coalesce("channel", "_c").alias("channel"), "was", "is")
