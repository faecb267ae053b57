"""The closed annotation vocabulary as a dimension and normalised labels of the annotations table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The annotation vocabulary, version v1.
VERSION = "v1"
VALUES = {
    "function": ["hook", "promise", "context", "escalation", "mechanism", "evidence", "objection", "resolution", "implication", "cta"],
    "loop": ["opens", "closes", "holds", "none"],
    "evidence_type": ["study", "statistic", "case", "analogy", "authority"],
    "scale": ["individual", "human", "planetary", "abstract"],
    "density": ["0", "1", "2"],
}
REQUIRED = {"function": True, "loop": True, "evidence_type": False, "scale": True, "density": True}
CONDITION = {"evidence_type": ("function", "evidence")}


def vocabulary(spark: SparkSession) -> DataFrame:
    """One row per allowed value: field, value, required, condition."""
    rows = [(f, v, REQUIRED[f], " == ".join(CONDITION[f]) if f in CONDITION else None) for f, vs in VALUES.items() for v in vs]
    return spark.createDataFrame(rows, "field string, value string, required boolean, condition string")


def normal(col: str) -> F.Column:
    """A label without outer white space, in lower case; null stays null."""
    return F.lower(F.regexp_replace(F.col(col).cast("string"), r"^\s+|\s+$", ""))


def long_labels(annotations: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, ``field``, ``label``: valid labels only; evidence_type only where function is evidence."""
    clean = annotations.select(*keys, *[normal(f).alias(f"_l_{f}") for f in {*fields, "function"}])
    tags = []
    for f in fields:
        ok = F.col(f"_l_{f}").isin(VALUES[f])
        if f in CONDITION:
            on, need = CONDITION[f]
            ok = ok & F.coalesce(F.col(f"_l_{on}") == need, F.lit(False))
        tags.append(F.when(ok, F.struct(F.lit(f).alias("field"), F.col(f"_l_{f}").alias("label"))))
    out = clean.select(*keys, F.explode(F.array_compact(F.array(*tags))).alias("_x"))
    return out.select(*keys, "_x.field", "_x.label")
