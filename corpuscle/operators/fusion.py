"""Runs of equal labels: blocks, smoothing, positions, thirds, pairs of openings and closings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.operators.sequence import last_known, running_sum

#: Rows (by order) of a block.
BLOCK = 4_096


def runs(df: DataFrame, by: str, order: str, label: str) -> DataFrame:
    """by, ``run`` (from 0), ``label``, ``n``, ``first``, ``last``: neighbouring rows of one label. A null label is a label.

    ``order`` is an integer; rows are scanned by blocks of BLOCK, so an entity of any length is no single task's sort.
    """
    rows = df.select(by, order, label, F.coalesce(F.floor(F.col(order) / BLOCK), F.lit(-1)).cast("bigint").alias("_block"))
    before = last_known(rows, [by], "_block", [order], F.struct(F.col(label).alias("l")), "_before", inclusive=False)
    new = F.col("_before").isNull() | ~F.col("_before.l").eqNullSafe(F.col(label))
    numbered = running_sum(before, [by], "_block", [order], new.cast("bigint"), "_run")
    return numbered.groupBy(by, (F.col("_run") - 1).alias("run")).agg(F.max(label).alias("label"), F.count("*").alias("n"), F.min(order).alias("first"), F.max(order).alias("last"))


def absorbed(run: DataFrame, by: str) -> DataFrame:
    """``run`` with ``absorbed``: a run of one row between runs of at least two rows of one label. All at once: such runs can't be neighbours."""
    w = Window.partitionBy(by).orderBy("run")
    near = (F.lag("label").over(w) == F.lead("label").over(w)) & (F.lag("n").over(w) >= 2) & (F.lead("n").over(w) >= 2)
    return run.withColumn("absorbed", F.coalesce((F.col("n") == 1) & near, F.lit(False)))


def smooth(run: DataFrame, by: str) -> DataFrame:
    """by, ``block``, ``label``, ``n``, ``first``, ``last``, ``n_absorbed`` after absorption."""
    w = Window.partitionBy(by).orderBy("run")
    a = absorbed(run, by)
    a = a.withColumn("_l", F.when(F.col("absorbed"), F.lag("label").over(w)).otherwise(F.col("label")))
    before = F.lag(F.struct("_l")).over(w)
    new = (before.isNull() | ~before["_l"].eqNullSafe(F.col("_l"))).cast("bigint")
    b = a.withColumn("_new", new).withColumn("block", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return b.groupBy(by, "block").agg(F.max("_l").alias("label"), F.sum("n").cast("bigint").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.count_if("absorbed").alias("n_absorbed"))


def thirds(df: DataFrame, by: str, order: str) -> DataFrame:
    """``third`` 1, 2 or 3 of every row's place; what doesn't divide goes to the later thirds."""
    w = Window.partitionBy(by)
    k, n = F.row_number().over(w.orderBy(order)) - 1, F.count("*").over(w)
    return df.withColumn("third", F.when(k < F.floor(n / 3), 1).when(k < F.floor(2 * n / 3), 2).otherwise(3))


def pairs(df: DataFrame, by: str, order: str, label: str, opening: str, closing: str) -> DataFrame:
    """by, ``k``, ``opened``, ``closed``: the k-th opening with the k-th closing of the entity, where that lies after it."""
    w = Window.partitionBy(by).orderBy(order)
    side = lambda v, name: df.where(F.col(label) == v).select(by, F.col(order).alias(name), F.row_number().over(w).alias("k"))
    return side(opening, "opened").join(side(closing, "closed"), [by, "k"]).where("closed > opened").select(by, F.col("k").cast("bigint").alias("k"), "opened", "closed")
