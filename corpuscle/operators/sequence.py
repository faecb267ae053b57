"""Ordered scans over long sequences that never window over a whole hot group.

Rows of an entity are cut into blocks (``block`` column). A scan runs within blocks, and what it carries from the blocks
before comes from one summary row per block; only the summaries pass through an entity-wide window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def null_safe(left: list[str], right: list[str]) -> Column:
    """left[i] <=> right[i] for all i."""
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with ``cols``, each computed once per row: a generator that the optimiser doesn't inline into lambdas that use them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def with_carry(rows: DataFrame, entity: list[str], block: str, summary: Column, fold, name: str) -> DataFrame:
    """``rows`` with ``name``: ``fold`` (F.max, F.sum, ...) of ``summary`` over all earlier blocks of the entity.

    Null in an entity's first block. Null entities and blocks equal each other.
    """
    before = Window.partitionBy(*entity).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*entity, block]
    other = [f"_seq_k{i}" for i in range(len(keys))]
    sums = rows.groupBy(*keys).agg(summary.alias("_seq_sum"))
    carry = sums.select(*[F.col(k).alias(o) for k, o in zip(keys, other)], fold("_seq_sum").over(before).alias(name))
    return rows.join(carry, null_safe(keys, other), "left").drop(*other)


def running_sum(rows: DataFrame, entity: list[str], block: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``name``: sum of ``value`` up to and including the row. Ties of ``order`` are added in any order."""
    local = Window.partitionBy(*entity, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    valued = with_carry(rows.withColumn("_seq_v", value), entity, block, F.sum("_seq_v"), F.sum, "_seq_c")
    return valued.withColumn(name, F.coalesce("_seq_c", F.lit(0)) + F.coalesce(F.sum("_seq_v").over(local), F.lit(0))).drop("_seq_v", "_seq_c")


def last_known(rows: DataFrame, entity: list[str], block: str, order: list[str], value: Column, name: str, inclusive: bool = True) -> DataFrame:
    """``name``: the last non-null ``value`` up to the row (before it, unless ``inclusive``); null if there is none."""
    local = Window.partitionBy(*entity, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    at = F.struct(*order)
    valued = rows.withColumn("_seq_v", value)
    latest = F.max(F.when(F.col("_seq_v").isNotNull(), F.struct(at.alias("at"), F.col("_seq_v").alias("v"))))["v"]
    valued = with_carry(valued, entity, block, latest, lambda c: F.last(c, ignorenulls=True), "_seq_c")
    return valued.withColumn(name, F.coalesce(F.last("_seq_v", ignorenulls=True).over(local), F.col("_seq_c"))).drop("_seq_v", "_seq_c")


#: Blocks whose functions are composed in one step of ``states_before``: 1 << FAN_BITS.
FAN_BITS = 8


def states_before(blocks: DataFrame, entity: list[str], block: str, step: str, gain: str | None, start: int, names: tuple[str, str]) -> DataFrame:
    """entity, block and, named by ``names``, the state before each block and the gains of all blocks before it.

    ``step`` (array<int>) maps a state (0, 1, ...) to the one behind the block, ``gain`` (array<bigint>, none if null) to what the block adds.
    A prefix scan over a tree: the functions of neighbouring blocks compose in groups, then over the groups of the entity, and states go back
    down, so no row gathers more than a group's functions or one function per group. ``blocks`` has one row per block, an integer.
    """
    gains = F.col(gain) if gain else F.transform(step, lambda _: F.lit(0).cast("bigint"))
    b = blocks.select(*entity, F.shiftright(F.col(block), FAN_BITS).alias("_g"), F.struct(F.col(block).alias("b"), F.col(step).cast("array<int>").alias("f"), gains.cast("array<bigint>").alias("c")).alias("_y"))
    groups = b.groupBy(*entity, "_g").agg(F.array_sort(F.collect_list("_y")).alias("_x"))
    first = F.struct(F.element_at("_x", 1)["f"].alias("f"), F.element_at("_x", 1)["c"].alias("c"))
    both = lambda acc, x: F.struct(F.transform(acc["f"], lambda s: F.get(x["f"], s)).alias("f"), F.zip_with(acc["c"], acc["f"], lambda n, s: n + F.get(x["c"], s)).alias("c"))
    whole = F.aggregate(F.slice("_x", 2, F.greatest(F.size("_x") - 1, F.lit(0))), first, both)

    def scanned(begin: Column) -> Column:
        """The (state, gains) before each of ``_x``."""
        move = lambda acc, x: F.array_append(acc, F.struct(F.get(x["f"], F.element_at(acc, -1)["s"]).alias("s"), (F.element_at(acc, -1)["n"] + F.get(x["c"], F.element_at(acc, -1)["s"])).alias("n")))
        return F.zip_with("_x", F.slice(F.aggregate("_x", F.array(begin), move), F.lit(1), F.size("_x")), lambda x, y: F.struct(x["b"].alias("b"), y.alias("y")))

    tops = once(groups, _w=whole).select(*entity, F.struct(F.col("_g").alias("b"), F.col("_w.f").alias("f"), F.col("_w.c").alias("c")).alias("_t")).groupBy(*entity).agg(F.array_sort(F.collect_list("_t")).alias("_x"))
    other = [f"_seq_k{i}" for i in range(len(entity) + 1)]
    begin = F.struct(F.lit(start).alias("s"), F.lit(0).cast("bigint").alias("n"))
    tops = tops.select(*[F.col(k).alias(o) for k, o in zip(entity, other)], F.explode(scanned(begin)).alias("_z")).select(*other[:-1], F.col("_z.b").alias(other[-1]), F.col("_z.y").alias("_in"))
    down = groups.join(tops, null_safe([*entity, "_g"], other)).select(*entity, F.explode(scanned(F.col("_in"))).alias("_z"))
    return down.select(*entity, F.col("_z.b").alias(block), F.col("_z.y.s").alias(names[0]), F.col("_z.y.n").alias(names[1]))
