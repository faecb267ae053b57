"""Selecting and sampling: top-k pools, reserved samples, quotas with backfill."""

from __future__ import annotations

import random
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions.text import LONG_FORM_S, MATURE_DAYS
from corpuscle.session import settle


class PoolTooSmall(ValueError):
    """A pool has fewer items than were asked for."""


def eligible(df: DataFrame, by: str, duration: str, published: str, now: str, target: int, long_form: float = LONG_FORM_S) -> DataFrame:
    """Long-form rows of each pool that are mature; all long-form rows of a pool with fewer than ``target`` mature ones.

    An unknown date has age 0. ``now`` is a parameter, so the result doesn't depend on when it is made.
    """
    days = F.floor((F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col(published).cast("timestamp"))) / 86400)
    long_form = df.where(F.coalesce(F.col(duration), F.lit(0.0)) >= long_form).withColumn("_mature", F.coalesce(days, F.lit(0)) >= MATURE_DAYS)
    n = long_form.groupBy(F.col(by).alias("_by")).agg(F.count_if("_mature").alias("_n"))
    return long_form.join(n, F.col(by).eqNullSafe(F.col("_by"))).where(F.col("_mature") | (F.col("_n") < target)).drop("_by", "_n", "_mature")


def top_k(df: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    """``rank`` 1 to k of each group; Spark prunes with the limit of ranks before it shuffles."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


def hash_order(seed: int, key: str) -> Column:
    """A reproducible shuffle order that SQL engines share."""
    return F.sha1(F.concat(F.lit(f"{seed}:"), F.col(key)))


def quota_sample(df: DataFrame, owner: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows: an equal quota of each owner, smaller owners whole, the deficit from the remaining rows of all. ``n_owners`` is counted, not given.

    Raises ``PoolTooSmall`` if there are fewer than n rows.
    """
    owners = settle(df.groupBy(owner).agg(F.count("*").alias("_n")))
    sizes = owners.agg(F.count(owner).alias("o"), F.sum("_n").alias("r")).first()
    if (sizes.r or 0) < n:
        raise PoolTooSmall(f"{sizes.r or 0} rows, {n} wanted")
    quota = n // max(1, sizes.o)
    deficit = n - owners.agg(F.sum(F.least("_n", F.lit(quota))).alias("b")).first().b
    # Ranks up to the quota and n rows of the whole order are all that can be drawn; both prune before they shuffle.
    hashed = df.withColumn("_h", hash_order(seed, key))
    base = hashed.withColumn("_r", F.row_number().over(Window.partitionBy(owner).orderBy("_h", key))).where(F.col("_r") <= quota).drop("_r")
    first = base.select(F.col(key).alias("_k"))
    rest = hashed.orderBy("_h", key).limit(n).join(F.broadcast(first), F.col(key) == F.col("_k"), "left_anti").orderBy("_h", key).limit(deficit)  # at most n rows each
    return base.unionByName(rest).drop("_h")


def seeded_sample(ids: Sequence, k: int, seed: int) -> list:
    """Python's own draw, for parity with its random module."""
    return random.Random(seed).sample(ids, k)


def seeded_draw(df: DataFrame, by: str, key: str, k: int, seed: int) -> DataFrame:
    """by, key, ``rank`` (from 0): ``seeded_sample`` of the sorted keys of each group; smaller groups whole.

    Python's draw depends on the number of keys only, so places are drawn from the sizes and no group's keys are gathered.
    """
    placed = df.select(by, key, (F.row_number().over(Window.partitionBy(by).orderBy(key)) - 1).cast("bigint").alias("_i"))

    def places(batches):
        for pdf in batches:
            drawn = [(g, i, r) for g, n in zip(pdf["_g"], pdf["_n"]) for r, i in enumerate(seeded_sample(range(n), min(k, n), seed))]
            yield pd.DataFrame(drawn, columns=["_g", "_p", "rank"])

    drawn = df.groupBy(F.col(by).alias("_g")).agg(F.count("*").alias("_n")).mapInPandas(places, f"_g {dict(df.dtypes)[by]}, _p bigint, rank int")
    return placed.join(drawn, F.col(by).eqNullSafe(F.col("_g")) & (F.col("_i") == F.col("_p"))).select(by, key, "rank")


def holdout(pool: list[str], taken: set[str], size: int, least: int, seed: int) -> list[str]:
    """``size`` (down to ``least``) of the pool that aren't taken; none where both are 0 or less."""
    if size <= 0 and least <= 0:
        return []
    rest = [x for x in pool if x not in taken]
    if len(rest) < least:
        raise PoolTooSmall(f"{len(rest)} left, {least} wanted")
    return seeded_sample(rest, min(size, len(rest)), seed)


def anchored_draw(candidates: list[str], pool: list[str], n: int, seed: int) -> tuple[list[str], str]:
    """(n ids with one of the candidates first, one of them to repeat), by one generator."""
    rng = random.Random(seed)
    if candidates:
        anchor = rng.choice(sorted(candidates))
        drawn = [anchor, *rng.sample(sorted(x for x in pool if x != anchor), n - 1)]
    else:
        drawn = rng.sample(sorted(pool), n)
    return drawn, rng.choice(sorted(drawn))


def anchored_positions(df: DataFrame, by: str, key: str, candidate: str, n: int, seed: int) -> DataFrame:
    """``df`` with ``rank`` (from 0) and ``again``: ``anchored_draw`` of the sorted keys of each group; smaller groups give all they have.

    Draws depend on the numbers of keys and of candidates and on the anchor's place only, so no group's keys are gathered.
    """
    order = Window.partitionBy(by).orderBy(key)
    placed = df.withColumn("_i", (F.row_number().over(order) - 1).cast("bigint")).withColumn("_c", F.when(F.col(candidate), F.sum(F.col(candidate).cast("bigint")).over(order) - 1))
    sizes = placed.groupBy(F.col(by).alias("_g")).agg(F.count("*").alias("_n"), F.count("_c").alias("_m"))
    kind = dict(df.dtypes)[by]

    def anchors(batches):
        for pdf in batches:
            yield pd.DataFrame([(g, random.Random(seed).choice(range(m)) if m else -1) for g, m in zip(pdf["_g"], pdf["_m"])], columns=["_g2", "_a"])

    chosen = sizes.mapInPandas(anchors, f"_g2 {kind}, _a bigint")
    anchor = placed.join(chosen, F.col(by).eqNullSafe(F.col("_g2")) & (F.col("_c") == F.col("_a"))).select(F.col(by).alias("_g3"), F.col("_i").alias("_at"))
    sizes = sizes.join(anchor, F.col("_g").eqNullSafe(F.col("_g3")), "left").select("_g", "_n", "_m", F.coalesce("_at", F.lit(-1)).cast("bigint").alias("_at"))

    def places(batches):
        for pdf in batches:
            rows = []
            for g, size, m, at in zip(pdf["_g"], pdf["_n"], pdf["_m"], pdf["_at"]):
                rng = random.Random(seed)
                if m:
                    rng.choice(range(m))
                    drawn = [at, *(i + (i >= at) for i in rng.sample(range(size - 1), min(n, size) - 1))]
                else:
                    drawn = rng.sample(range(size), min(n, size))
                again = rng.choice(sorted(drawn))
                rows += [(g, i, r, i == again) for r, i in enumerate(drawn)]
            yield pd.DataFrame(rows, columns=["_g", "_p", "rank", "again"])

    drawn = sizes.mapInPandas(places, f"_g {kind}, _p bigint, rank int, again boolean")
    return placed.join(drawn, F.col(by).eqNullSafe(F.col("_g")) & (F.col("_i") == F.col("_p"))).drop("_g", "_p", "_i", "_c")
