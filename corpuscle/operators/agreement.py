"""Agreement between coders: Krippendorff's alpha, confusion, votes, occurrence counts.

Alpha needs no pairs of labels. With the counts of values per unit, the disagreement of a unit is a closed form: m*m minus the sum
of squares for nominal data, and 2 * (m * sum(s*s) - sum(s)**2) for scores s with squared distance. The ordinal distance between
two values is the squared difference of their mid-ranks among the eligible ratings, so ordinal data are interval data of mid-ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ratings(df: DataFrame, by: list[str], unit: str, coder: str, value: str, order: str | None = None) -> DataFrame:
    """by, _u, _c, _v: one rating of a coder per unit, the last by ``order`` (the greatest value without one); nulls are no ratings."""
    rated = df.where(F.col(value).isNotNull() & F.col(unit).isNotNull() & F.col(coder).isNotNull())
    last = F.max(F.struct(*([order] if order else []), F.col(value).alias("_v")))["_v"]
    return rated.groupBy(*by, F.col(unit).alias("_u"), F.col(coder).alias("_c")).agg(last.alias("_v"))


def alpha(df: DataFrame, by: list[str], unit: str, coder: str, value: str, level: str = "nominal", order: str | None = None) -> DataFrame:
    """by, ``alpha``, ``n_units``, ``n_ratings`` over the units of at least two ratings.

    ``level``: nominal, ordinal (values in their sort order) or interval (numeric). Null where no unit is eligible (a group then has no row;
    without groups there is one), or where the eligible ratings have fewer than two distinct values. Counted by value before any shuffle of
    units, so neither a frequent value nor a busy coder is one task's work. A null group is a group.
    """
    per_value = ratings(df, by, unit, coder, value, order).groupBy(*by, "_u", "_v").agg(F.count("*").cast("double").alias("_n"))
    whole = Window.partitionBy(*by, "_u")
    eligible = per_value.withColumn("_m", F.sum("_n").over(whole)).where("_m >= 2")
    margins = eligible.groupBy(*by, "_v").agg(F.sum("_n").alias("_nv"))
    ranked = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    if level == "ordinal":
        margins = margins.withColumn("_s", F.sum("_nv").over(ranked) - F.col("_nv") / F.lit(2.0))
    elif level == "interval":
        margins = margins.withColumn("_s", F.col("_v").cast("double"))
    else:
        margins = margins.withColumn("_s", F.lit(0.0))
    tot = F.sum("_nv")
    if level == "nominal":
        expected = tot * tot - F.sum(F.col("_nv") * F.col("_nv"))
    else:
        expected = F.lit(2.0) * (tot * F.sum(F.col("_nv") * F.col("_s") * F.col("_s")) - F.sum(F.col("_nv") * F.col("_s")) * F.sum(F.col("_nv") * F.col("_s")))
    names = {b: f"_by{i}" for i, b in enumerate(by)}
    de = margins.groupBy(*[F.col(b).alias(n) for b, n in names.items()]).agg(expected.alias("_e"), tot.alias("_t"), F.count("*").alias("_k"))
    on = F.lit(True)
    for b, n in names.items():
        on = on & F.col(b).eqNullSafe(F.col(n))
    if level == "nominal":
        scored, unit_sum = eligible, F.max("_m") * F.max("_m") - F.sum(F.col("_n") * F.col("_n"))
    else:
        scores = margins.select(*[F.col(b).alias(n) for b, n in names.items()], F.col("_v").alias("_w"), "_s")
        scored = eligible.join(scores, on & (F.col("_v") == F.col("_w")))
        unit_sum = F.lit(2.0) * (F.max("_m") * F.sum(F.col("_n") * F.col("_s") * F.col("_s")) - F.sum(F.col("_n") * F.col("_s")) * F.sum(F.col("_n") * F.col("_s")))
    units = scored.groupBy(*by, "_u").agg((unit_sum / (F.max("_m") - F.lit(1.0))).alias("_d"))
    do = units.groupBy(*by).agg(F.sum("_d").alias("_o"), F.count("*").alias("n_units"))
    value_ = F.when(F.col("_k") >= 2, F.lit(1.0) - (F.col("_o") / F.col("_t")) / (F.col("_e") / (F.col("_t") * (F.col("_t") - F.lit(1.0)))))
    return do.join(F.broadcast(de) if not by else de, on).select(*by, value_.alias("alpha"), F.col("n_units").cast("bigint").alias("n_units"), F.col("_t").cast("bigint").alias("n_ratings"))


def confusion(df: DataFrame, unit: str, coder: str, value: str, first: str, second: str, by: list[str] | None = None) -> DataFrame:
    """by, ``label_a``, ``label_b``, ``n``: how often two coders gave which labels to the same units."""
    by = by or []
    pair = df.where(F.col(coder).isin(first, second)).groupBy(*by, unit).agg(F.max(F.when(F.col(coder) == first, F.col(value))).alias("label_a"), F.max(F.when(F.col(coder) == second, F.col(value))).alias("label_b"))
    return pair.where("label_a is not null and label_b is not null").groupBy(*by, "label_a", "label_b").agg(F.count("*").alias("n"))


def confused_pairs(df: DataFrame, by: list[str], unit: list[str], value: str) -> DataFrame:
    """by, ``label_a`` < ``label_b``, ``n``, ``rate``: pairs of ratings of one unit that differ, and their share of all pairs of the group.

    Counted by value within the unit first, so pairs of labels are multiplied, never listed. Null values are no ratings.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, *unit, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    held = counts.groupBy(*by, *unit).agg(F.array_sort(F.collect_list(F.struct("_v", "_n"))).alias("_x"))
    same = lambda x: F.struct(x["_v"].alias("a"), x["_v"].alias("b"), (x["_n"] * (x["_n"] - 1) / 2).cast("bigint").alias("n"))
    across = F.flatten(F.transform("_x", lambda x: F.transform(F.filter("_x", lambda y: y["_v"] > x["_v"]), lambda y: F.struct(x["_v"].alias("a"), y["_v"].alias("b"), (x["_n"] * y["_n"]).alias("n")))))
    pair = held.select(*by, F.explode(F.concat(F.transform("_x", same), across)).alias("_p")).groupBy(*by, F.col("_p.a").alias("label_a"), F.col("_p.b").alias("label_b")).agg(F.sum("_p.n").cast("bigint").alias("n"))
    rated = pair.where("n > 0").withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))
    return rated.where("label_a <> label_b")


def majority(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, ``label`` (null without consensus), ``votes``, ``n_ratings``, ``consensus``: a strict majority of the ratings. Null values don't vote."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    best = counts.groupBy(*by).agg(F.max(F.struct("_n", "_v")).alias("_b"), F.sum("_n").cast("bigint").alias("n_ratings"))
    agreed = F.col("_b._n") * 2 > F.col("n_ratings")
    return best.select(*by, F.when(agreed, F.col("_b._v")).alias("label"), F.col("_b._n").alias("votes"), "n_ratings", agreed.alias("consensus"))


def occurrence(df: DataFrame, field: str, value: str, vocabulary: DataFrame) -> DataFrame:
    """``vocabulary`` (field, value) with ``n``, zero where a value never occurs."""
    counts = df.groupBy(F.col(field).alias("_f"), F.col(value).alias("_w")).agg(F.count("*").alias("_n"))
    return vocabulary.join(counts, (F.col(field) == F.col("_f")) & (F.col(value) == F.col("_w")), "left").select(field, value, F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"))


def mutual_information(df: DataFrame, a: str, b: str) -> DataFrame:
    """``mi_bits``, ``entropy_a``, ``entropy_b`` of two label columns; rows with a null are left out."""
    n = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count("*").cast("double").alias("_n"))
    everything = Window.partitionBy(F.lit(1))  # the contingency table, one row per pair of labels
    t = n.withColumn("_t", F.sum("_n").over(everything)).withColumn("_na", F.sum("_n").over(Window.partitionBy("_a"))).withColumn("_nb", F.sum("_n").over(Window.partitionBy("_b")))
    mi = F.sum(F.col("_n") / F.col("_t") * F.log2(F.col("_n") * F.col("_t") / (F.col("_na") * F.col("_nb"))))
    h = lambda c: -F.sum(F.col("_n") / F.col("_t") * F.log2(F.col(c) / F.col("_t")))
    return t.agg(F.round(mi, 6).alias("mi_bits"), F.round(h("_na"), 6).alias("entropy_a"), F.round(h("_nb"), 6).alias("entropy_b"))
