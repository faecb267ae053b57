import random

from pyspark.sql import functions as F

from corpuscle.operators.intervals import gaps, periods, to_ms


def brute(rows):
    out = {}
    for k in {r[0] for r in rows}:
        merged = []
        for s, e in sorted((s, e) for kk, s, e in rows if kk == k and s is not None and e is not None and e >= s):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out[k] = merged
    return out


def test_random_against_brute_force_with_tiny_buckets(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", "hot", "hot", None]), s, None if s is None or rng.random() < 0.05 else s + rng.randint(-2, 9)) for s in (rng.choice([None, *range(200)]) for _ in range(600))]
    df = spark.createDataFrame(rows, "k string, s bigint, e bigint")
    want = brute(rows)
    for bucket in (1, 7, 50, 10_000):
        got = {(r.k, r.start, r.end) for r in periods(df, ["k"], "s", "e", bucket).collect()}
        assert got == {(k, s, e) for k, m in want.items() for s, e in m}
        g = {(r.k, r.gap_start, r.gap_end) for r in gaps(df, ["k"], "s", "e", bucket).collect()}
        assert g == {(k, a[1], b[0]) for k, m in want.items() for a, b in zip(m, m[1:])}


def test_touching_point_reversed_null_and_repeated_rows(spark):
    rows = [("v", 0, 10), ("v", 10, 20), ("v", 25, 25), ("v", 25, 25), ("v", 40, 30), ("v", None, 5), ("v", 50, None), ("v", 60, 61)]
    df = spark.createDataFrame(rows, "v string, s bigint, e bigint").withColumn("start", F.lit("clash")).withColumn("_end", F.lit(1))
    assert sorted((r.gap_start, r.gap_end) for r in gaps(df, ["v"], "s", "e").collect()) == [(20, 25), (25, 60)]
    assert [(r.period, r.start, r.end) for r in periods(df, ["v"], "s", "e").orderBy("period").collect()] == [(0, 0, 20), (1, 25, 25), (2, 60, 61)]


def test_empty_and_float_noise(spark):
    empty = spark.createDataFrame([], "v string, s bigint, e bigint")
    assert gaps(empty, ["v"], "s", "e").count() == 0 and periods(empty, ["v"], "s", "e").count() == 0
    f = spark.createDataFrame([(8.181000000000001,), (float("nan"),), (None,), (float("inf"),), (-0.0004,)], "x double")
    assert [r[0] for r in f.select(to_ms("x")).collect()] == [8181, None, None, None, 0]
