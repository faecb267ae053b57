import random

import pandas as pd
from pyspark.sql import functions as F

from corpuscle.llm import repetition
from corpuscle.llm.repetition import FEATURES, as_expression, exact, judged, learn, letters, repetitive, with_features, with_shares


def brute(text, passage=12):
    s = letters(text)
    hit = set()
    for i in range(len(s) - passage + 1):
        if s.find(s[i : i + passage]) + passage <= i:
            hit |= set(range(i, i + passage))
    return len(hit) / len(s) if s else 0.0


def texts():
    rng = random.Random(6)
    out = ["", None, "short", "abcabcabcabcabcabcabcabcabcabcabc", "A b, c! " * 30, "語の文。" * 20, "x" * 25, "x" * 4000, "No repeats whatsoever in this line of text."]
    for _ in range(120):
        parts = ["".join(rng.choice("abcdef 1") for _ in range(rng.randint(3, 40))) for _ in range(4)]
        out.append(" ".join(rng.choice(parts).upper() if rng.random() < 0.3 else rng.choice(parts) for _ in range(rng.randint(1, 9))))
    return out


def test_share_equals_brute_force():
    for t in texts():
        assert abs(exact(t)[1] - brute(t or "")) < 1e-12


def frame(spark):
    rows = [(f"v{i}", i % 3, t, 0.5) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "video_id string, seg_idx int, texto string, share double"), {r[0] for r in rows if brute(r[2] or "") >= 0.4}


def test_found_by_the_list_then_the_definition(spark):
    df, want = frame(spark)
    for sample in (1, 20, 4000):
        got = judged(df, ["video_id", "seg_idx"], "texto", sample=sample)
        assert got.count() == df.count()
        found = {r.video_id for r in repetitive(df, ["video_id", "seg_idx"], "texto", sample=sample).collect()}
        assert found <= want and len(found) >= (0.9 if sample == 4000 else 0.0) * len(want)
    assert {r.video_id for r in with_shares(df, ["video_id"], "texto").where("share >= 0.4").collect()} == want
    assert judged(df.limit(0), ["video_id"], "texto").count() == 0 and repetitive(df.limit(0), ["video_id"], "texto").count() == 0


def test_the_list_decides_what_is_read(spark, monkeypatch):
    df, want = frame(spark)
    read = lambda: judged(df, ["video_id"], "texto").where("rule > 0").count()
    called = read()
    assert called < df.count()
    # Without a list every row is read; a list that calls nothing finds nothing.
    monkeypatch.setattr(repetition, "learn", lambda *a, **k: None)
    assert read() == df.count() and {r.video_id for r in repetitive(df, ["video_id"], "texto").collect()} == want
    monkeypatch.setattr(repetition, "learn", lambda *a, **k: [])
    assert read() == 0 and repetitive(df, ["video_id"], "texto").count() == 0


def test_features_are_shares_of_what_stood_before(spark):
    df = spark.createDataFrame([("Rain rain GO away",), (None,), ("",), ("語の文。" * 8,), ("abc",)], "t string")
    got = [(r.word_share, r.gram_share) for r in with_features(df, "t").collect()]
    assert got[0][0] == 0.25 and got[1] == got[2] == (0.0, 0.0) and got[3][1] > 0.5 and got[4] == (0.0, 0.0)


def test_list_of_rules(spark):
    rng = random.Random(1)
    d = pd.DataFrame([{f: rng.random() for f in FEATURES} for _ in range(500)])
    d["y"] = (d["gram_share"] > 0.9) | (d["size"] > 0.8) & (d["word_share"] > 0.5)
    rules = learn(d, "y", FEATURES, per_true=0.05)
    got = spark.createDataFrame(d).withColumn("r", as_expression(rules)).toPandas()
    assert ((got["r"] > 0) & ~got["y"]).sum() <= 5 and ((got["r"] > 0) & got["y"]).sum() >= 0.8 * got["y"].sum()
    assert learn(d[d["y"]], "y", FEATURES) is None and learn(d.iloc[:0], "y", FEATURES) is None
    assert spark.range(1).select(as_expression(None).alias("r")).first().r == 1
    assert spark.range(1).select(F.lit(0.0).alias("size"), as_expression([]).alias("r")).first().r == 0
