import datetime
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from corpuscle.operators.agreement import confused_pairs
from corpuscle.operators.gates import GATES, drift, registry, report
from corpuscle.operators.sampling import anchored_draw, anchored_positions
from corpuscle.operators.segments import cut_sentences
from corpuscle.operators.sequence import states_before
from corpuscle.plans import profile_queries
from corpuscle.sources.artifacts import envelope, read_envelopes, write_envelopes

DIR = "/root/testdata/sf0.001"


def test_queries_equal_their_sql(spark):
    db = duckdb.connect()
    for f in os.listdir(DIR):
        db.execute(f"create view {f.split('.')[0]} as select * from '{DIR}/{f}'")
    for name, sql in profile_queries.SQL.items():
        rows, want = profile_queries.QUERIES[name](spark, DIR), db.sql(sql)
        assert sorted(rows.columns) == sorted(want.columns), name
        key = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
        assert sorted(map(repr, map(key, rows.select(*want.columns).collect()))) == sorted(map(repr, map(key, want.fetchall()))), name


@pytest.mark.parametrize("seed", [1, 42])
def test_gold_draw_is_pythons_own(spark, seed):
    rng, rows, want = random.Random(seed), [], set()
    for g, n, m in (("a", 40, 6), ("b", 9, 0), ("c", 7, 7), (None, 12, 1)):
        ids = [f"{g}{i:03}" for i in range(n)]
        hits = set(rng.sample(ids, m))
        rows += [(g, x, x in hits, "extra") for x in ids]
        drawn, again = anchored_draw(sorted(hits), ids, 5, seed)
        want |= {(g, x, r, x == again) for r, x in enumerate(drawn)}
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k string, c boolean, rank_ string")
    assert {(r.g, r.k, r["rank"], r.again) for r in anchored_positions(df, "g", "k", "c", 5, seed).collect()} == want
    assert anchored_positions(df.limit(0), "g", "k", "c", 5, seed).count() == 0


def test_gold_selection_of_small_channels(spark):
    got = profile_queries.gold_selection(spark, DIR).collect()
    assert len({(r.channel, r.id) for r in got}) == len(got) and all(sum(x.again for x in got if x.channel == c) == 1 for c in {r.channel for r in got})


def test_confused_pairs_against_all_pairs(spark):
    rng = random.Random(2)
    rows = [("f", f"u{rng.randint(0, 9)}", rng.choice(["x", "y", "z", None])) for _ in range(90)]
    n, total = {}, 0
    for u in {r[1] for r in rows}:
        own = [r[2] for r in rows if r[1] == u and r[2]]
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                total += 1
                if a != b:
                    n[min(a, b), max(a, b)] = n.get((min(a, b), max(a, b)), 0) + 1
    got = confused_pairs(spark.createDataFrame(rows, "f string, u string, v string"), ["f"], ["u"], "v").collect()
    assert {(r.label_a, r.label_b): (r.n, round(r.rate, 9)) for r in got} == {k: (x, round(x / total, 9)) for k, x in n.items()}


def test_states_before_blocks_of_any_number(spark):
    rng, rows, want = random.Random(4), [], {}
    for e, n in (("a", 700), ("b", 1), (None, 30)):
        state, gain = 1, 0
        for b in sorted(rng.sample(range(-1, 3 * n), n)):
            f, c = [rng.randrange(3) for _ in range(3)], [rng.randrange(9) for _ in range(3)]
            want[e, b] = (state, gain)
            state, gain = f[state], gain + c[state]
            rows.append((e, b, f, c))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "e string, b bigint, f array<int>, c array<bigint>")
    assert {(r.e, r.b): (r.s, r.n) for r in states_before(df, ["e"], "b", "f", "c", 1, ("s", "n")).collect()} == want


def test_registry_and_drift(spark):
    assert len(GATES) == 15 and len({g[0] for g in GATES}) == 15
    ch = spark.createDataFrame([("a", "benchmark")], "channel string, role string")
    one = report(registry(spark), ch, spark.createDataFrame([("cut_sentences", "a", 0.0)], "gate string, channel string, measured double"))
    two = report(registry(spark), ch, spark.createDataFrame([("cut_sentences", "a", 2.0)], "gate string, channel string, measured double"))
    assert drift(one, one).count() == 0
    [r] = drift(two, one).collect()
    assert (r.gate, r.channel) == ("cut_sentences", "a") and r.was.endswith("passed (0.000)") and r["is"].endswith("failed (2.000)")
    assert drift(one.where("gate = 'coverage'"), one).count() == one.count() - 1


def test_cut_sentences(spark):
    df = spark.createDataFrame([("Eins. Zwei!  Drei? 4.5 ",), (" ",), (None,), ("no mark",)], "t string")
    assert [r.x for r in df.select(cut_sentences(F.col("t")).alias("x")).collect()] == [["Eins.", "Zwei!", "Drei?", "4.5"], [], [], ["no mark"]]


def test_envelopes_are_written_once_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("v", 1, None), ("v", 0, "x"), ("w", 0, "y")], "v string, i int, t string")
    made = envelope(rows, "v", "rows", "i", datetime.date(2025, 1, 1).isoformat())
    write_envelopes(made, str(tmp_path / "raw"))
    with pytest.raises(Exception, match="(?i)exist"):
        write_envelopes(made, str(tmp_path / "raw"))
    write_envelopes(made, str(tmp_path / "raw"), again=True)
    back = read_envelopes(spark, str(tmp_path / "raw*"), "v string, generated_at string, rows array<struct<i:int,t:string>>", "rows")
    assert sorted((r.v, r.row, r.i, r.t) for r in back.collect()) == [("v", 0, 0, "x"), ("v", 1, 1, None), ("w", 0, 0, "y")]
