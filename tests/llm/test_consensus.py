import datetime
import random

from corpuscle.llm import consensus as consensus_module
from corpuscle.llm.consensus import consensus, reliability

T = datetime.datetime(2024, 1, 1)
SCHEMA = "round string, coder string, window_id string, video_id string, function string, loop string, evidence_type string, scale string, density int, annotated_at timestamp_ntz"


def planted(spark, seed=1, windows=220):
    rng = random.Random(seed)
    loops, rows, truth = ["opens", "closes", "holds", "none"], [], {}
    kinds = {f"good{i}": "good" for i in range(7)} | {"weak": "weak", "random": "random", "constant": "constant", "contrary": "contrary"}
    for w in range(windows):
        truth[f"w{w}"] = z = rng.choice(loops + ["none"])
        for c in rng.sample(list(kinds), 5):
            k = kinds[c]
            right = {"good": 0.85, "weak": 0.6, "random": 0.0, "constant": 0.0, "contrary": 0.0}[k]
            label = "none" if k == "constant" else rng.choice(loops) if k == "random" else rng.choice([x for x in loops if x != z]) if k == "contrary" else z if rng.random() < right else rng.choice(loops)
            label = rng.choice([label, label.upper(), f" {label}\t"])
            rows.append(("r", c, f"w{w}", "v", "evidence" if rng.random() < 0.5 else None, label, "study" if rng.random() < 0.5 else "bogus", "human", 1, T))
    return spark.createDataFrame(rows, SCHEMA), truth


def test_planted_coders_and_truth(spark):
    df, truth = planted(spark)
    got = {r.coder: r for r in reliability(df).where("field = 'loop'").collect()}
    assert {c for c, r in got.items() if r.corrected <= r.chance_limit} == {"random", "constant", "contrary"}
    assert got["weak"].ability < got["good0"].ability
    labels = {r.window_id: r.label for r in consensus(df).where("field = 'loop'").collect()}
    assert sum(labels[w] == z for w, z in truth.items()) > 0.93 * len(truth)
    # Repeated rows change nothing.
    again = {r.coder: round(r.corrected, 9) for r in reliability(df.unionByName(df)).where("field = 'loop'").collect()}
    assert again == {c: round(r.corrected, 9) for c, r in got.items()}


def test_no_labels_alone_and_empty(spark):
    rows = [("r", "a", "w", "v", None, "bogus", None, None, 9, T), ("r", "b", "w2", "v", None, "opens", None, None, None, T), ("r", None, "w2", "v", None, "opens", None, None, 1, T), ("r", "c", "w3", "v", None, "opens", "study", None, 1, T), ("r", "d", "w3", "v", None, "opens", "study", None, 1, T)]
    got = {(r.coder, r.field): r.corrected for r in reliability(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {("c", "loop"), ("d", "loop"), ("c", "density"), ("d", "density")}
    assert reliability(spark.createDataFrame([], SCHEMA)).count() == 0


def test_joined_abilities_give_the_same(spark, monkeypatch):
    df, _ = planted(spark, seed=2, windows=40)
    want = {(r.field, r.coder): round(r.corrected, 6) for r in reliability(df).collect()}
    monkeypatch.setattr(consensus_module, "MOST_BROADCAST", 3)
    assert {(r.field, r.coder): round(r.corrected, 6) for r in reliability(df).collect()} == want
