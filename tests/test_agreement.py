import itertools
import random

import pytest

from corpuscle.operators.agreement import alpha, confusion, majority, mutual_information, occurrence

# A published reliability matrix: four coders, twelve units, None where a coder gave no value.
MATRIX = {
    "A": [1, 2, 3, 3, 2, 1, 4, 1, 2, None, None, None],
    "B": [1, 2, 3, 3, 2, 2, 4, 1, 2, 5, None, 3],
    "C": [None, 3, 3, 3, 2, 3, 4, 2, 2, 5, 1, None],
    "D": [1, 2, 3, 3, 2, 4, 4, 1, 2, 5, 1, None],
}


def by_pairs(rows, dist):
    units = {}
    for c, u, v in rows:
        units.setdefault(u, {})[c] = v
    units = [list(x.values()) for x in units.values() if len(x) > 1]
    every = [v for u in units for v in u]
    n = len(every)
    if len(set(every)) < 2:
        return None
    do = sum(dist(a, b) / (len(u) - 1) for u in units for a, b in itertools.permutations(u, 2)) / n
    de = sum(dist(a, b) for a, b in itertools.permutations(every, 2)) / (n * (n - 1))
    return 1 - do / de


@pytest.mark.parametrize("level,want", [("nominal", 0.743421), ("ordinal", 0.815388), ("interval", 0.849107)])
def test_published_matrix(spark, level, want):
    rows = [(c, u, v) for c, vs in MATRIX.items() for u, v in enumerate(vs) if v is not None]
    df = spark.createDataFrame(rows, "coder string, unit int, value int")
    got = alpha(df, [], "unit", "coder", "value", level).first()
    assert abs(got.alpha - want) < 1e-5


def test_groups_against_pairs(spark):
    rng = random.Random(2)
    rows = [(g, c, u, rng.choice([0, 1, 1, 2])) for g in ("x", None) for u in range(30) for c in "abcd" if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "g string, coder string, unit int, value int")
    got = {r.g: r.alpha for r in alpha(df, ["g"], "unit", "coder", "value", "interval").collect()}
    for g in ("x", None):
        assert abs(got[g] - by_pairs([r[1:] for r in rows if r[0] == g], lambda a, b: (a - b) ** 2)) < 1e-9
    got = {r.g: r.alpha for r in alpha(df, ["g"], "unit", "coder", "value").collect()}
    for g in ("x", None):
        assert abs(got[g] - by_pairs([r[1:] for r in rows if r[0] == g], lambda a, b: a != b)) < 1e-9


def test_undefined_and_last_rating(spark):
    one = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "coder string, unit int, value string")
    assert alpha(one, [], "unit", "coder", "value").first().alpha is None
    assert alpha(one.limit(1), [], "unit", "coder", "value").first().alpha is None
    two = spark.createDataFrame([("a", 1, "x", 1), ("b", 1, "x", 1), ("b", 1, "y", 2)], "coder string, unit int, value string, at int")
    assert alpha(two, [], "unit", "coder", "value", order="at").first().alpha == 0.0


def test_votes_confusion_occurrence_information(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (1, "c", "y"), (2, "a", "x"), (2, "b", "y"), (3, "a", None)], "unit int, coder string, label string")
    got = {r.unit: (r.label, r.votes, r.consensus) for r in majority(df, ["unit"], "label").collect()}
    assert got == {1: ("x", 2, True), 2: (None, 1, False)}
    assert {(r.label_a, r.label_b): r.n for r in confusion(df, "unit", "coder", "label", "a", "b").collect()} == {("x", "x"): 1, ("x", "y"): 1}
    vocab = spark.createDataFrame([("f", "x"), ("f", "z")], "f string, v string")
    rows = spark.createDataFrame([("f", "x"), ("f", "x"), ("f", "q")], "f string, v string")
    assert {r.v: r.n for r in occurrence(rows, "f", "v", vocab).collect()} == {"x": 2, "z": 0}
    same = spark.createDataFrame([("a", "p"), ("b", "q")] * 4, "x string, y string")
    assert mutual_information(same, "x", "y").first().mi_bits == 1.0
