import datetime
import itertools
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from corpuscle.functions.boundary import digest_sql, signal_sql
from corpuscle.functions.text import display_id, numbered_id, position, strip_markers, word_count
from corpuscle.operators.fusion import pairs, runs, smooth, thirds
from corpuscle.operators.gates import inconsistent, registry, report
from corpuscle.operators.merging import merge_open, signals
from corpuscle.operators.sampling import PoolTooSmall, anchored_draw, eligible, holdout, quota_sample, top_k
from corpuscle.operators.segments import attach, chunk_offsets, gap_segments
from corpuscle.operators import windows as windows_module
from corpuscle.operators.windows import window_numbers
from corpuscle.plans.annotation_queries import smoothing_rate
from corpuscle.plans.corpus_queries import KEPT, SEED, _video_measured, eligible_pool_topk, gate_report, gate_report_full, holdout_seeded
from corpuscle.plans.sentence_queries import sentence_times, window_gate_parity, window_gate_ratio
from corpuscle.sources.artifacts import caption_fragments, envelope, first_source, merge_worksheet, raw_chunks, read_listing, read_manifest, read_raw, sample_report, worksheet, write_manifest
from corpuscle.sources.tables import current_rows


def test_text_functions(spark):
    df = spark.createDataFrame([(" a b  c\n", "x [Music] y [MÚSICA]", "v", 12345), (None, None, "v", 7)], "t string, m string, v string, n int")
    got = df.select(word_count("t").alias("w"), strip_markers("m").alias("s"), numbered_id(F.col("v"), "j", F.col("n")).alias("i")).collect()
    assert [tuple(r) for r in got] == [(3, "x y", "v:j12345"), (0, None, "v:j0007")]
    p = spark.createDataFrame([(5.0, 10.0), (5.0, 0.0), (5.0, None)], "s double, d double").select(position(F.col("s"), F.col("d")).alias("p")).collect()
    assert [r.p for r in p] == [0.5, None, None]
    assert len(spark.range(1).select(display_id(F.lit("v"), F.lit("w")).alias("d")).first().d) == 8


@pytest.mark.parametrize(
    "rows,gap,want",
    [
        ([(0, 1, "[Music]"), (1, 1, "words"), (2, 1, "[Aplausos]")], 1.0, [(1.0, "words")]),
        ([(0, 2, "a"), (2, 2, "b")], 1.0, [(0.0, "a b")]),
        ([(0, 1, "a"), (20, 1, "b")], 1.0, [(0.0, "a"), (20.0, "b")]),
        ([(0, 1, "a"), (1, 0.5, "[Music]"), (1.5, 1, "b")], 5.0, [(0.0, "a"), (1.5, "b")]),
        ([(0, 1, "a"), (2, None, "b"), (3, 1, "c"), (3.5, 1, None)], 1.0, [(0.0, "a b c")]),
        ([], 1.0, []),
    ],
)
def test_gap_segments(spark, rows, gap, want):
    df = spark.createDataFrame([("v", i, float(s), None if d is None else float(d), t) for i, (s, d, t) in enumerate(rows)], "v string, i int, s double, d double, t string")
    got = gap_segments(df, ["v"], ["i"], F.col("s"), F.col("d"), F.col("t"), gap).orderBy("segment").collect()
    assert [(r.inicio_s, r.texto) for r in got] == want


def test_offsets_and_attachment(spark):
    rng = random.Random(1)
    rows = [(v, i, "x" * rng.randint(1, 9)) for v in "ab" for i in range(12)]
    chunks = chunk_offsets(spark.createDataFrame(rows, "v string, i int, t string"), ["v"], ["i"], "t")
    spans = {}
    for r in chunks.collect():
        spans.setdefault(r.v, []).append((r.char_from, r.char_to, r.i))
    points = [(v, p, "extra") for v in "ab" for p in range(0, 150, 3)]
    got = attach(spark.createDataFrame(points, "v string, p bigint, chunk_x string"), chunks.select("v", "char_from", F.col("i").alias("chunk")), ["v"], "p").collect()
    assert len(got) == len(points)
    for r in got:
        assert r.chunk == max(i for a, _, i in spans[r.v] if a <= r.p)


@pytest.mark.parametrize("words,sizes", [([20, 10, 10], [2, 1]), ([5] * 5, [4, 1]), ([100], [1]), ([20, 20, 5], [2, 1]), ([20, 45], [1, 1]), ([], []), ([36, 3], [1, 1])])
def test_window_grouping(spark, words, sizes):
    df = spark.createDataFrame([("v", i, w) for i, w in enumerate(words)], "v string, idx int, w int")
    got = [r["count"] for r in window_numbers(df, ["v"], "idx", "w").groupBy("win").count().orderBy("win").collect()]
    assert got == sizes


# Own sentences, two or more for each rule in the order of the rules.
BOUNDARIES = [
    ("Rain filled the barrel by noon.", "Nobody drank", "complete"),
    ('Their sign read "closed!"', "Inside", "complete"),
    ("(Was the kettle theirs?)", "Inside", "complete"),
    ("Quite so", "we waited", "complete"),
    ("Far north", "these drifted", "complete"),
    ("Quite so", "kettles waited", "open"),
    ("Green lamps", None, "open"),
    ("Every kettle was sold to the", "harbour", "open"),
    ("Pots, pans and lids were sold and", "shipped", "open"),
    ("Their lamps, all nine of them, might", "break", "open"),
    ("What matters is, in plain words, salt", "and rope", "open"),
    ("All of them were, oddly, painted", "green", "open"),
    ("Unless somebody mends that kettle soon", "we freeze", "open"),
    ("But while somebody mends that kettle", "we freeze", "open"),
    ("Two sailors whose kettle leaks badly", "we freeze", "open"),
    ("Any lamp which flickers at dusk", "we freeze", "open"),
    ("They rowed past the cliffs of Marrowby", "Harbour lights", "open"),
    ("Barrel staves, copper rings, coils of tarred rope", "they", "open"),
    ("Salt, rope, lamp oil, nothing else aboard", "they", "open"),
    ("It has been sold, like everything, by a man who mended kettles badly", "they", "open"),
    ("Mending a cracked kettle beside a stove, quietly", "they", "open"),
    ("Four grey gulls above a harbour wall", "they", "open"),
    ("He had rowed for an hour, and he was tired", "Directly, is the word", "open"),
    ("He had rowed for an hour, and he was tired", "was the answer", "open"),
    ("He had rowed for an hour and he was tired", "they slept", "undetermined"),
    ("She mends kettles near a window", "they slept", "undetermined"),
    ("Everyone had eaten, and lamps were lit", "Later it rained", "undetermined"),
    ("We can't row, not today", "Later it rained", "undetermined"),
]


def test_boundary_signals(spark):
    df = spark.createDataFrame(BOUNDARIES, "text string, next_text string, want string")
    assert [(r.text, r.signal) for r in signals(df).collect()] == [(t, w) for t, _, w in BOUNDARIES]


def test_windows_of_blocks_against_one_pass(spark, monkeypatch):
    monkeypatch.setattr(windows_module, "BLOCK", 16)
    rng = random.Random(8)
    rows, want = [], {}
    for v, n, gap in (("a", 700, 1), ("b", 90, 9), ("c", 1, 1), (None, 33, 1)):
        count, words, win = 0, 0, -1
        for i in sorted(rng.sample(range(n * gap), n)):
            w = rng.choice([0, 1, 5, 9, 20, 34, 36, 60, 61, 300, None])
            x = w or 0
            if count in (0, 4) or count == 1 and words > 35 or words + x > 35 and (count >= 2 or words + x > 60):
                count, words, win = 0, 0, win + 1
            count, words = count + 1, words + x
            want[v, i] = win
            rows.append((v, i, w, "clash"))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "v string, idx int, w int, win string")
    assert {(r.v, r.idx): r.win for r in window_numbers(df, ["v"], "idx", "w").collect()} == want
    assert window_numbers(df.limit(0), ["v"], "idx", "w").count() == 0


def test_digest_keeps_the_signal(spark):
    rng = random.Random(3)
    words = "the who is , is, was because and it runs it's don't Sand Old running x, y; ' 12 - \" (the) that's which has whose of 3, it He, a word people , Directly — now. end! the' of\" THE".split()
    rows = []
    for _ in range(1_500):
        plain = rng.random() < 0.5
        text = [rng.choice(["word", "cat", "12", "-", ","] if plain and rng.random() < 0.7 else words) for _ in range(rng.choice([1, 3, 14, 15, 16, 22, 60]))]
        rows.append((" ".join(text), " ".join(rng.choice(words) for _ in range(rng.randint(0, 3)))))
    df = spark.createDataFrame(rows, "text string, next_text string").withColumn("short", F.expr(digest_sql("text")))
    got = df.select("text", "short", F.expr(signal_sql("text", "next_text", True)).alias("a"), F.expr(signal_sql("short", "next_text", True)).alias("b")).collect()
    assert all(r.a == r.b for r in got) and max(len(r.short.split()) for r in got) <= 14


def test_merge_over_long_chains_and_late_confidence(spark):
    rows = [("v", i, "rain of the" if i % 7 else "It ended there.", None) for i in range(3_000)] + [("w", i, t, c) for i, (t, c) in enumerate([("They went to the", 0.0), ("coast and it was long", 0.0), ("they say.", None), ("", None), (None, None)])]
    df = spark.createDataFrame(rows, "v string, i int, t string, c double").repartition(5)
    got = merge_open(df, "v", "i", "t", "c").orderBy("v", "idx").collect()
    texts = [r.text for r in got if r.v == "v"]
    assert texts[:3] == ["It ended there.", " ".join(["rain of the"] * 6 + ["It ended there."]), " ".join(["rain of the"] * 6 + ["It ended there."])]
    assert [r.idx for r in got if r.v == "v"] == list(range(len(texts))) and " ".join(texts) == " ".join(r[2] for r in rows if r[0] == "v")
    # The boundary behind "coast" is undetermined from the start, with and without what is merged before it.
    assert [(r.first, r.last) for r in got if r.v == "w"][0] == (0, 2)


def test_merge_cascades_and_confidence(spark):
    rows = [("v", 0, "They went to the", None), ("v", 1, "river and", None), ("v", 2, "it was cold.", None), ("v", 3, "That took years and it was long", 0.2), ("v", 4, "they say.", None), ("v", 5, "That took years and it was long", 0.5), ("v", 6, "it was.", 0.0), ("w", 0, "alone at the", 0.0)]
    df = spark.createDataFrame(rows, "v string, i int, t string, c double")
    got = [(r.v, r.idx, r.first, r.last) for r in merge_open(df, "v", "i", "t", "c").orderBy("v", "idx").collect()]
    assert got == [("v", 0, 0, 2), ("v", 1, 3, 4), ("v", 2, 5, 5), ("v", 3, 6, 6), ("w", 0, 0, 0)]
    assert [r.last for r in merge_open(df, "v", "i", "t").where("v = 'v'").orderBy("idx").collect()] == [2, 3, 4, 5, 6]


def one_pass(labels):
    """Absorb runs of one between runs of two or more of one label, left to right."""
    r = [[k, len(list(g))] for k, g in itertools.groupby(labels)]
    out = [list(x) for x in r]
    for i in range(1, len(r) - 1):
        if r[i][1] == 1 and r[i - 1][0] == r[i + 1][0] and r[i - 1][1] >= 2 and r[i + 1][1] >= 2:
            out[i][0] = r[i - 1][0]
    return [(k, sum(n for _, n in g)) for k, g in itertools.groupby(out, key=lambda x: x[0])]


def test_smoothing(spark):
    rng = random.Random(4)
    seqs = {"s0": "mmemm", "s1": "meem", "s2": "emm"} | {f"r{i}": "".join(rng.choice("mme") for _ in range(rng.randint(1, 14))) for i in range(60)}
    df = spark.createDataFrame([(k, i, c) for k, s in seqs.items() for i, c in enumerate(s)], "v string, i int, l string")
    got = {}
    for r in smooth(runs(df, "v", "i", "l"), "v").orderBy("block").collect():
        got.setdefault(r.v, []).append((r.label, r.n))
    assert got == {k: one_pass(s) for k, s in seqs.items()}


def test_thirds_and_pairs(spark):
    for n, want in [(98, [32, 33, 33]), (107, [35, 36, 36]), (1, [1])]:
        df = spark.createDataFrame([("v", i) for i in range(n)], "v string, i int")
        assert [r["count"] for r in thirds(df, "v", "i").groupBy("third").count().orderBy("third").collect()] == want
    df = spark.createDataFrame([("v", i, c) for i, c in enumerate("oocxc")], "v string, i int, l string")
    assert [(r.opened, r.closed) for r in pairs(df, "v", "i", "l", "o", "c").orderBy("k").collect()] == [(0, 2), (1, 4)]


def test_selection(spark):
    old, new = datetime.datetime(2020, 1, 1), datetime.datetime(2025, 5, 1)
    rows = [("a", "x", 200.0, old), ("a", "y", 200.0, new), ("a", "z", 179.0, old), ("b", "p", 500.0, new), ("b", "q", 180.0, None)]
    df = spark.createDataFrame(rows, "ch string, id string, d double, p timestamp_ntz")
    assert {r.id for r in eligible(df, "ch", "d", "p", "2025-06-01", 1).collect()} == {"x", "p", "q"}
    assert {r.id for r in top_k(df, "ch", [F.col("id").desc()], 1).collect()} == {"z", "q"}
    assert holdout(["a", "b"], set(), 0, 0, 1) == [] and len(holdout(list("abcdef"), {"a"}, 5, 4, 1)) == 5
    with pytest.raises(PoolTooSmall):
        holdout(list("abc"), {"a"}, 5, 4, 1)
    drawn, again = anchored_draw(["c"], list("abcdefg"), 5, 42)
    assert drawn[0] == "c" and len(set(drawn)) == 5 and again in drawn


@pytest.mark.parametrize("sizes,want", [((60, 60), [25, 25]), ((60, 10), [40, 10])])
def test_quota(spark, sizes, want):
    df = spark.createDataFrame([(f"v{k}", f"v{k}:{i}") for k, n in enumerate(sizes) for i in range(n)], "v string, w string")
    got = {r.v: r["count"] for r in quota_sample(df, "v", "w", 50, 42).groupBy("v").count().collect()}
    assert [got["v0"], got["v1"]] == want
    with pytest.raises(PoolTooSmall):
        quota_sample(df.limit(10), "v", "w", 50, 42)


def test_gates(spark):
    ch = spark.createDataFrame([("a", "benchmark"), ("b", "other")], "channel string, role string")
    m = spark.createDataFrame([("profile_videos", "a", 31.0), ("word_ratio", "a", 0.5), ("profile_videos", "b", 1.0)], "gate string, channel string, measured double")
    got = {(r.gate, r.channel): r.status for r in report(registry(spark), ch, m).collect()}
    assert got["profile_videos", "a"] == "passed (31.000)" and got["word_ratio", "a"] == "failed (0.500)"
    assert got["profile_videos", "b"] == "not applicable" and got["self_agreement", None] == "not measured"
    assert {(r.name, r.problem) for r in inconsistent(registry(spark), ch).collect()} == {("reference", "role without channel"), ("b", "channel of unknown role")}


def test_current_rows(spark):
    rows = [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "b"), ("n", None, "c"), (None, 1, "d"), (None, 3, "e")]
    df = spark.createDataFrame(rows, "k string, loaded_at int, v string")
    assert {(r.k, r.v) for r in current_rows(df, ["k"]).collect()} == {("k", "b"), ("n", "c"), (None, "e")}


def test_artifacts(spark, tmp_path):
    caps = {"events": [{"tStartMs": 1500, "dDurationMs": 500, "segs": [{"utf8": "a "}, {"utf8": "b\n"}]}, {"tStartMs": 1}, {"segs": [{"utf8": "\n"}]}]}
    df = spark.createDataFrame([("v", json.dumps(caps)), ("w", "{}")], "id string, j string")
    assert [tuple(r) for r in caption_fragments(df, "id", "j").collect()] == [("v", 0, 1.5, 0.5, "a b")]

    (tmp_path / "l.jsonl").write_text('{"id": "a", "timestamp": 0}\n\n{"id": "b", "duration": 3.5, "view_count": 7}\n')
    assert [(r.id, r.duration, r.view_count) for r in read_listing(spark, str(tmp_path / "l.jsonl")).orderBy("id").collect()] == [("a", 0.0, 0), ("b", 3.5, 7)]

    (tmp_path / "m.csv").write_text("id,titulo,duracao_s,contagem_palavras,fonte\na,T,1,2,x\n")
    old = read_manifest(spark, str(tmp_path / "m.csv"))
    assert old.first().role == "profile"
    write_manifest(old.withColumn("role", F.lit("")).withColumn("fonte", F.lit(None).cast("string")), str(tmp_path / "out"))
    back = read_manifest(spark, str(tmp_path / "out")).first()
    assert (back.role, back.fonte, back.titulo) == ("", "", "T")

    (tmp_path / "r.json").write_text(json.dumps({"video_id": "v", "source": "s", "fragments": [{"start": 1.0, "text": "[Music]"}, {"start": 2.0, "text": "x  y"}]}))
    assert [(r.frag_idx, r.start_s, r.end_s, r.text) for r in raw_chunks(read_raw(spark, str(tmp_path / "r.json"))).collect()] == [(1, 2.0, 2.0, "x y")]

    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    src = [(n, spark.createDataFrame(r, "id string, fragments string")) for n, r in (("one", [("a", "1")]), ("two", [("a", "2"), ("b", "2")]))]
    assert [(r.id, r.fragments, r.source) for r in first_source(ids, "id", src).orderBy("id").collect()] == [("a", "1", "one"), ("b", "2", "two"), ("c", None, None)]

    e = envelope(spark.createDataFrame([("v", 1, None), ("v", 0, "x")], "v string, i int, t string"), "v", "rows", "i", "now", n=F.lit(2)).first().json
    assert json.loads(e) == {"v": "v", "generated_at": "now", "n": 2, "rows": [{"i": 0, "t": "x"}, {"i": 1, "t": None}]}
    b = spark.createDataFrame([("d", ["x"], "t")], "display_id string, context array<string>, target string")
    assert json.loads(worksheet(b, ["function"]).first().value) == {"display_id": "d", "context": ["x"], "target": "t", "function": None}
    both, lost = merge_worksheet(b, spark.createDataFrame([("d", "w"), ("q", "z")], "display_id string, window_id string"))
    assert both.first().window_id == "w" and [tuple(r) for r in lost.collect()] == [("q", "not in worksheet")]
    assert "a\\|b" in sample_report(spark.createDataFrame([("a|b",)], "t string"), ["t"])


def test_seeded_holdout_of_every_channel(spark, tmp_path):
    old = datetime.datetime(2020, 1, 1)
    rows = [(f"{c}{i:03}", c, "t", 30.0 + 10 * (i % 7), i * 37 % 101, old, "s", "profile", old) for c, n in (("lanternwell", 30), ("b", 200), ("c", 6), ("d", 1), (None, 9)) for i in range(n)]
    spark.createDataFrame(rows, "id string, channel string, title string, duration double, view_count bigint, published_at timestamp_ntz, source string, role string, loaded_at timestamp_ntz").write.parquet(str(tmp_path / "videos.parquet"))
    taken = {r.id for r in eligible_pool_topk(spark, str(tmp_path)).collect()}
    want = {(c, x, i) for c in ("lanternwell", "b", "c", "d", None) for i, x in enumerate(holdout(sorted(r[0] for r in rows if r[1] == c), taken, KEPT, 0, SEED))}
    assert {(r.channel, r.id, r["rank"]) for r in holdout_seeded(spark, str(tmp_path)).collect()} == want


def _brute_sentences(frags):
    """The plain way: the joined text cut into sentences, each attached by a search of all spans."""
    text, spans = "", []
    for start, dur, t in frags:
        text += " " if spans else ""
        spans.append((len(text), len(text) + len(t), start, start + (dur or 0.0)))
        text += t
    cuts = [m.end() for m in re.finditer(r"""[.!?…।॥؟۔]+["'”’»)\]]*(?=\s|$)|[。！？]+[」』”’）]*""", text)]
    out, at = [], 0
    for cut in [*cuts, len(text)]:
        piece = text[at:cut]
        if piece.strip():
            a, b = at + len(piece) - len(piece.lstrip()), at + len(piece.rstrip())
            out.append((len(out), a, b, next(s for x, y, s, _ in spans if x <= a < y), next(e for x, y, _, e in spans if x <= b - 1 < y)))
        at = cut
    return out


def test_sentence_times_against_brute_force(spark, tmp_path):
    rng, at = random.Random(5), datetime.datetime(2025, 1, 1)
    bits = ["Hello", "it was.", "Why?!", 'he said "no."', "4.7.0 of", "本です。次は「何？」", "क्या।", "نعم؟", "end...", "a longer run of words", "🙂 ok.", "."]
    rows, want = [], {}
    for v in ("a", "b", "c", "d"):
        frags = [(i * 1.5, rng.choice([None, 1.0, 2.25]), " ".join(rng.choice(bits) for _ in range(rng.randint(1, 4))) if rng.random() > 0.15 else "[Music]") for i in range(40 if v != "d" else 1)]
        # Arrival and speech are in different order.
        order = rng.sample(range(len(frags)), len(frags))
        rows += [(v, order[i], s, dur, t.replace(" ", "  "), at) for i, (s, dur, t) in enumerate(frags)]
        want[v] = _brute_sentences([f for f in frags if f[2] != "[Music]"])
    rows += [("e", 0, 0.0, 1.0, None, at), ("e", 1, 1.0, 1.0, " ", at)]
    spark.createDataFrame(rows, "video_id string, frag_idx int, start double, duration double, text string, loaded_at timestamp_ntz").write.parquet(str(tmp_path / "fragments.parquet"))
    got = {}
    for r in sentence_times(spark, str(tmp_path)).orderBy("video_id", "idx").collect():
        got.setdefault(r.video_id, []).append((r.idx, r.char_from, r.char_to, r.start_s, r.end_s))
    assert got == {v: x for v, x in want.items() if x}


def test_gate_report_full_measures_windows_and_smoothing(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    got = {(r.gate, r.channel): r.status for r in gate_report_full(spark, d).collect()}
    less = {(r.gate, r.channel): r.status for r in gate_report(spark, d).collect()}
    assert got.keys() == less.keys()
    assert any(g in ("big_windows", "single_ratio", "smoothing") and s.startswith(("passed", "failed")) for (g, _), s in got.items())
    assert all(got[k] == s for k, s in less.items() if k[0] not in ("big_windows", "single_ratio", "smoothing", "window_residual", "window_band"))
    # With all videos in one channel the figures are those of the gates over everything.
    for t in ("sentences", "windows", "annotations"):
        os.symlink(f"{d}/{t}.parquet", tmp_path / f"{t}.parquet")
    ids = spark.read.parquet(f"{d}/sentences.parquet").select("video_id").union(spark.read.parquet(f"{d}/windows.parquet").select("video_id")).union(spark.read.parquet(f"{d}/annotations.parquet").select("video_id")).distinct()
    videos = spark.read.parquet(f"{d}/videos.parquet").drop("id", "channel").limit(1)
    ids.select(F.col("video_id").alias("id"), F.lit("one").alias("channel")).crossJoin(videos).write.parquet(str(tmp_path / "videos.parquet"))
    m = {r.gate: r.measured for r in _video_measured(spark, str(tmp_path)).collect()}
    p = window_gate_parity(spark, d).first()
    assert m["big_windows"] == abs(p.big_windows - p.big_sentences) + p.unproven
    assert m["single_ratio"] == pytest.approx(window_gate_ratio(spark, d).first().ratio, abs=1e-6) and m["smoothing"] == pytest.approx(smoothing_rate(spark, d).first().rate, abs=1e-6)
