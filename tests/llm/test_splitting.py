import random

from corpuscle.llm.splitting import atoms, oversized, pieces, units


def greedy(rows, max_words=60, max_chars=400, overlap=10):
    """Piece by piece, from the first atom to the last."""
    a = [x for r in rows if r for x in atoms(r, max_words, max_chars)]
    size = lambda s, e: (sum(x[1] for x in a[s:e]), sum(len(x[0]) for x in a[s:e]))
    fits = lambda s, e: size(s, e)[0] <= max_words and size(s, e)[1] <= max_chars
    begins, s = [], 0
    for i, x in enumerate(a):
        begins.append(s)
        s = i + 1 if x[2] else s
    out, at, start = [], 0, 0
    while at < len(a):
        end = at + 1
        while end < len(a) and fits(start, end + 1):
            end += 1
        if end < len(a) or not fits(start, len(a)):
            natural = [e for e in range(at + 1, end + 1) if a[e - 1][2]]
            end = natural[-1] if natural else end
        out.append((start, end, *size(start, end)))
        if end == len(a):
            break
        back = begins[end - 1] if a[end - 1][2] else max(end - overlap, begins[end - 1])
        start = back if fits(back, end + 1) else end
        at = end
    return out


def test_atoms_rebuild_and_fit():
    for t in ["a b. " * 300, "x" * 2000, "語、" * 500, "  Lead. " + "w " * 500 + "End here. Next one.", "語" * 1000 + "。" + "字" * 50]:
        got = atoms(t, 60, 400)
        assert "".join(x[0] for x in got) == t
        assert all(len(x[0]) <= 400 and x[1] <= 60 for x in got)


def test_against_greedy(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(60):
        own = []
        for _ in range(rng.randint(1, 9)):
            n = rng.choice([0, 3, 12, 30, 45, 60, 61, 150])
            own.append(" ".join(rng.choice(["word", "a", "longerword", "x" * 90, "語"]) + rng.choice(["", "", "", ". Next", ","]) for _ in range(n)) + rng.choice(["", ".", ". "]))
        if i == 7:
            own = ["y" * 1500]
        if i == 8:
            own = ["word. " * 9000]
        want[i] = greedy(own) or [(0, 0, 0, 0)]
        rows += [(i, k, t, "clash") for k, t in enumerate(own)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id int, k int, text string, n_words string")
    got = {}
    for r in pieces(units(df, "id", "k", "text"), "id").collect():
        got.setdefault(r.id, {})[r.piece] = (r.n_words, r.n_chars)
    assert {i: [x[1] for x in sorted(p.items())] for i, p in got.items()} == {i: [(w, c) for _, _, w, c in v] for i, v in want.items()}
    assert {r.id for r in oversized(units(df, "id", "k", "text"), "id").collect()} == {i for i, v in want.items() if len(v) > 1}


def test_overlap_text_null_and_empty(spark):
    rows = [(1, 1, "A " * 25 + "end."), (1, 2, "Second " + "b " * 10 + "here."), (1, 3, "c " * 30 + "stop."), (2, None, None), (3, 0, "")]
    df = units(spark.createDataFrame(rows, "id int, k int, text string"), "id", "k", "text")
    got = {(r.id, r.piece): r.text for r in pieces(df, "id").collect()}
    assert got[2, 0] == "" and got[3, 0] == ""
    assert got[1, 0].endswith("here.") and got[1, 1].startswith("Second b") and got[1, 1].endswith("stop.") and len(got) == 4
    assert pieces(df.limit(0), "id").count() == 0


def test_windows_by_their_sentences(spark, tmp_path):
    import datetime

    from corpuscle.llm.splitting import p1_found, p1_pieces

    t = [datetime.datetime(2024, 1, d) for d in (1, 2)]
    long = "word " * 40
    sentences = [("a", 0, long, t[1]), ("a", 0, "old " * 200, t[0]), ("b", 1, long, t[0]), ("c", 2, None, t[0]), ("d", 3, "short.", t[0])]
    windows = [("two", ["b", "a"], None, t[0]), ("same", ["a", "a"], "w " * 90, t[0]), ("lost", ["x"], "w " * 90, t[0]), ("text", None, "w " * 90, t[0]), ("none", None, None, t[0]), ("no", [], "x", t[0]), ("few", ["c", "d", "x", None], None, t[0])]
    spark.createDataFrame(sentences, "sent_id string, idx int, text string, loaded_at timestamp_ntz").write.parquet(str(tmp_path / "sentences.parquet"))
    spark.createDataFrame(windows * 2, "window_id string, sent_ids array<string>, text string, loaded_at timestamp_ntz").write.parquet(str(tmp_path / "windows.parquet"))
    assert {r.window_id for r in p1_found(spark, str(tmp_path)).collect()} == {"two", "text"}
    got = {}
    for r in p1_pieces(spark, str(tmp_path)).collect():
        got.setdefault(r.window_id, []).append((r.piece, r.n_words))
    assert {k: sorted(v) for k, v in got.items()} == {"two": [(0, 40), (1, 40)], "same": [(0, 40)], "lost": [(0, 0)], "text": [(0, 60), (1, 40)], "none": [(0, 0)], "no": [(0, 0)], "few": [(0, 1)]}
