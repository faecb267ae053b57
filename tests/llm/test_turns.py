import random

import pytest

from corpuscle.llm import turns as turns_module
from corpuscle.llm.turns import Cast, clean, near, spoken, stamp, turn_starts, turns, units

CAST = [("s0", "c", "Orla Venn", "host", "SPEAKER_00"), ("s1", "c", "Bruno Kask", "guest", "SPEAKER_01"), ("s2", "c", "Tilde Moor", "narrator", "SPEAKER_02")]
SCHEMA = "video_id string, channel string, frag_idx int, start double, duration double, text string, source string, loaded_at timestamp_ntz"


def frames(spark, rows):
    import datetime

    t = datetime.datetime(2024, 1, 1)
    full = [(v, "c", i, s, 1.0, x, "a", t) for v, i, s, x in rows]
    return spark.createDataFrame(full, SCHEMA), spark.createDataFrame(CAST, "speaker_id string, channel string, full_name string, role string, diar_label string")


@pytest.mark.parametrize(
    "label,who",
    [("Orla", "s0"), ("orla venn", "s0"), ("O. Venn", "s0"), ("OV", "s0"), ("ov", None), ("HOST", "s0"), ("SPEAKER_02", "s2"), ("Brunno", "s1"), ("Burno", "s1"), ("Note", None), ("Venn", "s0")],
)
def test_names(label, who):
    assert Cast(tuple((a, b, c, d) for a, _, b, c, d in CAST)).find(label) == who


def test_near():
    assert near("dorno", "donro") and near("dorno", "dornno") and near("dorno", "drno") and near("dorno", "darno")
    assert not near("dorno", "drn") and not near("abcd", "badc")


def test_stamp_and_words():
    assert stamp("[0:02] - Orla: x", 2.4)[2] and stamp("00:00:38.893 --> of", 38.5)[2] and not stamp("10:45 in town", 3.0)[2]
    assert stamp("@131s | text", 131.0)[::2] == ("T @|9a||", True) and stamp("{2m11} text", 131.2)[2] and stamp("words 3", 3.0) is None
    assert clean("blame um childhood [Applause] things") == ("blame childhood things", True)
    assert clean("nada foi por um tempo (risos)") == ("nada foi por um tempo", True)
    assert clean("Um, hmm... *sighs* ♪ ♪") == ("", False)
    assert clean("Er kam um 1654.") == ("Er kam um 1654.", True)


def test_turns_of_every_layout(spark):
    rows = [
        ("v", 0, 0.0, "Before any label."),
        ("v", 1, 2.0, "[0:02] >> ORLA: First. Second is Bruno Kask (guest): third"),
        ("v", 2, 4.0, "00:00:04.100 --> goes on. [Music]"),
        ("v", 3, 6.0, "<v Orla> Um..."),
        ("v", 4, 7.0, "(laughter)"),
        ("v", 5, 8.0, "[SPEAKER_01]: still mine. Note: it was 10:45."),
        ("v", 6, 10.0, "Orla Venn (host): Yes"),
        ("v", 7, 11.0, None),
        ("v", 8, 12.0, "  "),
        ("v", 9, 13.0, "Olra Venn: and I go on."),
        ("w", 0, 5.0, ">> No name."),
        ("w", 1, 1.0, "OV: One."),
        ("w", 2, 3.0, "[Bruno] Two."),
        ("w", 3, 7.0, ">> [inaudible]"),
        ("w", 4, 8.0, "- Bruno: Um"),
        ("w", 5, 9.0, "[Applause]"),
    ]
    f, s = frames(spark, rows)
    f = f.unionByName(f).repartition(3)
    got = [(r.video_id, r.speaker_id, r.frag_idx, r.text) for r in turns(f, s).orderBy("video_id", "turn").collect()]
    assert got == [
        ("v", "s2", 0, "Before any label."),
        ("v", "s0", 1, "First. Second is"),
        ("v", "s1", 1, "third goes on. still mine. Note: it was 10:45."),
        ("v", "s0", 6, "Yes and I go on."),
        ("w", "s0", 1, "One."),
        ("w", "s1", 2, "Two."),
        ("w", "s0", 0, "No name."),
    ]


def test_blocks_against_one_pass(spark):
    rng = random.Random(1)
    rows = []
    for v in ("a", "b", "hot"):
        for i in range(600 if v == "hot" else 40):
            head = rng.choice(["", "", "", "Orla: ", "[Bruno] ", ">> "])
            rows.append((v, i, float(i * 37 % 601) * 11, head + rng.choice(["words here", "um", "more of it", "[Music]"])))
    f, s = frames(spark, rows)
    cast = Cast(tuple((a, b, c, d) for a, _, b, c, d in CAST))
    layouts = frozenset({"L |Aa|:", "L [|Aa|]"})
    want = set()
    for v in ("a", "b", "hot"):
        voice, other, last = "s2", {"s0": "s1", "s1": "s0", "s2": "s0"}, None
        for _, i, st, x in sorted((r for r in rows if r[0] == v), key=lambda r: (r[2], r[1])):
            for named, change, _, some in units(x, st, cast, layouts):
                voice = named or (other[voice] if change else voice)
                if some:
                    if voice != last:
                        want.add((v, i, voice))
                    last = voice
    assert {(r.video_id, r.frag_idx, r.speaker_id) for r in turn_starts(f, s).where("new").collect()} == want


def test_empty_tables_and_unknown_channel(spark):
    f, s = frames(spark, [("v", 0, 0.0, "Orla: words")])
    assert spoken(f.limit(0), s).count() == 0
    assert [r.speaker_id for r in spoken(f, s.limit(0)).collect()] == [None]


def test_um_by_language_of_the_video_and_long_notes(spark):
    rows = [("p", 0, 0.0, "Não foi isso, você já disse."), ("p", 1, 1.0, "um homem velho chegou"), ("p", 2, 2.0, "um"), ("e", 0, 0.0, "The man and the dog."), ("e", 1, 1.0, "um it was tempo"), ("e", 2, 2.0, "[upbeat electronic music that is now playing all over again]")]
    f, s = frames(spark, rows)
    got = {(r.video_id, r.frag_idx): r.text for r in spoken(f, s).collect()}
    assert got == {("p", 0): rows[0][3], ("p", 1): rows[1][3], ("e", 0): rows[3][3], ("e", 1): "it was tempo"}
    assert clean("He came (which was rather late for all of us).")[0] == "He came (which was rather late for all of us)."


def test_new_layouts_are_found_without_a_pattern(spark):
    rng = random.Random(9)
    rows, want = [], []
    heads = {"s0": "{Orla}", "s1": "★ Bruno Kask ★", "s2": "~Tilde Moor~"}
    for i in range(60):
        who = rng.choice(list(heads))
        rows.append(("v", i, i * 7.0, f"@{i * 7}s | {heads[who]} row {'abc'[i % 3]} of words"))
        if not want or want[-1][1] != who:
            want.append((i, who))
    f, s = frames(spark, rows)
    got = spoken(f, s).orderBy("frag_idx").collect()
    assert {r.text for r in got} == {f"row {c} of words" for c in "abc"}
    assert [(r.frag_idx, r.speaker_id) for r in turn_starts(f, s).where("new").orderBy("frag_idx").collect()] == want
    # Times that aren't the fragments' own are numbers, and names of nobody in the cast are words.
    f, s = frames(spark, [("v", i, i * 7.0, f"@{i * 5 + 90}s | {{Nobody}} says so") for i in range(20)])
    assert {r.speaker_id for r in spoken(f, s).collect()} == {"s2"} and "Nobody" in spoken(f, s).first().text


def test_casts_joined_where_they_are_large(spark, monkeypatch):
    f, s = frames(spark, [("v", i, float(i), ["Orla: yes", "[Bruno] no", "more"][i % 3]) for i in range(12)])
    want = sorted((r.frag_idx, r.speaker_id) for r in spoken(f, s).collect())
    monkeypatch.setattr(turns_module, "MOST_CAST_BYTES", 1)
    assert sorted((r.frag_idx, r.speaker_id) for r in spoken(f, s).collect()) == want
