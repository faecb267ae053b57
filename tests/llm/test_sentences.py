import random

import pytest

from corpuscle.llm import sentences as sentences_module
from corpuscle.llm.boundaries import NOTHING, OUT, head, scan
from corpuscle.llm.sentences import row_ends, sentences


def sequential(texts, lang=None):
    """Ends of each text, read from the first to the last."""
    out, state = [], OUT
    for i, t in enumerate(texts):
        nxt, ends, size, outside, tail = scan(t, lang=lang)
        follow = head(texts[i + 1]) if i + 1 < len(texts) else NOTHING
        own = [p for p, m in ends if m >> state & 1]
        if follow == NOTHING or outside >> state & 1 and tail >> follow & 1:
            own.append(size)
        out.append(own)
        state = nxt[state]
    return out


CASES = [
    ("One here. Two there.", ["One here.", "Two there."]),
    ("Mr. Smith met Dr. J. R. Jones at 7 a.m. on a day. He paid 1,200.50 marks, i.e. far too much.", ["Mr. Smith met Dr. J. R. Jones at 7 a.m. on a day.", "He paid 1,200.50 marks, i.e. far too much."]),
    ("The lamp failed at 1 p.m. The door closed.", ["The lamp failed at 1 p.m.", "The door closed."]),
    ("“Stop! Put it down,” said Ann. He did.", ["“Stop! Put it down,” said Ann.", "He did."]),
    ('The line read: "Nothing lasts." It was late.', ['The line read: "Nothing lasts."', "It was late."]),
    ("'Why me? Why now?' wrote Ann in the tenant's book. End.", ["'Why me? Why now?' wrote Ann in the tenant's book.", "End."]),
    ("— Cuidado! Larga isso! — gritou Ana. Depois saiu.", ["— Cuidado! Larga isso! — gritou Ana.", "Depois saiu."]),
    ("« Stop ! Plus un geste ! » cria Mme Roux. Fin ? Oui.", ["« Stop ! Plus un geste ! » cria Mme Roux.", "Fin ?", "Oui."]),
    ("„Halt! Keiner geht!“ rief Eva. Am 3. März kamen z. B. 2 Briefe an.", ["„Halt! Keiner geht!“ rief Eva.", "Am 3. März kamen z. B. 2 Briefe an."]),
    ("静けさ……それだけが残った。「終わりだ。帰ろう。」とケイは言った。（昔の話だ。）次。", ["静けさ……それだけが残った。", "「終わりだ。帰ろう。」とケイは言った。", "（昔の話だ。）", "次。"]),
    ("“快停！别动。”兰努说。真的吗？！是。", ["“快停！别动。”兰努说。", "真的吗？！", "是。"]),
    ("डॉ. केइना आए। और फिर... कुछ नहीं हिला। क्यों?", ["डॉ. केइना आए।", "और फिर... कुछ नहीं हिला।", "क्यों?"]),
    ("وقع عليه د. كاينا. انظر ص. 20 من الدفتر. لماذا؟ لا.", ["وقع عليه د. كاينا.", "انظر ص. 20 من الدفتر.", "لماذا؟", "لا."]),
    ("มาค่อยๆ ดูกันครับ ทำไมจึงกลับมาค่ะ", ["มาค่อยๆ ดูกันครับ", "ทำไมจึงกลับมาค่ะ"]),
    ("A statement without a mark\n\nAnother one\nThird here and\nit goes on.", ["A statement without a mark", "Another one", "Third here and\nit goes on."]),
    ("And then... nothing. Nobody answered... They left.Then rain at a.example/9 fell.", ["And then... nothing.", "Nobody answered...", "They left.", "Then rain at a.example/9 fell."]),
]


@pytest.mark.parametrize("text,want", CASES)
def test_cases(text, want):
    [ends] = sequential([text])
    got, at = [], 0
    for e in ends:
        got.append(text[at:e].strip())
        at = e
    assert got == want and not text[at:].strip()


@pytest.mark.parametrize(
    "text,lang,n",
    [
        ("Come with me. She left.", "en", 2), ("I love art. It is good.", "en", 2), ("He called his ex. She cried.", None, 2), ("Tell Al. He knows.", "en", 2), ("Lane et al. 2010 say so. Fine.", "en", 2),
        ("Me Roux parla. Fin.", "fr", 2), ("Er hat ca. 3 Boote.", "de", 1), ('"One. Two. Three. Four. Five. Six," she said.', "en", 1),
    ],
)
def test_abbreviations_by_language_and_long_quotations(text, lang, n):
    _, ends, size, _, _ = scan(text, alone=True, lang=lang)
    assert len({e for e, m in ends if m & 1} | {size}) == n


def test_long_rows_are_cut_into_chunks(spark, monkeypatch):
    text = "He said one thing. " * 300 + "“Stop it. Now,” said Ann. " * 200 + "静けさだけが残った。" * 200 + "Prof. Venn and Dr. Moor went home"
    df = spark.createDataFrame([("a", "v", 0, text), ("b", "v", 1, "at last. End")], "sent_id string, video_id string, idx int, text string")
    want = {r.sent_id: r.ends for r in row_ends(df, "video_id", "sent_id", "idx", "text").collect()}
    monkeypatch.setattr(sentences_module, "_CUT", sentences_module._CUT.replace(str(sentences_module.CHUNK), "97"))
    monkeypatch.setattr(sentences_module, "CHUNK", 97)
    assert {r.sent_id: r.ends for r in row_ends(df, "video_id", "sent_id", "idx", "text").collect()} == want and len(want["a"]) == 700


def test_chunks_anywhere_between_words_give_the_same_sentences():
    whole = " ".join(t for t, _ in CASES if "\n" not in t)
    rng = random.Random(2)
    reference = None
    for _ in range(40):
        words = whole.split(" ")
        cuts = sorted(rng.sample(range(1, len(words)), 12))
        rows = [" ".join(words[a:b]) for a, b in zip([0, *cuts], [*cuts, len(words)])]
        ends, base = set(), 0
        for t, own in zip(rows, sequential(rows)):
            ends |= {base + e for e in own}
            base += len(t) + 1
        reference = reference or ends
        assert len(ends ^ reference) <= 4  # marks at a cut between scripts see only the class of what follows


def test_blocks_equal_reading_in_order(spark):
    rng = random.Random(7)
    pieces = [w for t, _ in CASES for w in t.split(" ")]
    rows, want = [], {}
    for v in ["a", "b", None, "hot"]:
        n = 400 if v == "hot" else 20
        texts = [" ".join(rng.choices(pieces, k=rng.randint(1, 8))) for _ in range(n)]
        texts[3] = None
        texts[4] = " \n "
        texts[5] = ""
        own = [(i, t) for i, t in enumerate(texts) if t and t.strip()]
        for (i, _), e in zip(own, sequential([t for _, t in own])):
            want[(v, i)] = e
        rows += [(f"{v}:{i}", v, i, t, "x") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "sent_id string, video_id string, idx int, text string, ends string")
    for block in (2, 50, 1000):
        got = {(r.video_id, r.idx): r.ends for r in row_ends(df, "video_id", "sent_id", "idx", "text", block).collect()}
        assert got == want


def test_long_text_repeated_order_and_empty(spark):
    rows = [("x", "v", None, "First part of"), ("y", "v", 0, "a sentence. " + "Word goes on. " * 20_000), ("z", "v", 0, "Last")]
    df = spark.createDataFrame(rows, "sent_id string, video_id string, idx int, text string")
    got = {r.sent_id: r.ends for r in row_ends(df, "video_id", "sent_id", "idx", "text").collect()}
    assert got["x"] == [] and len(got["y"]) == 20_001 and got["z"] == [4]
    assert row_ends(df.limit(0), "video_id", "sent_id", "idx", "text").count() == 0


def test_sentences_have_text_and_time(spark):
    rows = [("a", "v", 0, 0.0, 4.0, "One. Two is"), ("b", "v", 1, 4.0, 6.0, "long. X"), ("c", "v", 2, 9.0, 7.0, None), ("d", "v", 3, 9.0, 7.0, "y.")]
    df = spark.createDataFrame(rows, "sent_id string, video_id string, idx int, s double, e double, text string")
    got = [(r.sentence, r.text, r.n_rows) for r in sentences(df, "video_id", "sent_id", "idx", "text", "s", "e", 2).orderBy("sentence").collect()]
    assert got == [(0, "One.", 1), (1, "Two is long.", 2), (2, "X y.", 2)]
