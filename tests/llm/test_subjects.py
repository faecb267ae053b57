import random

import numpy as np
import pyarrow as pa

from corpuscle.llm.subjects import ALPHA, CHUNK, LANGUAGES, MIN_DOCS, PLACES, SETTLED, _added, _rows, _sums, _read, fit, language, place, prepare, proportions, sentences_of, settled, terms, topic_terms

WORDS = {"law": ["verdict hearing", "penal code", "appeal court"], "sport": ["goal keeper", "relay team", "penalty kick"], "science": ["enzyme count", "photon field", "fossil layer"]}
FRAMES = ["The {} is older than it looks.", "Nobody asked about the {} again.", "We come back to the {} soon."]
PLAIN = ["Nobody said a word.", "It was raining on that day.", "Stay with us until the end."]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    docs, truth = [], {}
    for i in range(n):
        subject = rng.choice([*WORDS, None])
        m = rng.randint(4, 9)
        k = 0 if subject is None else rng.randint(2, m)
        sents = [rng.choice(FRAMES).format(rng.choice(WORDS[subject])) for _ in range(k)] + [rng.choice(PLAIN) for _ in range(m - k)]
        rng.shuffle(sents)
        docs.append((i, " ".join(sents), "clash"))
        truth[i] = {subject: k / m} if k else {}
    return docs, truth


def test_subjects_of_unlabelled_documents(spark):
    docs, truth = corpus()
    docs += [(1000, None, "x"), (1001, "", "x"), (1002, " \n ", "x")]
    labels = [(i, s.upper() + " ") for i, t in truth.items() if i % 4 == 0 for s in t] * 2 + [(0, "bogus"), (None, "law"), (5, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, subject string")
    got = {}
    for r in proportions(df, spark.createDataFrame(labels, "doc_id bigint, subject string"), sorted(WORDS)).collect():
        got.setdefault(r.doc_id, {})[r.subject] = r.share
    wrong = sum({s for s, x in got.get(i, {}).items() if x >= 0.2} != {s for s, x in t.items() if x >= 0.2} for i, t in truth.items())
    assert wrong <= 0.03 * len(truth)
    assert not {1000, 1001, 1002} & set(got)


def test_without_labels_or_documents(spark):
    docs, _ = corpus(30)
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    none = spark.createDataFrame([], "doc_id bigint, subject string")
    assert proportions(df, none, sorted(WORDS)).count() == 0
    assert proportions(df.limit(0), none, sorted(WORDS)).count() == 0


def test_language_sentences_terms():
    assert [language(t) for t in ["the end of it", "não é o que foi", "das ist nicht der Fall", "これは本です", "这只是开始", "यह है", "ครับ", "في عام", "12"]] == ["en", "pt", "de", "ja", "zh", "hi", "th", "ar", "other"]
    assert sentences_of("## part 1\nOne here. Two. ½") == ["One here.", "Two."]
    assert terms("The cat, the cat of 12") == ["the", "cat", "the cat", "cat the", "cat of"] and terms("熊猫吃") == ["熊猫", "猫吃", "熊猫吃"]


def test_only_places_of_enough_documents_are_known(spark):
    docs = [(i, "alpha beta gamma" + (" delta" if i < MIN_DOCS - 1 else "")) for i in range(MIN_DOCS)]
    coded = prepare(spark.createDataFrame(docs, "k bigint, t string"), "k", "t")
    model = fit(coded, spark.createDataFrame([(0, "law")], "_id bigint, subject string"), ["law"], rounds=1)
    block = LANGUAGES.index("other")
    assert set(model.known) == {place(t, block) for t in ("alpha", "beta", "gamma", "alpha beta", "beta gamma")}
    assert np.allclose(model.beta.sum(0), 1, atol=1e-3)
    got = topic_terms(spark.createDataFrame(docs, "k bigint, t string"), model, ["law"], "t").where("topic = 0").collect()
    assert {r.term for r in got} == {"alpha", "beta", "gamma", "alpha beta", "beta gamma"} and {r.language for r in got} == {"other"}


def test_proportions_settle():
    rng = np.random.default_rng(3)
    k, v = 4, 60
    beta = rng.dirichlet(np.ones(v), k).astype(np.float32)
    docs = [rng.integers(0, v, n) for n in (5, 400, 30, 0, 120)]
    got = settled(np.concatenate(docs), np.array([len(d) for d in docs]), beta.T.copy(), np.full((len(docs), k), ALPHA, np.float32))
    for d, row in zip(docs, got):
        theta = np.full(k, 1.0 / k)
        for _ in range(500 if len(d) else 0):
            share = theta[:, None] * beta[:, d]
            theta = (ALPHA + (share / share.sum(0)).sum(1)) / (k * ALPHA + len(d))
        assert np.abs(row - theta).max() < 20 * SETTLED


def test_sums_add_up_over_chunks():
    v = len(LANGUAGES) * PLACES
    docs = pa.array([[[1, CHUNK + 1], [1]], [], [[v - 1]], None], pa.list_(pa.list_(pa.int32())))

    class Shared:
        value = (None, None)

    rows = [r for _ in range(3) for r in _sums(Shared, 1, ALPHA)(iter([pa.RecordBatch.from_arrays([docs], names=["_ids"])]))]
    got = {}
    for r in _added(1)(iter(rows)):
        own, values = _read(r.column(2)[0].as_py(), 1)
        got |= {r.column(0)[0].as_py() * CHUNK + int(o): float(x[0]) for o, x in zip(own, values)}
    assert got == {1: 3.0, CHUNK + 1: 3.0, v - 1: 3.0} and not list(_rows(np.zeros((CHUNK, 2)), 0))


def test_language_counts_the_whole_of_a_long_text():
    # Every second character is Latin, and more characters are Han.
    text = "a国" * 4_000 + "国" * 10
    assert language(text) == "zh" and language("国" * 10 + text) == "zh"
    assert language(text[:-10] + "b" * 10) == "other"
