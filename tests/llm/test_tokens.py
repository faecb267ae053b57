import base64
import os
import random

import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpuscle.llm.bpe import TrieEncoder, read_ranks
from corpuscle.llm.tokens import BYTE_BPE_SPLIT, TOKENIZERS, encode

PATH = os.path.join(TOKENIZERS, "byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def theirs():
    t = Tokenizer.from_file(os.path.join(TOKENIZERS, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def samples():
    rng = random.Random(5)
    pools = ["abcdefgh ", "aeiou tnrs'", "  \t\n x", "日本語テスト。はい", "ÄÖüßéñ ", "0123456789.,", "👍🏽🇧🇷é", "ไม่มีครับ ", "=-_*#<|>", "".join(map(chr, range(32, 127)))]
    out = ["", " ", "<|endoftext|>", "a<|endoftext|>b", "don't we'll I'VE", "a" * 5000, "日" * 3000, "-" * 300, "\n\n\n  x"]
    for _ in range(1500):
        p = rng.choice(pools) + (rng.choice(pools) if rng.random() < 0.4 else "")
        out.append("".join(rng.choice(p) for _ in range(rng.randint(1, 60))))
    return out


def test_equals_public_tokenizer(ranks, theirs):
    texts = samples()
    enc = TrieEncoder(ranks, BYTE_BPE_SPLIT)
    assert enc.encode_batch(texts) == theirs(texts)
    small = TrieEncoder(ranks, BYTE_BPE_SPLIT, memory=50)
    assert [i for k in range(0, len(texts), 7) for i in small.encode_batch(texts[k : k + 7])] == theirs(texts)


def test_every_token_alone_and_round_trip(ranks):
    enc = TrieEncoder(ranks, BYTE_BPE_SPLIT)
    order = sorted(ranks)
    got = dict(zip(order, enc._walk(order)))
    own = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    for token in order[::17]:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        assert got[token] == own.encode_ordinary(text)
    assert all(b"".join(enc.bytes_of[i] for i in ids) == t for t, ids in got.items())


def test_column(spark, theirs):
    texts = [*samples()[:200], None, ""]
    rows = [(i, t, "x" * (i % 3)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n string").repartition(3)
    want = dict(enumerate(theirs([t or "" for t in texts])))
    got = encode(df, "text")
    assert got.columns == ["doc_id", "n", "ids"]
    assert {r.doc_id: r.ids for r in got.collect()} == want
    assert {r.doc_id: r.size for r in encode(df, "text", "size", count_only=True).collect()} == {k: len(v) for k, v in want.items()}
    assert encode(df.limit(0), "text").count() == 0
    with pytest.raises(ValueError):
        encode(df, "text", "n")
    assert encode(df.withColumn("extra", F.array(F.lit(1))), "text").where("ids is null").count() == 0


def test_vocabulary_is_parsed():
    line = open(PATH, "rb").readline().split()
    assert read_ranks(PATH)[base64.b64decode(line[0])] == int(line[1])
