"""Problem 7: the corpus as token ids of a public tokenizer."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscle.llm.bpe import TrieEncoder, parse_ranks
from corpuscle.sources.tables import table

#: Folder of the public tokenizers and the vocabulary file in it; the file is read on the driver and sent to the executors.
TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.tiktoken"
#: A vocabulary file is a broadcast; larger ones are refused.
MOST_VOCABULARY_BYTES = 16 << 20
# Fixed value: the public byte-level BPE split, as the vocabulary's own definition has it.
BYTE_BPE_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Texts of one batch together in a worker at a time, in characters; a longer text is a batch by itself.
BATCH_CHARS = 4 << 20

_encoders: dict[bytes, TrieEncoder] = {}


def encoder(data: bytes, split: str) -> TrieEncoder:
    """The worker's encoder of a vocabulary; it lives on from task to task."""
    if data not in _encoders:
        _encoders.clear()
        _encoders[data] = TrieEncoder(parse_ranks(data), split)
    return _encoders[data]


def _batches(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    at, start, chars = [], 0, 0
    for i, text in enumerate(column):
        t = text.as_py()
        if at and chars + len(t or "") > BATCH_CHARS:
            yield start, at
            at, start, chars = [], i, 0
        at.append(t)
        chars += len(t or "")
    if at:
        yield start, at


def encode(df: DataFrame, text: str, ids: str = "ids", count_only: bool = False, folder: str = TOKENIZERS, vocabulary: str = BYTE_BPE) -> DataFrame:
    """``df`` with ``ids``, the token ids of ``text``, in place of ``text``; with ``count_only`` their number (int).

    No shuffle: each task inserts the distinct words of a batch of texts into a trie and encodes them by one walk over
    it; encodings are remembered across batches, up to a bound. Whole texts are encoded, of any length. Null and empty
    text give an empty list (0). Text that looks like a special token is ordinary text. Other columns stay as they are,
    also those of struct or array type; a column already named ``ids`` other than ``text`` is an error.
    """
    spark = df.sparkSession
    path = os.path.join(folder, vocabulary)
    if os.path.getsize(path) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} is too large for a vocabulary")
    if ids in df.columns and ids != text:
        raise ValueError(f"column {ids} exists already")
    with open(path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    split = BYTE_BPE_SPLIT
    keep = [c for c in df.columns if c != text]
    kind = T.IntegerType() if count_only else T.ArrayType(T.IntegerType(), True)
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(ids, kind, True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, split)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            rest = batch.select([batch.schema.names[i] for i in range(batch.num_columns) if i != at])
            for start, texts in _batches(batch.column(at)):
                found = enc.encode_batch(texts)
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                if count_only:
                    column = pa.array(sizes, pa.int32())
                else:
                    flat = np.fromiter((i for x in found for i in x), np.int32, int(sizes.sum()))
                    column = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
                part = rest.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, ids])

    return df.select(*[F.col(f"`{c}`") for c in keep], text).mapInArrow(run, schema)


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


QUERIES = {"p7_ids": p7_ids}
SQL: dict[str, str] = {}
