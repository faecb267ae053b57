"""Timed fragments to segments; chunks to text with offsets; offsets back to chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.text import strip_markers
from corpuscle.operators.sequence import last_known, running_sum


def gap_segments(df: DataFrame, by: list[str], order: list[str], start: Column, duration: Column, text: Column, gap: float = 1.0, block: Column | None = None) -> DataFrame:
    """by, ``segment`` (from 0), ``inicio_s``, ``texto``: fragments joined until a gap or a marker-only fragment.

    A segment begins at the first fragment with text, behind a marker-only fragment, and where start - previous end > ``gap``
    (strictly). Marker-only fragments move the previous end and give no text; null texts are marker-only, null durations 0.
    ``block`` cuts long entities into parts of neighbouring fragments (it never falls in their order), each scanned by itself.
    """
    o = [f"_o{i}" for i in range(len(order))]
    clean = strip_markers(text)
    part = F.lit(0) if block is None else block
    f = df.select(*by, *[F.col(c).alias(n) for c, n in zip(order, o)], part.cast("bigint").alias("_block"), start.cast("double").alias("_s"), (start + F.coalesce(duration, F.lit(0.0))).cast("double").alias("_e"), F.coalesce(clean, F.lit("")).alias("_t"))
    f = last_known(f, by, "_block", o, F.struct("_e", (F.col("_t") == "").alias("blank")), "_p", inclusive=False)
    new = (F.col("_t") != "") & (F.col("_p").isNull() | F.col("_p.blank") | (F.col("_s") - F.col("_p._e") > gap))
    f = running_sum(f, by, "_block", o, new.cast("bigint"), "_seg").where("_t <> ''")
    out = f.groupBy(*by, (F.col("_seg") - 1).alias("segment")).agg(F.min(F.struct(*o, "_s"))["_s"].alias("inicio_s"), F.array_sort(F.collect_list(F.struct(*o, "_t"))).alias("_x"))
    return out.select(*by, "segment", "inicio_s", F.array_join(F.transform("_x", lambda x: x["_t"]), " ").alias("texto"))


def chunk_offsets(df: DataFrame, by: list[str], order: list[str], text: str, block: Column | None = None) -> DataFrame:
    """``df`` with the half-open span ``char_from``, ``char_to`` of each chunk in the text joined by single spaces; ``block`` as above."""
    part = F.lit(0) if block is None else block
    size = F.coalesce(F.length(text), F.lit(0)).cast("bigint") + 1
    out = running_sum(df.withColumn("_block", part.cast("bigint")), by, "_block", order, size, "_upto").drop("_block")
    return out.withColumn("char_from", (F.col("_upto") - size).cast("bigint")).withColumn("char_to", (F.col("_upto") - 1).cast("bigint")).drop("_upto")


#: Characters of a text that one scan of ``attach`` or ``sentence_spans`` covers.
SCAN_CHARS = 1_000_000

# Closing marks, which end a sentence before a space (those of scripts without spaces anywhere), and what may follow them.
_CLOSES = r"(?:[.!?…।॥؟۔]+[\"'”’»)\]]*(?=\s|$)|[。！？]+[」』”’）]*)"


def cut_sentences(text: Column) -> Column:
    """Sentences of a text, cut behind ., ! or ? before white space; blank pieces are none. Null text has none. A form that SQL engines share."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])\s+", "$1\x01")
    return F.filter(F.transform(F.split(marked, "\x01"), lambda x: F.trim(x)), lambda x: x != "")


def sentence_spans(chunks: DataFrame, by: list[str], text: str) -> DataFrame:
    """by, ``idx`` (from 0), ``char_from``, ``char_to``: the sentences of the text joined by single spaces, cut at closing marks.

    ``chunks`` has by, char_from and the text, without outer and with single white space. No mark runs over the end of a chunk, so
    each chunk is cut by itself; a sentence is a run of pieces up to a closed one, whatever stands behind the last is one too.
    """
    cut = F.regexp_extract_all(F.col(text), F.lit(rf" ?(?=\S).*?(?:{_CLOSES}|$)"), F.lit(0))
    pieces = chunks.select(*by, F.col("char_from").alias("_base"), cut.alias("_p")).select(*by, "_base", "_p", F.posexplode("_p").alias("_k", "_t"))
    before = F.aggregate(F.slice("_p", F.lit(1), F.col("_k")), F.lit(0), lambda n, x: n + F.length(x))
    at = (F.col("_base") + before).cast("bigint")
    closed = F.col("_t").rlike(_CLOSES + "$").cast("bigint")
    rows = pieces.select(*by, (at + F.when(F.col("_t").startswith(" "), 1).otherwise(0)).alias("_from"), (at + F.length("_t")).alias("_to"), closed.alias("_closed"))
    rows = running_sum(rows.withColumn("_block", F.floor(F.col("_from") / SCAN_CHARS).cast("bigint")), by, "_block", ["_from"], F.col("_closed"), "_n")
    return rows.groupBy(*by, (F.col("_n") - F.col("_closed")).alias("idx")).agg(F.min("_from").alias("char_from"), F.max("_to").alias("char_to"))


def attach(points: DataFrame, chunks: DataFrame, by: list[str], at: str) -> DataFrame:
    """``points`` with ``chunk``, the order of the chunk whose span holds ``at``, the last chunk behind all spans.

    No range join: spans are in order, so the chunk of a point is the last one that begins at or before it; one sort of the
    union gives it to every point. ``chunks`` has by, char_from and chunk.
    """
    cols = [c for c in points.columns if c not in by]
    p = points.select(*by, F.col(at).cast("bigint").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("bigint").alias("_chunk"), F.struct(*cols).alias("_row"))
    c = chunks.select(*by, F.col("char_from").alias("_at"), F.lit(0).alias("_kind"), F.col("chunk").cast("bigint").alias("_chunk"), F.lit(None).cast(p.schema["_row"].dataType).alias("_row"))
    both = p.unionByName(c).withColumn("_block", F.floor(F.col("_at") / SCAN_CHARS).cast("bigint"))
    got = last_known(both, by, "_block", ["_at", "_kind"], F.col("_chunk"), "chunk").where("_kind = 1")
    return got.select(*by, *[F.col(f"_row.{x}").alias(x) for x in cols], "chunk")
