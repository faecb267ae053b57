"""Problem 2: machine-cut rows of text become the true sentences of every video.

Every row is a chunk of its video's text, long rows are several, and becomes a state-transition function (``boundaries.scan``), whatever
precedes it. The functions compose: within blocks of BLOCK rows first, then over the blocks of a video by a prefix scan over a tree, then back
into the blocks, so neither a video nor a document of any length is one task's text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.llm.boundaries import IDENTITY, NOTHING, OUT, head, scan
from corpuscle.llm.languages import FREQUENT
from corpuscle.operators.sequence import null_safe, once, states_before
from corpuscle.session import settle
from corpuscle.sources.tables import current_rows, table

#: Rows (by idx) of a block.
BLOCK = 256
#: Characters of a chunk; longer rows are cut, where possible between words, else between characters of scripts without spaces.
CHUNK = 1 << 16

_LETTERS = r"[\p{L}\p{M}]"
_HAN = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]"
_CUT = rf"(?s).{{1,{CHUNK}}}(?:$|(?<={_LETTERS})(?=\s\p{{L}}))|.{{1,{CHUNK}}}(?:(?<={_HAN})(?={_HAN}))|.{{1,{CHUNK}}}"

_SCANNED = "_next array<int>, _ends array<struct<at:int,states:bigint>>, _size int, _outside bigint, _tail int, _head int"


def _scan_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = {k: [] for k in ("_next", "_ends", "_size", "_outside", "_tail", "_head")}
        for text, lang in zip(pdf["_text"], pdf["_lang"]):
            state, ends, size, outside, tail = scan(text, lang=lang)
            out["_next"].append(state)
            out["_ends"].append([{"at": a, "states": m} for a, m in ends])
            out["_size"].append(size)
            out["_outside"].append(outside)
            out["_tail"].append(tail)
            out["_head"].append(head(text))
        yield pd.concat([pdf.drop(columns=["_text", "_lang"]).reset_index(drop=True), pd.DataFrame(out)], axis=1)


def languages(rows: DataFrame, entity: str, text: str) -> DataFrame:
    """_le, ``_lang``: the language in Latin letters of each entity's whole text, by frequent words; null where none is ahead."""
    words = F.split(F.lower(text), r"[^\p{L}]+")
    hits = lambda own: F.sum(F.size(F.filter(words, lambda w: w.isin(own))))
    n = rows.groupBy(F.col(entity).alias("_le")).agg(*[hits(v.split()).alias(k) for k, v in FREQUENT.items()])
    best = F.greatest(*FREQUENT)
    lead = F.size(F.filter(F.array(*FREQUENT), lambda x: x == best)) == 1
    return n.select("_le", F.when(lead & (best > 0), F.coalesce(*[F.when(F.col(k) == best, F.lit(k)) for k in FREQUENT])).alias("_lang"))


def chunk_ends(df: DataFrame, video: str, row: str, order: str, text: str, block: int = BLOCK) -> DataFrame:
    """Rows with text, with ``ends``: the ends of sentences in the row, in code points from its beginning, ascending; long rows in several rows.

    Columns: video, row, order, ``ends`` array<int>. Rows follow each other by ``order`` (null first), then by ``row``. Null, empty and blank
    texts have no row in the result and don't interrupt a sentence; a null ``video`` is a video. A sentence that runs on
    into the next row ends there; the last row with text ends its last sentence. Texts of any length are scanned whole, in
    one pass. Abbreviations are those of the language of the video's text. An empty input gives an empty result. Other columns are left out; their names don't matter.
    """
    blank = F.length(F.regexp_replace(F.col(text), r"(?U)\s+", "")) == 0
    rows = df.where(F.col(text).isNotNull() & ~blank).select(F.col(video).alias("_video"), F.col(row).alias("_row"), F.col(order).cast("bigint").alias("_order"), F.col(text).alias("_text"))
    kinds = dict(rows.dtypes)
    rows = rows.join(languages(rows, "_video", "_text"), null_safe(["_video"], ["_le"]), "left").drop("_le")
    whole = F.when(F.length("_text") <= CHUNK, F.array("_text")).otherwise(F.regexp_extract_all("_text", F.lit(_CUT), F.lit(0)))
    cut = once(rows, _parts=whole).drop("_text").select("_video", "_row", "_order", "_lang", "_parts", F.posexplode("_parts").alias("_chunk", "_text"))
    base = F.aggregate(F.slice("_parts", F.lit(1), F.col("_chunk")), F.lit(0), lambda n, x: n + F.length(x))
    cut = cut.select("_video", "_row", "_order", "_chunk", base.alias("_base"), "_text", "_lang")
    scanned = cut.mapInPandas(_scan_batches, f"_video {kinds['_video']}, _row {kinds['_row']}, _order bigint, _chunk int, _base int, {_SCANNED}")
    scanned = scanned.withColumn("_block", F.coalesce(F.floor(F.col("_order") / block), F.lit(-1)).cast("bigint"))
    # A chunk of only white space behind a cut has no end of its own and interrupts nothing.
    item = F.struct("_order", "_row", "_chunk", "_base", "_next", "_ends", "_size", "_outside", "_tail", "_head")
    blocks = settle(scanned.where("_size > 0").groupBy("_video", "_block").agg(F.array_sort(F.collect_list(item)).alias("_rows")))

    identity = F.array(*[F.lit(s) for s in IDENTITY])
    f = F.aggregate("_rows", identity, lambda acc, r: F.transform(acc, lambda s: F.get(r["_next"], s)))
    states = states_before(blocks.select("_video", "_block", f.alias("_f")), ["_video"], "_block", "_f", None, OUT, ("_state", "_none")).drop("_none")
    behind = blocks.select("_video", "_block", F.get("_rows", F.lit(0))["_head"].alias("_first"))
    behind = behind.select(F.col("_video").alias("_v"), F.col("_block").alias("_b"), F.lead("_first").over(Window.partitionBy("_video").orderBy("_block")).alias("_after"))
    states = states.select(F.col("_video").alias("_v2"), F.col("_block").alias("_b2"), "_state")
    whole = blocks.join(states, null_safe(["_video", "_block"], ["_v2", "_b2"])).join(behind, null_safe(["_video", "_block"], ["_v", "_b"]))
    step = lambda acc, r: F.array_append(acc, F.get(r["_next"], F.element_at(acc, -1)))
    heads = F.concat(F.transform(F.slice("_rows", 2, F.greatest(F.size("_rows") - 1, F.lit(0))), lambda r: r["_head"]), F.array(F.coalesce("_after", F.lit(NOTHING))))
    whole = once(whole, _states=F.aggregate("_rows", F.array("_state"), step), _heads=heads)
    laid = whole.select("_video", F.inline(F.arrays_zip(F.col("_rows").alias("r"), F.slice("_states", F.lit(1), F.size("_rows")).alias("i"), F.col("_heads").alias("h"))))
    laid = laid.select("_video", "r.*", F.col("i").alias("_in"), F.col("h").alias("_follow"))

    bit = lambda mask, at: F.expr(f"shiftright(CAST({mask} AS BIGINT), {at}) & 1") == 1
    inner = F.expr("transform(filter(_ends, e -> (shiftright(e.states, _in) & 1) = 1), e -> e.at)")
    ends_here = (F.col("_follow") == NOTHING) | (bit("_tail", "_follow") & bit("_outside", "_in"))
    ends = F.when(ends_here, F.array_distinct(F.concat(inner, F.array("_size")))).otherwise(inner)
    absolute = F.transform(ends, lambda e: e + F.col("_base"))
    return laid.select(F.col("_video").alias(video), F.col("_row").alias(row), F.col("_order").alias(order), absolute.alias("ends"))


def row_ends(df: DataFrame, video: str, row: str, order: str, text: str, block: int = BLOCK) -> DataFrame:
    """``chunk_ends`` with one row for each row of ``df`` (repeated rows of a key are one)."""
    parts = chunk_ends(df, video, row, order, text, block)
    return parts.groupBy(video, row, order).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ends")))).alias("ends"))


def _current(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    rows = table(spark, sf_dir, "sentences").select("sent_id", "video_id", "idx", "text", "loaded_at", *more)
    return current_rows(rows, ["sent_id"])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = chunk_ends(_current(spark, sf_dir), "video_id", "sent_id", "idx", "text")
    return ends.select("sent_id", F.explode("ends").alias("end_char"))


def sentences(df: DataFrame, video: str, row: str, order: str, text: str, start: str, end: str, block: int = BLOCK) -> DataFrame:
    """The true sentences of every video: video, ``sentence`` (from 0), ``start_s``, ``end_s``, ``n_rows``, ``text``.

    A part of a row gets the part of the row's time span that its characters are of the row's; rows with a null time or an
    end before the start have none, and a sentence of only such rows has null times. White space inside is made single;
    a sentence over several rows is joined by a space.
    """
    ends = row_ends(df, video, row, order, text, block).select(F.col(row).alias("_row"), "ends", F.coalesce(F.floor(F.col(order) / block), F.lit(-1)).alias("_block"))
    rows = df.select(F.col(video).alias("_video"), F.col(row).alias("_id"), F.col(order).cast("bigint").alias("_order"), F.col(text).alias("_text"), F.col(start).alias("_s"), F.col(end).alias("_e"))
    rows = rows.join(ends, F.col("_id").eqNullSafe(F.col("_row"))).drop("_row")
    spans = F.col("_s").isNotNull() & F.col("_e").isNotNull() & (F.col("_e") >= F.col("_s"))
    size = F.length("_text")
    cuts = F.when(F.coalesce(F.try_element_at("ends", F.lit(-1)) < size, F.lit(True)), F.concat("ends", F.array(size))).otherwise(F.col("ends"))
    parts = rows.withColumn("_from", F.concat(F.array(F.lit(0)), F.col("ends"))).select("*", cuts.alias("_cuts"))
    parts = parts.select("_video", "_block", "_order", "_id", "_text", "_s", "_e", size.alias("_n"), spans.alias("_ok"), F.size("ends").alias("_closed"), "_from", F.posexplode("_cuts").alias("_part", "_to"))
    parts = parts.withColumn("_at", F.get("_from", F.col("_part")))
    piece = F.trim(F.regexp_replace(F.substring(F.col("_text"), F.col("_at") + 1, F.col("_to") - F.col("_at")), r"(?U)\s+", " "))
    time = lambda at: F.when(F.col("_ok"), F.col("_s") + (F.col("_e") - F.col("_s")) * F.col(at) / F.col("_n"))
    parts = parts.select("_video", "_block", "_order", "_id", "_part", piece.alias("_piece"), time("_at").alias("_b"), time("_to").alias("_f"), (F.col("_part") < F.col("_closed")).cast("bigint").alias("_closes")).where("_piece <> ''")
    keys = ["_order", "_id", "_part"]
    counts = parts.groupBy("_video", "_block").agg(F.sum("_closes").alias("_c"))
    before = counts.select(F.col("_video").alias("_v"), F.col("_block").alias("_bb"), F.sum("_c").over(Window.partitionBy("_video").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"))
    local = Window.partitionBy("_video", "_block").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    numbered = parts.join(before, F.col("_video").eqNullSafe(F.col("_v")) & (F.col("_block") == F.col("_bb")), "left")
    numbered = numbered.withColumn("sentence", F.coalesce(F.sum("_closes").over(local), F.lit(0)) + F.coalesce("_earlier", F.lit(0)))
    out = numbered.groupBy("_video", "sentence").agg(F.min("_b").alias("start_s"), F.max("_f").alias("end_s"), F.countDistinct("_id").alias("n_rows"), F.array_sort(F.collect_list(F.struct(*keys, "_piece"))).alias("_pieces"))
    return out.select(F.col("_video").alias(video), F.col("sentence"), "start_s", "end_s", "n_rows", F.array_join(F.transform("_pieces", lambda p: p["_piece"]), " ").alias("text"))


def p2_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences(settle(_current(spark, sf_dir, "start_s", "end_s")), "video_id", "sent_id", "idx", "text", "start_s", "end_s")


QUERIES = {"p2_found": p2_found, "p2_sentences": p2_sentences}
SQL: dict[str, str] = {}
