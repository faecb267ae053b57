"""Problem 1: items over a size limit come out as ordered pieces under it, cut at natural boundaries, with overlap.

Every boundary of an oversized item is joined to its farthest legal successor: where the piece that starts behind it (with
its overlap) has to end. Following successors from the start gives the greedy cuts; instead of walking, the successor table
is squared again and again, and each squaring doubles the cuts known, so an item of n pieces needs log2(n) joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.llm.boundaries import scan
from corpuscle.operators.sequence import null_safe
from corpuscle.session import settle
from corpuscle.sources.tables import current_rows, table

MAX_WORDS, MAX_CHARS, OVERLAP_WORDS = 60, 400, 10
#: Boundaries of a block.
BLOCK = 4_096

_PAUSE = re.compile(r"[^、，；：,;]*[、，；：,;]+|[^、，；：,;]+")


def atoms(text: str, max_words: int, max_chars: int) -> list[tuple[str, int, bool]]:
    """(text, words, whether a sentence ends with it): the whole text if it fits, else its sentences, of oversized ones the
    words, of oversized words the parts between pauses, of oversized parts slices. They rebuild the text exactly."""

    def fits(t: str) -> bool:
        return len(t) <= max_chars and len(t.split()) <= max_words

    if fits(text):
        return [(text, len(text.split()), True)]
    _, ends, size, _, _ = scan(text)
    cuts = sorted({e for e, m in ends if m & 1} | {size})
    out: list[tuple[str, int, bool]] = []
    at = 0
    for k, cut in enumerate(cuts):
        end = cut
        while end < len(text) and text[end].isspace():
            end += 1
        if k + 1 == len(cuts):
            end = len(text)
        sentence, at = text[at:end], end
        if not sentence:
            continue
        if fits(sentence):
            out.append((sentence, len(sentence.split()), True))
            continue
        parts: list[str] = []
        for word in re.findall(r"\s*\S+\s*(?=\S|$)|\s+", sentence):
            if len(word) <= max_chars:
                parts.append(word)
                continue
            for part in _PAUSE.findall(word):
                parts += [part[i : i + max_chars] for i in range(0, len(part), max_chars)]
        out += [(p, min(1, len(p.split())), i + 1 == len(parts)) for i, p in enumerate(parts)]
    return out


def _atom_batches(max_words: int, max_chars: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for item, unit, text in zip(pdf["_item"], pdf["_unit"], pdf["_text"]):
                found = atoms(text, max_words, max_chars)
                words = chars = 0
                for j, (t, w, e) in enumerate(found):
                    words, chars = words + w, chars + len(t)
                    rows.append((item, unit, j, t, w, len(t), e, " " if j + 1 == len(found) else "", words, chars))
            yield pd.DataFrame(rows, columns=["_item", "_unit", "_j", "_atom", "_w", "_c", "_end", "_sep", "_uw", "_uc"])

    return run


def words_of(col) -> F.Column:
    return F.size(F.filter(F.split(F.coalesce(col, F.lit("")), r"(?U)\s+"), lambda x: x != ""))


def _double(steps: DataFrame) -> DataFrame:
    """All boundaries reached from 0: ``_item, _at, _order``; ``steps`` has ``_item, _at, _next``, the last boundary no row."""
    power = settle(steps)
    reached = power.where("_at = 0").select("_item", "_at", F.lit(0).cast("bigint").alias("_order"))
    stride = 1
    for _ in range(62):
        # Every reached boundary leaps by the present power; order tells how many pieces lie before it.
        ahead = power.select(F.col("_item").alias("_i"), F.col("_at").alias("_a"), F.col("_next").alias("_n"))
        leap = reached.join(ahead, null_safe(["_item", "_at"], ["_i", "_a"])).select("_item", F.col("_n").alias("_at"), (F.col("_order") + stride).alias("_order"))
        leap = settle(leap)
        if leap.isEmpty():
            return reached
        reached = settle(reached.unionByName(leap))
        power = settle(power.alias("a").join(ahead.alias("b"), F.col("a._item").eqNullSafe(F.col("b._i")) & (F.col("a._next") == F.col("b._a"))).select(F.col("a._item").alias("_item"), F.col("a._at").alias("_at"), F.col("b._n").alias("_next")))
        stride *= 2
    raise ValueError("a boundary is its own successor")


def _boundaries(rows: DataFrame, max_words: int, max_chars: int) -> DataFrame:
    """Atoms of oversized items, numbered: _item, _b (before the atom), _atom, _w, _c, _end, _sep, and _aw, _ac (words and characters up to and with it)."""
    kind = dict(rows.dtypes)["_item"]
    schema = f"_item {kind}, _unit bigint, _j bigint, _atom string, _w int, _c int, _end boolean, _sep string, _uw bigint, _uc bigint"
    made = settle(rows.where("_text <> ''").mapInPandas(_atom_batches(max_words, max_chars), schema))
    # Atoms are counted inside their unit already; a unit's last atom has its totals, and only those are added up, by blocks of units.
    totals = made.where("_sep <> ''").select("_item", "_unit", F.floor(F.col("_unit") / BLOCK).cast("bigint").alias("_block"), (F.col("_j") + 1).alias("_un"), "_uw", "_uc")
    sums = ("_un", "_uw", "_uc")
    carried = Window.partitionBy("_item").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.groupBy("_item", "_block").agg(*[F.sum(c).alias(c) for c in sums]).select(F.col("_item").alias("_i"), F.col("_block").alias("_bl"), *[F.coalesce(F.sum(c).over(carried), F.lit(0)).alias("_carry" + c) for c in sums])
    local = Window.partitionBy("_item", "_block").orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    units_ = totals.select("_item", "_block", "_unit", *[F.coalesce(F.sum(c).over(local), F.lit(0)).alias("_local" + c) for c in sums]).join(carry, null_safe(["_item", "_block"], ["_i", "_bl"]))
    units_ = units_.select(F.col("_item").alias("_i"), F.col("_unit").alias("_u"), *[(F.col("_carry" + c) + F.col("_local" + c)).alias("_before" + c) for c in sums])
    made = made.join(units_, null_safe(["_item", "_unit"], ["_i", "_u"]))
    place = [(F.col("_before_un") + F.col("_j")).alias("_b"), (F.col("_before_uw") + F.col("_uw")).alias("_aw"), (F.col("_before_uc") + F.col("_uc")).alias("_ac")]
    return made.select("_item", "_atom", "_w", "_c", "_end", "_sep", *place)


def cut(rows: DataFrame, max_words: int = MAX_WORDS, max_chars: int = MAX_CHARS, overlap_words: int = OVERLAP_WORDS) -> tuple[DataFrame, DataFrame]:
    """(pieces, atoms) of the oversized items of ``rows`` (_item, _unit, _text): pieces have _item, _piece, _from, _to."""
    totals = rows.groupBy("_item").agg(F.sum(words_of(F.col("_text"))).alias("_tw"), F.sum(F.length("_text")).alias("_tc"))
    big = totals.where((F.col("_tw") > max_words) | (F.col("_tc") > max_chars)).select(F.col("_item").alias("_i"))
    own = settle(_boundaries(rows.join(big, F.col("_item").eqNullSafe(F.col("_i")), "left_semi"), max_words, max_chars))

    # Boundary b lies before atom b; the one after the last atom has no row. A block sees REACH atoms on either side of it,
    # and no piece or overlap reaches further, as every atom has a character.
    reach = max_chars + overlap_words + 2
    if reach >= BLOCK:
        raise ValueError("limits must be far smaller than a block")
    block, place = F.floor(F.col("_b") / BLOCK).cast("bigint"), F.col("_b") % BLOCK
    near = F.array_compact(F.array(block, F.when((place < reach) & (block > 0), block - 1), F.when(place >= BLOCK - reach, block + 1)))
    part = Window.partitionBy("_item", "_block")
    row = part.orderBy("_b")
    seen = own.withColumn("_block", F.explode(near)).withColumn("_bw", F.col("_aw") - F.col("_w")).withColumn("_bc", F.col("_ac") - F.col("_c"))
    ended = F.when(F.col("_end"), F.col("_b") + 1)
    seen = seen.select(
        "*",
        F.max("_b").over(part.orderBy("_bw").rangeBetween(Window.currentRow, max_words)).alias("_fw"),
        F.max("_b").over(part.orderBy("_bc").rangeBetween(Window.currentRow, max_chars)).alias("_fc"),
        F.max(F.struct("_b", "_aw", "_ac")).over(part).alias("_tail"),
        F.coalesce(F.max(ended).over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s0"),
        F.coalesce(F.max(ended).over(row.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("_s1"),
    )
    whole = (F.col("_tail._aw") - F.col("_bw") <= max_words) & (F.col("_tail._ac") - F.col("_bc") <= max_chars)
    seen = seen.withColumn("_far", F.when(whole, F.col("_tail._b") + 1).otherwise(F.least("_fw", "_fc")))
    # Where a piece that follows the cut at this boundary would begin: the sentence before it, or the words before it inside the sentence.
    back = F.when(F.lag("_end").over(row), F.lag("_s0").over(row)).otherwise(F.greatest(F.col("_b") - overlap_words, F.lag("_s0").over(row)))
    seen = seen.withColumn("_back", F.when(F.col("_b") == 0, F.lit(0)).otherwise(back).cast("bigint")).where(block == F.col("_block"))
    known = settle(seen.select("_item", "_b", "_bw", "_bc", "_aw", "_ac", "_far", "_s1", "_back"))

    there = known.select(F.col("_item").alias("_i"), F.col("_b").alias("_e"), F.col("_bw").alias("_ow"), F.col("_bc").alias("_oc"), F.col("_far").alias("_ofar"))
    room = (F.col("_aw") - F.col("_ow") <= max_words) & (F.col("_ac") - F.col("_oc") <= max_chars)
    cuts = known.join(there, null_safe(["_item", "_back"], ["_i", "_e"]))
    cuts = cuts.select("_item", F.col("_b").alias("_at"), F.when(room, F.col("_back")).otherwise(F.col("_b")).alias("_from"), F.when(room, F.col("_ofar")).otherwise(F.col("_far")).alias("_far"))
    # Farthest legal successor: the last sentence end the limit allows, a place inside the sentence if there is none.
    ends = known.select(F.col("_item").alias("_i"), (F.col("_b") + 1).alias("_e"), F.col("_s1"))
    cuts = cuts.join(ends, null_safe(["_item", "_far"], ["_i", "_e"]), "left").drop("_i", "_e")
    cuts = settle(cuts.select("_item", "_at", "_from", F.when(F.col("_s1") > F.col("_at"), F.col("_s1")).otherwise(F.col("_far")).alias("_next")))

    reached = _double(cuts.select("_item", "_at", "_next"))
    by = cuts.select(F.col("_item").alias("_i"), F.col("_at").alias("_a"), "_from", F.col("_next").alias("_to"))
    pieces = reached.join(by, null_safe(["_item", "_at"], ["_i", "_a"])).select("_item", F.col("_order").alias("_piece"), "_from", "_to")
    return pieces, own


def units(df: DataFrame, item: str, unit: str, text: str) -> DataFrame:
    """Rows as ``cut`` takes them: null text as empty, a null unit first."""
    return df.select(F.col(item).alias("_item"), F.coalesce(F.col(unit).cast("bigint"), F.lit(0)).alias("_unit"), F.coalesce(F.col(text), F.lit("")).alias("_text"))


def oversized(rows: DataFrame, item: str, **limits: int) -> DataFrame:
    """Items of more than one piece."""
    pieces, _ = cut(rows, **limits)
    return pieces.where("_piece = 1").select(F.col("_item").alias(item))


def pieces(rows: DataFrame, item: str, max_words: int = MAX_WORDS, max_chars: int = MAX_CHARS, overlap_words: int = OVERLAP_WORDS) -> DataFrame:
    """Every item as ordered pieces: item, ``piece`` (from 0), n_words, n_chars, text.

    ``rows`` as of ``units``: the sentences of each item in order of ``_unit`` (distinct within an item), sizes summed without anything
    between them. Items within the limits, empty ones too, are one piece. Pieces end at the last sentence end the limits
    allow, inside a sentence only if it alone exceeds them (then at a word, inside a word only if that alone does). The
    next piece begins with the last sentence, or inside a sentence the last ``overlap_words`` words, of the earlier one,
    if the limits leave room for what follows. In ``text`` sentences are joined by a space.
    """
    cuts, own = cut(rows, max_words, max_chars, overlap_words)
    parts = cuts.withColumn("_b", F.explode(F.sequence("_from", F.col("_to") - 1)))
    atoms_ = own.select(F.col("_item").alias("_i"), F.col("_b").alias("_a"), "_atom", "_w", "_c", "_sep")
    parts = parts.join(atoms_, null_safe(["_item", "_b"], ["_i", "_a"]))
    big = parts.groupBy("_item", "_piece").agg(F.sum("_w").alias("n_words"), F.sum("_c").alias("n_chars"), F.array_sort(F.collect_list(F.struct("_b", F.concat("_atom", "_sep").alias("t")))).alias("_t"))
    text = lambda c: F.trim(F.array_join(F.transform(c, lambda x: x["t"]), ""))
    big = big.select("_item", "_piece", "n_words", "n_chars", text("_t").alias("text"))
    split = cuts.where("_piece = 0").select(F.col("_item").alias("_i"))
    small = rows.join(split, F.col("_item").eqNullSafe(F.col("_i")), "left_anti").groupBy("_item").agg(F.sum(words_of(F.col("_text"))).alias("n_words"), F.sum(F.length("_text")).alias("n_chars"), F.array_sort(F.collect_list(F.struct("_unit", F.concat("_text", F.lit(" ")).alias("t")))).alias("_t"))
    small = small.select("_item", F.lit(0).cast("bigint").alias("_piece"), "n_words", "n_chars", text("_t").alias("text"))
    return big.unionByName(small).select(F.col("_item").alias(item), F.col("_piece").alias("piece"), F.col("n_words").cast("bigint"), F.col("n_chars").cast("bigint"), "text")


def _window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = current_rows(table(spark, sf_dir, "windows").select("window_id", "sent_ids", "text", "loaded_at"), ["window_id"])
    named = windows.where("sent_ids is not null").select("window_id", F.explode_outer(F.array_distinct("sent_ids")).alias("sent_id"))
    rows = current_rows(table(spark, sf_dir, "sentences").select("sent_id", "idx", "text", "loaded_at"), ["sent_id"]).drop("loaded_at")
    named = named.join(rows, "sent_id", "left").withColumn("_k", F.row_number().over(Window.partitionBy("window_id").orderBy("idx", "sent_id")))
    alone = windows.where("sent_ids is null").select("window_id", F.lit(1).alias("_k"), "text")
    return units(named.select("window_id", "_k", "text").unionByName(alone), "window_id", "_k", "text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oversized(settle(_window_rows(spark, sf_dir)), "window_id")


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(settle(_window_rows(spark, sf_dir)), "window_id")


_FOUND = r"""
WITH w AS (SELECT window_id, sent_ids, text FROM windows QUALIFY row_number() OVER (PARTITION BY window_id ORDER BY loaded_at DESC) = 1),
s AS (SELECT sent_id, coalesce(text, '') AS text FROM sentences QUALIFY row_number() OVER (PARTITION BY sent_id ORDER BY loaded_at DESC) = 1),
named AS (SELECT window_id, unnest(list_distinct(sent_ids)) AS sent_id FROM w WHERE sent_ids IS NOT NULL),
rows_ AS (SELECT window_id, s.text FROM named JOIN s USING (sent_id) UNION ALL SELECT window_id, coalesce(text, '') FROM w WHERE sent_ids IS NULL)
SELECT window_id FROM rows_ GROUP BY window_id
HAVING sum(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))) > 60 OR sum(length(text)) > 400
"""

QUERIES = {"p1_found": p1_found, "p1_pieces": p1_pieces}
SQL = {"p1_found": _FOUND}
