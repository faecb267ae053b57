"""Sentences grouped into annotation windows, and the gates over windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions.text import numbered_id, position, word_count
from corpuscle.operators.sequence import null_safe, once, states_before

WORDS, SENTENCES, LEAST, CEILING = 35, 4, 2, 60
RATE, TOLERANCE, SINGLE_LIMIT = 4.86, 0.40, 0.15
#: Sentences (by order) of a block.
BLOCK = 1_024


def window_numbers(df: DataFrame, by: list[str], order: str, words: str, keep: list[str] | None = None, most: int = WORDS, sentences: int = SENTENCES, least: int = LEAST, ceiling: int = CEILING) -> DataFrame:
    """by, order, ``keep``, ``win`` (from 0): the window of every sentence.

    A window closes before the next sentence if it has ``sentences``; if it is one sentence of over ``most`` words; or if the next
    would take it over ``most`` and it has ``least`` sentences already or would go over ``ceiling``. Null words are 0; rows follow each
    other by ``order`` (an integer, null first), then by ``keep``. Null entities form one entity.

    The open window before a sentence is its sentences and words, a bounded number of states, so a block of BLOCK sentences is a function from
    the state before it to the state behind it; these functions are composed by a prefix scan. Inside a block the windows that begin at each
    place are sized once and followed from the first places only. Only bounded blocks are ever gathered; the work is linear in the sentences.
    """
    keep = keep or []
    block = F.coalesce(F.floor(F.col(order) / BLOCK), F.lit(-1)).cast("bigint")
    rows = df.select(*by, F.struct(F.col(order), *keep, F.coalesce(F.col(words), F.lit(0)).cast("int").alias("_w")).alias("_r"), block.alias("_block"))
    packed = rows.groupBy(*by, "_block").agg(F.array_sort(F.collect_list("_r")).alias("_x"))
    # States: 0 is full (or nothing yet), else 1 + (sentences - 1) * wide + words.
    wide = (most if least <= 2 else ceiling) + 1
    shut = f"(a.n >= {sentences} OR ((a.n = 1 OR a.n >= {least}) AND a.w > {most}) OR a.w > {ceiling})"
    closes = f"({shut} OR (a.w + x > {most} AND (a.n >= {least} OR a.w + x > {ceiling})))"
    grow = f"(a, x) -> IF(a.open AND (a.n = 0 OR NOT {closes}), named_struct('n', a.n + 1, 'w', a.w + x, 'k', a.k + 1, 'open', true), named_struct('n', a.n, 'w', a.w, 'k', a.k, 'open', false))"
    code = f"CAST(IF({shut}, 0, 1 + (a.n - 1) * {wide} + a.w) AS INT)"
    # The window that begins at place i: how many of the block's sentences it holds, and the state if it reaches the block's end.
    own = f"transform(sequence(0, size(_ws) - 1), i -> aggregate(slice(_ws, i + 1, {sentences}), named_struct('n', 0, 'w', 0, 'k', 0, 'open', true), {grow}, a -> named_struct('k', a.k, 'code', {code})))"
    # Sentences at the block's beginning that still go to the window of each state, and the state if that is all of them.
    held = f"named_struct('n', IF(s = 0, {sentences}, CAST(1 + (s - 1) div {wide} AS INT)), 'w', IF(s = 0, 0, (s - 1) % {wide}), 'k', 0, 'open', true)"
    into = f"transform(sequence(0, {(sentences - 1) * wide}), s -> aggregate(slice(_ws, 1, {sentences - 1}), {held}, {grow}, a -> named_struct('k', a.k, 'code', IF(s = 0, 0, {code}))))"
    orbit = F.transform(F.sequence(F.lit(0), F.lit(sentences - 1)), lambda e: F.struct(e.alias("at"), F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("code")))

    def walk(acc, size):
        moved = F.transform(acc["e"], lambda e: F.when(e["at"] == acc["i"], F.struct((e["at"] + size["k"]).alias("at"), (e["n"] + 1).alias("n"), size["code"].alias("code"))).otherwise(e))
        return F.struct((acc["i"] + 1).alias("i"), moved.alias("e"))

    sized = once(once(packed.select(*by, "_block", "_x"), _ws=F.transform("_x", lambda x: x["_w"])).drop("_x"), _own=F.expr(own), _into=F.expr(into))
    ends = once(sized, _e=F.aggregate("_own", F.struct(F.lit(0).alias("i"), orbit.alias("e")), walk)["e"])
    past = lambda s: s["k"] >= F.size("_ws")
    step = F.transform("_into", lambda s: F.when(past(s), s["code"]).otherwise(F.get("_e", s["k"])["code"]))
    gain = F.transform("_into", lambda s: F.when(past(s), F.lit(0).cast("bigint")).otherwise(F.get("_e", s["k"])["n"]))
    states = states_before(ends.select(*by, "_block", step.alias("_step"), gain.alias("_gain")), by, "_block", "_step", "_gain", 0, ("_in", "_base"))
    names = [f"_k{i}" for i in range(len(by) + 1)]
    states = states.select(*[F.col(k).alias(n) for k, n in zip([*by, "_block"], names)], "_in", "_base")

    whole = packed.join(states, null_safe([*by, "_block"], names)).drop(*names)
    whole = once(once(whole, _ws=F.transform("_x", lambda x: x["_w"])), _own=F.expr(own))
    head = f"aggregate(slice(_ws, 1, {sentences - 1}), {held.replace('s = 0', '_in = 0').replace('(s - 1)', '(_in - 1)')}, {grow}, a -> a.k)"
    first = F.struct(F.lit(0).alias("i"), F.expr(head).alias("at"), F.array().cast("array<int>").alias("starts"))
    hop = lambda acc, size: F.when(acc["at"] == acc["i"], F.struct((acc["i"] + 1).alias("i"), (acc["at"] + size["k"]).alias("at"), F.array_append(acc["starts"], acc["i"]).alias("starts"))).otherwise(F.struct((acc["i"] + 1).alias("i"), acc["at"], acc["starts"]))
    whole = once(whole, _starts=F.aggregate("_own", first, hop)["starts"])
    # What lies before the first start belongs to the last window of the blocks before.
    whole, cuts = once(whole, _cuts=F.concat(F.array(F.lit(0)), F.col("_starts"), F.array(F.size("_x")))), F.col("_cuts")
    part = F.transform(F.sequence(F.lit(0), F.size("_starts")), lambda k: F.struct((F.col("_base") + k - 1).alias("win"), F.slice("_x", F.get(cuts, k) + 1, F.get(cuts, k + 1) - F.get(cuts, k)).alias("x")))
    wins = whole.select(*by, F.explode(part).alias("_p"))
    return wins.select(*by, F.col("_p.win").cast("bigint").alias("win"), F.explode("_p.x").alias("_r")).select(*by, f"_r.{order}", *[f"_r.{c}" for c in keep], "win")


def window_records(df: DataFrame, duration: str | None = None) -> DataFrame:
    """Windows of sentences (video_id, idx, sent_id, start_s, end_s, text, n_words, win[, duration])."""
    part = F.struct("idx", "sent_id", "text")
    out = df.groupBy("video_id", "win").agg(
        F.array_sort(F.collect_list(part)).alias("_x"), F.min_by("start_s", "idx").alias("start_s"), F.max_by("end_s", "idx").alias("end_s"), F.count("*").alias("n_sentences"), *([F.max(duration).alias("_d")] if duration else [])
    )
    out = out.withColumn("text", F.array_join(F.transform("_x", lambda x: x["text"]), " "))
    pos = position(F.col("start_s"), F.col("_d")) if duration else F.lit(None).cast("double")
    return out.select(numbered_id(F.col("video_id"), "j", F.col("win")).alias("window_id"), "video_id", F.col("win").alias("idx"), F.transform("_x", lambda x: x["sent_id"]).alias("sent_ids"), "start_s", "end_s", "text", word_count("text").alias("n_words"), "n_sentences", pos.alias("pos_pct"))


def band(duration_s, rate: float = RATE, tolerance: float = TOLERANCE):
    """(least, most) windows of a video of this duration."""
    mid = duration_s / F.lit(60.0) * F.lit(rate)
    return F.ceil(mid * F.lit(1 - tolerance)).cast("bigint"), F.floor(mid * F.lit(1 + tolerance)).cast("bigint")
