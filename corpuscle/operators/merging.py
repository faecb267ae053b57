"""Sentences whose boundary is open are merged with what follows, left to right, the merged text judged anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.boundary import MERGE_BELOW, closed_sql, digest_sql, signal_sql
from corpuscle.operators.sequence import once, running_sum

#: Sentences (by order), or chains, of a block; decisions noted in a line.
BLOCK, LINE = 4_096, 1_024


def signals(df: DataFrame, text: str = "text", following: str = "next_text") -> DataFrame:
    """``df`` with ``signal``."""
    return df.withColumn("signal", F.expr(signal_sql(f"coalesce({text}, '')", following, spark=True)))


def merge_open(df: DataFrame, by: str, order: str, text: str, confidence: str | None = None) -> DataFrame:
    """by, ``idx`` (from 0), ``first``, ``last`` (by ``order``), ``text``: sentences merged over their open boundaries.

    A boundary that is undetermined before anything is merged merges where its ``confidence`` (of the boundary behind the row) is below
    the limit; null doesn't merge, and a boundary that only becomes undetermined by merging has none. Null texts are empty. Rows follow each
    other by ``order`` (an integer, null first), a null entity is an entity.

    Behind a row that ends with a closing mark the boundary is complete whatever was merged before, so entities are cut there
    into chains, and only chains are folded. The fold's state is a digest of the merged text of bounded size, not the text; its decisions
    are noted as characters in lines of LINE, so a chain of any length costs little more than linear work.
    """
    conf = F.col(confidence).cast("double") if confidence else F.lit(None).cast("double")
    t = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(by).alias("_by"), F.col(order).cast("bigint").alias("_o"), t.alias("_t"), conf.alias("_c"), F.coalesce(F.floor(F.col(order) / BLOCK), F.lit(-1)).cast("bigint").alias("_block"))
    closed = F.expr(closed_sql("_t")).cast("bigint")
    rows = running_sum(rows, ["_by"], "_block", ["_o", "_t"], closed, "_n")
    item = F.struct(F.col("_o").alias("o"), F.col("_t").alias("t"), F.col("_c").alias("c"))
    chains = rows.groupBy("_by", (F.col("_n") - closed).alias("_chain")).agg(F.array_sort(F.collect_list(item)).alias("xs"))
    merge = signal_sql("acc.t", "x.t", spark=True)
    undetermined = f"""IF(x.c IS NULL, CAST(NULL AS DOUBLE), IF(({signal_sql('x.t', 'xs[i + 1].t', spark=True)}) = 'undetermined', x.c, CAST(NULL AS DOUBLE)))"""
    named = f"transform(xs, (x, i) -> named_struct('t', {digest_sql('x.t')}, 'c', {undetermined}))" if confidence else f"transform(xs, x -> named_struct('t', {digest_sql('x.t')}, 'c', x.c))"
    decide = f"transform(array({merge}), s -> s = 'open' OR (s = 'undetermined' AND coalesce(acc.c < {MERGE_BELOW}, false)))[0]"
    noted = f"IF(length(acc.line) >= {LINE}, named_struct('line', m.k, 'lines', array_append(acc.lines, acc.line)), named_struct('line', concat(acc.line, m.k), 'lines', acc.lines))"
    step = f"""transform(array(named_struct('go', {decide})), d -> transform(array(named_struct('k', IF(d.go, '1', '0'))), m -> transform(array({noted}), n ->
      named_struct('t', IF(d.go, transform(array(concat(acc.t, ' ', x.t)), w -> {digest_sql('w')})[0], x.t), 'c', x.c, 'line', n.line, 'lines', n.lines))[0])[0])[0]"""
    fold = f"""aggregate(slice(ys, 2, size(ys)), named_struct('t', ys[0].t, 'c', ys[0].c, 'line', '', 'lines', cast(array() as array<string>)), (acc, x) -> {step},
      acc -> concat(array_join(acc.lines, ''), acc.line))"""
    folded = once(once(chains, ys=F.expr(named)), flags=F.when(F.size("xs") == 1, F.lit("")).otherwise(F.expr(fold))).drop("ys")
    begins = "concat(array(0), filter(sequence(1, size(xs)), i -> get(marks, i - 1) = '0'), array(size(xs)))"
    parts = "transform(sequence(0, size(cuts) - 2), k -> slice(xs, cuts[k] + 1, cuts[k + 1] - cuts[k]))"
    pieces = once(once(once(folded, marks=F.split("flags", "")).drop("flags"), cuts=F.expr(begins)).drop("marks"), parts=F.expr(parts)).drop("xs", "cuts")
    pieces = running_sum(pieces.withColumn("_block", F.floor(F.col("_chain") / BLOCK)), ["_by"], "_block", ["_chain"], F.size("parts").cast("bigint"), "_upto")
    out = pieces.select("_by", (F.col("_upto") - F.size("parts")).alias("_base"), F.posexplode("parts").alias("_k", "_x"))
    joined = F.array_join(F.transform("_x", lambda x: x["t"]), " ")
    return out.select(F.col("_by").alias(by), (F.col("_base") + F.col("_k")).cast("bigint").alias("idx"), F.get("_x", F.lit(0))["o"].alias("first"), F.element_at("_x", -1)["o"].alias("last"), joined.alias("text"))
