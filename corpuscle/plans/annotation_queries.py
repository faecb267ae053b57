"""Queries over annotations: validation, agreement, votes, blocks and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.ontology import VALUES, long_labels, normal, vocabulary
from corpuscle.operators.agreement import alpha, confusion, majority, mutual_information, occurrence
from corpuscle.operators.fusion import absorbed, pairs, runs, smooth, thirds
from corpuscle.plans.sentence_queries import CUR_W
from corpuscle.sources.tables import current_rows, table

FIELDS = ["function", "loop", "evidence_type", "scale", "density"]
_CUR_A = 'ca AS (SELECT * FROM annotations QUALIFY row_number() OVER (PARTITION BY "round", coder, window_id ORDER BY annotated_at DESC) = 1)'
_N = lambda f: f"lower(regexp_replace(CAST({f} AS VARCHAR), '^\\s+|\\s+$', '', 'g'))"
_IN = lambda f: "(" + ", ".join(f"'{v}'" for v in VALUES[f]) + ")"
_LONG = f"""{_CUR_A}, long AS (
""" + " UNION ALL ".join(f"SELECT \"round\", coder, window_id, video_id, '{f}' AS field, {_N(f)} AS label FROM ca WHERE {_N(f)} IN {_IN(f)}" + (f" AND {_N('function')} = 'evidence'" if f == "evidence_type" else "") for f in FIELDS) + ")"
_VOCAB = "voc(field, value) AS (VALUES " + ", ".join(f"('{f}', '{v}')" for f in FIELDS for v in VALUES[f]) + ")"


def _annotations(spark: SparkSession, d: str) -> DataFrame:
    return current_rows(table(spark, d, "annotations").select("round", "coder", "window_id", "video_id", *FIELDS, "annotated_at"), ["round", "coder", "window_id"], "annotated_at")


def _long(spark: SparkSession, d: str) -> DataFrame:
    return long_labels(_annotations(spark, d), ["round", "coder", "window_id", "video_id"], FIELDS)


def _rated(spark: SparkSession, d: str) -> DataFrame:
    """Coders of the two rounds are separate coders."""
    return _long(spark, d).withColumn("rater", F.concat_ws("/", "round", "coder"))


def _alpha(level: str, field: str | None):
    def q(spark: SparkSession, d: str) -> DataFrame:
        rows = _rated(spark, d)
        rows = rows.where(F.col("field") == field) if field else rows
        return alpha(rows, ["field"], "window_id", "rater", "label", level).withColumn("alpha", F.round("alpha", 6))

    return q


def alpha_gate(spark: SparkSession, d: str) -> DataFrame:
    """Required fields against 0.8; an undefined alpha fails; evidence_type is reported only."""
    a = _alpha("nominal", None)(spark, d).where("field <> 'density'").unionByName(_alpha("ordinal", "density")(spark, d))
    need = F.col("field") != "evidence_type"
    return a.select("field", "alpha", need.alias("required"), F.when(need, F.coalesce(F.col("alpha") >= 0.8, F.lit(False))).alias("passed"))


def vocabulary_violations(spark: SparkSession, d: str) -> DataFrame:
    """Labels outside the vocabulary, required labels missing, evidence_type without its condition or missing under it."""
    a = _annotations(spark, d)
    checks = []
    for f in FIELDS:
        v = normal(f)
        bad = F.when(v.isNull(), F.lit("missing") if f != "evidence_type" else F.lit(None)).when(~v.isin(VALUES[f]), F.lit("unknown value"))
        checks.append(F.struct(F.lit(f).alias("field"), bad.alias("problem")))
    evidence = F.coalesce(normal("function") == "evidence", F.lit(False))
    checks.append(F.struct(F.lit("evidence_type").alias("field"), F.when(evidence & F.col("evidence_type").isNull(), F.lit("condition without value")).when(~evidence & F.col("evidence_type").isNotNull(), F.lit("value without condition")).alias("problem")))
    return a.select("round", "coder", "window_id", F.explode(F.array(*checks)).alias("_c")).select("round", "coder", "window_id", "_c.field", "_c.problem").where("problem is not null")


def occurrence_zero_fill(spark: SparkSession, d: str) -> DataFrame:
    return occurrence(_long(spark, d), "field", "label", vocabulary(spark).select("field", F.col("value").alias("label")))


#: The coder that others are compared with.
LEAD = "an-lead"


def confusion_q(spark: SparkSession, d: str, lead_coder: str = LEAD) -> DataFrame:
    """Function labels of one coder against those of the others, by window of round 1."""
    rows = _long(spark, d).where("round = 'round1' and field = 'function'")
    lead = rows.where(F.col("coder") == lead_coder).select("window_id", F.col("label").alias("label_a"))
    rest = rows.where(F.col("coder") != lead_coder).select("window_id", F.col("label").alias("label_b"))
    return lead.join(rest, "window_id").groupBy("label_a", "label_b").agg(F.count("*").alias("n"))


def round_confusion(spark: SparkSession, d: str) -> DataFrame:
    """The consensus of round 1 and that of round 2 as two coders of the same window."""
    votes = majority(_long(spark, d).where("field = 'function'"), ["window_id", "round"], "label").where("consensus")
    return confusion(votes, "window_id", "round", "label", "round1", "round2")


def majority_vote(spark: SparkSession, d: str) -> DataFrame:
    return majority(_long(spark, d).where("round = 'round1'"), ["window_id", "field"], "label")


def mutual_information_q(spark: SparkSession, d: str) -> DataFrame:
    a = _annotations(spark, d).select(normal("function").alias("f"), normal("scale").alias("s"))
    return mutual_information(a.where(F.col("f").isin(VALUES["function"]) & F.col("s").isin(VALUES["scale"])), "f", "s")


def _sequence(spark: SparkSession, d: str, field: str = "function") -> DataFrame:
    """Windows in order with the commonest label of round 1 (the least by name of equals)."""
    votes = _long(spark, d).where(F.col("field") == field).where("round = 'round1'").groupBy("window_id", "label").agg(F.count("*").alias("n"))
    best = votes.groupBy("window_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "label"))["label"].alias("label"))
    w = current_rows(table(spark, d, "windows").select("window_id", "video_id", "idx", "loaded_at"), ["window_id"])
    return w.join(best, "window_id").select("video_id", "window_id", F.col("idx").cast("bigint").alias("idx"), "label")


_SEQ = lambda f: f"""{_LONG}, {CUR_W}, votes AS (SELECT window_id, label, count(*) AS n FROM long WHERE field = '{f}' AND "round" = 'round1' GROUP BY 1, 2),
best AS (SELECT window_id, label FROM votes QUALIFY row_number() OVER (PARTITION BY window_id ORDER BY n DESC, label) = 1),
seq AS (SELECT video_id, window_id, CAST(idx AS BIGINT) AS idx, label FROM cw JOIN best USING (window_id))"""  # noqa: E731
_RUNS = f"""{_SEQ('function')}, chg AS (SELECT *, CASE WHEN label IS DISTINCT FROM lag(label) OVER (PARTITION BY video_id ORDER BY idx) THEN 1 ELSE 0 END AS nw FROM seq),
num AS (SELECT *, sum(nw) OVER (PARTITION BY video_id ORDER BY idx) - 1 AS run FROM chg),
runs_ AS (SELECT video_id, CAST(run AS BIGINT) AS run, max(label) AS label, count(*) AS n, min(idx) AS "first", max(idx) AS "last" FROM num GROUP BY 1, 2),
abs_ AS (SELECT *, coalesce(n = 1 AND lag(label) OVER w = lead(label) OVER w AND lag(n) OVER w >= 2 AND lead(n) OVER w >= 2, false) AS absorbed, lag(label) OVER w AS pl FROM runs_ WINDOW w AS (PARTITION BY video_id ORDER BY run)),
sm AS (SELECT *, CASE WHEN absorbed THEN pl ELSE label END AS l2 FROM abs_),
smc AS (SELECT *, CASE WHEN l2 IS DISTINCT FROM lag(l2) OVER (PARTITION BY video_id ORDER BY run) THEN 1 ELSE 0 END AS nw FROM sm),
smn AS (SELECT *, sum(nw) OVER (PARTITION BY video_id ORDER BY run) - 1 AS block FROM smc)"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return runs(_sequence(spark, d), "video_id", "idx", "label")


def blocks(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d)


def smoothed_blocks(spark: SparkSession, d: str) -> DataFrame:
    return smooth(_runs(spark, d), "video_id")


def smoothing_rate(spark: SparkSession, d: str) -> DataFrame:
    a = absorbed(_runs(spark, d), "video_id").agg(F.count_if("absorbed").alias("absorbed"), F.count_if(F.col("n") == 1).alias("single"))
    rate = F.when(F.col("single") > 0, F.col("absorbed") / F.col("single")).otherwise(F.lit(0.0))
    return a.select("absorbed", "single", F.round(rate, 6).alias("rate"), (rate <= 0.15).alias("passed"))


def _shares(spark: SparkSession, d: str) -> DataFrame:
    s = _sequence(spark, d)
    total = s.groupBy("video_id").agg(F.count("*").alias("t"))
    grid = total.crossJoin(F.broadcast(vocabulary(spark).where("field = 'function'").select(F.col("value").alias("function"))))
    n = s.groupBy("video_id", F.col("label").alias("function")).agg(F.count("*").alias("n"))
    return grid.join(n, ["video_id", "function"], "left").select("video_id", "function", (F.coalesce("n", F.lit(0)) / F.col("t")).alias("share"))


def share_bands(spark: SparkSession, d: str) -> DataFrame:
    """20th and 80th percentile over videos of each function's share; videos without it count as 0."""
    # Shares are counted first, so that a function's group holds its distinct shares, not its videos.
    n = _shares(spark, d).groupBy("function", "share").agg(F.count("*").alias("n"))
    b = n.groupBy("function").agg(F.percentile("share", F.array(F.lit(0.2), F.lit(0.8)), F.col("n")).alias("_p"))
    return b.select("function", F.round(F.col("_p")[0], 6).alias("p20"), F.round(F.col("_p")[1], 6).alias("p80"))


def thirds_distribution(spark: SparkSession, d: str) -> DataFrame:
    return thirds(_sequence(spark, d, "scale"), "video_id", "idx").groupBy("third", "label").agg(F.count("*").alias("n"))


def trigrams(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("video_id").orderBy("run")
    t = _runs(spark, d).select("label", F.lead("label").over(w).alias("second"), F.lead("label", 2).over(w).alias("third"))
    return t.where("third is not null").groupBy(F.col("label").alias("first"), "second", "third").agg(F.count("*").alias("n"))


def first_position(spark: SparkSession, d: str) -> DataFrame:
    w = current_rows(table(spark, d, "windows").select("window_id", "pos_pct", "loaded_at"), ["window_id"])
    s = _sequence(spark, d).join(w.select("window_id", "pos_pct"), "window_id")
    f = s.groupBy("video_id", "label").agg(F.min_by(F.struct("pos_pct"), "idx")["pos_pct"].alias("pos_pct"), F.min("idx").alias("idx"))
    return f.select("video_id", "label", "idx", F.round("pos_pct", 6).alias("pos_pct"))


def loop_pairs(spark: SparkSession, d: str) -> DataFrame:
    return pairs(_sequence(spark, d, "loop"), "video_id", "idx", "label", "opens", "closes")


def script_verifier(spark: SparkSession, d: str) -> DataFrame:
    """Each video against the share bands: criteria met and the verdict at nine tenths."""
    got = _shares(spark, d).join(F.broadcast(share_bands(spark, d)), "function")
    ok = F.round("share", 6).between(F.col("p20"), F.col("p80"))
    v = got.groupBy("video_id").agg(F.count_if(ok).alias("met"), F.count("*").alias("criteria"))
    return v.withColumn("passed", F.col("met") >= 0.9 * F.col("criteria"))


def id_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Windows on one side only: annotated but unknown, known but never annotated."""
    a = table(spark, d, "annotations").select("window_id").where("window_id is not null").distinct()
    w = table(spark, d, "windows").select("window_id").where("window_id is not null").distinct()
    return a.join(w, "window_id", "left_anti").select("window_id", F.lit("unknown window").alias("problem")).unionByName(w.join(a, "window_id", "left_anti").select("window_id", F.lit("not annotated").alias("problem")))


QUERIES = {
    "alpha_nominal": _alpha("nominal", None), "alpha_ordinal": _alpha("ordinal", "density"), "alpha_interval": _alpha("interval", "density"), "alpha_gate": alpha_gate, "vocabulary_violations": vocabulary_violations, "occurrence_zero_fill": occurrence_zero_fill,
    "confusion": confusion_q, "round_confusion": round_confusion, "majority_vote": majority_vote, "mutual_information": mutual_information_q, "blocks": blocks, "smoothed_blocks": smoothed_blocks, "smoothing_rate": smoothing_rate, "share_bands": share_bands,
    "thirds_distribution": thirds_distribution, "trigrams": trigrams, "first_position": first_position, "loop_pairs": loop_pairs, "script_verifier": script_verifier, "id_mismatch": id_mismatch,
}


def _alpha_sql(level: str, where: str = "true") -> str:
    score = {"nominal": "NULL", "ordinal": "sum(n) OVER (PARTITION BY field ORDER BY label) - n / 2.0::DOUBLE", "interval": "CAST(label AS DOUBLE)"}[level]
    delta = "CASE WHEN a.label = b.label THEN 0::DOUBLE ELSE 1::DOUBLE END" if level == "nominal" else "(ma.s - mb.s) * (ma.s - mb.s)"
    return f"""r AS (SELECT DISTINCT field, window_id, "round" || '/' || coder AS rater, label FROM long WHERE {where}),
      e AS (SELECT *, count(*) OVER (PARTITION BY field, window_id) AS m FROM r QUALIFY m >= 2),
      mg0 AS (SELECT field, label, CAST(count(*) AS DOUBLE) AS n FROM e GROUP BY 1, 2), mg AS (SELECT *, {score} AS s FROM mg0),
      ob AS (SELECT a.field, sum({delta} / (a.m - 1)) AS o FROM e a JOIN e b ON a.field = b.field AND a.window_id = b.window_id AND a.rater <> b.rater
        JOIN mg ma ON ma.field = a.field AND ma.label = a.label JOIN mg mb ON mb.field = b.field AND mb.label = b.label GROUP BY 1),
      ex AS (SELECT a.field, sum(a.n * b.n * {delta.replace('ma.s', 'a.s').replace('mb.s', 'b.s')}) AS x FROM mg a JOIN mg b ON a.field = b.field GROUP BY 1),
      tt AS (SELECT field, CAST(count(*) AS DOUBLE) AS t, count(DISTINCT window_id) AS n_units, count(DISTINCT label) AS k FROM e GROUP BY 1),
      al AS (SELECT field, CASE WHEN k >= 2 THEN round(1 - (o / t) / (x / (t * (t - 1))), 6) END AS alpha, n_units, CAST(t AS BIGINT) AS n_ratings FROM tt JOIN ob USING (field) JOIN ex USING (field))"""


_SHARE_SQL = f"""{_SEQ('function')}, {_VOCAB}, tot AS (SELECT video_id, count(*) AS t FROM seq GROUP BY 1), cnt AS (SELECT video_id, label, count(*) AS n FROM seq GROUP BY 1, 2),
sh AS (SELECT tot.video_id, voc.value AS function, coalesce(n, 0) / t AS share FROM tot CROSS JOIN voc LEFT JOIN cnt ON cnt.video_id = tot.video_id AND cnt.label = voc.value WHERE voc.field = 'function'),
bands AS (SELECT function, round(quantile_cont(share, 0.2), 6) AS p20, round(quantile_cont(share, 0.8), 6) AS p80 FROM sh GROUP BY 1)"""

SQL = {
    "alpha_nominal": f"WITH {_LONG}, {_alpha_sql('nominal')} SELECT * FROM al",
    "alpha_ordinal": f"""WITH {_LONG}, {_alpha_sql('ordinal', "field = 'density'")} SELECT * FROM al""",
    "alpha_interval": f"""WITH {_LONG}, {_alpha_sql('interval', "field = 'density'")} SELECT * FROM al""",
    "alpha_gate": f"""WITH {_LONG}, {_alpha_sql('nominal', "field <> 'density'")} SELECT field, alpha, field <> 'evidence_type' AS required, CASE WHEN field <> 'evidence_type' THEN coalesce(alpha >= 0.8, false) END AS passed FROM al
      UNION ALL (WITH {_alpha_sql('ordinal', "field = 'density'")} SELECT field, alpha, true, coalesce(alpha >= 0.8, false) FROM al)""",
    "vocabulary_violations": f"WITH {_CUR_A} " + " UNION ALL ".join(
        [f"SELECT \"round\", coder, window_id, '{f}' AS field, CASE WHEN {f} IS NULL THEN 'missing' ELSE 'unknown value' END AS problem FROM ca WHERE " + (f"{f} IS NULL OR " if f != "evidence_type" else "") + f"{_N(f)} NOT IN {_IN(f)}" for f in FIELDS]
        + [f"SELECT \"round\", coder, window_id, 'evidence_type', 'condition without value' FROM ca WHERE {_N('function')} = 'evidence' AND evidence_type IS NULL", f"SELECT \"round\", coder, window_id, 'evidence_type', 'value without condition' FROM ca WHERE coalesce({_N('function')}, '') <> 'evidence' AND evidence_type IS NOT NULL"]
    ),
    "occurrence_zero_fill": f"WITH {_LONG}, {_VOCAB} SELECT voc.field, voc.value AS label, count(long.label) AS n FROM voc LEFT JOIN long ON long.field = voc.field AND long.label = voc.value GROUP BY 1, 2",
    "confusion": f"""WITH {_LONG}, x AS (SELECT * FROM long WHERE "round" = 'round1' AND field = 'function') SELECT a.label AS label_a, b.label AS label_b, count(*) AS n FROM x a JOIN x b USING (window_id) WHERE a.coder = '{LEAD}' AND b.coder <> '{LEAD}' GROUP BY 1, 2""",
    "round_confusion": f"""WITH {_LONG}, c AS (SELECT window_id, "round", label, count(*) AS n FROM long WHERE field = 'function' GROUP BY 1, 2, 3), x AS (SELECT * FROM c QUALIFY n * 2 > sum(n) OVER (PARTITION BY window_id, "round"))
      SELECT a.label AS label_a, b.label AS label_b, count(*) AS n FROM x a JOIN x b USING (window_id) WHERE a."round" = 'round1' AND b."round" = 'round2' GROUP BY 1, 2""",
    "majority_vote": f"""WITH {_LONG}, c AS (SELECT window_id, field, label, count(*) AS n FROM long WHERE "round" = 'round1' GROUP BY 1, 2, 3), t AS (SELECT *, CAST(sum(n) OVER (PARTITION BY window_id, field) AS BIGINT) AS n_ratings FROM c QUALIFY row_number() OVER (PARTITION BY window_id, field ORDER BY n DESC, label DESC) = 1)
      SELECT window_id, field, CASE WHEN n * 2 > n_ratings THEN label END AS label, n AS votes, n_ratings, n * 2 > n_ratings AS consensus FROM t""",
    "mutual_information": f"""WITH {_CUR_A}, x AS (SELECT {_N('function')} AS f, {_N('scale')} AS s FROM ca), y AS (SELECT f, s, CAST(count(*) AS DOUBLE) AS n FROM x WHERE f IN {_IN('function')} AND s IN {_IN('scale')} GROUP BY 1, 2),
      z AS (SELECT *, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY f) AS nf, sum(n) OVER (PARTITION BY s) AS ns FROM y)
      SELECT round(sum(n / t * log2(n * t / (nf * ns))), 6) AS mi_bits, round(-sum(n / t * log2(nf / t)), 6) AS entropy_a, round(-sum(n / t * log2(ns / t)), 6) AS entropy_b FROM z""",
    "blocks": f"WITH {_RUNS} SELECT * FROM runs_",
    "smoothed_blocks": f'WITH {_RUNS} SELECT video_id, CAST(block AS BIGINT) AS block, max(l2) AS label, CAST(sum(n) AS BIGINT) AS n, min("first") AS "first", max("last") AS "last", count(*) FILTER (absorbed) AS n_absorbed FROM smn GROUP BY 1, 2',
    "smoothing_rate": f"WITH {_RUNS}, c AS (SELECT count(*) FILTER (absorbed) AS absorbed, count(*) FILTER (n = 1) AS single FROM abs_) SELECT absorbed, single, round(CASE WHEN single > 0 THEN absorbed / single ELSE 0 END, 6) AS rate, coalesce(absorbed / nullif(single, 0), 0) <= 0.15 AS passed FROM c",
    "share_bands": f"WITH {_SHARE_SQL} SELECT * FROM bands",
    "thirds_distribution": f"WITH {_SEQ('scale')}, t AS (SELECT label, row_number() OVER (PARTITION BY video_id ORDER BY idx) - 1 AS k, count(*) OVER (PARTITION BY video_id) AS n FROM seq) SELECT CASE WHEN k < n // 3 THEN 1 WHEN k < 2 * n // 3 THEN 2 ELSE 3 END AS third, label, count(*) AS n FROM t GROUP BY 1, 2",
    "trigrams": f'WITH {_RUNS}, t AS (SELECT label AS "first", lead(label) OVER w AS "second", lead(label, 2) OVER w AS "third" FROM runs_ WINDOW w AS (PARTITION BY video_id ORDER BY run)) SELECT *, count(*) AS n FROM t WHERE "third" IS NOT NULL GROUP BY ALL',
    "first_position": f"WITH {_SEQ('function')} SELECT seq.video_id, label, seq.idx, round(pos_pct, 6) AS pos_pct FROM seq JOIN cw USING (window_id) QUALIFY row_number() OVER (PARTITION BY seq.video_id, label ORDER BY seq.idx) = 1",
    "loop_pairs": f"WITH {_SEQ('loop')}, o AS (SELECT video_id, label, idx, row_number() OVER (PARTITION BY video_id, label ORDER BY idx) AS k FROM seq) SELECT a.video_id, a.k, a.idx AS opened, b.idx AS closed FROM o a JOIN o b ON a.video_id = b.video_id AND a.k = b.k WHERE a.label = 'opens' AND b.label = 'closes' AND b.idx > a.idx",
    "script_verifier": f"WITH {_SHARE_SQL} SELECT video_id, count(*) FILTER (round(share, 6) BETWEEN p20 AND p80) AS met, count(*) AS criteria, met >= 0.9 * criteria AS passed FROM sh JOIN bands USING (function) GROUP BY 1",
    "id_mismatch": "SELECT DISTINCT window_id, 'unknown window' AS problem FROM annotations WHERE window_id IS NOT NULL AND window_id NOT IN (SELECT window_id FROM windows) UNION ALL SELECT DISTINCT window_id, 'not annotated' FROM windows WHERE window_id NOT IN (SELECT window_id FROM annotations WHERE window_id IS NOT NULL)",
}
