"""Queries over sentences, labels and samples: cleaned sentences, agreement by group, confused pairs, coverage, sequences, gold samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.functions.text import CTA_PHRASES, contains_any, numbered_id, word_count
from corpuscle.ontology import VALUES, normal
from corpuscle.operators.agreement import alpha, confused_pairs, majority
from corpuscle.operators.fusion import pairs
from corpuscle.operators.gates import inconsistent, registry
from corpuscle.operators.sampling import anchored_positions
from corpuscle.operators.segments import cut_sentences
from corpuscle.operators.sequence import running_sum
from corpuscle.plans.annotation_queries import _CUR_A, _IN, _LONG, _N, _RUNS, _SEQ, _alpha_sql, _annotations, _long, _rated, _runs, _sequence
from corpuscle.plans.corpus_queries import _GATES, _RATIO, _SEG, SEED, _ratio
from corpuscle.plans.sentence_queries import CUR_W, TOKENS, _videos
from corpuscle.sources.tables import current_rows, table

#: Coverage misses allowed of so many windows; videos of a gold sample.
MISSES, MISSES_OF, GOLD = 20, 205, 5


def sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of the cleaned segments with ids, cut at closing marks before white space, numbered over the video's segments."""
    g = current_rows(table(spark, d, "segments").select("video_id", "seg_idx", "texto", "loaded_at"), ["video_id", "seg_idx"])
    cut = g.select("video_id", F.col("seg_idx").cast("bigint").alias("seg_idx"), cut_sentences(F.col("texto")).alias("_x"))
    numbered = running_sum(cut.withColumn("_block", F.floor(F.coalesce("seg_idx", F.lit(-1)) / 4096)), ["video_id"], "_block", ["seg_idx"], F.size("_x").cast("bigint"), "_upto")
    rows = numbered.select("video_id", (F.col("_upto") - F.size("_x")).alias("_base"), F.posexplode("_x").alias("_k", "text")).withColumn("idx", (F.col("_base") + F.col("_k")).cast("bigint"))
    return rows.select(numbered_id(F.col("video_id"), "s", F.col("idx")).alias("sent_id"), "video_id", "idx", "text", word_count("text").alias("n_words"))


def alpha_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Nominal alpha of each field within each round."""
    rows = _rated(spark, d).withColumn("group", F.concat_ws("/", "round", "field"))
    return alpha(rows, ["group"], "window_id", "rater", "label").withColumn("alpha", F.round("alpha", 6))


def round_agreement(spark: SparkSession, d: str) -> DataFrame:
    """The consensus of round 1 against every label of round 2, by field and window: confused label pairs with their share of the field's pairs."""
    first = majority(_long(spark, d).where("round = 'round1'"), ["window_id", "field"], "label").where("consensus").select("window_id", "field", F.col("label").alias("label_a"))
    second = _long(spark, d).where("round = 'round2'").select("window_id", "field", F.col("label").alias("label_b"))
    n = first.join(second, ["window_id", "field"]).groupBy("field", "label_a", "label_b").agg(F.count("*").alias("n"))
    return n.withColumn("rate", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("field")), 6))


def confused_labels(spark: SparkSession, d: str) -> DataFrame:
    """How often two coders of one window and round gave which two different labels, and that as a share of all their pairs."""
    return confused_pairs(_long(spark, d), ["field"], ["round", "window_id"], "label").withColumn("rate", F.round("rate", 6))


def coverage_gate(spark: SparkSession, d: str) -> DataFrame:
    """Round-1 annotations whose function is outside the vocabulary, against the misses allowed."""
    f = normal("function")
    n = _annotations(spark, d).where("round = 'round1'").agg(F.count_if(f.isNull() | ~f.isin(VALUES["function"])).alias("misses"), F.count("*").alias("total"))
    return n.select("misses", "total", (F.col("misses") * MISSES_OF <= F.col("total") * MISSES).alias("passed"))


def word_ratio_skip(spark: SparkSession, d: str) -> DataFrame:
    """Per channel, the least word ratio of profile videos with a duration; null where there is none."""
    known = (F.col("role") == "profile") & F.coalesce(F.col("duration") > 0, F.lit(False))
    r = _ratio(spark, d).join(_videos(spark, d).select(F.col("id").alias("_id"), "duration"), F.col("id") == F.col("_id"))
    return r.groupBy("channel").agg(F.min(F.when(known, F.col("ratio"))).alias("least_ratio"))


def typical_sequences(spark: SparkSession, d: str) -> DataFrame:
    """Sequences of blocks of whole videos and how many videos have them; the first by name of the commonest is typical."""
    s = _runs(spark, d).groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("run", "label"))).alias("_x"))
    return s.groupBy(F.array_join(F.transform("_x", lambda x: x["label"]), " ").alias("sequence")).agg(F.count("*").alias("n_videos"))


def loop_distance(spark: SparkSession, d: str) -> DataFrame:
    """Per video: opening and closing loops, pairs of them, and their mean distance in windows."""
    s = _sequence(spark, d, "loop")
    n = s.groupBy("video_id").agg(F.count_if(F.col("label") == "opens").alias("opens"), F.count_if(F.col("label") == "closes").alias("closes"))
    p = pairs(s, "video_id", "idx", "label", "opens", "closes").groupBy(F.col("video_id").alias("_v")).agg(F.count("*").alias("_n"), F.avg(F.col("closed") - F.col("opened")).alias("_d"))
    return n.join(p, F.col("video_id") == F.col("_v"), "left").select("video_id", "opens", "closes", F.coalesce("_n", F.lit(0)).cast("bigint").alias("pairs"), F.round("_d", 6).alias("mean_distance"))


def density_by_third(spark: SparkSession, d: str) -> DataFrame:
    """Mean density of the windows of each third of their video."""
    s = _sequence(spark, d, "density")
    n = s.groupBy(F.col("video_id").alias("_v")).agg(F.count("*").alias("_n"))
    k = s.withColumn("_block", F.floor(F.col("idx") / 4096))
    k = running_sum(k, ["video_id"], "_block", ["idx", "window_id"], F.lit(1).cast("bigint"), "_k").join(n, F.col("video_id") == F.col("_v")).withColumn("_k", F.col("_k") - 1)
    third = F.when(F.col("_k") < F.floor(F.col("_n") / 3), 1).when(F.col("_k") < F.floor(2 * F.col("_n") / 3), 2).otherwise(3)
    return k.groupBy(third.alias("third")).agg(F.round(F.avg(F.col("label").cast("double")), 6).alias("density"), F.count("*").alias("n"))


def source_contrast(spark: SparkSession, d: str) -> DataFrame:
    """Words, sentences and long windows of the spoken text by source of the video, one column each."""
    w = current_rows(table(spark, d, "windows").select("window_id", "video_id", "text", "loaded_at"), ["window_id"])
    v = _videos(spark, d).select("id", "source")
    n = w.join(v, F.col("video_id") == F.col("id")).select("source", word_count("text").alias("n"))
    return n.groupBy("source").agg(F.count("*").alias("windows"), F.sum("n").alias("words"), F.count_if(F.col("n") > 35).alias("long_windows"))


def gold_selection(spark: SparkSession, d: str) -> DataFrame:
    """Per channel, GOLD profile videos by Python's own draw, one with a call to action first, with their durations and the one to annotate again."""
    v = _videos(spark, d).where("role = 'profile'").select("channel", "id", "duration")
    w = current_rows(table(spark, d, "windows").select("window_id", "video_id", "text", "loaded_at"), ["window_id"])
    hit = w.where(contains_any(F.col("text"), CTA_PHRASES)).select(F.col("video_id").alias("_c")).distinct()
    pool = v.join(hit, F.col("id") == F.col("_c"), "left").withColumn("candidate", F.col("_c").isNotNull()).drop("_c")
    return anchored_positions(pool, "channel", "id", "candidate", GOLD, SEED).select("channel", "id", "rank", "again", "duration")


def registry_problems(spark: SparkSession, d: str) -> DataFrame:
    """Roles of gates without a channel and channels whose role no gate knows."""
    return inconsistent(registry(spark), table(spark, d, "channels").select("channel", "role"))


QUERIES = {
    "sentences": sentences, "alpha_by_group": alpha_by_group, "round_agreement": round_agreement, "confused_labels": confused_labels, "coverage_gate": coverage_gate, "word_ratio_skip": word_ratio_skip,
    "typical_sequences": typical_sequences, "loop_distance": loop_distance, "density_by_third": density_by_third, "source_contrast": source_contrast, "gold_selection": gold_selection, "registry_problems": registry_problems,
}

_GROUPED = _alpha_sql("nominal").replace("FROM long", "FROM (SELECT * REPLACE (\"round\" || '/' || field AS field) FROM long) long")

SQL = {
    "sentences": rf"""WITH {_SEG}, p AS (SELECT video_id, seg_idx, list_filter(list_transform(string_split(regexp_replace(coalesce(texto, ''), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS x FROM cg),
      e AS (SELECT video_id, seg_idx, unnest(x) AS text, generate_subscripts(x, 1) AS k FROM p), n AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seg_idx, k) - 1 AS idx FROM e)
      SELECT format('{{}}:s{{:04d}}', video_id, idx) AS sent_id, video_id, idx, text, {TOKENS.format('text')} AS n_words FROM n""",
    "alpha_by_group": f'WITH {_LONG}, {_GROUPED} SELECT field AS "group", alpha, n_units, n_ratings FROM al',
    "round_agreement": f"""WITH {_LONG}, c AS (SELECT window_id, field, label, count(*) AS n FROM long WHERE "round" = 'round1' GROUP BY 1, 2, 3), t AS (SELECT *, sum(n) OVER (PARTITION BY window_id, field) AS t FROM c),
      a AS (SELECT window_id, field, label AS label_a FROM t WHERE n * 2 > t), j AS (SELECT field, label_a, label AS label_b, count(*) AS n FROM a JOIN long USING (window_id, field) WHERE "round" = 'round2' GROUP BY 1, 2, 3)
      SELECT *, round(n / sum(n) OVER (PARTITION BY field), 6) AS rate FROM j""",
    "confused_labels": f"""WITH {_LONG}, j AS (SELECT a.field, a.label AS label_a, b.label AS label_b FROM long a JOIN long b ON a.field = b.field AND a."round" = b."round" AND a.window_id = b.window_id AND a.coder < b.coder),
      k AS (SELECT field, least(label_a, label_b) AS label_a, greatest(label_a, label_b) AS label_b, count(*) AS n FROM j GROUP BY 1, 2, 3), r AS (SELECT *, round(n / sum(n) OVER (PARTITION BY field), 6) AS rate FROM k)
      SELECT * FROM r WHERE label_a <> label_b""",
    "coverage_gate": f"""WITH {_CUR_A}, n AS (SELECT count(*) FILTER (function IS NULL OR {_N('function')} NOT IN {_IN('function')}) AS misses, count(*) AS total FROM ca WHERE "round" = 'round1')
      SELECT *, misses * {MISSES_OF} <= total * {MISSES} AS passed FROM n""",
    "word_ratio_skip": f"WITH {_RATIO} SELECT ra.channel, min(ratio) FILTER (ra.role = 'profile' AND cv.duration > 0) AS least_ratio FROM ra JOIN cv USING (id) GROUP BY 1",
    "typical_sequences": f"""WITH {_RUNS}, s AS (SELECT video_id, string_agg(label, ' ' ORDER BY run) AS "sequence" FROM runs_ GROUP BY 1) SELECT "sequence", count(*) AS n_videos FROM s GROUP BY 1""",
    "loop_distance": f"""WITH {_SEQ('loop')}, n AS (SELECT video_id, count(*) FILTER (label = 'opens') AS opens, count(*) FILTER (label = 'closes') AS closes FROM seq GROUP BY 1),
      o AS (SELECT video_id, label, idx, row_number() OVER (PARTITION BY video_id, label ORDER BY idx) AS k FROM seq), p AS (SELECT a.video_id, count(*) AS pairs, avg(b.idx - a.idx) AS dist FROM o a JOIN o b ON a.video_id = b.video_id AND a.k = b.k WHERE a.label = 'opens' AND b.label = 'closes' AND b.idx > a.idx GROUP BY 1)
      SELECT n.video_id, opens, closes, coalesce(pairs, 0) AS pairs, round(dist, 6) AS mean_distance FROM n LEFT JOIN p USING (video_id)""",
    "density_by_third": f"""WITH {_SEQ('density')}, t AS (SELECT label, row_number() OVER (PARTITION BY video_id ORDER BY idx, window_id) - 1 AS k, count(*) OVER (PARTITION BY video_id) AS n FROM seq)
      SELECT CASE WHEN k < n // 3 THEN 1 WHEN k < 2 * n // 3 THEN 2 ELSE 3 END AS third, round(avg(CAST(label AS DOUBLE)), 6) AS density, count(*) AS n FROM t GROUP BY 1""",
    "source_contrast": f"""WITH {CUR_W}, cv AS (SELECT * FROM videos QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1), x AS (SELECT source, {TOKENS.format('text')} AS n FROM cw JOIN cv ON cw.video_id = cv.id)
      SELECT source, count(*) AS windows, CAST(sum(n) AS BIGINT) AS words, count(*) FILTER (n > 35) AS long_windows FROM x GROUP BY 1""",
    "registry_problems": f"""WITH {_GATES}, r AS (SELECT DISTINCT unnest(string_split(roles, ',')) AS role FROM gates WHERE scope = 'per_channel')
      SELECT role AS name, 'role without channel' AS problem FROM r WHERE role <> '' AND role NOT IN (SELECT role FROM channels WHERE role IS NOT NULL)
      UNION ALL SELECT channel, 'channel of unknown role' FROM channels WHERE role IS NULL OR role NOT IN (SELECT role FROM r)""",
}
