"""Queries over videos, segments and documents: counts, corpus gates, selection, sampling, style, the gate report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions.text import CTA_PHRASES, contains_any, expected_words, reading_ease, syllables, word_count
from corpuscle.operators.fusion import absorbed
from corpuscle.operators.gates import GATES, registry, report
from corpuscle.operators.sampling import eligible, hash_order, quota_sample, seeded_draw, top_k
from corpuscle.operators.windows import CEILING, WORDS, band
from corpuscle.plans.annotation_queries import _runs
from corpuscle.plans.sentence_queries import CUR_V, CUR_W, TOKENS, _gated, _sentences, _videos
from corpuscle.sources.tables import current_rows, table

#: Videos of the test tables are short; of them, those of a minute are the long ones.
NOW, SEED, TOP, KEPT, LONG_S = "2025-06-01 00:00:00", 42, 5, 3, 60.0
_SEG = "cg AS (SELECT * FROM segments QUALIFY row_number() OVER (PARTITION BY video_id, seg_idx ORDER BY loaded_at DESC) = 1)"


def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", word_count("text").alias("n_words"))


def _words(spark: SparkSession, d: str) -> DataFrame:
    g = current_rows(table(spark, d, "segments").select("video_id", "seg_idx", "texto", "loaded_at"), ["video_id", "seg_idx"])
    return g.groupBy("video_id").agg(F.sum(word_count("texto")).alias("words"))


def _ratio(spark: SparkSession, d: str) -> DataFrame:
    """Videos with segments: words against those expected of the duration; 1 where none are expected."""
    v = _videos(spark, d).join(_words(spark, d), F.col("id") == F.col("video_id"))
    e = expected_words(F.coalesce("duration", F.lit(0.0)))
    return v.select("id", "channel", "role", "words", F.round(F.when(e > 0, F.col("words") / e).otherwise(F.lit(1.0)), 6).alias("ratio"))


def expected_word_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _ratio(spark, d).select("id", "words", "ratio")


def corpus_gate(spark: SparkSession, d: str) -> DataFrame:
    """Per channel: at least 30 profile videos, four to five reserved ones, every profile video with 60 % of the expected words."""
    r = _ratio(spark, d).groupBy("channel").agg(F.count_if(F.col("role") == "profile").alias("n_profile"), F.count_if(F.col("role") == "holdout").alias("n_holdout"), F.min(F.when(F.col("role") == "profile", F.col("ratio"))).alias("least_ratio"))
    ok = (F.col("n_profile") >= 30) & F.col("n_holdout").between(4, 5) & F.coalesce(F.col("least_ratio") >= 0.6, F.lit(True))
    return r.withColumn("passed", ok)


def eligible_pool_topk(spark: SparkSession, d: str) -> DataFrame:
    pool = eligible(_videos(spark, d), "channel", "duration", "published_at", NOW, TOP, LONG_S)
    return top_k(pool, "channel", [F.coalesce("view_count", F.lit(0)).desc(), F.col("id")], TOP).select("channel", "id", F.col("rank").cast("bigint").alias("rank"))


def holdout_hash_sample(spark: SparkSession, d: str) -> DataFrame:
    """Per channel, three videos by hash that weren't selected."""
    rest = _videos(spark, d).join(eligible_pool_topk(spark, d).select("id"), "id", "left_anti")
    return top_k(rest.withColumn("_h", hash_order(SEED, "id")), "channel", [F.col("_h"), F.col("id")], KEPT).select("channel", "id", F.col("rank").cast("bigint").alias("rank"))


def holdout_seeded(spark: SparkSession, d: str) -> DataFrame:
    """Per channel, three videos that weren't selected, by the draw of Python's own generator."""
    rest = _videos(spark, d).join(eligible_pool_topk(spark, d).select("id"), "id", "left_anti")
    return seeded_draw(rest, "channel", "id", KEPT, SEED)


def quota_sample_q(spark: SparkSession, d: str) -> DataFrame:
    w = current_rows(table(spark, d, "windows").select("window_id", "video_id", "idx", "loaded_at"), ["window_id"])
    return quota_sample(w, "video_id", "window_id", 50, SEED).select("video_id", "window_id", "idx")


#: Phrases that select videos; terms that a text must not have.
PHRASES, FORBIDDEN = [*CTA_PHRASES, "stay until the end", "escreva o seu palpite"], ["rocket science", "marathon", "http"]


def phrase_candidates(spark: SparkSession, d: str, phrases: list[str] = PHRASES) -> DataFrame:
    """Videos any of whose windows has one of the phrases."""
    w = current_rows(table(spark, d, "windows").select("window_id", "video_id", "text", "loaded_at"), ["window_id"])
    return w.where(contains_any(F.col("text"), phrases)).select("video_id").distinct()


def readability(spark: SparkSession, d: str) -> DataFrame:
    """Words, sentences by closing marks, syllables by vowel groups, and reading ease of every document."""
    t = F.coalesce("text", F.lit(""))
    x = table(spark, d, "documents").select("doc_id", word_count(t).alias("words"), F.size(F.regexp_extract_all(t, F.lit(r"[.!?]+"), F.lit(0))).cast("bigint").alias("sentences"), syllables(t).alias("syllables"))
    return x.withColumn("ease", F.round(reading_ease(F.col("words"), F.col("sentences"), F.col("syllables")), 6))


def source_contamination(spark: SparkSession, d: str) -> DataFrame:
    """Style by source, to see whether a source differs: documents, words per sentence, mean ease."""
    x = readability(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return x.groupBy("source").agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.sum("sentences").alias("sentences"), F.round(F.avg("ease"), 6).alias("ease"))


def forbidden_terms(spark: SparkSession, d: str, forbidden: list[str] = FORBIDDEN) -> DataFrame:
    """Documents with a literal forbidden term."""
    t = table(spark, d, "documents").select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("t"))
    return t.select("doc_id", F.explode(F.array_compact(F.array(*[F.when(F.col("t").contains(x), F.lit(x)) for x in forbidden]))).alias("term"))


def channel_report(spark: SparkSession, d: str) -> DataFrame:
    """Videos and views rolled up by channel and source."""
    return _videos(spark, d).rollup("channel", "source").agg(F.count("*").alias("n"), F.sum(F.coalesce("view_count", F.lit(0))).cast("bigint").alias("views"), F.grouping_id().cast("int").alias("level"))


def _corpus_measured(spark: SparkSession, d: str) -> DataFrame:
    g = corpus_gate(spark, d)
    return g.select(F.lit("profile_videos").alias("gate"), "channel", F.col("n_profile").cast("double").alias("measured")).unionByName(g.select(F.lit("holdout_videos").alias("gate"), "channel", F.col("n_holdout").cast("double").alias("measured"))).unionByName(g.select(F.lit("word_ratio").alias("gate"), "channel", F.col("least_ratio").alias("measured")))


def gate_report(spark: SparkSession, d: str) -> DataFrame:
    """The gates of the corpus phase measured, as SQL has them; gate_report_full measures those of windows and blocks too."""
    return report(registry(spark), table(spark, d, "channels").select("channel", "role"), _corpus_measured(spark, d))


def _video_measured(spark: SparkSession, d: str) -> DataFrame:
    """Gates of windows and of smoothing, per channel: what breaks parity, the share of single windows, the share of single blocks absorbed."""
    g = _gated(spark, d).groupBy("video_id").agg(
        F.count_if(F.col("words") > CEILING).alias("big"), F.count_if((F.col("words") > CEILING) & ((F.col("n") != 1) | (F.col("big") <= CEILING))).alias("unproven"),
        F.count_if((F.col("n") == 1) & F.col("next_words").isNotNull()).alias("single"), F.count("*").alias("total"),
        F.count_if((F.col("n") == 1) & F.col("next_words").isNotNull() & (F.col("words") <= WORDS) & (F.col("words") + F.col("next_words") <= CEILING)).alias("residual"))
    s = _sentences(spark, d).groupBy("video_id").agg(F.count_if(word_count("text") > CEILING).alias("big_sentences"))
    b = absorbed(_runs(spark, d), "video_id").groupBy("video_id").agg(F.count_if("absorbed").alias("absorbed"), F.count_if(F.col("n") == 1).alias("single_blocks"))
    lo, hi = band(F.coalesce("duration", F.lit(0.0)))
    v = _videos(spark, d).select(F.col("id").alias("video_id"), "channel", lo.alias("_lo"), hi.alias("_hi")).join(g, "video_id", "left").join(s, "video_id", "left").join(b, "video_id", "left")
    c = v.groupBy("channel").agg(*[F.sum(x).alias(x) for x in ("big", "unproven", "single", "total", "big_sentences", "absorbed", "single_blocks", "residual")], F.count_if(~F.coalesce("total", F.lit(0)).between(F.col("_lo"), F.col("_hi"))).alias("off_band"))
    rate = F.when(F.col("single_blocks") > 0, F.col("absorbed") / F.col("single_blocks")).when(F.col("single_blocks") == 0, F.lit(0.0))
    of = {"big_windows": (F.abs(F.col("big") - F.col("big_sentences")) + F.col("unproven")).cast("double"), "single_ratio": F.col("single") / F.col("total"), "smoothing": rate, "window_residual": F.col("residual").cast("double"), "window_band": F.col("off_band").cast("double")}
    return c.select("channel", F.explode(F.array(*[F.struct(F.lit(k).alias("gate"), x.alias("measured")) for k, x in of.items()])).alias("_x")).select("_x.gate", "channel", "_x.measured")


def gate_report_full(spark: SparkSession, d: str) -> DataFrame:
    """gate_report with the gates of windows and of smoothing measured too."""
    measured = _corpus_measured(spark, d).unionByName(_video_measured(spark, d))
    return report(registry(spark), table(spark, d, "channels").select("channel", "role"), measured)


QUERIES = {
    "word_counts": word_counts, "expected_word_ratio": expected_word_ratio, "corpus_gate": corpus_gate, "eligible_pool_topk": eligible_pool_topk, "holdout_hash_sample": holdout_hash_sample, "holdout_seeded": holdout_seeded, "quota_sample": quota_sample_q,
    "phrase_candidates": phrase_candidates, "readability": readability, "source_contamination": source_contamination, "forbidden_terms": forbidden_terms, "channel_report": channel_report, "gate_report": gate_report, "gate_report_full": gate_report_full,
}

_RATIO = f"""{_SEG}, {CUR_V}, wd AS (SELECT video_id, sum({TOKENS.format('texto')}) AS words FROM cg GROUP BY 1),
ra AS (SELECT id, channel, role, CAST(words AS BIGINT) AS words, round(CASE WHEN coalesce(duration, 0) > 0 THEN words / (duration / 60.0::DOUBLE * 150.0::DOUBLE) ELSE 1 END, 6) AS ratio FROM cv JOIN wd ON wd.video_id = cv.id)"""
_GATE = f"""{_RATIO}, ga AS (SELECT channel, count(*) FILTER (role = 'profile') AS n_profile, count(*) FILTER (role = 'holdout') AS n_holdout, min(ratio) FILTER (role = 'profile') AS least_ratio FROM ra GROUP BY 1)"""
_POOL = f"""{CUR_V}, lf AS (SELECT *, coalesce(CAST(floor((epoch(TIMESTAMP '{NOW}') - floor(epoch(published_at))) / 86400) AS BIGINT), 0) >= 182 AS mature FROM cv WHERE coalesce(duration, 0) >= {LONG_S}),
pool AS (SELECT *, count(*) FILTER (mature) OVER (PARTITION BY channel) AS nm FROM lf),
top AS (SELECT channel, id, row_number() OVER (PARTITION BY channel ORDER BY coalesce(view_count, 0) DESC, id) AS "rank" FROM pool WHERE mature OR nm < {TOP} QUALIFY "rank" <= {TOP})"""
_READ = f"""rd0 AS (SELECT doc_id, source, {TOKENS.format('text')} AS words, len(regexp_extract_all(coalesce(text, ''), '[.!?]+')) AS sentences, len(regexp_extract_all(lower(coalesce(text, '')), '[aeiouy]+')) AS syllables FROM documents),
rd AS (SELECT *, round(CASE WHEN words > 0 AND sentences > 0 THEN 206.835::DOUBLE - 1.015::DOUBLE * (words / sentences) - 84.6::DOUBLE * (syllables / words) END, 6) AS ease FROM rd0)"""
_GATES = "gates(gate, kind, op, value, unit, statement, scope, roles) AS (VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else f"{v}::DOUBLE" if isinstance(v, float) else f"'{v}'" for v in (g[0], g[2], g[3], g[4], g[5], g[6], g[8], g[9])) + ")" for g in GATES) + ")"

SQL = {
    "word_counts": f"SELECT doc_id, {TOKENS.format('text')} AS n_words FROM documents",
    "expected_word_ratio": f"WITH {_RATIO} SELECT id, words, ratio FROM ra",
    "corpus_gate": f"WITH {_GATE} SELECT *, n_profile >= 30 AND n_holdout BETWEEN 4 AND 5 AND coalesce(least_ratio >= 0.6, true) AS passed FROM ga",
    "eligible_pool_topk": f"WITH {_POOL} SELECT * FROM top",
    "holdout_hash_sample": f"""WITH {_POOL} SELECT channel, id, row_number() OVER (PARTITION BY channel ORDER BY sha1('{SEED}:' || id), id) AS "rank" FROM cv WHERE id NOT IN (SELECT id FROM top) QUALIFY "rank" <= {KEPT}""",
    "quota_sample": f"""WITH {CUR_W}, q AS (SELECT video_id, window_id, idx, sha1('{SEED}:' || window_id) AS h, row_number() OVER (PARTITION BY video_id ORDER BY sha1('{SEED}:' || window_id), window_id) AS r, 50 // (SELECT count(DISTINCT video_id) FROM cw) AS quota FROM cw),
      base AS (SELECT * FROM q WHERE r <= quota), rest AS (SELECT * FROM q WHERE r > quota QUALIFY row_number() OVER (ORDER BY h, window_id) <= 50 - (SELECT count(*) FROM base))
      SELECT video_id, window_id, idx FROM base UNION ALL SELECT video_id, window_id, idx FROM rest""",
    "phrase_candidates": f"WITH {CUR_W} SELECT DISTINCT video_id FROM cw WHERE " + " OR ".join(f"contains(lower(text), '{p}')" for p in PHRASES),
    "readability": f"WITH {_READ} SELECT doc_id, words, sentences, syllables, ease FROM rd",
    "source_contamination": f"WITH {_READ} SELECT source, count(*) AS n, CAST(sum(words) AS BIGINT) AS words, CAST(sum(sentences) AS BIGINT) AS sentences, round(avg(ease), 6) AS ease FROM rd GROUP BY 1",
    "forbidden_terms": "SELECT doc_id, term FROM documents, (VALUES " + ", ".join(f"('{x}')" for x in FORBIDDEN) + ") t(term) WHERE contains(lower(text), term)",
    "channel_report": f"WITH {CUR_V} SELECT channel, source, count(*) AS n, CAST(sum(coalesce(view_count, 0)) AS BIGINT) AS views, CAST(grouping_id(channel, source) AS INT) AS level FROM cv GROUP BY ROLLUP (channel, source)",
    "gate_report": f"""WITH {_GATE}, {_GATES}, ms AS (SELECT 'profile_videos' AS gate, channel, CAST(n_profile AS DOUBLE) AS m FROM ga UNION ALL SELECT 'holdout_videos', channel, CAST(n_holdout AS DOUBLE) FROM ga UNION ALL SELECT 'word_ratio', channel, least_ratio FROM ga),
      x AS (SELECT g.*, c.channel, list_contains(string_split(g.roles, ','), c.role) AS applies FROM gates g CROSS JOIN channels c WHERE scope = 'per_channel' UNION ALL SELECT g.*, NULL, true FROM gates g WHERE scope = 'global'),
      y AS (SELECT x.*, m, CASE op WHEN '>=' THEN m >= value WHEN '<=' THEN m <= value WHEN '==' THEN m = value END AS ok FROM x LEFT JOIN ms ON ms.gate = x.gate AND ms.channel IS NOT DISTINCT FROM x.channel)
      SELECT gate, channel, CASE WHEN kind = 'bound' THEN op || ' ' || printf('%.3f', value) || ' ' || unit ELSE statement END AS threshold,
      CASE WHEN NOT coalesce(applies, false) THEN 'not applicable' WHEN ok IS NULL THEN 'not measured' WHEN ok THEN 'passed (' || printf('%.3f', round(m, 3)) || ')' ELSE 'failed (' || printf('%.3f', round(m, 3)) || ')' END AS status FROM y""",
}
