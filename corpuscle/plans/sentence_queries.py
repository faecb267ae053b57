"""Queries over fragments and sentences: segments, offsets, boundary signals, merging, windows and their gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.functions.boundary import signal_sql
from corpuscle.functions.text import WHITE, display_id, strip_markers, word_count
from corpuscle.operators.merging import merge_open, signals
from corpuscle.operators.segments import attach, chunk_offsets, gap_segments, sentence_spans
from corpuscle.operators.windows import CEILING, SENTENCES, SINGLE_LIMIT, WORDS, band, window_numbers
from corpuscle.operators.windows import window_records as records
from corpuscle.sources.tables import current_rows, table

TOKENS = "len(list_filter(regexp_split_to_array(coalesce({0}, ''), '" + WHITE.replace("{", "{{").replace("}", "}}") + "'), lambda x: x <> ''))"
CUR_F = "cf AS (SELECT * FROM fragments QUALIFY row_number() OVER (PARTITION BY video_id, frag_idx ORDER BY loaded_at DESC) = 1)"
CUR_S = "cs AS (SELECT * FROM sentences QUALIFY row_number() OVER (PARTITION BY sent_id ORDER BY loaded_at DESC) = 1)"
CUR_V = "cv AS (SELECT * FROM videos QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1)"
CUR_W = "cw AS (SELECT * FROM windows QUALIFY row_number() OVER (PARTITION BY window_id ORDER BY loaded_at DESC) = 1)"


def _fragments(spark: SparkSession, d: str) -> DataFrame:
    return current_rows(table(spark, d, "fragments").select("video_id", "frag_idx", "start", "duration", "text", "loaded_at"), ["video_id", "frag_idx"])


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    return current_rows(table(spark, d, "sentences").select("sent_id", "video_id", "idx", "start_s", "end_s", "text", "loaded_at"), ["sent_id"]).drop("loaded_at")


def _videos(spark: SparkSession, d: str) -> DataFrame:
    return current_rows(table(spark, d, "videos").select("id", "channel", "title", "duration", "view_count", "published_at", "source", "role", "loaded_at"), ["id"])


_STRIP = r"trim(regexp_replace(regexp_replace({0}, '(?i)\[(m[uúÚ]sica|music|aplausos|applause)\]', '', 'g'), '" + WHITE.replace("{", "{{").replace("}", "}}") + "', ' ', 'g'))"


#: A live session holds a large part of all fragments, so scans go by ten minutes of start; a null start comes first.
def _ten_minutes() -> F.Column:
    return F.coalesce(F.floor(F.col("start") / 600), F.lit(-(1 << 40)))


def marker_strip(spark: SparkSession, d: str) -> DataFrame:
    return _fragments(spark, d).where("text is not null").select("video_id", "frag_idx", strip_markers("text").alias("text"))


def gap_segments_q(spark: SparkSession, d: str) -> DataFrame:
    out = gap_segments(_fragments(spark, d), ["video_id"], ["start", "frag_idx"], F.col("start"), F.col("duration"), F.col("text"), block=_ten_minutes())
    return out.withColumn("inicio_s", F.round("inicio_s", 6))


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    f = _fragments(spark, d).select("video_id", "start", "frag_idx", strip_markers(F.coalesce("text", F.lit(""))).alias("text")).where("text <> ''")
    return chunk_offsets(f, ["video_id"], ["start", "frag_idx"], "text", block=_ten_minutes())


def chunk_offsets_q(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).select("video_id", "frag_idx", "char_from", "char_to")


def sentence_time_attach(spark: SparkSession, d: str) -> DataFrame:
    """Where every 100th character of a video's text was said: attachment alone, in a form SQL shares; sentence_times is the whole job."""
    chunks = _chunks(spark, d)
    # Each chunk gives the positions of its own span and of the space behind it.
    first = F.ceil(F.col("char_from") / EVERY) * EVERY
    points = chunks.where(first <= F.col("char_to")).select("video_id", F.explode(F.sequence(first, F.col("char_to"), F.lit(EVERY).cast("bigint"))).alias("pos"))
    got = attach(points, chunks.select("video_id", "char_from", F.col("frag_idx").alias("chunk")), ["video_id"], "pos")
    return got.select("video_id", "pos", "chunk")


def sentence_times(spark: SparkSession, d: str) -> DataFrame:
    """Every sentence of a video's text with its span, and the time of the fragments that hold its first and last character."""
    chunks = _chunks(spark, d)
    spans = sentence_spans(chunks, ["video_id"], "text")
    ends = spans.select("video_id", "idx", "char_from", "char_to", F.explode(F.array(F.struct(F.lit(0).alias("_end"), F.col("char_from").alias("pos")), F.struct(F.lit(1).alias("_end"), (F.col("char_to") - 1).alias("pos")))).alias("_x"))
    points = ends.select("video_id", "idx", "char_from", "char_to", "_x.*")
    got = attach(points, chunks.select("video_id", "char_from", F.col("frag_idx").alias("chunk")), ["video_id"], "pos")
    said = _fragments(spark, d).select(F.col("video_id").alias("_v"), F.col("frag_idx").cast("bigint").alias("_c"), "start", (F.col("start") + F.coalesce("duration", F.lit(0.0))).alias("_until"))
    timed = got.join(said, F.col("video_id").eqNullSafe(F.col("_v")) & F.col("chunk").eqNullSafe(F.col("_c")))
    return timed.groupBy("video_id", "idx", "char_from", "char_to").agg(F.max(F.when(F.col("_end") == 0, F.col("start"))).alias("start_s"), F.max(F.when(F.col("_end") == 1, F.col("_until"))).alias("end_s"))


#: Distance of the positions that sentence_time_attach attaches.
EVERY = 100


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return _sentences(spark, d).withColumn("next_text", F.lead("text").over(Window.partitionBy("video_id").orderBy("idx", "sent_id")))


def boundary_signals(spark: SparkSession, d: str) -> DataFrame:
    return signals(_pairs(spark, d)).select("sent_id", "signal")


def merged_sentences(spark: SparkSession, d: str) -> DataFrame:
    return merge_open(_sentences(spark, d), "video_id", "idx", "text")


def _numbered(spark: SparkSession, d: str, *keep: str) -> DataFrame:
    """video_id, idx, sent_id, ``keep``, words and ``win`` of every sentence."""
    s = _sentences(spark, d).withColumn("words", word_count("text")).withColumn("text", F.coalesce("text", F.lit("")))
    return window_numbers(s, ["video_id"], "idx", "words", ["sent_id", *keep, "words"])


def windows_q(spark: SparkSession, d: str) -> DataFrame:
    v = _videos(spark, d).select(F.col("id").alias("video_id"), F.col("duration").alias("_dur"))
    s = _numbered(spark, d, "start_s", "end_s", "text").join(v, "video_id", "left")
    return records(s, "_dur").withColumn("pos_pct", F.round("pos_pct", 6)).drop("sent_ids")


_NUMBERED = f"""{CUR_S},
ordered AS (SELECT video_id, idx, sent_id, start_s, end_s, coalesce(text, '') AS text, {TOKENS.format('text')} AS w, row_number() OVER (PARTITION BY video_id ORDER BY idx) AS p FROM cs),
fold AS (
  SELECT video_id, p, 0 AS win, 1 AS n, w AS t FROM ordered WHERE p = 1
  UNION ALL
  SELECT o.video_id, o.p,
    CASE WHEN f.n >= {SENTENCES} OR (f.n = 1 AND f.t > {WORDS}) OR (f.t + o.w > {WORDS} AND (f.n >= 2 OR f.t + o.w > {CEILING})) THEN f.win + 1 ELSE f.win END,
    CASE WHEN f.n >= {SENTENCES} OR (f.n = 1 AND f.t > {WORDS}) OR (f.t + o.w > {WORDS} AND (f.n >= 2 OR f.t + o.w > {CEILING})) THEN 1 ELSE f.n + 1 END,
    CASE WHEN f.n >= {SENTENCES} OR (f.n = 1 AND f.t > {WORDS}) OR (f.t + o.w > {WORDS} AND (f.n >= 2 OR f.t + o.w > {CEILING})) THEN o.w ELSE f.t + o.w END
  FROM fold f JOIN ordered o ON o.video_id = f.video_id AND o.p = f.p + 1),
numbered AS (SELECT o.*, f.win FROM ordered o JOIN fold f USING (video_id, p)),
wins AS (SELECT video_id, win, count(*) AS n, sum(w) AS w, string_agg(text, ' ' ORDER BY p) AS text, first(start_s ORDER BY p) AS s, max(p) AS last_p FROM numbered GROUP BY 1, 2)"""


def _gated(spark: SparkSession, d: str) -> DataFrame:
    """Windows with what the gates need: words, sentences, words of the largest sentence, of the next sentence, and whether they are last."""
    s = _numbered(spark, d)
    w = s.groupBy("video_id", "win").agg(F.sum("words").alias("words"), F.count("*").alias("n"), F.max("words").alias("big"), F.min_by("words", "idx").alias("first_words"))
    return w.withColumn("next_words", F.lead("first_words").over(Window.partitionBy("video_id").orderBy("win")))


def window_gate_parity(spark: SparkSession, d: str) -> DataFrame:
    w = _gated(spark, d).agg(F.count_if(F.col("words") > CEILING).alias("big_windows"), F.count_if((F.col("words") > CEILING) & ((F.col("n") != 1) | (F.col("big") <= CEILING))).alias("unproven"))
    s = _sentences(spark, d).agg(F.count_if(word_count("text") > CEILING).alias("big_sentences"))
    return w.crossJoin(s).select("big_windows", "big_sentences", "unproven", ((F.col("big_windows") == F.col("big_sentences")) & (F.col("unproven") == 0)).alias("passed"))


def window_gate_residual(spark: SparkSession, d: str) -> DataFrame:
    single = (F.col("n") == 1) & F.col("next_words").isNotNull()
    left = single & (F.col("words") <= WORDS) & (F.col("words") + F.col("next_words") <= CEILING)
    return _gated(spark, d).agg(F.count_if(left).alias("residual")).withColumn("passed", F.col("residual") == 0)


def window_gate_ratio(spark: SparkSession, d: str) -> DataFrame:
    g = _gated(spark, d).agg(F.count_if((F.col("n") == 1) & F.col("next_words").isNotNull()).alias("single"), F.count("*").alias("total"))
    ratio = F.when(F.col("total") > 0, F.col("single") / F.col("total")).otherwise(F.lit(0.0))
    return g.select("single", "total", F.round(ratio, 6).alias("ratio"), (ratio <= SINGLE_LIMIT).alias("passed"), F.lit(False).alias("blocking"))


def window_gate_band(spark: SparkSession, d: str) -> DataFrame:
    """Every video, also those without a window."""
    n = _gated(spark, d).groupBy("video_id").agg(F.count("*").alias("_n"))
    v = _videos(spark, d).join(n, F.col("id") == F.col("video_id"), "left")
    lo, hi = band(F.coalesce("duration", F.lit(0.0)))
    c = F.coalesce("_n", F.lit(0))
    return v.select("id", c.alias("n_windows"), lo.alias("least"), hi.alias("most"), c.between(lo, hi).alias("passed"))


def window_gate_verdict(spark: SparkSession, d: str) -> DataFrame:
    a = window_gate_parity(spark, d).select(F.col("passed").alias("parity"))
    b = window_gate_residual(spark, d).select(F.col("passed").alias("residual"))
    c = window_gate_band(spark, d).agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("band"))
    return a.crossJoin(b).crossJoin(c).withColumn("passed", F.col("parity") & F.col("residual") & F.col("band"))


def context_bundles(spark: SparkSession, d: str) -> DataFrame:
    w = current_rows(table(spark, d, "windows").select("window_id", "video_id", "idx", "text", "loaded_at"), ["window_id"])
    prior = Window.partitionBy("video_id").orderBy("idx", "window_id").rowsBetween(-3, -1)
    text = F.coalesce("text", F.lit(""))
    return w.select("window_id", display_id(F.col("video_id"), F.col("window_id")).alias("display_id"), F.array_join(F.collect_list(text).over(prior), " | ").alias("context"), text.alias("target"))


QUERIES = {
    "marker_strip": marker_strip, "gap_segments": gap_segments_q, "chunk_offsets": chunk_offsets_q, "sentence_time_attach": sentence_time_attach, "sentence_times": sentence_times, "boundary_signals": boundary_signals, "merged_sentences": merged_sentences,
    "windows": windows_q, "window_gate_parity": window_gate_parity, "window_gate_residual": window_gate_residual, "window_gate_ratio": window_gate_ratio, "window_gate_band": window_gate_band, "window_gate_verdict": window_gate_verdict, "context_bundles": context_bundles,
}

_CHUNKS = f"""{CUR_F}, ct AS (SELECT video_id, frag_idx, start, {_STRIP.format("coalesce(text, '')")} AS t FROM cf),
co AS (SELECT video_id, frag_idx, start, length(t) AS n, CAST(coalesce(sum(length(t) + 1) OVER (PARTITION BY video_id ORDER BY start, frag_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_from FROM ct WHERE t <> '')"""
_BAND = f"""{CUR_V}, band AS (SELECT id, CAST(coalesce(n, 0) AS BIGINT) AS n_windows, CAST(ceil(coalesce(duration, 0) / 60.0::DOUBLE * 4.86::DOUBLE * (1::DOUBLE - 0.4::DOUBLE)) AS BIGINT) AS least,
  CAST(floor(coalesce(duration, 0) / 60.0::DOUBLE * 4.86::DOUBLE * (1::DOUBLE + 0.4::DOUBLE)) AS BIGINT) AS most FROM cv LEFT JOIN (SELECT video_id, count(*) AS n FROM wins GROUP BY 1) x ON x.video_id = cv.id)"""
_GATED = f"""{_NUMBERED}, g AS (SELECT w.*, (SELECT max(x.w) FROM numbered x WHERE x.video_id = w.video_id AND x.win = w.win) AS big, nx.w AS next_words FROM wins w LEFT JOIN ordered nx ON nx.video_id = w.video_id AND nx.p = w.last_p + 1)"""

SQL = {
    "marker_strip": f"WITH {CUR_F} SELECT video_id, frag_idx, {_STRIP.format('text')} AS text FROM cf WHERE text IS NOT NULL",
    "gap_segments": f"""WITH {CUR_F}, t AS (SELECT video_id, frag_idx, start, start + coalesce(duration, 0) AS e, {_STRIP.format("coalesce(text, '')")} AS t FROM cf),
      l AS (SELECT *, lag(e) OVER w AS pe, lag(t) OVER w AS pt FROM t WINDOW w AS (PARTITION BY video_id ORDER BY start, frag_idx)),
      s AS (SELECT *, sum(CASE WHEN t <> '' AND (pt IS NULL OR pt = '' OR start - pe > 1.0::DOUBLE) THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY start, frag_idx) - 1 AS seg FROM l)
      SELECT video_id, CAST(seg AS BIGINT) AS segment, round(min(start), 6) AS inicio_s, string_agg(t, ' ' ORDER BY start, frag_idx) AS texto FROM s WHERE t <> '' GROUP BY 1, 2""",
    "chunk_offsets": f"WITH {_CHUNKS} SELECT video_id, frag_idx, char_from, char_from + n AS char_to FROM co",
    "sentence_time_attach": f"""WITH {_CHUNKS}, pts AS (SELECT video_id, unnest(generate_series(0, m, 100)) AS pos FROM (SELECT video_id, max(char_from + n) AS m FROM co GROUP BY 1))
      SELECT pts.video_id, pos, CAST(frag_idx AS BIGINT) AS chunk FROM pts ASOF JOIN co ON pts.video_id = co.video_id AND pts.pos >= co.char_from""",
    "boundary_signals": f"WITH {CUR_S}, n AS (SELECT *, lead(text) OVER (PARTITION BY video_id ORDER BY idx, sent_id) AS next_text FROM cs), n2 AS (SELECT sent_id, coalesce(text, '') AS text, next_text FROM n) SELECT sent_id, {signal_sql('text', 'next_text', spark=False)} AS signal FROM n2",
    "merged_sentences": f"""WITH RECURSIVE {CUR_S}, o AS (SELECT video_id, idx, coalesce(text, '') AS text, row_number() OVER (PARTITION BY video_id ORDER BY idx) AS p FROM cs),
      j AS (SELECT video_id, p, idx AS f, idx AS l, text, CAST(0 AS BIGINT) AS k FROM o WHERE p = 1
        UNION ALL SELECT o.video_id, o.p, CASE WHEN ({signal_sql('j.text', 'o.text', spark=False)}) = 'open' THEN j.f ELSE o.idx END, o.idx,
          CASE WHEN ({signal_sql('j.text', 'o.text', spark=False)}) = 'open' THEN j.text || ' ' || o.text ELSE o.text END, CASE WHEN ({signal_sql('j.text', 'o.text', spark=False)}) = 'open' THEN j.k ELSE j.k + 1 END
        FROM j JOIN o ON o.video_id = j.video_id AND o.p = j.p + 1)
      SELECT video_id, k AS idx, CAST(f AS BIGINT) AS "first", CAST(max(l) AS BIGINT) AS "last", arg_max(text, p) AS text FROM j GROUP BY video_id, k, f""",
    "windows": f"""WITH RECURSIVE {_NUMBERED}, {CUR_V} SELECT format('{{}}:j{{:04d}}', n.video_id, n.win) AS window_id, n.video_id, CAST(n.win AS BIGINT) AS idx, n.s AS start_s, l.end_s, n.text, {TOKENS.format('n.text')} AS n_words, n.n AS n_sentences,
      round(CASE WHEN cv.duration <> 0 THEN n.s / cv.duration END, 6) AS pos_pct FROM wins n JOIN ordered l ON l.video_id = n.video_id AND l.p = n.last_p LEFT JOIN cv ON cv.id = n.video_id""",
    "window_gate_parity": f"""WITH RECURSIVE {_GATED}, c AS (SELECT (SELECT count(*) FROM g WHERE w > 60) AS big_windows, (SELECT count(*) FROM ordered WHERE w > 60) AS big_sentences, (SELECT count(*) FROM g WHERE w > 60 AND (n <> 1 OR big <= 60)) AS unproven)
      SELECT *, big_windows = big_sentences AND unproven = 0 AS passed FROM c""",
    "window_gate_residual": f"WITH RECURSIVE {_GATED} SELECT count(*) AS residual, count(*) = 0 AS passed FROM g WHERE n = 1 AND next_words IS NOT NULL AND w <= 35 AND w + next_words <= 60",
    "window_gate_ratio": f"""WITH RECURSIVE {_GATED}, c AS (SELECT count(*) FILTER (n = 1 AND next_words IS NOT NULL) AS single, count(*) AS total FROM g)
      SELECT single, total, round(single / total, 6) AS ratio, single / total <= 0.15 AS passed, false AS blocking FROM c""",
    "window_gate_band": f"WITH RECURSIVE {_NUMBERED}, {_BAND} SELECT *, n_windows BETWEEN least AND most AS passed FROM band",
    "window_gate_verdict": f"""WITH RECURSIVE {_GATED}, {_BAND}, v AS (SELECT (SELECT count(*) FROM g WHERE w > 60) = (SELECT count(*) FROM ordered WHERE w > 60) AND (SELECT count(*) FROM g WHERE w > 60 AND (n <> 1 OR big <= 60)) = 0 AS parity,
      (SELECT count(*) FROM g WHERE n = 1 AND next_words IS NOT NULL AND w <= 35 AND w + next_words <= 60) = 0 AS residual, (SELECT bool_and(n_windows BETWEEN least AND most) FROM band) AS band) SELECT *, parity AND residual AND band AS passed FROM v""",
    "context_bundles": f"""WITH {CUR_W} SELECT window_id, substr(sha1(video_id || ':' || window_id), 1, 8) AS display_id,
      coalesce(string_agg(coalesce(text, ''), ' | ') OVER (PARTITION BY video_id ORDER BY idx, window_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS context, coalesce(text, '') AS target FROM cw""",
}
