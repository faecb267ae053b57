"""Corpus artifacts as sources and sinks: caption events, listings, manifests, envelopes, worksheets, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscle.functions.text import strip_markers

MANIFEST = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "titulo", "duracao_s", "contagem_palavras", "fonte", "role")])
LISTING = "id string, title string, duration double, view_count bigint, timestamp double"
CAPTIONS = "events array<struct<tStartMs:double,dDurationMs:double,segs:array<struct<utf8:string>>>>"
RAW = "video_id string, source string, metadata struct<title:string,duration:double,view_count:bigint,published_at:string>, fragments array<struct<start:double,duration:double,text:string>>"


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Listed videos from JSON lines: missing duration and views are 0, an epoch becomes a UTC time, blank lines are skipped."""
    rows = spark.read.schema(LISTING).json(path).where("id is not null")
    return rows.select("id", "title", F.coalesce("duration", F.lit(0.0)).alias("duration"), F.coalesce("view_count", F.lit(0)).cast("bigint").alias("view_count"), F.timestamp_seconds("timestamp").alias("published_at"))


def caption_fragments(df: DataFrame, key: str, json: str) -> DataFrame:
    """key, ``frag_idx``, start, duration, text from caption documents: segments of an event concatenated, new lines as spaces,
    trimmed, empty ones left out, milliseconds as seconds (a missing time is 0). A document without text has no row."""
    events = df.select(key, F.posexplode(F.from_json(json, CAPTIONS)["events"]).alias("_p", "_e")).where("_e.segs is not null")
    text = F.trim(F.regexp_replace(F.array_join(F.transform("_e.segs", lambda s: F.coalesce(s["utf8"], F.lit(""))), ""), "\n", " "))
    ms = lambda c: F.coalesce(F.col(c), F.lit(0.0)) / 1000.0
    return events.select(key, F.col("_p").alias("frag_idx"), ms("_e.tStartMs").alias("start"), ms("_e.dDurationMs").alias("duration"), text.alias("text")).where("text <> ''")


def first_source(keys: DataFrame, key: str, sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """``keys`` with the ``fragments`` and the name of the first of ``sources`` (key, fragments) that has any; null if none has."""
    out, frags, tag = keys, [], F.lit(None).cast("string")
    for i, (_, df) in enumerate(sources):
        out = out.join(df.select(F.col(key).alias(f"_k{i}"), F.col("fragments").alias(f"_f{i}")), F.col(key) == F.col(f"_k{i}"), "left")
        frags.append(F.col(f"_f{i}"))
    for i, (name, _) in reversed(list(enumerate(sources))):
        tag = F.when(F.col(f"_f{i}").isNotNull(), F.lit(name)).otherwise(tag)
    return out.select(*keys.columns, F.coalesce(*frags).alias("fragments"), tag.alias("source"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw envelopes, one document per file."""
    return spark.read.schema(RAW).option("multiLine", True).json(path)


def raw_chunks(raw: DataFrame) -> DataFrame:
    """video_id, frag_idx, start_s, end_s, text: markers stripped, empty ones left out, a missing duration is 0."""
    f = raw.select("video_id", F.posexplode("fragments").alias("frag_idx", "_f"))
    return f.select("video_id", "frag_idx", F.col("_f.start").alias("start_s"), (F.col("_f.start") + F.coalesce("_f.duration", F.lit(0.0))).alias("end_s"), strip_markers(F.col("_f.text")).alias("text")).where("text <> ''")


def read_manifest(spark: SparkSession, path: str, default_role: str = "profile") -> DataFrame:
    """Manifest rows, all text; a manifest without a role column gives every row ``default_role``, an empty role stays empty."""
    rows = spark.read.option("header", True).option("emptyValue", "").option("nullValue", "\x00").csv(path)
    if "role" not in rows.columns:
        rows = rows.withColumn("role", F.lit(default_role))
    return rows.select(*[(F.coalesce(F.col(f.name), F.lit("")) if f.name in rows.columns else F.lit("")).alias(f.name) for f in MANIFEST])


def write_manifest(df: DataFrame, path: str) -> None:
    """The six columns in their order; missing values are empty."""
    cols = [(F.coalesce(F.col(f.name).cast("string"), F.lit("")) if f.name in df.columns else F.lit("")).alias(f.name) for f in MANIFEST]
    df.select(*cols).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def envelope(df: DataFrame, key: str, name: str, order: str, generated_at: str, **extra: Column) -> DataFrame:
    """One JSON text per key: the key, ``generated_at`` (a parameter), extra values and the rows under ``name``, in order."""
    cols = [c for c in df.columns if c != key]
    rows = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*cols).alias("_r")))).alias("_x"))
    body = F.struct(F.col(key), F.lit(generated_at).alias("generated_at"), *[v.alias(k) for k, v in extra.items()], F.transform("_x", lambda x: x["_r"]).alias(name))
    return rows.select(key, F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def write_envelopes(rows: DataFrame, path: str, again: bool = False) -> None:
    """The envelopes of ``rows`` (json) as JSON lines; what is there already is only replaced ``again``, so raw envelopes are never overwritten."""
    rows.select(F.col("json").alias("value")).write.mode("overwrite" if again else "errorifexists").text(path)


def read_envelopes(spark: SparkSession, path: str, schema: str, name: str) -> DataFrame:
    """Rows of envelopes under a path or glob: the envelope's own columns and those of its rows under ``name``, with ``row``, their place.

    ``schema`` is that of an envelope. Envelopes without rows give none.
    """
    whole = spark.read.schema(schema).json(path)
    rows = whole.select(*[c for c in whole.columns if c != name], F.posexplode(name).alias("row", "_r"))
    return rows.select(*[c for c in rows.columns if c != "_r"], *[F.col(f"_r.`{c}`").alias(c) for c in whole.schema[name].dataType.elementType.names])


def worksheet(bundles: DataFrame, fields: list[str]) -> DataFrame:
    """JSON lines to be filled in: display_id, context, target and a null for each field."""
    return bundles.select(F.to_json(F.struct("display_id", "context", "target", *[F.lit(None).cast("string").alias(f) for f in fields]), {"ignoreNullFields": "false"}).alias("value"))


def merge_worksheet(sheet: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with their window_id, ids on one side only): ``sheet`` has display_id, ``index`` display_id and window_id."""
    both = sheet.join(index, "display_id")
    lost = sheet.join(index, "display_id", "left_anti").select("display_id", F.lit("not in index").alias("problem")).unionByName(index.join(sheet, "display_id", "left_anti").select("display_id", F.lit("not in worksheet").alias("problem")))
    return both, lost


def sample_report(rows: DataFrame, columns: list[str], most: int = 50) -> str:
    """A Markdown table of a sample of at most ``most`` rows with two blank columns for judgement; pipes are escaped."""
    head = [*columns, "functions", "cut sentence"]
    lines = ["| " + " | ".join(head) + " |", "|" + "---|" * len(head)]
    for r in rows.select(*columns).limit(most).collect():
        lines.append("| " + " | ".join(str("" if v is None else v).replace("|", "\\|").replace("\n", " ") for v in r) + " |  |  |")
    return "\n".join(lines) + "\n"
