"""Problem 3: repeated content inside a document.

Cheap statistics of every document are Spark expressions: shares of repeated words and of repeated short runs of characters, and size. None
of them is the share that defines a case. A decision list over them is learned by sequential covering from a bounded sample labelled by
the definition, and becomes an ordered conditional expression over all documents; it decides which documents the exact pass reads.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.operators.sequence import once
from corpuscle.session import settle
from corpuscle.sources.tables import current_rows, table

#: A passage has so many letters and digits at least; a case has this share of its letters and digits in repeated ones.
PASSAGE, CASE_SHARE = 12, 0.4
#: Documents that the list is learned from: those least by hash of their key.
SAMPLE, SAMPLE_PARTS = 4_000, 16
#: Characters of the short runs of the cheap statistics; a text of more than UNSPACED characters a word is in a script without spaces.
GRAM, UNSPACED = 6, 12
#: A rule may call so many documents that aren't cases, for each that is: what an exact check behind it costs against what a miss costs.
FALSE_PER_TRUE = 1.0

FEATURES = ["word_share", "pair_share", "gram_share", "size"]


def letters(text: str) -> str:
    """The letters and decimal digits of ``text`` in lower case."""
    low = text.lower()
    if low.isascii():
        return "".join(c for c in low if c.isalnum())
    return "".join(c for c in low if c.isalpha() or unicodedata.category(c) == "Nd")


def exact(text: str | None, passage: int = PASSAGE) -> tuple[int, float]:
    """(letters and digits, share of them repeated): the definition.

    A gram of ``passage`` letters is repeated if the same gram stood before without overlapping it; the letters of repeated
    grams are repeated. Any longer passage that stood before consists of such grams, so this is the share of all passages.
    """
    s = letters(text or "")
    n = len(s)
    if n < 2 * passage:
        return n, 0.0
    first: dict[str, int] = {}
    covered = to = 0
    for i in range(n - passage + 1):
        if first.setdefault(s[i : i + passage], i) + passage <= i:
            covered += i + passage - max(to, i)
            to = i + passage
    return n, covered / n


def with_features(df: DataFrame, text: str) -> DataFrame:
    """``df`` with FEATURES: shares of words, of pairs of words and of short runs of characters that occurred before, log of size.

    Runs of characters are looked at only where white space parts few words, pairs of words elsewhere. Expressions only. Null and empty
    texts have 0 of all.
    """
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    df = once(df, _words=F.filter(F.split(low, r"[^\p{L}\p{Nd}]+"), lambda w: w != ""), _low=low)
    unspaced = F.length("_low") > UNSPACED * F.size(F.split("_low", r"\s+"))
    df = once(df, _chars=F.when(unspaced, F.split(F.regexp_replace("_low", r"[^\p{L}\p{Nd}]", ""), "")).otherwise(F.array().cast("array<string>")), _spaced=~unspaced)
    run = "concat(" + ", ".join(f"_chars[i + {k}]" for k in range(GRAM)) + ")"
    runs = F.expr(f"IF(size(_chars) < {GRAM}, array(), transform(sequence(0, greatest(size(_chars) - {GRAM}, 0)), i -> {run}))")
    pairs = F.expr("IF(_spaced AND size(_words) > 1, transform(sequence(0, greatest(size(_words) - 2, 0)), i -> concat(_words[i], ' ', _words[i + 1])), array())")
    again = lambda x: F.when(F.size(x) > 1, F.lit(1.0) - F.size(F.array_distinct(x)) / F.size(x)).otherwise(F.lit(0.0))
    df = once(df, _runs=runs, _pairs=pairs)
    df = df.select("*", again("_words").alias("word_share"), again("_pairs").alias("pair_share"), again("_runs").alias("gram_share"), F.log1p(F.length("_low").cast("double")).alias("size"))
    return df.drop("_words", "_low", "_chars", "_spaced", "_runs", "_pairs")


def with_shares(df: DataFrame, keys: list[str], text: str, passage: int = PASSAGE) -> DataFrame:
    """keys, ``n_letters`` and ``share`` of every row by the definition, of whole texts; null and empty texts have 0. Repeated rows stay."""
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = pd.DataFrame([exact(t, passage) for t in pdf[text]], columns=["n_letters", "share"])
            yield pd.concat([pdf.drop(columns=text).reset_index(drop=True), found], axis=1)

    return df.select(*keys, text).mapInPandas(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n_letters int, share double")


Rule = list[tuple[str, float]]


def learn(rows: pd.DataFrame, label: str, features: list[str], most_rules: int = 8, most_terms: int = 3, per_true: float = FALSE_PER_TRUE) -> list[Rule] | None:
    """Decision list by sequential covering: conjunctions of ``feature > threshold``, for the label true.

    A rule grows by the term that leaves the most positives among those that bring it down to ``per_true`` negatives a positive, else by
    the one that leaves the fewest negatives a positive, and is pruned of terms that it stays within that bound without. Thresholds are as low as the
    bound allows, so that a rule claims the room below the positives it has seen. Without a positive or without a negative nothing is learned: None.
    """
    rest = rows[[*features, label]]
    if rest.empty or rest[label].all() or not rest[label].any():
        return None
    negatives, positives = rest[~rest[label]], rest[rest[label]]
    rules: list[Rule] = []
    while len(positives) and len(rules) < most_rules:
        rule: Rule = []
        pos, neg = positives, negatives
        while len(neg) > per_true * len(pos) and len(rule) < most_terms:
            best = None
            for f in features:
                p, n = np.sort(pos[f].to_numpy()), np.sort(neg[f].to_numpy())
                for t in np.unique(np.concatenate([n, [-np.inf]])):
                    np_, nn = len(p) - np.searchsorted(p, t, "right"), len(n) - np.searchsorted(n, t, "right")
                    if np_:
                        within = nn <= per_true * np_
                        score = (within, np_ if within else np_ / (np_ + nn), nn if within else -nn)
                        if best is None or score > best[0]:
                            best = (score, f, float(t))
            if best is None or best[2] == -np.inf:
                break
            _, f, t = best
            rule.append((f, t))
            pos, neg = pos[pos[f] > t], neg[neg[f] > t]
        if not rule or len(pos) == 0:
            break
        holds = lambda d, r: d[pd.concat([d[f] > t for f, t in r], axis=1).all(axis=1)]
        for term in list(rule):
            shorter = [x for x in rule if x != term]
            if shorter and len(holds(negatives, shorter)) <= per_true * len(holds(positives, shorter)):
                rule = shorter
        rules.append(rule)
        positives = positives.drop(holds(positives, rule).index)
    return rules


def as_expression(rules: list[Rule] | None) -> Column:
    """Number of the first rule that holds (from 1), 0 if none; where nothing was learned every row gets 1."""
    if rules is None:
        return F.lit(1)
    out = F.lit(0)
    for k, rule in reversed(list(enumerate(rules, 1))):
        holds = F.lit(True)
        for f, t in rule:
            holds = holds & (F.col(f) > t)
        out = F.when(holds, F.lit(k)).otherwise(out)
    return out


def judged(df: DataFrame, keys: list[str], text: str, passage: int = PASSAGE, case_share: float = CASE_SHARE, sample: int = SAMPLE) -> DataFrame:
    """keys, text, FEATURES and ``rule``, the decision list's verdict (0: not repetitive), of every row.

    The list is learned from ``sample`` documents at most, which are labelled by the definition; features and verdicts cover all.
    """
    drawn = df.select(*keys, text).orderBy(F.xxhash64(*keys), *keys).limit(sample)
    rows = with_shares(with_features(settle(drawn.select(F.col(text).alias("_text")).repartition(SAMPLE_PARTS)), "_text"), FEATURES, "_text", passage).toPandas()
    rows["repetitive"] = rows["share"] >= case_share
    return with_features(df.select(*keys, text), text).withColumn("rule", as_expression(learn(rows, "repetitive", FEATURES)))


def repetitive(df: DataFrame, keys: list[str], text: str, passage: int = PASSAGE, case_share: float = CASE_SHARE, sample: int = SAMPLE) -> DataFrame:
    """keys, ``n_letters``, ``share`` of the rows that the decision list calls repetitive and the definition confirms.

    Only rows that the list calls are read by the exact pass; a case that no rule calls is missed. Null and empty texts are no cases.
    """
    called = judged(df, keys, text, passage, case_share, sample).where(F.col("rule") > 0)
    return with_shares(called, keys, text, passage).where(F.col("share") >= case_share)


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(table(spark, sf_dir, "segments").select("video_id", "seg_idx", "texto", "loaded_at"), ["video_id", "seg_idx"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the list calls repetitive and the definition confirms."""
    return repetitive(_segments(spark, sf_dir), ["video_id", "seg_idx"], "texto").select("video_id", "seg_idx")


def p3_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of every segment; the list isn't needed where all are measured."""
    out = with_shares(_segments(spark, sf_dir), ["video_id", "seg_idx"], "texto")
    return out.select("video_id", "seg_idx", F.col("n_letters").cast("bigint").alias("n_letters"), F.round("share", 6).alias("share"))


_SHARES = r"""
WITH cur AS (SELECT video_id, seg_idx, regexp_replace(lower(coalesce(texto, '')), '[^\p{L}\p{Nd}]', '', 'g') AS s FROM segments
  QUALIFY row_number() OVER (PARTITION BY video_id, seg_idx ORDER BY loaded_at DESC) = 1),
grams AS (SELECT video_id, seg_idx, i, substr(s, CAST(i AS INT), 12) AS g FROM cur, unnest(generate_series(1, length(s) - 11)) AS t(i)),
repeated AS (SELECT *, min(i) OVER (PARTITION BY video_id, seg_idx, g) AS f FROM grams),
covered AS (SELECT DISTINCT video_id, seg_idx, i + k AS at FROM repeated, unnest(generate_series(0, 11)) AS u(k) WHERE f + 12 <= i),
counted AS (SELECT video_id, seg_idx, count(*) AS c FROM covered GROUP BY ALL),
shares AS (SELECT cur.video_id, cur.seg_idx, length(s) AS n, CASE WHEN length(s) = 0 THEN 0 ELSE coalesce(c, 0) / CAST(length(s) AS DOUBLE) END AS share
  FROM cur LEFT JOIN counted ON cur.video_id = counted.video_id AND cur.seg_idx = counted.seg_idx)
"""

QUERIES = {"p3_found": p3_found, "p3_shares": p3_shares}
SQL = {
    "p3_found": _SHARES + "SELECT video_id, seg_idx FROM shares WHERE share >= 0.4",
    "p3_shares": _SHARES + "SELECT video_id, seg_idx, n AS n_letters, round(share, 6) AS share FROM shares",
}
