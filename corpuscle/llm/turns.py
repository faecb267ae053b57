"""Problem 5: raw caption fragments become clean, ordered speaker turns.

Line templates are mined first. A lexer that knows words, numbers and symbols, but no label and no time stamp, lays every place that
could be a slot into a token tree of fixed depth: the symbols before the slot, the shape of what fills it, the symbols behind it. What a slot
means follows from its fillers over all lines: a number slot whose values agree with the fragments' own start times is a time stamp, a word slot
that members of the channel's cast fill is a speaker label. Only slots of such templates are taken out of the lines.
Words then follow the voice at hand, in order of start; a voice's words up to another voice's words are one turn.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.operators.sequence import last_known, null_safe, running_sum
from corpuscle.session import settle
from corpuscle.sources.tables import current_rows, table

#: Tokens that a slot can hold, and symbols or words that a template keeps on either side of it.
DEPTH, SIDE = 4, 6
#: A time stamp may differ from the fragment's start by so many seconds; a stamp slot needs this share of fillers that fit.
STAMP_S, STAMP_SHARE = 2.0, 0.5
#: A speaker slot may share its template with sound notes, and a cast name doesn't stand in a slot by chance.
LABEL_SHARE = 0.05
#: Rows (by seconds of start) of a block.
BLOCK_S = 600
#: Layouts are bounded by their alphabet and depth; more accepted ones than this are an error, not a truncation.
MOST_LAYOUTS = 10_000
#: Casts of up to so many bytes are broadcast, larger ones are joined.
MOST_CAST_BYTES = 16 << 20

# Hesitation sounds. UM is a word in some languages and a sound in others.
HESITATION = re.compile(
    r"(?:u+h+m*|u+m{2,}|h+m+|m{2,}h*m*|m+h+m+|e+r+m+|a+h+|a+hn+|h+ã+n*|h+u+m+|é{2,}|e+h+|e+h+m+|e+u+h+|h+e+u+|ä+h+m*|ö+h+m*|uhum|"
    r"え[ーえ]+と?|えっと|あの[ーう]+|う[ーう]+ん|嗯+|呃+|唔+|अं+|उम्+|हम्म+|เอ่อ+|อืม+|อ่า+|آه+|ام+م|إم+م|ا?مم+)",
    re.IGNORECASE,
)
#: Frequent words that only languages with the word UM have, and those of the other languages in Latin letters.
UM_WORDS = "não nada você uma do da os é já foi em ninguém até mais pelo pela isso der die das und nicht ist wir zur mit wie ein eine sich auch für von war er dem den".split()
OTHER_WORDS = "the and of was that it with you they this from el los las y hay una sin nadie muy pero le les et est dans une pas rien plus ce".split()
_UM_WORDS, _OTHER_WORDS = set(UM_WORDS), set(OTHER_WORDS)
ROLES = ("host", "guest", "narrator", "expert")

NOTE = re.compile(r"\[[^\[\]]+\]|\([^()]+\)|<[^<>]+>|\*[^*\s][^*]*\*|【[^】]+】|（[^（）]+）|♪[^♪]*♪|[♪♫]")
_NOTES = re.compile(r"[\[(<*【（♪♫]")

# The lexer: a word (with what joins words, a numbered suffix and the stop of an initial), a number (groups with what joins them), symbols.
_WORD = r"[^\W\d_][\w'’-]*\.?"
_SYMBOL = r"[\p{P}\p{S}]"
#: A place for a number: at the head of a line only, with the symbols around it and a joining symbol behind it.
NUMBER_SLOT = regex.compile(rf"\s*(?P<left>{_SYMBOL}*)\s?(?P<slot>\d+(?:[^\s\d\[\](){{}}<>]{{1,2}}\d+)*)(?P<unit>[^\W\d_]{{0,3}})(?P<right>{_SYMBOL}*)(?P<tail>\s+(?!>+(?:\s|$))[\p{{Pd}}\p{{Sm}}|:]+)?(?=\s|$)\s*")
#: A place for words: a run of them between symbols, or up to symbols that aren't just the stops and commas of speech.
WORD_SLOT = regex.compile(
    rf"(?P<left>(?:{_SYMBOL}+\s?)*)(?:(?<={_SYMBOL})(?P<lead>[^\W\d_]\s))?(?<![\w'’-])(?P<slot>{_WORD}(?:\s{_WORD}){{0,{DEPTH - 1}}})"
    rf"(?P<right>(?:\s?\((?P<aside>[^()\s]+)\))?(?!\s?[\p{{Ps}}\p{{Pi}}<])(?!\s[*♪\"])\s?(?![.,!?…;'’\"”]+(?:\s|$)){_SYMBOL}+)"
)
_SIGNS = regex.compile(r"(?![.,!?…;'’\"”-])[\p{P}\p{S}]")
CHANGE = re.compile(r">>+\s*")
WORD = re.compile(r"[^\W_]+", re.UNICODE)


def mask(text: str) -> str:
    """Letters and digits of a text by class, DEPTH tokens at most: AA upper, Aa title, a lower, 9 digits; symbols stay."""
    text = " ".join(text.split(None, DEPTH)[:DEPTH])
    text = re.sub(r"[^\W\d_]+", lambda m: "AA" if m[0].isupper() and len(m[0]) > 1 else "A" if m[0].isupper() else "Aa" if m[0][0].isupper() else "a", text)
    return re.sub(r"\d+", "9", text)


def path(kind: str, left: str, slot: str, right: str) -> str:
    """A leaf of the token tree: symbols before the slot, shape of the slot, symbols behind it."""
    return f"{kind} {mask(left.strip())[-SIDE:]}|{mask(slot)}|{mask(right.strip())[:SIDE]}"


def near(a: str, b: str) -> bool:
    """One letter put in, left out, changed or swapped with its neighbour."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]
    return a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


class Cast:
    """Who a label names, in one channel."""

    def __init__(self, members: tuple[tuple[str, str, str, str], ...]):
        self.exact: dict[str, set[str]] = {}
        self.initials: dict[str, set[str]] = {}
        self.long: dict[str, set[str]] = {}
        self.narrator = None
        for speaker, name, role, diar in members:
            parts = (name or "").lower().split()
            forms = {(diar or "").lower(), (role or "").lower(), " ".join(parts)}
            if len(parts) > 1:
                forms |= {parts[0], parts[-1], f"{parts[0][0]}. {parts[-1]}", f"{parts[0][0]} {parts[-1]}", f"{parts[0]} {parts[-1][0]}."}
                self.initials.setdefault("".join(p[0] for p in parts).upper(), set()).add(speaker)
            for f in forms - {""}:
                self.exact.setdefault(f, set()).add(speaker)
                if len(f) > 3:
                    self.long.setdefault(f, set()).add(speaker)
            if (role or "").lower() == "narrator" and (self.narrator is None or speaker < self.narrator):
                self.narrator = speaker
        self.cache: dict[str, str | None] = {}

    def _find(self, label: str) -> str | None:
        key = " ".join(label.lower().split())
        for book, k in ((self.exact, key), (self.initials, label.strip().replace(".", "").replace(" ", ""))):
            if len(found := book.get(k, ())) == 1:
                return next(iter(found))
        if len(key) > 4 and key not in self.exact:
            found = {s for f, who in self.long.items() if near(key, f) for s in who}
            if len(found) == 1:
                return next(iter(found))
        return None

    def find(self, label: str) -> str | None:
        if label not in self.cache:
            if len(self.cache) > 50_000:
                self.cache.clear()
            self.cache[label] = self._find(label)
        return self.cache[label]


@lru_cache(maxsize=10_000)
def cast_of(members: str | None) -> Cast:
    """The cast written as a JSON list of (speaker_id, full_name, role, diar_label)."""
    return Cast(tuple(tuple(x or "" for x in m) for m in json.loads(members)) if members else ())


def readings(groups: list[int], fraction: float) -> Iterator[float]:
    """Seconds that the groups of a number may mean: in sixties, in sixties with a fraction, as they stand or in thousandths."""
    value = 0
    for g in groups:
        value = value * 60 + g
    yield value
    if len(groups) > 1:
        yield (value - groups[-1]) / 60 + fraction
    else:
        yield groups[0] / 1000


def stamp(text: str, start: float | None) -> tuple[str, int, bool] | None:
    """(template, where the text after it begins, whether the slot tells the start) of the number at the head of a line."""
    m = NUMBER_SLOT.match(text)
    if not m:
        return None
    digits = re.findall(r"\d+", m["slot"])
    fits = False
    if start is not None and len(digits) <= 4 and all(len(d) < 12 for d in digits):
        fits = any(abs(x - start) <= STAMP_S for x in readings([int(d) for d in digits], float("0." + digits[-1])))
    return path("T", m["left"], m["slot"] + m["unit"], m["right"] + (m["tail"] or "")), m.end(), fits


def labels(text: str, cast: Cast) -> Iterator[tuple[str, int, int, str | None]]:
    """(template, begin, end, speaker or None) of every place for words.

    The words of a slot are the last ones before its symbols that name somebody; words before those are speech.
    """
    if not _SIGNS.search(text):
        return
    at = 0
    while m := WORD_SLOT.search(text, at):
        begin, end = m.span()
        at = end
        base, left, lead = m.start("slot"), m["left"], m["lead"] or ""
        words = list(re.finditer(r"\S+", m["slot"]))
        found = None
        enclosed = left[-1:].strip() != "" or bool(lead)
        for take in (len(words),) if enclosed else (2, 1, 3):
            if take <= len(words):
                s = words[-take].start()
                name = m["slot"][s:]
                # A role's bare name in brackets is a remark on the speaker named outside them.
                who = None if enclosed and not lead and name.islower() and name in ROLES else cast.find(name)
                if who is None and s == 0 and m["aside"] and m["aside"].lower() in ROLES:
                    who = cast.find(m["aside"])
                if who is not None:
                    found = (s, who)
                    break
        if found is None:
            yield path("L", left + lead, m["slot"], m["right"]), begin, end, None
        elif found[0] == 0:
            yield path("L", left + lead, m["slot"], m["right"]), begin, end, found[1]
        else:
            yield path("L", "", m["slot"][found[0] :], m["right"]), base + found[0], end, found[1]


def mine(text: str, start: float | None, cast: Cast) -> Iterator[tuple[str, bool]]:
    """(layout, whether its slot fits) of every stamp and label of a line."""
    at = 0
    if found := stamp(text, start):
        yield found[0], found[2]
        at = found[1]
    for layout, _, _, who in labels(text[at:], cast):
        yield layout, who is not None


def clean(text: str, um_is_a_word: bool | None = None) -> tuple[str, bool]:
    """Speech without sound notes and hesitation sounds, and whether words are left.

    Whether UM is a word is a matter of the video's language; only where that isn't told do the words of the line decide. Alone it is a sound.
    """
    def note(m: re.Match) -> str:
        inner = WORD.findall(m[0])
        # Square brackets are a transcriber's, whatever their length; between other marks long text can be speech.
        return " " if (m[0][0] in "[【" or len(inner) <= 3) and not any(c.isdigit() for c in m[0]) else m[0]

    if _NOTES.search(text):
        text = NOTE.sub(note, text)
    words = WORD.findall(text)
    if not words:
        return "", False
    low = {w.lower() for w in words}
    word = len(low & _UM_WORDS) > len(low & _OTHER_WORDS) if um_is_a_word is None else um_is_a_word
    um = "um" in low and (not word or all(w == "um" or HESITATION.fullmatch(w) for w in low))
    if not any(HESITATION.fullmatch(w) for w in low) and not um:
        return " ".join(text.split()), True
    out = []
    for t in text.split():
        core = "".join(WORD.findall(t))
        if core and (HESITATION.fullmatch(core) or um and core.lower() == "um"):
            continue
        out.append(t)
    text = " ".join(out)
    return (text, True) if WORD.search(text) else ("", False)


def units(text: str | None, start: float | None, cast: Cast, layouts: frozenset[str], um_is_a_word: bool | None = None) -> list[tuple[str | None, bool, str, bool]]:
    """(speaker named, whether the voice changes without a name, text, whether it has words), in order."""
    if not text:
        return []
    if (found := stamp(text, start)) and found[0] in layouts:
        text = text[found[1] :]
    cuts: list[tuple[int, int, str | None, bool]] = [(b, e, who, False) for layout, b, e, who in labels(text, cast) if who is not None and layout in layouts]
    for m in CHANGE.finditer(text):
        if not any(b <= m.start() < e for b, e, _, _ in cuts) and text[max(0, m.start() - 2) : m.start()] != "--":
            cuts.append((*m.span(), None, True))
    cuts.sort()
    out = []
    parts = [(None, False, 0)] + [(who, change, e) for _, e, who, change in cuts]
    ends = [b for b, _, _, _ in cuts] + [len(text)]
    for (who, change, b), e in zip(parts, ends):
        words, some = clean(text[b:e], um_is_a_word)
        if who or change or some:
            out.append((who, change, words, some))
    return out


class Casts:
    """The casts of all channels: a broadcast where they are small, else JSON joined to every row (``cast``)."""

    def __init__(self, shared):
        self.shared = shared

    def of(self, pdf: pd.DataFrame) -> Iterator[Cast]:
        if self.shared is None:
            return (cast_of(c) for c in pdf["cast"])
        known = self.shared.value
        return (cast_of(known.get(None if pd.isna(c) else c)) for c in pdf["channel"])


def _prepared(fragments: DataFrame, speakers: DataFrame) -> tuple[DataFrame, Casts]:
    rows = current_rows(fragments.select("video_id", "frag_idx", "channel", F.col("start").cast("double").alias("start"), F.col("text").cast("string").alias("text"), "loaded_at"), ["video_id", "frag_idx"]).drop("loaded_at")
    cast = settle(speakers.where("speaker_id is not null").groupBy(F.col("channel").alias("_ch")).agg(F.to_json(F.array_sort(F.collect_set(F.array("speaker_id", "full_name", "role", "diar_label")))).alias("cast")))
    if (cast.agg(F.sum(F.octet_length("cast")).alias("n")).first().n or 0) <= MOST_CAST_BYTES:
        shared = fragments.sparkSession.sparkContext.broadcast({r._ch: r.cast for r in cast.collect()})
        return rows.withColumn("cast", F.lit(None).cast("string")), Casts(shared)
    return rows.join(cast, F.col("channel").eqNullSafe(F.col("_ch")), "left").drop("_ch"), Casts(None)


def mined_layouts(prepared: DataFrame, casts: Casts) -> DataFrame:
    """layout, n, fit: every leaf of the token tree with how often its slot's filler fits, a time or a member of the cast."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen, fits = Counter(), Counter()
            for text, start, cast in zip(pdf["text"], pdf["start"], casts.of(pdf)):
                if text:
                    for layout, fit in mine(text, None if pd.isna(start) else start, cast):
                        seen[layout] += 1
                        fits[layout] += fit
            yield pd.DataFrame({"layout": list(seen), "n": list(seen.values()), "fit": [fits[k] for k in seen]}).astype({"layout": "object", "n": "int64", "fit": "int64"})

    return prepared.select("text", "start", "channel", "cast").mapInPandas(run, "layout string, n bigint, fit bigint").groupBy("layout").agg(F.sum("n").alias("n"), F.sum("fit").alias("fit"))


def _um_videos(prepared: DataFrame) -> DataFrame:
    """_v, ``um``: whether UM is a word in the video's language, by frequent words of all its lines; null where they don't tell."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    hits = lambda of: F.sum(F.size(F.filter(words, lambda w: w.isin(of))))
    n = prepared.where("text is not null").groupBy(F.col("video_id").alias("_v")).agg(hits(UM_WORDS).alias("_u"), hits(OTHER_WORDS).alias("_o"))
    return n.select("_v", F.when(F.col("_u") != F.col("_o"), F.col("_u") > F.col("_o")).alias("um"))


def spoken(fragments: DataFrame, speakers: DataFrame) -> DataFrame:
    """Units of speech with words, each with its voice, in any order.

    Columns: video_id, channel, ``_block``, ``at`` (start, null first), frag_idx, unit, speaker_id, start, text. Rows are the current ones of
    fragments; null and blank texts say nothing. Speech before any label is the narrator's (null if the channel has none).
    ``>>`` without a name changes to the other of the video's two voices: of the two named ones, or of the named one and
    the narrator; with more voices, to the one named before. A null start comes first, equal starts go by frag_idx.
    """
    prepared, casts = _prepared(fragments, speakers)
    prepared = settle(prepared)
    good = mined_layouts(prepared, casts).where("fit > 0").where(F.col("fit") >= F.col("n") * F.when(F.col("layout").startswith("T "), STAMP_SHARE).otherwise(LABEL_SHARE)).select("layout").limit(MOST_LAYOUTS + 1).collect()
    if len(good) > MOST_LAYOUTS:
        raise ValueError("more layouts than lines can have")
    layouts = frozenset(r.layout for r in good)

    prepared = prepared.join(_um_videos(prepared), null_safe(["video_id"], ["_v"]), "left").drop("_v")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for video, frag, start, text, who, um in zip(pdf["video_id"], pdf["frag_idx"], pdf["start"], pdf["text"], casts.of(pdf), pdf["um"]):
                at = None if pd.isna(start) else start
                for k, (name, change, words, some) in enumerate(units(text, at, who, layouts, None if pd.isna(um) else bool(um))):
                    out.append((video, frag, at, k, name, int(change), words if some else None, who.narrator))
            yield pd.DataFrame(out, columns=["video_id", "frag_idx", "start", "unit", "named", "change", "text", "narrator"])

    kinds = dict(prepared.dtypes)
    schema = f"video_id {kinds['video_id']}, frag_idx {kinds['frag_idx']}, start double, unit int, named string, change int, text string, narrator string"
    parsed = prepared.select("video_id", "frag_idx", "start", "text", "channel", "cast", "um").mapInPandas(parse, schema)
    at = F.coalesce("start", F.lit(float("-inf")))
    parsed = settle(parsed.withColumn("at", at).withColumn("_block", F.coalesce(F.floor(F.col("start") / BLOCK_S), F.lit(-(1 << 40))).cast("bigint")))

    order, entity = ["at", "frag_idx", "unit"], ["video_id"]
    counted = running_sum(parsed, entity, "_block", order, F.col("change").cast("bigint"), "_changes")
    last = F.when(F.col("named").isNotNull(), F.struct("named", "_changes"))
    known = last_known(counted, entity, "_block", order, last, "_last")
    voices = parsed.groupBy(F.col("video_id").alias("_v")).agg(F.array_sort(F.collect_set("named")).alias("_voices"), F.max("change").alias("_any"))
    voices = voices.where("_any = 1").select("_v", "_voices")
    known = known.join(voices, null_safe(["video_id"], ["_v"]), "left").drop("_v")
    base = F.coalesce("_last.named", "narrator")
    odd = (F.col("_changes") - F.coalesce("_last._changes", F.lit(0))) % 2 == 1
    others = F.array_except(F.when(F.size("_voices") >= 2, F.col("_voices")).otherwise(F.array_union("_voices", F.array("narrator"))), F.array(base))
    other = F.coalesce(F.get(others, F.lit(0)), base)
    voiced = known.withColumn("speaker_id", F.when(odd & F.col("_voices").isNotNull(), other).otherwise(base))
    return voiced.where(F.col("text").isNotNull()).select("video_id", "_block", "at", "frag_idx", "unit", "start", "speaker_id", "text")


def turn_starts(fragments: DataFrame, speakers: DataFrame) -> DataFrame:
    """``spoken`` with ``new``: whether the unit begins a turn."""
    rows = spoken(fragments, speakers).withColumn("_who", F.struct(F.col("speaker_id").alias("id")))
    before = last_known(rows, ["video_id"], "_block", ["at", "frag_idx", "unit"], F.col("_who"), "_before", inclusive=False)
    return before.withColumn("new", F.col("_before").isNull() | ~F.col("_before.id").eqNullSafe(F.col("speaker_id"))).drop("_who", "_before")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = turn_starts(table(spark, sf_dir, "fragments"), table(spark, sf_dir, "speakers"))
    return marks.where("new").select("video_id", "frag_idx", "speaker_id")


def turns(fragments: DataFrame, speakers: DataFrame) -> DataFrame:
    """Turns: video_id, ``turn`` (from 0), speaker_id, frag_idx of the first word, start_s, end_s, n_fragments, text.

    A turn ends where its last fragment ends: at start plus duration, the start itself where the duration is null or negative.
    """
    ends = current_rows(fragments.select("video_id", "frag_idx", "start", "duration", "loaded_at"), ["video_id", "frag_idx"])
    ends = ends.select(F.col("video_id").alias("_v"), F.col("frag_idx").alias("_f"), (F.col("start") + F.greatest(F.coalesce("duration", F.lit(0.0)), F.lit(0.0))).alias("_end"))
    marks = settle(turn_starts(fragments, speakers))
    order = ["at", "frag_idx", "unit"]
    numbered = running_sum(marks, ["video_id"], "_block", order, F.col("new").cast("bigint"), "_turn")
    numbered = numbered.join(ends, null_safe(["video_id", "frag_idx"], ["_v", "_f"]), "left")
    part = F.struct(*order, "text")
    out = numbered.groupBy("video_id", "_turn").agg(
        F.max("speaker_id").alias("speaker_id"), F.min(F.struct(*order)).alias("_first"), F.min("start").alias("start_s"), F.max("_end").alias("end_s"), F.countDistinct("frag_idx").alias("n_fragments"), F.array_sort(F.collect_list(part)).alias("_parts")
    )
    return out.select("video_id", (F.col("_turn") - 1).alias("turn"), "speaker_id", F.col("_first.frag_idx").alias("frag_idx"), "start_s", "end_s", "n_fragments", F.array_join(F.transform("_parts", lambda p: p["text"]), " ").alias("text"))


def p5_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(table(spark, sf_dir, "fragments"), table(spark, sf_dir, "speakers"))


def p5_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined_layouts(*_prepared(table(spark, sf_dir, "fragments"), table(spark, sf_dir, "speakers")))


QUERIES = {"p5_found": p5_found, "p5_turns": p5_turns, "p5_layouts": p5_layouts}
SQL: dict[str, str] = {}
