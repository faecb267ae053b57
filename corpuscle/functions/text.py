"""Column functions over text: tokens, markers, ids, thresholds, readability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bracketed music and applause tags, in English and Portuguese.
MARKER = r"(?i)\[(m[uúÚ]sica|music|aplausos|applause)\]"
#: White space as Unicode has it, in a form that Java and RE2 share.
WHITE = r"[\s\x{B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
LONG_FORM_S, MATURE_DAYS, WORDS_PER_MINUTE = 180, 182, 150
# Phrases of a call to action.
CTA_PHRASES = ["link in the description", "let me know in the comments", "let us know in the comments"]


def tokens(text: Column | str) -> Column:
    """White-space separated tokens; null text has none."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(c, F.lit("")), WHITE), lambda x: x != "")


def word_count(text: Column | str) -> Column:
    return F.size(tokens(text)).cast("bigint")


def strip_markers(text: Column | str, marker: str = MARKER) -> Column:
    """Without marker tags, white space made single."""
    c = F.col(text) if isinstance(text, str) else text
    return F.trim(F.regexp_replace(F.regexp_replace(c, marker, ""), WHITE, " "))


def expected_words(duration_s: Column, wpm: int = WORDS_PER_MINUTE) -> Column:
    return duration_s / F.lit(60.0) * F.lit(float(wpm))


def display_id(video: Column, window: Column) -> Column:
    """First 8 hex digits of SHA-1 of video:window."""
    return F.substring(F.sha1(F.concat_ws(":", video, window)), 1, 8)


def numbered_id(owner: Column, kind: str, number: Column) -> Column:
    """owner:k0001, at least four digits."""
    return F.format_string(f"%s:{kind}%04d", owner, number)


def position(start_s: Column, duration_s: Column) -> Column:
    """Share of the duration before a start; null where the duration is null or 0."""
    return F.when(duration_s != 0, start_s / duration_s)


def contains_any(text: Column, phrases: list[str]) -> Column:
    low, out = F.lower(F.coalesce(text, F.lit(""))), F.lit(False)
    for p in phrases:
        out = out | low.contains(p)
    return out


def syllables(text: Column) -> Column:
    """Vowel groups."""
    return F.size(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[aeiouy]+"), F.lit(0))).cast("bigint")


def reading_ease(words: Column, sentences: Column, syllables_: Column) -> Column:
    """Flesch reading ease; null without words or sentences."""
    w, s, y = words.cast("double"), sentences.cast("double"), syllables_.cast("double")
    return F.when((w > 0) & (s > 0), F.lit(206.835) - F.lit(1.015) * (w / s) - F.lit(84.6) * (y / w))
