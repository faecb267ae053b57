"""Sentence ends as a finite transducer over boundary events.

A text is scanned once for events: closing marks, quotation marks, line breaks, Thai closing particles. The transducer's
state says in which kind of quotation the text is, and how many statements that quotation already held, so a quotation that
doesn't close is given up after MOST_QUOTED statements. A chunk of text is thereby a function from the state before it to the
state after it, with the ends it emits for each state before; such functions compose, so chunks are scanned independently.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from corpuscle.llm.languages import FREQUENT

# Words before a full stop that don't end a sentence, by language, and German months after an ordinal.
TITLES = {
    "en": {"mr", "mrs", "ms", "dr", "prof", "st", "rev", "gen", "capt", "sgt", "lt", "col", "hon", "jr", "sr"},
    "pt": {"sr", "sra", "srta", "dr", "dra", "prof", "profa", "d"},
    "es": {"sr", "sra", "srta", "dr", "dra", "prof", "d", "dña"},
    "fr": {"m", "mm", "mme", "mlle", "me", "dr", "prof", "st"},
    "de": {"dr", "prof", "hr", "fr", "frl", "herr", "st"},
    "hi": {"डॉ", "श्री"},
    "ar": {"د", "أ"},
}
SHORT = {
    "en": {"approx", "vs", "e.g", "i.e", "cf", "fig", "figs", "vol", "ch", "pp", "ed", "eds", "est", "dept", "ca", "viz", "al", "etc"},
    "pt": {"aprox", "séc", "pág", "págs", "ex", "p.ex", "núm", "art", "cap", "av", "vol", "etc"},
    "es": {"aprox", "pág", "págs", "ej", "p.ej", "núm", "art", "cap", "av", "vol", "etc"},
    "fr": {"env", "chap", "éd", "art", "av", "cf", "vol", "etc"},
    "de": {"bzw", "ca", "z.b", "d.h", "u.a", "nr", "bd", "abb", "vgl", "usw", "etc"},
    "hi": {"पृ", "सं"},
    "ar": {"ص", "ج"},
}
# Abbreviations that are words of some language too: written small and before a capital letter they end a sentence.
ALSO_WORDS = {"ed", "art", "ex", "cap", "est", "ch", "ca", "me", "env"}
NUMBERED = {"no", "nos", "nº", "n"}
CLOCK = {"a.m", "p.m", "u.s", "u.k", "d.c"}
MONTHS = {"Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"}

#: Kinds of quotation; the low one is opened by „ and closed by “.
KINDS = ("double", "low", "single", "angle", "corner", "dash")
MOST_QUOTED = 10
OUT = 0
N_STATES = 1 + len(KINDS) * MOST_QUOTED


def _in(kind: int, held: int = 0) -> int:
    return 1 + kind * MOST_QUOTED + held


DOUBLE, LOW, SINGLE, ANGLE, CORNER, DASH = range(len(KINDS))
#: Event classes: open kind k, close kind k, the mark “ that opens double or closes low, an end of a statement, a blank line.
OPEN, CLOSE, CURLY, STATEMENT, BLANK = 0, len(KINDS), 2 * len(KINDS), 2 * len(KINDS) + 1, 2 * len(KINDS) + 2


IDENTITY = list(range(N_STATES))

# What follows a possible end, of the same row or at the beginning of the next one.
LOWER, UPPER, DIGIT, CASELESS, OPENING, JOINING, NOTHING = range(7)

FULL = "。！？।॥؟۔"
MARKS = ".!?…" + FULL
#: No abbreviation is longer, so no more is looked at before a stop.
LONGEST_WORD = 64


@lru_cache(maxsize=None)
def abbreviations(lang: str | None) -> frozenset[str]:
    """Words before a full stop that don't end a sentence: those of the language, of all languages where it isn't known. Other scripts' always count."""
    own = [lang] if lang in FREQUENT else list(FREQUENT) if lang is None else []
    return frozenset().union(*(x.get(k, set()) for x in (TITLES, SHORT) for k in [*own, "hi", "ar"]))
CLOSERS = "\"”’»)]）」』'】〕“"
OPENERS = "\"“„«(［[（「『'‘¿¡—–-•*#"
EVENT = re.compile(rf"(?P<mark>[{MARKS}](?:[   ]?[{MARKS}])*|[   ][!?](?=\s|$|[»”\"]))|(?P<line>[^\S\n]*\n\s*)|(?P<thai>(?:ครับ|ค่ะ|คะ)(?=\s|$))|(?P<quote>[\"“”„«»「」『』'‘’])|(?P<dash>[—–](?=\s|$))")
QUOTES = {"“": CURLY, "”": CLOSE + DOUBLE, "„": OPEN + LOW, "«": OPEN + ANGLE, "»": CLOSE + ANGLE, "「": OPEN + CORNER, "『": OPEN + CORNER, "」": CLOSE + CORNER, "』": CLOSE + CORNER, "‘": OPEN + SINGLE}


def follows(ch: str) -> int:
    """Class of the first character after a possible end."""
    if not ch:
        return NOTHING
    if ch.islower():
        return LOWER
    if ch.isupper() or ch.istitle():
        return UPPER
    if ch.isdigit():
        return DIGIT
    if ch in ",;:،؛、，；：)]）」』”»/%":
        return JOINING
    if unicodedata.category(ch)[0] in "LM":
        return CASELESS
    return OPENING


def _word_before(text: str, i: int) -> str:
    j = i
    while j > max(0, i - LONGEST_WORD) and not text[j - 1].isspace() and text[j - 1] not in "\"“”„«»()[]（）「」'’‘,;:—–" + FULL:
        j -= 1
    # "al" is short behind "et" only.
    return text[j:i] if text[j:i].lower() != "al" or text[max(0, j - 3) : j].lower() == "et " else "name"


def _ends(mark: str, word: str, closers: str, gap: bool, after: int, rest: str, short: frozenset[str] = abbreviations(None)) -> bool:
    """Whether a statement ends at ``mark`` (with ``closers``), given the word before it and what follows."""
    quoted = any(c in "”“’»」』\"'" for c in closers)
    if after == NOTHING:
        return True
    if quoted and after in (CASELESS, LOWER, JOINING):
        return False
    if any(c in FULL for c in mark):
        return after != JOINING
    if after in (LOWER, JOINING):
        return False
    if "…" in mark or mark.count(".") > 1 and not set(mark) & set("!?"):
        return after in (UPPER, OPENING)
    if set(mark) & set("!?"):
        return gap or after in (UPPER, OPENING)
    # One full stop.
    low = word.lower().lstrip(".")
    if low in CLOCK:
        return after in (UPPER, OPENING) or after == CASELESS and gap
    if low in short or low in NUMBERED and after == DIGIT:
        return low in ALSO_WORDS and after == UPPER and not closers and word.islower() and bool(gap)
    if len(low) == 1 and not low.isdigit() and unicodedata.category(low)[0] == "L":
        return False
    if "." in low and len(low.rpartition(".")[2]) == 1 and low.rpartition(".")[2].isalpha() and len(low) <= 5:
        return False
    if not gap:
        return after == UPPER and (len(low) > 1 or bool(closers)) or after == OPENING and rest[:1] in "“«„\"(¿¡—"
    if low.isdigit() and len(low) <= 2 and rest.split(None, 1)[:1] and re.sub(r"\W+$", "", rest.split(None, 1)[0]) in MONTHS:
        return False
    return True


class _Tracks:
    """Where the transducer is by state before: a mask of those outside, and per kind of quotation a mask for each number of statements held.

    All states before move at once by a few operations on masks, whatever their number.
    """

    def __init__(self, alone: bool):
        self.out = 1 << OUT
        self.held = [[0] * MOST_QUOTED if alone else [1 << _in(k, h) for h in range(MOST_QUOTED)] for k in range(len(KINDS))]

    def event(self, kind: int) -> int:
        """Moves on; the mask of states before after which an end is emitted."""
        emitted = 0
        if kind == STATEMENT:
            emitted = self.out
            for row in self.held:
                emitted |= row.pop()
                row.insert(0, 0)
            self.out = emitted
        elif kind == BLANK:
            for k in range(len(KINDS)):
                self._leave(k)
            emitted = self.out
        elif kind == CURLY:
            before, self.out = self.out, 0
            self._leave(LOW)
            self.held[DOUBLE][0] |= before
        elif kind >= CLOSE:
            self._leave(kind - CLOSE)
        else:
            self.held[kind - OPEN][0] |= self.out
            self.out = 0
        return emitted

    def _leave(self, k: int) -> None:
        for mask in self.held[k]:
            self.out |= mask
        self.held[k] = [0] * MOST_QUOTED

    def next_states(self, n: int) -> list[int]:
        state = [OUT] * n
        for k, row in enumerate(self.held):
            for h, mask in enumerate(row):
                while mask:
                    low = mask & -mask
                    state[low.bit_length() - 1] = _in(k, h)
                    mask ^= low
        return state


def scan(text: str, alone: bool = False, lang: str | None = None) -> tuple[list[int], list[tuple[int, int]], int, int, int]:
    """(next state by state, [(end, mask of states before)], tail end, tail mask of states, tail classes).

    Ends count code points from the beginning of ``text``. The tail is the last character of ``text`` that isn't white
    space; whether a sentence ends there depends on what follows in the next row: tail classes is a mask of the classes
    (LOWER ... NOTHING) after which it does. Ends before the tail are in the list. A text that stands ``alone`` is read
    from the state OUT only; masks have one bit then. Abbreviations are those of ``lang``. Linear in the text.
    """
    size = len(text.rstrip())
    tracks = _Tracks(alone)
    short = abbreviations(lang)
    ends: dict[int, int] = {}
    tail = 0
    closed_to = 0
    quotes = quotes_to = 0

    def event(kind: int, at: int) -> None:
        if (mask := tracks.event(kind)) and at < size:
            ends[at] = ends.get(at, 0) | mask

    def before(i: int) -> int:
        """One behind the last character before ``i`` that isn't white space."""
        while i > 0 and text[i - 1].isspace():
            i -= 1
        return i

    for m in EVENT.finditer(text):
        i, j = m.span()
        if i < closed_to and m.lastgroup != "line":
            continue
        kind = m.lastgroup
        if kind == "mark":
            mark = text[i:j]
            k = j
            shut: list[int] = []
            while k < size:
                c = text[k]
                if c in "   " and k + 1 < size and text[k + 1] == "»":
                    k += 1
                    continue
                if c not in CLOSERS:
                    break
                if c in "\"'“" and k > j and text[k - 1] == c:
                    break
                if c == "“" and not (k + 1 >= size or text[k + 1].isspace() or text[k + 1] in ",;:"):
                    break  # it opens the next quotation
                if c == "'" and k + 1 < size and text[k + 1].isalnum():
                    break
                if c == '"' and k + 1 < size and text[k + 1].isalnum() and text[j - 1] in ".!?":
                    quotes, quotes_to = quotes + text.count('"', quotes_to, k), k
                    if quotes % 2 == 0:
                        break
                if c == '"':
                    shut.append(CLOSE + DOUBLE)
                elif c in "'’":
                    shut.append(CLOSE + SINGLE)
                elif c in QUOTES:
                    shut.append(QUOTES[c] if c != "“" else CLOSE + LOW)
                k += 1
            closed_to = k
            for e in shut:
                event(e, k)
            g = k
            while g < size and text[g].isspace():
                g += 1
            word, closers = _word_before(text, i), text[j:k]
            if k >= size:
                tail = 0
                for c in range(7):
                    if _ends(mark, word, closers, True, c, "", short):
                        tail |= 1 << c
                closed_to = size
                continue
            if "\n" in text[k:g]:
                continue  # left to the line break
            if _ends(mark, word, closers, g > k, follows(text[g]), text[g : g + 24], short):
                event(STATEMENT, k)
        elif kind == "thai":
            if j >= size:
                tail = 127
            else:
                event(STATEMENT, j)
        elif kind == "line":
            if i == 0:
                continue
            if j >= size:
                tail |= 127 & ~(1 << LOWER)
                continue
            at = before(i)
            breaks = text[i:j].count("\n")
            after = follows(text[j])
            b = at
            while b > 0 and text[b - 1] in CLOSERS + "   ":
                b -= 1
            a = b
            while a > 0 and text[a - 1] in MARKS:
                a -= 1
            if breaks > 1:
                event(BLANK, at)
            elif after == LOWER or after == JOINING:
                continue
            elif a < b:
                if _ends(text[a:b], _word_before(text, a), text[b:at].strip(), True, after, text[j : j + 24], short):
                    event(STATEMENT, at)
            elif text[at - 1] not in ",;:、，；：،—–-(":
                event(STATEMENT, at)
        elif kind == "dash":
            b, a = before(i), j
            while a < size and text[a].isspace():
                a += 1
            if follows(text[a : a + 1]) == UPPER and (not b or text[b - 1] in MARKS + CLOSERS or "\n" in text[b:i]):
                event(OPEN + DASH, i)
            else:
                event(CLOSE + DASH, i)
        else:
            c = text[i]
            if c in QUOTES:
                event(QUOTES[c], i)
            elif c == '"':
                opens = j < len(text) and not text[j].isspace() and (i == 0 or text[i - 1].isspace() or text[i - 1] in "([—–-" + MARKS)
                event(OPEN + DOUBLE if opens else CLOSE + DOUBLE, i)
            elif c == "'":
                if (i == 0 or text[i - 1].isspace() or text[i - 1] in MARKS) and j < len(text) and (text[j].isupper() or text[j] in "¿¡"):
                    event(OPEN + SINGLE, i)
                elif i > 0 and (text[i - 1] in ",.!?…") and (j >= len(text) or not text[j].isalnum()):
                    event(CLOSE + SINGLE, i)
            elif c == "’" and i > 0 and text[i - 1] in ",.!?…":
                event(CLOSE + SINGLE, i)
    return tracks.next_states(1 if alone else N_STATES), sorted(ends.items()), size, tracks.out, tail


def head(text: str) -> int:
    return follows(text.lstrip()[:1])
