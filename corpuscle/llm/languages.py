"""The language of a text, by script and frequent words."""

from __future__ import annotations

import re
from collections import Counter

# Frequent words by which languages in Latin letters are told apart.
FREQUENT = {
    "en": "the and of to in is was that it for with not you they will have about from this on what by",
    "pt": "o a de que em um uma não do da os é já foi por sem para ninguém até no na você as mais",
    "es": "el la de que en los un una no del es y ya por sin nadie lo fue hasta hay las más solo",
    "fr": "le la de que et les un une ne pas du est à il en sans plus ce fut on des dans rien tous",
    "de": "der die das und in nicht ein eine ist war es wir zur im mit ohne bis den wie hier auf von immer",
}
LANGUAGES = [*FREQUENT, "ja", "zh", "hi", "th", "ar", "other"]
_FREQUENT = {w: [k for k, v in FREQUENT.items() if w in v.split()] for w in " ".join(FREQUENT.values()).split()}


_SCRIPTS = {
    "kana": re.compile(r"[\u3040-\u30ff]+"), "han": re.compile(r"[\u4e00-\u9fff]+"), "hi": re.compile(r"[\u0900-\u097f]+"),
    "th": re.compile(r"[\u0e00-\u0e7f]+"), "ar": re.compile(r"[\u0600-\u06ff]+"), "latin": re.compile(r"[A-Za-z\u00c0-\u024f]+"),
}


def language(text: str) -> str:
    """The language of a text by script, in Latin letters by frequent words."""
    count = {k: sum(map(len, p.findall(text))) for k, p in _SCRIPTS.items()}
    if not any(count.values()):
        return "other"
    if count["kana"] + count["han"] >= count["latin"] and count["kana"] + count["han"] > 0:
        return "ja" if count["kana"] * 8 > count["han"] else "zh"
    best = max(("hi", "th", "ar", "latin"), key=count.get)
    if best != "latin":
        return best
    hits = dict.fromkeys(FREQUENT, 0)
    for w, n in Counter(re.findall(r"[^\W\d_]+", text.lower())).items():
        for k in _FREQUENT.get(w, ()):
            hits[k] += n
    best = max(hits, key=hits.get)
    return best if hits[best] else "other"
