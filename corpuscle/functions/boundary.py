"""Lexical signals of an open sentence boundary, as one ordered condition over a sentence and the next one.

Tokens are coded by class into a short string, so that rules about their order are patterns over that string.
"""

from __future__ import annotations

# Closed word classes of English and the marks that end a sentence.
COORDINATORS = ["and", "or", "but", "nor", "yet", "so"]
SUBORDINATORS = ["because", "although", "though", "while", "if", "when", "unless", "since", "whereas", "until", "before", "after", "once", "whether", "where", "as"]
PREPOSITIONS = ["of", "in", "on", "at", "to", "from", "with", "by", "about", "into", "onto", "upon", "under", "over", "between", "among", "through", "during", "without", "within", "along", "across", "behind", "beyond", "despite", "except", "near", "outside", "toward", "towards", "via", "per", "against", "around", "off", "for"]
ARTICLES = ["a", "an", "the"]
RELATIVES = ["who", "whom", "whose", "which"]
COPULAS = ["is", "are", "was", "were", "am", "be", "been", "being"]
AUXILIARIES = ["has", "have", "had", "do", "does", "did", "will", "would", "shall", "should", "can", "could", "may", "might", "must"]
SUBJECTS = ["it", "he", "she", "they", "we", "you", "i", "this", "that"]
OPENING_PRONOUNS = ["i", "you", "he", "she", "it", "we", "they", "this", "that", "these", "those", "there"]
ADVERBIALS = ["directly", "without", "interruption"]
MERGE_BELOW = 0.35

_FINAL = "|".join([*COORDINATORS, *SUBORDINATORS, *PREPOSITIONS, *ARTICLES, *RELATIVES, *COPULAS, *AUXILIARIES])
_SUB, _COP, _OPEN, _ADV, _SUBJ = ("|".join(x) for x in (SUBORDINATORS, COPULAS, OPENING_PRONOUNS, ADVERBIALS, SUBJECTS))


def _list(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def signal_sql(text: str, following: str, spark: bool) -> str:
    """complete, open or undetermined: a CASE over two string expressions, for Spark or (``spark`` false) DuckDB."""
    esc = (lambda p: "r'" + p.replace("'", "\\x27") + "'") if spark else (lambda p: "'" + p.replace("'", "''") + "'")
    has = (lambda s, p: f"rlike({s}, {esc(p)})") if spark else (lambda s, p: f"regexp_matches({s}, {esc(p)})")
    arrow = (lambda v, e: f"{v} -> {e}") if spark else (lambda v, e: f"lambda {v}: {e}")
    g = "" if spark else ", 'g'"
    sp = esc(r"\s+")
    cut = (lambda s: f"split({s}, {sp})") if spark else (lambda s: f"regexp_split_to_array({s}, {sp})")
    n = "size" if spark else "len"
    kept, mapped, joined = ("filter", "transform", "array_join") if spark else ("list_filter", "list_transform", "array_to_string")
    tok = f"{kept}({cut(text)}, {arrow('x', chr(120) + ' <> ' + chr(39) * 2)})"
    letters = f"lower(regexp_replace(y, {esc("[^A-Za-z']")}, ''{g}))"
    contraction = has("lower(y)", "(n't|'s|'re|'ve|'d|'ll)$")
    klass = f"CASE WHEN {letters} IN {_list(RELATIVES)} THEN 'r' WHEN {letters} IN {_list(COPULAS + AUXILIARIES)} THEN 'f' WHEN {contraction} THEN 'c' ELSE '-' END"
    code = f"{joined}({mapped}({tok}, {arrow('y', klass)}), '')"
    nxt = f"coalesce({following}, '')"
    no_comma = f"NOT {has(text, ',')}"
    no_finite = f"NOT {has(code, '[fc]')}"
    pronoun_verb = has(text, rf"^\s*[^A-Za-z'\s]*(?i:{_SUBJ})[^A-Za-z'\s]*\s+[^A-Za-z'\s]*[A-Za-z']+[A-RT-Za-rt-z'][sS][^A-Za-z'\s]*(\s|$)")
    next_pronoun = has(nxt, rf"^\s*(?i:{_OPEN})([^A-Za-z']|$)")
    return f"""CASE
    WHEN {has(text, r"[.!?]['\")”’]*\s*$")} THEN 'complete'
    WHEN {n}({tok}) <= 3 AND {no_comma} THEN CASE WHEN {next_pronoun} THEN 'complete' ELSE 'open' END
    WHEN {has(text, rf"(?i)(^|[^A-Za-z'])({_FINAL})[^A-Za-z']*$")} THEN 'open'
    WHEN {has(text, r"\b(is|are|was|were|am)\s*,")} THEN 'open'
    WHEN {has(text, rf"(?i)^\s*((but|and|so)([^A-Za-z'\s]\S*)?\s+)?({_SUB})([^A-Za-z']|$)")} THEN 'open'
    WHEN {has(code, r"^.[-c]{0,3}r")} THEN 'open'
    WHEN {no_comma} AND {n}({tok}) >= 2 AND {has(text, r"(^|\s)[^A-Za-z\s]*[A-Z]\S*\s*$")} AND NOT {next_pronoun} THEN 'open'
    WHEN {has(text, ",[^,]*,")} AND {no_finite} AND NOT {pronoun_verb} THEN 'open'
    WHEN {has(code, "r-+$")} THEN 'open'
    WHEN {has(text, r"(?i)^\s*[A-Za-z']*ing([^A-Za-z']|$)")} AND {no_finite} THEN 'open'
    WHEN {no_comma} AND {n}({tok}) > 3 AND {no_finite} AND NOT {pronoun_verb} THEN 'open'
    WHEN {has(nxt, rf"(?i)^[\s,]*(({_ADV})(\s[^,]*)?,[\s,]*)*({_COP})([^A-Za-z']|$)")} THEN 'open'
    ELSE 'undetermined' END"""


#: Texts of so many tokens are left as they are by ``digest_sql``; longer ones keep HEAD tokens of their beginning.
DIGESTED, HEAD = 14, 6


def closed_sql(text: str) -> str:
    """Whether a text ends with a closing mark: complete whatever stands before its last token (Spark)."""
    return f"rlike({text}, r'[.!?][\\x27\")”’]*\\s*$')"


def digest_sql(text: str) -> str:
    """A text of bounded size with the same signal as ``text``, alone and with anything behind it (Spark).

    The rules look at the first five tokens, at the last one, at the last one with a letter and at what stands between them only by whether
    it has none, one or more commas, a finite verb, a bare copula before a comma, and a relative pronoun as the last of its marked tokens.
    Those are kept as representatives: a token with a comma each, "has", "who"; a text of up to DIGESTED tokens stays as it is.
    """
    letters = "lower(regexp_replace(d_y, r'[^A-Za-z\\x27]', ''))"
    contraction = "rlike(lower(d_y), r'(n\\x27t|\\x27s|\\x27re|\\x27ve|\\x27d|\\x27ll)$')"
    klass = f"CASE WHEN {letters} IN {_list(RELATIVES)} THEN 'r' WHEN {letters} IN {_list(COPULAS + AUXILIARIES)} THEN 'f' WHEN {contraction} THEN 'c' ELSE '' END"
    # t: tokens, m: those between head and last, k: their marks, a: places of m with a letter.
    commas = "length(array_join(d_x.m, '')) - length(replace(array_join(d_x.m, ''), ',', ''))"
    lettered = "element_at(d_x.a, -1)"
    last = "rlike(element_at(d_x.t, -1), '[A-Za-z]')"
    behind = f"slice(d_x.m, {lettered} + 2, size(d_x.m))"
    copula = f"rlike({text}, r'\\b(is|are|was|were|am)\\s*,')"
    body = f"""array_join(concat(slice(d_x.t, 1, {HEAD}), IF({copula}, array('is,'), array()),
      IF({commas} > 0, array('x,'), array()), IF({commas} > 1, array('x,'), array()), IF(rlike(d_x.k, '[fc]'), array('has'), array()), IF(endswith(d_x.k, 'r'), array('who'), array()),
      IF({last}, array(), concat(IF(size(d_x.a) > 0, array(replace(d_x.m[{lettered}], ',', ';')), array()),
        IF(rlike(array_join(IF(size(d_x.a) > 0, {behind}, d_x.m), ''), r'\\x27'), array(char(39)), array('0')))),
      slice(d_x.t, -1, 1)), ' ')"""
    tokens = f"filter(split({text}, r'\\s+'), d_y -> d_y <> '')"
    middle = f"slice(d_t, {HEAD + 1}, size(d_t) - {HEAD + 1})"
    bound = f"""transform(array({tokens}), d_t -> named_struct('t', d_t, 'm', {middle}, 'k', array_join(transform({middle}, d_y -> {klass}), ''),
      'a', filter(sequence(0, size(d_t) - {HEAD + 2}), d_i -> rlike(d_t[d_i + {HEAD}], '[A-Za-z]'))))"""
    return f"IF(size({tokens}) <= {DIGESTED}, {text}, transform({bound}, d_x -> {body})[0])"
