"""Builders of DuckDB SQL text for the oracle queries.

The oracles restate each text rule in plain SQL (RE2 regexes, string and list
functions), from the same fixed values in ``docmart.rules``, so the check
shares no execution code with the Spark side.
"""

from __future__ import annotations

from docmart import rules
from docmart.functions.arrow import fold_one
from docmart.functions.text import KEY_NULL, py_word

WS = rules.WS

# Entities decoded by the oracle; '&amp;' last so it is decoded once only.
ORACLE_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\xa0"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
]


def lit(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def unescape(e: str) -> str:
    for ent, ch in ORACLE_ENTITIES:
        e = f"replace({e}, {lit(ent)}, {lit(ch)})"
    return e


def collapse(e: str) -> str:
    return f"regexp_replace({e}, '{WS}+', ' ', 'g')"


def strip_ws(e: str) -> str:
    return f"trim({e}, {lit(rules.WS_CHARS)})"


def strip_chars(e: str, chars: str) -> str:
    return f"trim({e}, {lit(chars)})"


def strip_tags_text(e: str) -> str:
    return "trim(" + collapse("regexp_replace(" + e + ", '<[^>]+>', ' ', 'g')") + ")"


def clean_html(e: str) -> str:
    return f"(CASE WHEN {e} IS NULL OR {e} = '' THEN NULL ELSE {strip_tags_text(unescape(e))} END)"


def fold(e: str) -> str:
    return "trim(" + collapse("lower(strip_accents(coalesce(" + e + ", '')))") + ")"


def capitalize_first(e: str) -> str:
    return f"(upper(substr({e}, 1, 1)) || substr({e}, 2))"


def contains_any(e: str, words) -> str:
    return "(" + " OR ".join(f"contains({e}, {lit(w)})" for w in words) + ")"


def clean_title(e: str) -> str:
    t = clean_html(e)
    t = f"regexp_replace({t}, '^[{rules.WS_CLASS},.-]+', '')"
    t = f"regexp_replace({t}, '(?i)^({'|'.join(rules.TITLE_CONNECTORS)}){WS}+', '')"
    t = strip_ws(t)
    return f"(CASE WHEN length({t}) >= {rules.TITLE_MIN_LEN} THEN {capitalize_first(t)} END)"


def content_key(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), {lit(KEY_NULL)})" for e in exprs)
    return f"md5(concat_ws(chr(31), {parts}))"


def classify_link(e: str) -> str:
    """Name of the platform for a link (T6 classifier)."""
    whens = [f"WHEN {e} IS NULL THEN NULL"]
    whens += [f"WHEN regexp_matches({e}, {lit('(?i)' + p)}) THEN {lit(n)}" for n, p in rules.PLATFORM_PATTERNS]
    ext = r"(?i)\.(" + "|".join(rules.PLATFORM_FILE_EXTENSIONS) + r")$"
    whens += [f"WHEN contains({e}, {lit(rules.PLATFORM_EXCLUDED_HOST)}) THEN NULL",
              f"WHEN regexp_matches({e}, {lit(ext)}) THEN NULL",
              f"WHEN starts_with({e}, 'http') THEN {lit(rules.PLATFORM_WEB)}"]
    return "(CASE " + " ".join(whens) + " ELSE NULL END)"


def first_href(e: str) -> str:
    pattern = (f"(?is)<a{WS}(?:[^>]*?{WS})?href{WS}*={WS}*"
               f"(?:\"([^\"]*)\"|'([^']*)'|([^{rules.WS_CLASS}\"'>]+))")
    raw = "coalesce(" + ", ".join(f"nullif(regexp_extract({e}, {lit(pattern)}, {g}), '')" for g in (1, 2, 3)) + ")"
    return unescape(raw)


def mail(e: str) -> str:
    return f"nullif(regexp_extract({e}, {lit('(?i)' + py_word(rules.MAIL_PATTERN))}, 0), '')"


def phone(e: str) -> str:
    return f"replace(nullif(regexp_extract({e}, {lit('(?i)' + rules.PHONE_PATTERN)}, 1), ''), ' ', '')"


BLACKLIST_FOLDED = [fold_one(w) for w in rules.PARTICIPANT_BLACKLIST]
