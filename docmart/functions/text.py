"""Text functions over HTML fragments and free text, as Catalyst expressions.

Every function maps Columns to a Column. Regexes carry ``(?U)`` where the
source semantics are Python's Unicode ``\\w \\d \\b``; whitespace uses the explicit
class ``rules.WS`` (exactly Python's ``str.isspace``). Only entity decoding and
accent folding leave the JVM (``functions.arrow``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmart import rules
from docmart.functions import arrow, matcher

WS = rules.WS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c



def strip_chars(c, chars: str) -> Column:
    """Python ``str.strip(chars)`` (looks at the two ends only)."""
    return F.btrim(_col(c), F.lit(chars))


def strip_ws(c) -> Column:
    """Python ``str.strip()``."""
    return F.btrim(_col(c), F.lit(rules.WS_CHARS))


def collapse_ws(c) -> Column:
    return F.regexp_replace(_col(c), f"{WS}+", " ")


def let(c, fn) -> Column:
    """``fn(x)`` with ``x`` bound to ``c`` evaluated once per row.

    Catalyst does not share a subexpression between a CASE predicate and its
    branches, so an expensive expression referenced several times inside
    ``when`` would be computed each time; binding it through a one-element
    array and ``transform`` computes it once.
    """
    return F.transform(F.array(_col(c)), fn)[0]


def capitalize_first(c) -> Column:
    """``s[0].upper() + s[1:]``."""
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def strip_tags_text(c) -> Column:
    """Tags to spaces, whitespace collapsed, ends trimmed (no entity step).

    Usable inside higher-order lambdas, where Python UDFs cannot run.
    """
    no_tags = F.regexp_replace(_col(c), "<[^>]+>", " ")
    return F.trim(collapse_ws(no_tags))


def unescape(c) -> Column:
    """HTML entity decoding. Text holding '&' is sent to the Arrow helper; any other keeps its value, and a start of it
    goes there and back (``arrow.START``)."""
    c = _col(c)
    has = c.contains("&")
    return F.when(has, arrow.html_unescape(F.when(has, c).otherwise(F.substring(c, 1, arrow.START)))).otherwise(c)


def unescape_many(cols) -> list[Column]:
    """``unescape`` for several columns in one Arrow call (one array per row)."""
    cols = [_col(c) for c in cols]
    decoded = arrow.html_unescape_array(F.array(*[F.when(c.contains("&"), c) for c in cols]))
    return [F.coalesce(decoded[i], c) for i, c in enumerate(cols)]


def clean_html(c) -> Column:
    """T1. NULL or '' -> NULL; decode entities, then tags -> space, collapse, trim."""
    # Decoding keeps NULL and '' as they are, so the test can run on its result,
    # which is bound once (see ``let``).
    return let(unescape(c), lambda x: F.when(x.isNull() | (x == ""), F.lit(None).cast("string"))
               .otherwise(strip_tags_text(x)))


def fold(c) -> Column:
    """T2. NFKD, drop combining marks, collapse whitespace, trim, lower; NULL -> ''."""
    return arrow.fold(_col(c))


def body_text(c, joiner: str = " ", require_closing: bool = False, is_array: bool = False) -> Column:
    """T0. Body given as a list, a JSON-array string, or plain text -> one string.

    A string whose trimmed form starts with ``[`` (and, with ``require_closing``,
    ends with ``]``) is decoded as a JSON array and joined; when decoding fails
    the string is returned as it is.
    """
    c = _col(c)
    if is_array:
        return F.array_join(c, joiner)
    t = strip_ws(c)
    looks = t.startswith("[")
    if require_closing:
        looks = looks & t.endswith("]")
    decoded = F.array_join(F.from_json(c, "array<string>"), joiner)
    return F.when(looks, F.coalesce(decoded, c)).otherwise(c)


def keyword_link(html, keyword: str = rules.APPOINTMENT_KEYWORD, prefix: str = "https:") -> Column:
    """T3. If the lower-cased HTML contains ``keyword``: the first
    ``<a ... href="<prefix>...">`` (double quotes only), else NULL."""
    h = _col(html)
    pattern = f'(?i)<a{WS}+(?:[^>]*?{WS}+)?href="({re.escape(prefix)}[^"]*)"'
    link = F.nullif(F.regexp_extract(h, pattern, 1), F.lit(""))
    return F.when(F.lower(h).contains(keyword), link)


def raw_href(html) -> Column:
    """The href of the first ``<a>`` tag that has one (any quoting), as it is written."""
    h = _col(html)
    pattern = rf"(?is)<a{WS}(?:[^>]*?{WS})?href{WS}*={WS}*(?:\"([^\"]*)\"|'([^']*)'|([^{rules.WS_CLASS}\"'>]+))"
    # The page is searched once; the quoting form is then read off the short tag.
    return let(F.regexp_extract(h, pattern, 0), lambda tag: F.coalesce(
        *[F.nullif(F.regexp_extract(tag, pattern, g), F.lit("")) for g in (1, 2, 3)]))


def first_href(html) -> Column:
    """``raw_href``, entities decoded."""
    return unescape(raw_href(html))


def classify_link(link, patterns: Sequence[tuple[str, str]] = rules.PLATFORM_PATTERNS,
                  excluded_host: str = rules.PLATFORM_EXCLUDED_HOST,
                  extensions: Sequence[str] = rules.PLATFORM_FILE_EXTENSIONS,
                  web_label: str = rules.PLATFORM_WEB) -> Column:
    """T6 classifier: ordered host patterns (first wins) -> (name, link);
    excluded host or file link -> NULLs; other ``http*`` -> (web_label, link)."""
    return let(link, lambda x: _classify(x, patterns, excluded_host, extensions, web_label))


def _classify(link: Column, patterns, excluded_host, extensions, web_label) -> Column:
    none = F.lit(None).cast("string")
    name = F.when(link.isNull(), none)
    for label, pat in patterns:
        name = name.when(link.rlike("(?i)" + pat), F.lit(label))
    ext = r"(?i)\.(" + "|".join(extensions) + r")$"
    name = (name.when(link.contains(excluded_host), none)
            .when(link.rlike(ext), none)
            .when(link.startswith("http"), F.lit(web_label))
            .otherwise(none))
    return let(name, lambda n: F.struct(n.alias("NOMBRE_PLATAFORMA"),
                                        F.when(n.isNotNull(), link).alias("LINK_PLATAFORMA")))


def platform(html) -> Column:
    """T6. Classify the first link of an HTML fragment."""
    return classify_link(first_href(html))


def max_level(text, keyword: str = rules.LEVEL_KEYWORD) -> Column:
    """T7. Highest single digit that follows ``keyword`` and whitespace; none -> NULL."""
    found = F.regexp_extract_all(_col(text), F.lit(f"(?i){keyword}{WS}+([0-9])"), 1)
    return F.array_max(F.transform(found, lambda x: x.cast("int")))


def clean_title(c, connectors: Sequence[str] = rules.TITLE_CONNECTORS,
                min_len: int = rules.TITLE_MIN_LEN) -> Column:
    """T8. clean_html, drop leading punctuation and one leading connector,
    shorter than ``min_len`` -> NULL, first letter upper-cased."""
    t = clean_html(c)
    t = F.regexp_replace(t, f"^[{rules.WS_CLASS},.-]+", "")
    t = F.regexp_replace(t, "(?i)^(" + "|".join(connectors) + f"){WS}+", "")
    t = strip_ws(t)
    return let(t, lambda x: F.when(F.length(x) >= min_len, capitalize_first(x)))


def contains_any(c, words: Iterable[str]) -> Column:
    c = _col(c)
    cond = F.lit(False)
    for w in words:
        cond = cond | c.contains(w)
    return cond


def person_flag(text, words: Sequence[str] = rules.LEGAL_PERSON_WORDS) -> Column:
    """T11. 'N' when the folded text names a legal person, else 'Y'."""
    return F.when(contains_any(fold(text), words), "N").otherwise("Y")


def required_flag(name, subtitle=None, words: Sequence[str] = rules.OPTIONAL_WORDS,
                  subtitle_word: str = rules.OPTIONAL_SUBTITLE_WORD) -> Column:
    """T12. 'N' when the folded name marks the item optional (or the subtitle does)."""
    cond = contains_any(fold(name), words)
    if subtitle is not None:
        cond = cond | fold(subtitle).contains(subtitle_word)
    return F.when(cond, "N").otherwise("Y")


def phone(text, pattern: str = rules.PHONE_PATTERN) -> Column:
    """T13a. Phone number within 40 non-digits of a cue word, spaces removed."""
    t = _col(text)
    found = F.nullif(F.regexp_extract(t, "(?iU)" + pattern, 1), F.lit(""))
    if pattern == rules.PHONE_PATTERN:
        # Every match holds one of the cue words: test them before the regex.
        found = F.when(contains_any(F.lower(t), PHONE_CUES), found)
    return F.regexp_replace(found, " ", "")


# Lower-case stems of the phone cue words (Tel[eé]fono, Contacto, llamar, comunicate).
PHONE_CUES = ["tel", "contacto", "llamar", "comunicate"]


def py_word(pattern: str) -> str:
    """Spell Python's Unicode ``\\w`` as an explicit class both Java regex and RE2 read."""
    return pattern.replace(r"[\w", r"[\p{L}\p{N}_").replace(r"\w", r"[\p{L}\p{N}_]")


def mail(text, pattern: str = rules.MAIL_PATTERN) -> Column:
    """T13b. First e-mail address."""
    t = _col(text)
    return F.when(t.contains("@"), F.nullif(F.regexp_extract(t, "(?i)" + py_word(pattern), 0), F.lit("")))


def markup_free(text) -> Column:
    """Tags and JSON escapes (a literal backslash-n and the like) to spaces, so a word right after an escaped
    newline still starts at a word boundary."""
    return F.regexp_replace(F.regexp_replace(_col(text), "<[^>]+>", " "), r"\\[nrtbf]", " ")


def payment_labels(text, patterns: Sequence[tuple[str, str]] = rules.PAYMENT_PATTERNS, bare: bool = False) -> Column:
    """T5. Sorted labels whose pattern matches the markup-free, folded text. ``bare`` texts are ``markup_free``
    already: a column that is read several times here is better computed beforehand."""
    return matcher.labels(_col(text) if bare else markup_free(text), patterns, decode=True)


def decimal_from_text(c, style: str = "plain", precision: int = 10, scale: int = 2) -> Column:
    """C6. Price text -> decimal. ``plain`` keeps digits and dots (the source
    rule, so ``1.500,00`` reads 1.50); ``comma`` reads ``.`` as thousands and
    ``,`` as the decimal mark. Unparseable -> NULL."""
    c = _col(c)
    if style == "comma":
        c = F.regexp_replace(F.regexp_replace(c, "[^0-9,]", ""), ",", ".")
    else:
        c = F.regexp_replace(c, "[^0-9.]", "")
    return c.try_cast(f"decimal({precision},{scale})")


def timestamp_from_epoch_text(c) -> Column:
    """C7. Epoch seconds as text -> timestamp (session time zone); bad text -> NULL."""
    return F.timestamp_seconds(_col(c).try_cast("bigint"))


def yn_to_bool(c) -> Column:
    """C1. 'Y' -> true, anything else -> false."""
    return F.when(_col(c) == "Y", True).otherwise(False)


def flag_by_regex(c, pattern: str) -> Column:
    """C1. Lower-cased text matches ``pattern`` -> true, else false."""
    return F.when(F.lower(_col(c)).rlike(pattern), True).otherwise(False)


def default_if_blank(c, default: str) -> Column:
    """C2. NULL or '' -> default."""
    c = _col(c)
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


KEY_SEP = "\x1f"
KEY_NULL = "\\N"


def content_key(*cols) -> Column:
    """K2. Stable key: md5 over the natural key, separated, with a NULL marker,
    so that ('ab', 'c') and ('a', 'bc'), or NULL and '', never collide."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEP, *parts))


def literal_key(*values) -> str:
    """The value ``content_key`` gives for constant inputs, computed locally."""
    import hashlib

    parts = [KEY_NULL if v is None else str(v) for v in values]
    return hashlib.md5(KEY_SEP.join(parts).encode("utf-8")).hexdigest()
