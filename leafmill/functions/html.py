"""Page text as columns: cleaned HTML, markdown, plain text, attributes of tags.

Patterns keep to what Java and RE2 share, so each can be checked against another engine; that for attributes is Java's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import collapse_space, decode_entities, strip_space
from leafmill.functions.urls import resolve_url

# A tag starts with a letter, `/`, `!` or `?`; any other `<` is text.
TAG = r"</?[A-Za-z][^>]*>|<[!?][^>]*>"

_NOISE = r"(?is)<(?:script\b.*?</script>|style\b.*?</style>|!--.*?-->)"

_LINK = r"""(?is)<a\s(?:[^>]*\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""
_IMG_ALT_SRC = r'(?is)<img\s(?:[^>]*\s)?alt="([^"]*)"[^>]*\ssrc="([^"]*)"[^>]*>'
_IMG_SRC_ALT = r'(?is)<img\s(?:[^>]*\s)?src="([^"]*)"[^>]*\salt="([^"]*)"[^>]*>'
_IMG_SRC = r"""(?is)<img\s(?:[^>]*\s)?src\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>"""

# Markdown steps in order: (tags one of which must be there, in lower case, patterns with their replacements).
_MARKDOWN_STEPS = (
    (("<head",), ((r"(?is)<head\b.*?</head>", ""),)),
    *(((f"<h{n}",), ((rf"(?is)<h{n}\b[^>]*>(.*?)</h{n}>", "\n\n" + "#" * n + " $1\n\n"),)) for n in range(1, 7)),
    (("<img",), ((_IMG_ALT_SRC, "![$1]($2)"), (_IMG_SRC_ALT, "![$2]($1)"), (_IMG_SRC, "![]($1$2$3)"))),
    (("</a>",), ((_LINK, "[$4]($1$2$3)"),)),
    (("<li",), ((r"(?i)<li\b[^>]*>", "\n- "),)),
    (("</b>", "</strong>"), ((r"(?is)<(?:b|strong)>([^<]*)</(?:b|strong)>", "**$1**"),)),
    (("</i>", "</em>"), ((r"(?is)<(?:i|em)>([^<]*)</(?:i|em)>", "*$1*"),)),
    (("<br",), ((r"(?i)<br\s*/?>", "\n"),)),
)
_BLOCK = r"(?i)</?(?:p|div|ul|ol|nav|article|footer|section|header|main|table|tr|dt|dd|pre|blockquote|figure|form)\b[^>]*>"
_CELL = r"(?i)</?(?:td|th)\b[^>]*>"

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` once for `body`, where using it twice would repeat a long expression."""
    return F.transform(F.array(value), body)[0]


def clean_html(raw: Column) -> Column:
    """HTML without scripts, styles and comments."""
    return F.regexp_replace(raw, _NOISE, "")


def _step_if(found: Column, patterns) -> Callable[[Column], Column]:
    def step(t: Column) -> Column:
        changed = t
        for pattern, replacement in patterns:
            changed = F.regexp_replace(changed, pattern, replacement)
        return F.when(found, changed).otherwise(t)

    return step


def _markdown_tags(cleaned: Column, low: Column) -> Column:
    c = cleaned
    for needed, patterns in _MARKDOWN_STEPS:
        found = low.contains(needed[0])
        for tag in needed[1:]:
            found = found | low.contains(tag)
        c = let(c, _step_if(found, patterns))
    c = let(c, _step_if(low.contains("<td") | low.contains("<th"), ((_CELL, " "),)))
    return F.regexp_replace(F.regexp_replace(c, _BLOCK, "\n\n"), TAG, "")


def markdown(cleaned: Column) -> Column:
    """Markdown of cleaned HTML.

    Every pattern is one more pass over the page, so a step runs only if a plain search finds the tags it needs.
    """
    c = decode_entities(let(F.lower(cleaned), lambda low: _markdown_tags(cleaned, low)))
    c = let(c, lambda t: _step_if(t.contains("  ") | t.contains("\t"), ((r"[ \t]{2,}|\t", " "),))(t))
    c = F.replace(F.replace(c, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    return F.trim(F.regexp_replace(c, r"\n{3,}", "\n\n"), F.lit(" \t\n\x0b\f\r"))


def bare_text(cleaned: Column) -> Column:
    """Text of all elements, tags as blanks, entities decoded, whitespace as it falls."""
    return decode_entities(F.regexp_replace(cleaned, TAG, " "))


def plain_text(cleaned: Column) -> Column:
    """The text in one line."""
    return collapse_space(bare_text(cleaned))


def tags(cleaned: Column, name: str) -> Column:
    """All opening tags of one element, as written, in document order."""
    return F.regexp_extract_all(cleaned, F.lit(rf"(?is)(<{name}(?:\s[^>]*)?>)"), 1)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, double-quoted, single-quoted or bare; NULL if there is none.

    Attributes are passed one by one, so a name inside another one's value is not taken for it.
    """
    value = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
    other = rf"""[\s/]++(?!{name}\s*+=)[^\s=>"'/]++(?:\s*+=\s*+{value})?+"""
    pattern = rf"""(?is)^<[^\s/>]++(?:{other})*+[\s/]++{name}\s*+=\s*+({value})"""
    value = F.nullif(F.regexp_extract(tag, pattern, 1), F.lit(""))
    return F.regexp_replace(value, r"""(?s)^["'](.*)["']$""", "$1")


def base_of(cleaned: Column, url: Column) -> Column:
    """What relative addresses of a page stand for: the target of its first `base` element that has one, else its own URL."""
    given = F.filter(F.transform(tags(cleaned, "base"), lambda t: strip_space(decode_entities(attribute(t, "href")))), lambda h: h.isNotNull())
    own = let(F.get(given, F.lit(0)), lambda h: F.when(h.isNull() | (h == ""), url).otherwise(resolve_url(h, url)))
    return F.when(cleaned.rlike(r"(?i)<base[\s/]"), own).otherwise(url)


def _urls_of(cleaned: Column, tag: str, attr: str, url: Column) -> Column:
    def found(page: Column) -> Column:
        values = F.transform(tags(page, tag), lambda t: strip_space(decode_entities(attribute(t, attr))))
        present = F.filter(values, lambda v: v.isNotNull() & (v != ""))
        absolute = let(base_of(page, url), lambda base: F.transform(present, lambda v: resolve_url(v, base)))
        return F.array_distinct(F.filter(absolute, lambda u: u.rlike(r"(?i)^https?://")))

    return let(cleaned, found)


def links(cleaned: Column, base: Column) -> Column:
    """Absolute http(s) targets of `a[href]`, first occurrence of each, in document order."""
    return _urls_of(cleaned, "a", "href", base)


def images(cleaned: Column, base: Column) -> Column:
    return _urls_of(cleaned, "img", "src", base)


def emails(cleaned: Column) -> Column:
    """Addresses in the text, then those of `mailto:` links, each once. Pages without an `@` or a numeric reference are not searched."""
    return F.when(cleaned.contains("@") | cleaned.contains("&#"), _emails(cleaned)).otherwise(F.when(cleaned.isNotNull(), _no_strings()))


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def _emails(cleaned: Column) -> Column:
    in_text = F.regexp_extract_all(bare_text(cleaned), F.lit(f"({_EMAIL})"), 1)
    hrefs = F.transform(tags(cleaned, "a"), lambda t: decode_entities(attribute(t, "href")))
    mailto = F.transform(
        F.filter(hrefs, lambda h: h.rlike("(?i)^mailto:")), lambda h: F.regexp_extract(h, f"({_EMAIL})", 1)
    )
    return F.array_distinct(F.concat(in_text, F.filter(mailto, lambda m: m != "")))


def title(cleaned: Column) -> Column:
    found = F.regexp_extract(cleaned, r"(?is)<title\b[^>]*>(.*?)</title>", 1)
    return F.nullif(collapse_space(decode_entities(found)), F.lit(""))


def description(cleaned: Column) -> Column:
    named = F.filter(tags(cleaned, "meta"), lambda t: F.lower(attribute(t, "name")) == "description")
    return let(F.try_element_at(named, F.lit(1)), lambda t: collapse_space(decode_entities(attribute(t, "content"))))


def language(cleaned: Column) -> Column:
    return attribute(F.regexp_extract(cleaned, r"(?is)<html\b[^>]*>", 0), "lang")


def favicon(cleaned: Column, base: Column) -> Column:
    icons = F.filter(
        tags(cleaned, "link"),
        lambda t: F.array_contains(F.split(F.lower(F.coalesce(attribute(t, "rel"), F.lit(""))), r"\s+"), "icon"),
    )
    hrefs = F.filter(F.transform(icons, lambda t: attribute(t, "href")), lambda h: h.isNotNull())
    return let(F.try_element_at(hrefs, F.lit(1)), lambda h: resolve_url(h, base))


def content_type(cleaned: Column) -> Column:
    charsets = F.filter(
        F.transform(tags(cleaned, "meta"), lambda t: F.lower(attribute(t, "charset"))), lambda c: c.isNotNull()
    )
    charset = F.try_element_at(charsets, F.lit(1))
    return F.concat(F.lit("text/html"), F.coalesce(F.concat(F.lit("; charset="), charset), F.lit("")))
