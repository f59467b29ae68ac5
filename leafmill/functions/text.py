"""Whitespace, entities and previews."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every whitespace character. Spark's trim() strips blanks only unless it is told what to strip.
SPACES = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"

#: Named references and what they show: those of HTML 4, and `&apos;`. A hard blank counts as a blank.
ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "nbsp": " "}
#: What the numbers 128 to 159 stand for in pages: the Windows characters where there is one, else the number's own.
_WINDOWS = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))


def strip_space(c: Column) -> Column:
    """Strip all leading and trailing whitespace, newlines and Unicode spaces included."""
    return F.trim(c, F.lit(SPACES))


def collapse_space(c: Column) -> Column:
    """Every run of whitespace becomes one blank; the ends are stripped. Single blanks are not touched."""
    return F.trim(F.regexp_replace(c, rf"{_SPACE}{{2,}}|{_SPACE[:-1]}&&[^ ]]", " "))


def decode_entities(c: Column) -> Column:
    """Named and numeric references, in one pass, so that nothing is decoded twice; others stay as they are. Texts without
    `&` are passed on."""

    def decoded(t: Column) -> Column:
        parts = F.split(t, "&", -1)
        return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), _reference), ""))

    return F.transform(F.array(c), lambda t: F.when(t.contains("&"), decoded(t)).otherwise(t))[0]


def _reference(part: Column) -> Column:
    """What stands behind an `&`, up to the next one, with the reference it begins with replaced."""
    known = F.str_to_map(F.lit(";".join(f"{k}:{v}" for k, v in ENTITIES.items())), F.lit(";"), F.lit(":"))
    name = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]{1,9});", 1)
    named = F.transform(
        F.array(name), lambda n: F.concat(F.try_element_at(known, n), F.substring(part, F.length(n) + 2, F.length(part)))
    )[0]
    return F.when(part.startswith("#"), _numeric(part)).otherwise(F.coalesce(named, F.concat(F.lit("&"), part)))


def _numeric(part: Column) -> Column:
    """`#8217;` and `#x2019;` as characters; a number that is no character stays as it is."""
    found = F.regexp_extract(part, "^#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7});", 0)
    is_hex = F.lower(F.substring(found, 2, 1)) == "x"
    digits = F.regexp_replace(found, "[#xX;]", "")
    code = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")

    def shown(n: Column) -> Column:
        good = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        own = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        char = F.when(n.between(128, 159), F.substring(F.lit(_WINDOWS), n - 127, F.lit(1))).otherwise(own)
        rest = F.substring(part, F.length(found) + 1, F.length(part))
        return F.when(good, F.concat(char, rest)).otherwise(F.concat(F.lit("&"), part))

    return F.transform(F.array(code), shown)[0]


def preview(c: Column, n: int) -> Column:
    """First `n` characters on one line."""
    return F.regexp_replace(F.substring(c, 1, n), r"[\r\n]", " ")


def blank_to_null(c: Column) -> Column:
    """Empty strings count as missing, as they do where a falsy value falls through."""
    return F.nullif(c, F.lit(""))
