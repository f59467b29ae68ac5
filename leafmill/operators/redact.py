"""PII redaction and its audit.

Patterns cover EMAIL, PHONE, FINANCIAL and SECRET. PERSON and LOCATION need names: the user brings them as a table
of terms.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.html import let
from leafmill.plans.skew import bounded_join
from leafmill.schemas import ENTITIES, REDACT_MODES, REPLACE_STYLES

# Secrets go first and cards before phones, so that a long run of digits is not taken for a phone; places before people, so
# that a name inside a place's name does not spoil it.
ORDER = ("SECRET", "EMAIL", "FINANCIAL", "PHONE", "LOCATION", "PERSON")

_PATTERNS = {
    # A named value; a bearer token; keys that tell what they are by their first letters.
    "SECRET": r"((?i:password|passwd|secret|token|api[_-]?key)[\"']?[ ]{0,3}[:=][ ]{0,3}[\"']?[A-Za-z0-9+/_.=$!@#%^&*-]{6,}[\"']?"
    r"|Bearer [A-Za-z0-9._~+/=-]{16,}|A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})",
    "EMAIL": r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})",
    # 13 to 19 digits, in groups or not.
    "FINANCIAL": r"(\b(?:[0-9][ -]?){12,18}[0-9]\b)",
    # International numbers, and national ones with the area in brackets.
    "PHONE": r"(\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[-.][0-9]{4})",
}
_LOOSE_PHONE = _PATTERNS["PHONE"][:-1] + r"|\b[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}\b)"

_MODE_ENTITIES = {
    "fast": ("SECRET", "EMAIL", "PHONE"),
    "accurate": ("SECRET", "EMAIL", "FINANCIAL", "PHONE"),
    "aggressive": ("SECRET", "EMAIL", "FINANCIAL", "PHONE"),
}


def normalise_option(option: bool | Mapping | None) -> dict | None:
    """`True` or a partial mapping to `{mode, entities, replaceStyle}`; `False` and None mean no redaction."""
    if option is None or option is False:
        return None
    given = {} if option is True else dict(option)
    out = {
        "mode": given.get("mode") or "accurate",
        "entities": tuple(given.get("entities") or ENTITIES),
        "replaceStyle": given.get("replaceStyle") or "tag",
    }
    if out["mode"] not in REDACT_MODES:
        raise ValueError(f"unknown mode {out['mode']!r}")
    if out["replaceStyle"] not in REPLACE_STYLES:
        raise ValueError(f"unknown replace style {out['replaceStyle']!r}")
    unknown = set(out["entities"]) - set(ENTITIES)
    if unknown:
        raise ValueError(f"unknown entities {sorted(unknown)}")
    return out


def patterns(mode: str = "accurate", entities: Sequence[str] = ENTITIES) -> list[tuple[str, str]]:
    """`(entity, pattern)` in the order they are applied."""
    chosen = [e for e in ORDER if e in entities and e in _MODE_ENTITIES[mode]]
    return [(e, _LOOSE_PHONE if e == "PHONE" and mode == "aggressive" else _PATTERNS[e]) for e in chosen]


def _stand_in(entity: str, style: str, hit: Column) -> Column:
    if style == "tag":
        return F.lit(f"[{entity}]")
    if style == "mask":
        return F.repeat(F.lit("*"), F.length(hit))
    return F.lit("")


def _rewrite(text: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """Replace every match by `new(match)`: the pieces between matches are zipped with the rewritten matches."""
    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), new)
    return F.array_join(
        F.zip_with(
            F.split(text, pattern, -1), matches, lambda gap, hit: F.concat(gap, F.coalesce(hit, F.lit("")))
        ),
        "",
    )


def _may_hold(text: Column, entity: str, mode: str) -> Column:
    """A cheap test that a text can have hits: a literal every match contains, else a search for the first match."""
    if entity == "EMAIL":
        return text.contains("@")
    if entity == "PHONE" and mode != "aggressive":
        return text.contains("+") | text.contains("(")
    return text.rlike(dict(patterns(mode))[entity])


def luhn_ok(c: Column) -> Column:
    return F.call_function("luhn_check", F.translate(c, " -", ""))


def _replace_card(style: str) -> Callable[[Column], Column]:
    return lambda m: F.when(luhn_ok(m), _stand_in("FINANCIAL", style, m)).otherwise(m)


def redact_text(text: Column, option: bool | Mapping | None = True) -> Column:
    opt = normalise_option(option)
    if opt is None:
        return text
    style = opt["replaceStyle"]
    for entity, pattern in patterns(opt["mode"], opt["entities"]):
        text = let(text, _redact_step(entity, pattern, opt["mode"], style))
    return text


def _redact_step(entity: str, pattern: str, mode: str, style: str) -> Callable[[Column], Column]:
    def step(text: Column) -> Column:
        if entity == "FINANCIAL" and mode == "accurate":
            changed = _rewrite(text, pattern, _replace_card(style))
        elif style == "mask":
            changed = _rewrite(text, pattern, lambda m: _stand_in(entity, "mask", m))
        else:
            changed = F.regexp_replace(text, pattern, f"[{entity}]" if style == "tag" else "")
        return F.when(_may_hold(text, entity, mode), changed).otherwise(text)

    return step


def redact(
    df: DataFrame,
    col: str,
    option: bool | Mapping | None = True,
    terms: Mapping[str, DataFrame] | None = None,
    id_col: str = "doc_id",
) -> DataFrame:
    """Redact the patterns of the chosen entities, then LOCATION and PERSON by the user's tables of terms (column `term`).

    No pattern can find the last two. An option that names one of them without a table for it is an error; with
    `True` or no list of entities, only those are redacted that have a pattern or a table.
    """
    opt = normalise_option(option)
    if opt is None:
        return df
    tables = dict(terms or {})
    named = () if option is True else dict(option).get("entities") or ()
    missing = sorted(set(named) - set(_PATTERNS) - set(tables))
    if missing:
        raise ValueError(f"{', '.join(missing)} needs a table of terms")
    df = df.withColumn(col, redact_text(F.col(col), option))
    for entity in ORDER:
        if entity in tables and entity in opt["entities"]:
            df = redact_terms(df, id_col, col, tables[entity], entity, style=opt["replaceStyle"])
    return df


def _hit_row(entity: str) -> Callable[[Column, Column], Column]:
    return lambda v, i: F.struct(F.lit(entity).alias("entity"), i.alias("pos"), v.alias("value"))


def find_pii(df: DataFrame, id_col: str, col: str, option: bool | Mapping = True) -> DataFrame:
    """What the patterns find, as rows `(id, entity, pos, value)`; `pos` counts the entity's hits in the text.

    Each entity is searched in the text as it stands, so the hits of one do not hide those of another.
    """
    opt = normalise_option(option)
    found = []
    for entity, pattern in patterns(opt["mode"], opt["entities"]):
        hits = F.when(
            _may_hold(F.col(col), entity, opt["mode"]), F.regexp_extract_all(F.col(col), F.lit(pattern), 1)
        ).otherwise(F.array().cast("array<string>"))
        if entity == "FINANCIAL" and opt["mode"] == "accurate":
            hits = F.filter(hits, luhn_ok)
        found.append(F.transform(hits, _hit_row(entity)))
    if not found:
        found = [F.array().cast("array<struct<entity: string, pos: int, value: string>>")]
    return df.select(id_col, F.inline(F.concat(*found)))


#: Most terms, and letters in all of them, that redact_terms() puts in one pattern.
MOST_TERMS, MOST_LETTERS = 20_000, 400_000

_WORD = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_]+)"


def _span(n: int) -> Callable[[Column, Column], Column]:
    """The `n` words and separators from place `i` on, as a candidate term; shorter at the end of the text."""
    return lambda word, i: F.struct(
        i.alias("first"), (i + n - 1).alias("last"),
        (word if n == 1 else F.array_join(F.slice(F.col("_w"), i + 1, F.lit(n)), "")).alias("_term"),
    )


def find_terms(df: DataFrame, id_col: str, col: str, terms: DataFrame, term: str = "term") -> DataFrame:
    """Where the terms stand in the texts: `(id, first, last)`, places in the word/separator sequence of the text.

    Terms match whole words, exactly as written, and may span several words. Texts are joined with the terms on the
    term itself, once per term length that occurs (those few numbers are read first), so this grows with the text and
    not with texts * terms.
    """
    pieces = F.regexp_extract_all(F.col(term), F.lit(_WORD), 1)
    sized = terms.select(F.col(term).alias("_term"), F.size(pieces).alias("_len"))
    sized = sized.where(F.col("_term").rlike(r"[\p{L}\p{N}_]")).distinct()
    lengths = sorted(r["_len"] for r in sized.select("_len").distinct().collect())
    words = df.select(id_col, F.regexp_extract_all(F.col(col), F.lit(_WORD), 1).alias("_w"))
    if not lengths:
        return df.select(id_col, F.lit(0).alias("first"), F.lit(0).alias("last")).where(F.lit(False))
    spans = F.array(*[F.transform("_w", _span(n)) for n in lengths])
    candidates = words.select(id_col, F.explode(spans).alias("_s")).select(id_col, F.inline("_s"))
    return bounded_join(
        candidates, sized.select("_term"), "_term", "left_semi", [id_col, "first", "last"]
    ).select(id_col, "first", "last")


def _quoted(c: str) -> str:
    return c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):x}}}"


_IN_WORD = r"\p{L}\p{N}_"


def term_pattern(terms: Iterable[str]) -> str:
    """A pattern for all of these terms, as a tree over their common beginnings, so that a place in a text costs the letters
    that fit and not the number of terms. Of several terms that start at a place the longest matches. A match starts and
    ends where words and separators meet, as the pieces of _WORD do."""
    tree: dict = {}
    for t in terms:
        at = tree
        for c in t:
            at = at.setdefault(c, {})
        at[""] = t

    def written(node: dict) -> str:
        said = ""
        while len(node) == 1 and "" not in node:  # letters without a choice
            (c, node), = node.items()
            said += _quoted(c)
        ways = [_quoted(c) + written(below) for c, below in sorted(node.items()) if c]
        if "" in node:
            ways.append(f"(?![{_IN_WORD}])" if _is_word(node[""][-1]) else f"(?![^{_IN_WORD}])")
        return said + (ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})")

    starts = []
    for word, edge in ((True, f"(?<![{_IN_WORD}])"), (False, f"(?<![^{_IN_WORD}])")):
        own = {c: below for c, below in tree.items() if c and _is_word(c) == word}
        if own:
            starts.append(edge + written(own))
    return f"({'|'.join(starts)})"


def _is_word(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] in "LN"


def redact_terms(
    df: DataFrame, id_col: str, col: str, terms: DataFrame, entity: str, term: str = "term", style: str = "tag"
) -> DataFrame:
    """Redact the user's terms. Where matches overlap, the one that starts first wins, then the longest.

    Terms match whole words, exactly as written; null terms and terms without a letter or digit match nothing. Each row is
    redacted by its own text; `id_col` may be null or repeated and is not read. A null text stays null.

    Up to MOST_TERMS terms of MOST_LETTERS letters in all become one pattern, and the redaction a projection. Larger tables
    are joined with the terms' places in the distinct texts.
    """
    wanted = terms.select(F.col(term).cast("string").alias("_term")).where(F.col("_term").rlike(r"[\p{L}\p{N}_]")).distinct()
    some = wanted.limit(MOST_TERMS + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("_term")).alias("letters")).first()
    if not some["n"]:
        return df
    if some["n"] > MOST_TERMS or some["letters"] > MOST_LETTERS:
        return _redact_by_join(df, col, wanted, entity, style)
    pattern = term_pattern(r["_term"] for r in wanted.collect())
    text = F.col(col)
    if style == "mask":
        changed = F.when(text.rlike(pattern), _rewrite(text, pattern, lambda m: _stand_in(entity, style, m))).otherwise(text)
    else:
        changed = F.regexp_replace(text, F.lit(pattern), F.lit(f"[{entity}]" if style == "tag" else ""))
    return df.withColumn(col, changed)


def _redact_by_join(df: DataFrame, col: str, terms: DataFrame, entity: str, style: str) -> DataFrame:
    """Places depend on the text alone, so they are found once for each distinct text and looked up by its digest."""
    order = F.struct("first", (-F.col("last")).alias("_back"), F.col("last").alias("last"))
    key, spans, words, new = _unused(df, "_text_key", "_spans", "_words", "_new")
    texts = df.select(F.sha2(F.col(col), 256).alias(key), F.col(col).alias("_text")).where(F.col("_text").isNotNull())
    found = find_terms(texts.dropDuplicates([key]), key, "_text", terms, "_term")
    per_text = found.groupBy(key).agg(F.sort_array(F.collect_list(order)).alias(spans))
    first_longest = F.aggregate(
        spans,
        F.array().cast("array<struct<first: int, _back: int, last: int>>"),
        lambda acc, s: F.when(
            (F.size(acc) == 0) | (s["first"] > F.element_at(acc, -1)["last"]), F.array_append(acc, s)
        ).otherwise(acc),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.slice(F.col(words), acc["at"] + 1, s["first"] - acc["at"])
        hit = F.array_join(F.slice(F.col(words), s["first"] + 1, s["last"] - s["first"] + 1), "")
        piece = F.concat(F.array_join(gap, ""), _stand_in(entity, style, hit))
        return F.struct((s["last"] + 1).alias("at"), F.array_append(acc["out"], piece).alias("out"))

    def finish(acc: Column) -> Column:
        rest = F.slice(F.col(words), acc["at"] + 1, F.greatest(F.size(words) - acc["at"], F.lit(0)))
        return F.concat(F.array_join(acc["out"], ""), F.array_join(rest, ""))

    joined = df.withColumn(key, F.sha2(F.col(col), 256)).join(per_text, key, "left").withColumn(spans, first_longest)
    cut = F.when(F.size(spans) > 0, F.regexp_extract_all(F.col(col), F.lit(_WORD), 1))
    rebuilt = joined.withColumn(words, cut).withColumn(new, F.aggregate(spans, start, step, finish))
    changed = F.when(F.size(spans) > 0, F.col(new)).otherwise(F.col(col))
    return rebuilt.withColumn(col, changed).select(*df.columns)


def _unused(df: DataFrame, *names: str) -> list[str]:
    """These names, with underscores behind them until no column of `df` has them."""
    out = []
    for name in names:
        while name in df.columns:
            name += "_"
        out.append(name)
    return out
