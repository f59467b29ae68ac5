"""Pages as node tables, and selector-extracted fields.

A page is cut into tokens that cover all of its cleaned HTML. Pages are spread by page_id *before* they are cut, so
the windows below (all bound to one page) need no further shuffle. Text is not carried through the windows: an element
is a pair of character offsets, and its text is cut out of the page once the match is known.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafmill.functions import html as H
from leafmill.functions.text import collapse_space, decode_entities
from leafmill.plans.spread import by_key, parts_for

_TOKEN = r"(?s)(</?[A-Za-z][^>]*>|<[!?][^>]*>|[^<]+|<)"
_ATTR = r"""([A-Za-z_:][A-Za-z0-9_:.\-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""

# Elements without content, and elements that the next one of the same name closes.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr",
)
SELF_CLOSED_BY_NEXT = ("p", "li", "dt", "dd", "option")


def page_tokens(pages: DataFrame, parts: int | None = None) -> DataFrame:
    """`(page_id, pos, offset, length, kind, tag, attrs, text)`; kind is open, close, void, text or other.

    `parts` are the partitions, by default as many as the length of the pages asks for: tokens are sorted several times in
    a task, which holds many times the text of its pages.
    """
    parts = parts_for(pages, "html") if parts is None else parts
    spread = by_key(pages.select("page_id", "html"), "page_id", parts)
    cut = spread.select(
        "page_id",
        F.posexplode(F.regexp_extract_all(H.clean_html(F.col("html")), F.lit(_TOKEN), 1)).alias("pos", "token"),
    )
    token = F.col("token")
    tag = F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s/>]*)", 1))
    second = F.substring(token, 2, 1)
    is_tag = token.startswith("<") & (F.length(token) > 1) & ~second.isin("!", "?")
    kind = (
        F.when(~token.startswith("<") | (F.length(token) == 1), "text")
        .when(second == "/", "close")
        .when(second.isin("!", "?"), "other")
        .when(token.endswith("/>") | tag.isin(*VOID_TAGS), "void")
        .otherwise("open")
    )
    has_attrs = kind.isin("open", "void") & token.rlike(r"\s[A-Za-z_:]")
    in_page = W.partitionBy("page_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    length = F.length(token)
    return cut.select(
        "page_id", "pos", length.alias("length"), kind.alias("kind"), F.when(is_tag, tag).alias("tag"),
        F.when(has_attrs, _attrs(token)).alias("attrs"), F.when(kind == "text", decode_entities(token)).alias("text"),
    ).withColumn("offset", F.sum("length").over(in_page) - F.col("length"))


def _attrs(token: Column) -> Column:
    """Attribute map of a tag; the first of repeated names counts, names are lower case."""
    body = F.regexp_replace(token, r"^<[^\s/>]+|/?>$", "")
    names = F.transform(F.regexp_extract_all(body, F.lit(_ATTR), 1), F.lower)
    values = F.transform(
        F.regexp_extract_all(body, F.lit(_ATTR), 2),
        lambda v: decode_entities(F.regexp_replace(v, r"""(?s)^["'](.*)["']$""", "$1")),
    )
    pairs = F.arrays_zip(names.alias("n"), values.alias("v"))
    return H.let(
        pairs,
        lambda p: F.map_from_arrays(
            F.array_distinct(p["n"]),
            F.transform(F.array_distinct(p["n"]), lambda k: p["v"][F.array_position(p["n"], k).cast("int") - 1]),
        ),
    )


def page_nodes(pages: DataFrame, parts: int | None = None) -> DataFrame:
    """Tokens with `id`, `classes` and `attrs` on tags that have attributes, and `text` on text tokens."""
    classes = F.filter(F.split(F.coalesce(F.col("attrs")["class"], F.lit("")), r"\s+"), lambda c: c != "")
    return page_tokens(pages, parts).withColumns(
        {"id": F.col("attrs")["id"], "classes": F.when(F.col("attrs").isNotNull(), classes)}
    )


def page_elements(pages: DataFrame, parts: int | None = None) -> DataFrame:
    """Opening tags with the place where each ends: `end_pos` and `end_offset`, the first after its content.

    Open and close are paired per tag name by nesting level, so bad nesting of one name does not upset another.
    An element that is never closed ends at the next one of its name (`SELF_CLOSED_BY_NEXT`), else where the
    element around it closes, else at the end of the page.
    """
    rows = page_nodes(pages, parts).where(F.col("kind").isin("open", "close", "void", "text")).drop("text")
    page_end = F.max(F.col("offset") + F.col("length")).over(W.partitionBy("page_id"))
    rows = rows.withColumn("_page_end", page_end).where(F.col("kind") != "text")

    step = F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)
    by_tag = W.partitionBy("page_id", "tag").orderBy("pos")
    depth = F.sum(step).over(by_tag.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("_level", F.when(F.col("kind") == "close", depth + 1).otherwise(depth))
    rows = rows.withColumn("_void", F.col("kind") == "void")
    pair = W.partitionBy("page_id", "tag", "_void", "_level").orderBy("pos")
    rows = rows.withColumns(
        {"_next": F.lead(F.struct("kind", "pos", "offset")).over(pair), "_previous": F.lag("kind").over(pair)}
    )
    paired = ((F.col("kind") == "open") & (F.col("_next.kind") == "close")) | (
        (F.col("kind") == "close") & (F.col("_previous") == "open")
    )
    rows = rows.withColumn("_paired", F.coalesce(paired, F.lit(False)))

    # Depth over paired tags only: the close that ends what surrounds an unpaired tag is the next one at its depth.
    in_page = W.partitionBy("page_id").orderBy("pos")
    depth = F.sum(F.when(F.col("_paired"), step).otherwise(0)).over(in_page.rowsBetween(W.unboundedPreceding, 0))
    closing = F.col("_paired") & (F.col("kind") == "close")
    rows = rows.withColumn("_around", F.when(closing, depth + 1).otherwise(depth))
    at = F.struct("pos", "offset")

    def following(found: Column, *keys: str) -> Column:
        # Read backwards: a frame that grows is linear, one that shrinks towards the end is not.
        backwards = W.partitionBy("page_id", *keys).orderBy(F.desc("pos")).rowsBetween(W.unboundedPreceding, -1)
        return F.last(F.when(found, at), ignorenulls=True).over(backwards)

    outer = following(closing, "_around")
    next_same = following(F.col("kind") == "open", "tag")
    rows = rows.withColumn("_outer", outer).withColumn(
        "_same", F.when(F.col("tag").isin(*SELF_CLOSED_BY_NEXT), next_same)
    )
    page_close = F.struct(F.lit(2**31 - 1).alias("pos"), F.col("_page_end").alias("offset"))
    unpaired_end = F.coalesce(F.least(F.col("_same"), F.col("_outer")), page_close)
    end = (
        F.when(F.col("_void"), F.struct(F.col("pos"), (F.col("offset") + F.col("length")).alias("offset")))
        .when(F.col("_paired"), F.struct("_next.pos", "_next.offset"))
        .otherwise(unpaired_end)
    )
    return (
        rows.where(F.col("kind") != "close")
        .withColumn("_end", end)
        .select(
            "page_id", "pos", "kind", "tag", "id", "classes", "attrs",
            (F.col("offset") + F.col("length")).alias("content_offset"),
            F.col("_end.pos").alias("end_pos"), F.col("_end.offset").alias("end_offset"),
        )
    )


@dataclass(frozen=True)
class Step:
    """One compound selector and how it hangs on the one before it."""

    combinator: str  # "" first, " " descendant, ">" child
    tag: str | None = None
    id: str | None = None
    classes: tuple[str, ...] = ()
    attrs: tuple[tuple[str, str | None], ...] = ()

    def matches(self) -> Column:
        tests = []
        if self.tag:
            tests.append(F.col("tag") == self.tag)
        if self.id:
            tests.append(F.col("id") == self.id)
        tests += [F.array_contains("classes", c) for c in self.classes]
        for name, value in self.attrs:
            got = F.try_element_at("attrs", F.lit(name))
            tests.append(got.isNotNull() if value is None else got == value)
        out = F.lit(True)
        for test in tests:
            out = out & F.coalesce(test, F.lit(False))
        return out


_COMPOUND = re.compile(r"""(\*)|([.#]?)([A-Za-z_][\w-]*)|\[\s*([\w:-]+)\s*(?:=\s*["']?([^\]"']*)["']?\s*)?\]""")


def selector_steps(selector: str) -> list[list[Step]]:
    """A selector as lists of steps, one list per comma-separated alternative.

    Understood: tag, `.class`, `#id`, `[attr]`, `[attr=v]`, `*`, compounds of these, descendant, child, comma lists.
    """
    alternatives = []
    for part in selector.split(","):
        pieces = re.findall(r"""(?:\[[^\]]*\]|[^\s>\[])+|>""", part.strip())
        steps, combinator = [], ""
        for piece in pieces:
            if piece == ">":
                combinator = ">"
                continue
            found = list(_COMPOUND.finditer(piece))
            if "".join(m.group(0) for m in found) != piece:
                raise ValueError(f"selector not understood: {selector!r}")
            tags = [m.group(3).lower() for m in found if m.group(3) and not m.group(2)]
            ids = [m.group(3) for m in found if m.group(2) == "#"]
            steps.append(
                Step(
                    combinator if steps else "",
                    tags[0] if tags else None,
                    ids[0] if ids else None,
                    tuple(m.group(3) for m in found if m.group(2) == "."),
                    tuple((m.group(4).lower(), m.group(5)) for m in found if m.group(4)),
                )
            )
            combinator = " "
        if not steps:
            raise ValueError(f"empty selector in {selector!r}")
        alternatives.append(steps)
    return alternatives


def _parents(elements: DataFrame, flags: list[str]) -> DataFrame:
    """Add `_parent_<flag>` per flag: whether the element right above matched.

    Each element is put once at its own depth and once, as a possible parent, at the depth below; the parent is then
    the last candidate before it at that depth. Linear in the page, no pairs.
    """
    in_page = W.partitionBy("page_id").orderBy("_at", "_rank")
    end_rank = F.when(F.col("kind") == "void", 2).otherwise(0)  # ends come before opens at one place, voids' after
    marks = F.array(
        F.struct(F.col("pos").alias("_at"), F.lit(1).alias("_rank"), F.lit(1).alias("_d")),
        F.struct(F.col("end_pos").alias("_at"), end_rank.alias("_rank"), F.lit(-1).alias("_d")),
    )
    events = elements.withColumn("_m", F.explode(marks)).select("*", "_m.*").drop("_m")
    depth = F.sum("_d").over(in_page.rowsBetween(W.unboundedPreceding, 0))
    placed = events.withColumn("_depth", depth).where("_d = 1").drop("_at", "_rank", "_d")
    roles = F.explode(F.array(F.lit(0), F.lit(1)))  # 0 the element itself, 1 as a parent of the depth below
    both = placed.withColumn("_role", roles).withColumn("_depth", F.col("_depth") + F.col("_role"))
    before = W.partitionBy("page_id", "_depth").orderBy("pos", "_role").rowsBetween(W.unboundedPreceding, -1)
    parent = F.last(F.when(F.col("_role") == 1, F.struct("end_pos", *flags)), ignorenulls=True).over(before)
    out = both.withColumn("_parent", parent).where("_role = 0")
    for flag in flags:
        inside = (F.col("_parent.end_pos") > F.col("pos")) & F.col(f"_parent.{flag}")
        out = out.withColumn(f"_parent_{flag}", F.coalesce(inside, F.lit(False)))
    return out.drop("_parent", "_role", "_depth")


def match_selectors(pages: DataFrame, selectors: Mapping[str, str], parts: int | None = None) -> DataFrame:
    """Elements that match, as `(page_id, field, pos, attrs, content_offset, end_offset)`.

    All selectors are tested together, step by step: "has an ancestor that matched the step before" is a running
    maximum of end positions over the page, not a join.
    """
    paths = [(field, steps) for field, text in selectors.items() for steps in selector_steps(text)]
    elements = page_elements(pages, parts)
    before = W.partitionBy("page_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    for depth in range(max(len(steps) for _, steps in paths)):
        active = [(i, steps[depth]) for i, (_, steps) in enumerate(paths) if len(steps) > depth]
        child = [f"_hit{i}" for i, step in active if step.combinator == ">"]
        if child:
            elements = _parents(elements, child)
        new = {}
        for i, step in active:
            hit = step.matches()
            if step.combinator == ">":
                hit = hit & F.col(f"_parent__hit{i}")
            elif step.combinator == " ":
                reach = F.max(F.when(F.col(f"_hit{i}"), F.col("end_pos"))).over(before)
                hit = hit & F.coalesce(reach > F.col("pos"), F.lit(False))
            new[f"_hit{i}"] = hit
        elements = elements.withColumns(new).drop(*[f"_parent_{c}" for c in child])
    by_field: dict[str, Column] = {}
    for i, (field, _) in enumerate(paths):
        by_field[field] = by_field[field] | F.col(f"_hit{i}") if field in by_field else F.col(f"_hit{i}")
    fields = F.array_compact(F.array(*[F.when(hit, F.lit(field)) for field, hit in by_field.items()]))
    return elements.withColumn("field", F.explode(fields)).select(
        "page_id", "field", "pos", "attrs", "content_offset", "end_offset"
    )


def extract_fields(pages: DataFrame, rules: Mapping[str, str | Mapping]) -> DataFrame:
    """Rows `(page_id, field, idx, value)` for rules `field -> selector` or `{selector, attr?, multiple?}`.

    A rule gives the first match; with `multiple` all matches. Value is the attribute named by `attr`, else the
    element's text. Matches without the attribute give nothing.
    """
    rules = {f: {"selector": r} if isinstance(r, str) else dict(r) for f, r in rules.items()}
    parts = parts_for(pages, "html")
    hits = match_selectors(pages, {f: r["selector"] for f, r in rules.items()}, parts)
    attr_of = {f: r["attr"].lower() for f, r in rules.items() if r.get("attr")}
    many = [f for f, r in rules.items() if r.get("multiple")]

    attr_value = F.lit(None).cast("string")
    for field, name in attr_of.items():
        attr_value = F.when(F.col("field") == field, F.try_element_at("attrs", F.lit(name))).otherwise(attr_value)
    hits = hits.withColumn("_attr", attr_value).drop("attrs")
    if attr_of:
        hits = hits.where(F.col("_attr").isNotNull() | ~F.col("field").isin(*attr_of))
    place = F.row_number().over(W.partitionBy("page_id", "field").orderBy("pos")) - 1
    hits = hits.withColumn("idx", place)
    hits = hits.where((F.col("idx") == 0) | F.col("field").isin(*many)) if many else hits.where("idx = 0")

    # Same spread as the hits, so the page text meets its matches without another shuffle of either.
    source = by_key(pages.select("page_id", "html"), "page_id", parts).select(
        "page_id", H.clean_html(F.col("html")).alias("_clean")
    )
    inner = F.substring(F.col("_clean"), F.col("content_offset") + 1, F.col("end_offset") - F.col("content_offset"))
    text = collapse_space(decode_entities(F.regexp_replace(inner, H.TAG, "")))
    value = F.when(F.col("field").isin(*attr_of), F.col("_attr")).otherwise(text) if attr_of else text
    return hits.join(source, "page_id").select("page_id", "field", "idx", value.alias("value"))


def fields_json(fields: DataFrame, rules: Mapping[str, str | Mapping]) -> DataFrame:
    """One JSON object per page: a string per field, or a list where the rule says `multiple`; null if unmatched."""
    many = {f for f, r in rules.items() if not isinstance(r, str) and r.get("multiple")}
    values = {}
    for field in rules:
        of_field = F.col("field") == field
        if field in many:
            rows = F.sort_array(F.collect_list(F.when(of_field, F.struct("idx", "value"))))
            values[field] = rows["value"]
        else:
            values[field] = F.min(F.when(of_field, F.col("value")))
    return fields.groupBy("page_id").agg(
        F.to_json(F.struct(*[v.alias(f) for f, v in values.items()]), {"ignoreNullFields": "false"}).alias("json")
    )


def match_rule_table(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """Match a rule *table* `(field, tag, cls, elem_id)` of single compounds: `(page_id, pos, field)`.

    Each rule is anchored on its most selective part and joined on that key; the other parts are a filter. Spark
    broadcasts the rules when they are small and shuffles on the key otherwise.
    """
    anchored = rules.withColumn(
        "_key",
        F.coalesce(
            F.concat(F.lit("#"), F.col("elem_id")), F.concat(F.lit("."), F.col("cls")), F.col("tag")
        ),
    ).select("_key", "field", F.col("tag").alias("_tag"), F.col("cls").alias("_cls"))
    keys = F.array_compact(
        F.concat(
            F.array(F.col("tag"), F.concat(F.lit("#"), F.col("id"))),
            F.transform(F.coalesce("classes", F.array().cast("array<string>")), lambda c: F.concat(F.lit("."), c)),
        )
    )
    opened = nodes.where(F.col("kind").isin("open", "void"))
    probes = opened.select("page_id", "pos", "tag", "classes", F.explode(F.array_distinct(keys)).alias("_key"))
    tag_ok = F.col("_tag").isNull() | (F.col("_tag") == F.col("tag"))
    cls_ok = F.col("_cls").isNull() | F.array_contains("classes", F.col("_cls"))
    return probes.join(anchored, "_key").where(tag_ok & cls_ok).select("page_id", "pos", "field")
