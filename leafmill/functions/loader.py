"""Text and metadata of loader records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import blank_to_null, strip_space


def hit_text(title: Column, description: Column, url: Column) -> Column:
    """Title and description on two lines, stripped; the URL when both are missing."""
    joined = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(description, F.lit("")))
    return F.coalesce(blank_to_null(strip_space(joined)), url)


def page_text(markdown: Column, html: Column | None = None) -> Column:
    """Markdown, else html where the caller allows it, else the empty string."""
    choices = [blank_to_null(markdown)]
    if html is not None:
        choices.append(blank_to_null(html))
    return F.coalesce(*choices, F.lit(""))


def loader_metadata(*layers: Column) -> Column:
    """Merge map<string,string> layers; a later layer wins and null values are left out.

    Layers are resolved key by key, so the result does not hang on the session's map-key policy.
    """
    layers = tuple(
        F.map_filter(F.coalesce(m, F.create_map().cast("map<string,string>")), lambda k, v: v.isNotNull())
        for m in layers
    )
    keys = F.array_distinct(F.concat(*[F.map_keys(m) for m in layers]))
    pick = lambda k: F.coalesce(*[F.try_element_at(m, k) for m in reversed(layers)])
    return F.map_from_arrays(keys, F.transform(keys, pick))
