"""URL encoding and resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_encode(c: Column) -> Column:
    """RFC 3986: only `A-Za-z0-9-._~` stay. Spark's url_encode writes forms, so its three differences are put right."""
    out = F.url_encode(c)
    for form, rfc in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(form), F.lit(rfc))
    return out


def _drop_dot_segments(url: Column) -> Column:
    """Fold `.` and `..` path segments; a `..` at the root has nothing to remove."""
    origin = F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)
    path = F.regexp_extract(url, r"^https?://[^/?#]+/([^?#]*)", 1)
    tail = F.regexp_extract(url, r"^[^?#]*([?#].*)$", 1)
    segments = F.split(path, "/", -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == ".", acc)
        .when(seg == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.array_append(acc, seg)),
    )
    dir_end = F.when(path.rlike(r"(^|/)\.\.?$") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(origin, F.lit("/"), F.array_join(kept, "/"), dir_end, tail)


def resolve_url(href: Column, base: Column) -> Column:
    """Make a link absolute against the page URL."""
    scheme = F.regexp_extract(base, r"^(https?:)", 1)
    origin = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    path_url = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.coalesce(
        F.nullif(F.regexp_extract(base, r"^(https?://[^/?#]+/(?:[^?#]*/)?)", 1), F.lit("")),
        F.concat(origin, F.lit("/")),
    )
    full = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(href.startswith("?"), F.concat(path_url, href))
        .otherwise(F.concat(folder, href))
    )
    # `full` is used twice below: bind it once instead of repeating the whole expression.
    return F.transform(
        F.array(full),
        lambda u: F.when(u.rlike(r"^https?://[^?#]*/\.\.?(/|[?#]|$)"), _drop_dot_segments(u)).otherwise(u),
    )[0]
