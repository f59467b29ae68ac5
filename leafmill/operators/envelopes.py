"""API responses (JSON text) to typed rows.

Text is parsed once into a VARIANT. Keys may be camelCase or snake_case; unknown keys survive in `extra` as JSON.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.functions.errors import error_message, is_retryable
from leafmill.functions.naming import KNOWN_KEYS, camel_to_snake, snake_json_keys
from leafmill.functions.text import blank_to_null

# Document fields and metadata fields with their types.
_DOC_FIELDS = {
    "markdown": "string", "html": "string", "raw_html": "string", "links": "array<string>",
    "images": "array<string>", "emails": "array<string>",
}
_META_FIELDS = {
    "title": "string", "description": "string", "language": "string", "source_url": "string", "url": "string",
    "status_code": "int", "scrape_id": "string", "credits_used": "double", "cache_state": "string",
    "content_type": "string", "favicon": "string",
}
NO_OBJECT = "response is not a JSON object"
_WIRE = {snake: camel for camel, snake in KNOWN_KEYS.items()}


def spellings(name: str) -> list[str]:
    """A field's snake_case name and its name on the wire, where they differ."""
    first, *rest = name.split("_")
    return list(dict.fromkeys((name, _WIRE.get(name, first + "".join(p.title() for p in rest)))))


def parse(df: DataFrame, col: str = "value", out: str = "body") -> DataFrame:
    """Text to VARIANT; text that is not JSON gives NULL."""
    return df.withColumn(out, F.try_parse_json(F.col(col)))


def get(v: Column, name: str, kind: str) -> Column:
    """A field under its snake_case or its wire name; NULL if missing or of another type."""
    return F.coalesce(*[F.try_variant_get(v, f"$.{n}", kind) for n in spellings(name)])


def object_of(v: Column) -> Column:
    """The fields of an object as map<string, variant>; NULL for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def extra_of(v: Column, known: Iterable[str]) -> Column:
    """Unknown fields as JSON with snake_case keys, NULL if there are none."""
    names = [n for k in known for n in spellings(k)]
    rest = F.map_filter(object_of(v), lambda k, _: ~k.isin(names))
    return F.when(F.size(rest) > 0, snake_json_keys(F.to_json(rest)))


def _success(env: Column) -> Column:
    """The object's flag, true without one; false for anything but an object."""
    given = F.coalesce(F.try_variant_get(env, "$.success", "boolean"), F.lit(True))
    return F.when(object_of(env).isNull(), F.lit(False)).otherwise(given)


def _with_data(df: DataFrame, envelope: str) -> DataFrame:
    """Add `_data`: the `data` field if it is an object, else the envelope itself."""
    data = F.try_variant_get(F.col(envelope), "$.data", "variant")
    is_object = F.try_variant_get(F.col(envelope), "$.data", "map<string,variant>").isNotNull()
    return df.withColumn("_data", F.when(is_object, data).otherwise(F.col(envelope)))


def documents_from_envelopes(df: DataFrame, envelope: str = "body") -> DataFrame:
    """Scrape responses to documents: fields at top level, `metadata` a struct, success and error settled.

    A missing `success` means true in an object; a response that is no JSON object failed and says so. The envelope's error
    comes first; an empty one falls through to the data's.
    """
    df = _with_data(df, envelope)
    data, env = F.col("_data"), F.col(envelope)
    meta = F.try_variant_get(data, "$.metadata", "variant")
    meta_struct = F.struct(
        *[get(meta, f, kind).alias(f) for f, kind in _META_FIELDS.items()],
        extra_of(meta, _META_FIELDS).alias("extra"),
    )
    known = [*_DOC_FIELDS, "json", "metadata", "success", "error"]
    has_meta = object_of(meta).isNotNull()
    return df.withColumns(
        {
            **{f: get(data, f, kind) for f, kind in _DOC_FIELDS.items()},
            "json": snake_json_keys(F.to_json(F.try_variant_get(data, "$.json", "variant"))),
            "metadata": F.when(has_meta, meta_struct),
            "success": _success(env),
            "error": F.coalesce(
                blank_to_null(F.try_variant_get(env, "$.error", "string")),
                F.try_variant_get(data, "$.error", "string"),
                F.when(object_of(env).isNull(), F.lit(NO_OBJECT)),
            ),
            "extra": extra_of(data, known),
        }
    ).drop("_data", envelope)


def search_from_envelopes(df: DataFrame, envelope: str = "body") -> DataFrame:
    """Search responses, one row each: success, credits, id and `web` as array<variant> (empty if missing)."""
    env = F.col(envelope)
    web = F.coalesce(
        F.try_variant_get(env, "$.data.web", "array<variant>"), F.array().cast("array<variant>")
    )
    return df.withColumns(
        {
            "success": _success(env),
            "credits_used": get(env, "credits_used", "double"),
            "id": F.try_variant_get(env, "$.id", "string"),
            "web": web,
        }
    ).drop(envelope)


def _hit_columns(v: Column) -> list[Column]:
    return [
        F.try_variant_get(v, "$.url", "string").alias("url"),
        F.try_variant_get(v, "$.title", "string").alias("title"),
        F.try_variant_get(v, "$.description", "string").alias("description"),
        F.try_variant_get(v, "$.position", "int").alias("position"),
        extra_of(v, ("url", "title", "description", "position")).alias("extra"),
    ]


def _objects(entries: Column) -> Column:
    """The entries that are objects, each with its place in the list."""
    placed = F.transform(entries, lambda v, i: F.struct(i.alias("idx"), v.alias("value")))
    return F.filter(placed, lambda e: object_of(e["value"]).isNotNull())


def _exploded(df: DataFrame, keep: list[str], entries: Column, value: str, keep_empty: bool) -> DataFrame:
    explode = F.explode_outer if keep_empty else F.explode
    rows = df.select(*keep, explode(_objects(entries)).alias("_entry"))
    return rows.select(*keep, F.col("_entry.idx").alias("idx"), F.col("_entry.value").alias(value))


def hits_from_envelopes(df: DataFrame, envelope: str = "body", keep_empty: bool = False) -> DataFrame:
    """Search responses to hits, one row each, in order (`idx`); entries that are not objects are skipped.

    With `keep_empty`, a response without hits keeps one row, whose `idx` and hit columns are null."""
    flat = search_from_envelopes(df, envelope)
    keep = [c for c in flat.columns if c != "web"]
    return _exploded(flat, keep, F.col("web"), "_hit", keep_empty).select(*keep, "idx", *_hit_columns(F.col("_hit")))


def batch_documents(df: DataFrame, envelope: str = "body", keep_empty: bool = False) -> DataFrame:
    """Batch responses to documents in input order (`idx`); entries that are not objects are skipped.

    With `keep_empty`, a batch without documents keeps one row, whose `idx` and document columns are null."""
    results = F.try_variant_get(F.col(envelope), "$.results", "array<variant>")
    keep = [c for c in df.columns if c != envelope]
    docs = documents_from_envelopes(_exploded(df, keep, results, "_item", keep_empty), "_item")
    if not keep_empty:
        return docs
    return docs.select(*keep, "idx", *(F.when(F.col("idx").isNotNull(), F.col(c)).alias(c) for c in docs.columns if c not in (*keep, "idx")))


def batch_counts(df: DataFrame, envelope: str = "body") -> DataFrame:
    """Success and count of each batch response; without a count, the number of documents in it."""
    env = F.col(envelope)
    results = F.coalesce(
        F.try_variant_get(env, "$.results", "array<variant>"), F.array().cast("array<variant>")
    )
    documents = F.size(F.filter(results, lambda r: object_of(r).isNotNull()))
    return df.withColumns(
        {
            "success": _success(env),
            "count": F.coalesce(F.try_variant_get(env, "$.count", "int"), documents),
        }
    ).drop(envelope)


def errors_from_bodies(df: DataFrame, envelope: str = "body", status: str = "status") -> DataFrame:
    """Failed responses: code, message (with its fallbacks), whether a retry is due, and the unknown rest."""
    env = F.col(envelope)
    text = lambda name: F.try_variant_get(env, f"$.{name}", "string")
    flag = F.try_variant_get(env, "$.retryable", "boolean")
    return df.withColumns(
        {
            "code": text("code"),
            "message": error_message(text("message"), text("title"), F.col(status)),
            "retryable": flag,
            "will_retry": is_retryable(F.col(status), flag),
            "remediation": text("remediation"),
            "extra": extra_of(env, ("code", "status", "retryable", "title", "message", "remediation")),
        }
    ).drop(envelope)


def batch_summary(docs: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Documents and successes per batch."""
    return docs.groupBy(batch).agg(
        F.count(F.lit(1)).alias("count"),
        F.count(F.when(F.col("success"), 1)).alias("succeeded"),
        F.bool_and("success").alias("success"),
    )


def _field_names(t: T.DataType) -> set[str]:
    """Names of all fields at any depth, through arrays and map values."""
    if isinstance(t, T.StructType):
        return {f.name for f in t} | {n for f in t for n in _field_names(f.dataType)}
    if isinstance(t, T.ArrayType):
        return _field_names(t.elementType)
    return _field_names(t.valueType) if isinstance(t, T.MapType) else set()


def _renamed(t: T.DataType, names: dict[str, str]) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(names[f.name], _renamed(f.dataType, names), f.nullable) for f in t])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_renamed(t.elementType, names), t.containsNull)
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, _renamed(t.valueType, names), t.valueContainsNull)
    return t


def normalize_keys(df: DataFrame) -> DataFrame:
    """Rename columns and nested fields, through arrays and map values, to snake_case. Data are not touched.

    The names go through `camel_to_snake` as one row of literals, which Spark folds while it plans: no job runs.
    """
    wire = sorted(_field_names(df.schema))
    one = df.sparkSession.range(1).select(F.array(*[camel_to_snake(F.lit(n)) for n in wire]).alias("names")).first()
    names = dict(zip(wire, one["names"], strict=True))
    return df.select(
        *[F.col(f"`{f.name}`").cast(_renamed(f.dataType, names)).alias(names[f.name]) for f in df.schema]
    )
