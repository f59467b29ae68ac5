"""PII redaction (R)."""

from pyspark.sql import functions as F

from leafmill.operators import redact as R
from registry import sql as S
from registry.base import Entries, table

ENTRIES = Entries()
add = ENTRIES.add


#: Texts with usual shapes of personal data at their end, by the document's number.
_SHAPES = """select doc_id, concat(text, case doc_id % 10
  when 0 then ' Card 4316 5226 7852 5456, not 4316 5226 7852 5457.'
  when 1 then concat(' key AKIA', upper(substr(md5(cast(doc_id as string)), 1, 16)), '.')
  when 2 then concat(' Password: "', substr(md5(cast(doc_id as string)), 1, 12), '!"')
  when 3 then concat(' Authorization: Bearer ', md5(cast(doc_id as string)))
  when 4 then concat(' call (555) 123-', lpad(cast(doc_id % 10000 as string), 4, '0'))
  when 5 then ' or +44 20 7946 0958, +49 (0)30 1234567'
  when 6 then ' 555.123.4567 and 4222222222222 and 6304-0000-0000-0000-12'
  when 7 then concat(' api_key=sk-', md5(cast(doc_id as string)), ' a@b.example.org')
  else '' end) as text from {documents}"""
_TEXTS = f"with texts as ({_SHAPES.format(documents='documents')}) "


def _docs(spark, d):
    return spark.sql(_SHAPES, documents=table(spark, d, "documents"))


def _chain(steps):
    x = "text"
    for pattern, new in steps:
        x = S.rep(x, pattern, new)
    return x


_TAGS = ((S.SECRET, "[SECRET]"), (S.EMAIL, "[EMAIL]"), (S.CARD, "[FINANCIAL]"), (S.PHONE, "[PHONE]"))
_LOOSE_TAGS = (*_TAGS[:3], (S.LOOSE_PHONE, "[PHONE]"))


def _pieces(x, pattern, new):
    """Rewrite each match by an expression of `m`, from the pieces around the matches."""
    gaps = f"regexp_split_to_array({x}, '{S.quoted(pattern)}')"
    hits = f"regexp_extract_all({x}, '{S.quoted(pattern)}')"
    return (
        f"array_to_string(list_transform(list_zip({gaps}, {hits}), "
        f"lambda p: p[1] || coalesce(list_transform([p[2]], lambda m: {new})[1], '')), '')"
    )


_ACCURATE = S.rep(
    _pieces(_chain(_TAGS[:2]), S.CARD, f"case when {S.luhn('m')} then '[FINANCIAL]' else m end"), S.PHONE, "[PHONE]"
)


@add("r01_redact_true", f"{_TEXTS} select doc_id, {_ACCURATE} as text from texts")
def r01(spark, d):
    return R.redact(_docs(spark, d), "text", True)


@add("r02_entities", f"{_TEXTS} select doc_id, {_chain([_TAGS[1], _TAGS[3]])} as text from texts")
def r02(spark, d):
    return R.redact(_docs(spark, d), "text", {"entities": ["PHONE", "EMAIL"], "mode": "fast"})


@add("r03_style_remove", f"{_TEXTS} select doc_id, {_chain([(p, '') for p, _ in _LOOSE_TAGS])} as text from texts")
def r03_remove(spark, d):
    return R.redact(_docs(spark, d), "text", {"mode": "aggressive", "replaceStyle": "remove"})


@add(
    "r03_style_mask",
    f"{_TEXTS} select doc_id, {_pieces('text', S.EMAIL, 'repeat(chr(42), cast(length(m) as bigint))')} as text from texts",
)
def r03_mask(spark, d):
    return R.redact(_docs(spark, d), "text", {"entities": ["EMAIL"], "replaceStyle": "mask"})


@add("r04_mode_fast", f"{_TEXTS} select doc_id, {_chain([_TAGS[0], _TAGS[1], _TAGS[3]])} as text from texts")
def r04_fast(spark, d):
    return R.redact(_docs(spark, d), "text", {"mode": "fast"})


@add("r04_mode_aggressive", f"{_TEXTS} select doc_id, {_chain(_LOOSE_TAGS)} as text from texts")
def r04_aggressive(spark, d):
    return R.redact(_docs(spark, d), "text", {"mode": "aggressive"})


_TERM_WORDS = r"[A-Za-z]{8,}"


def _terms(spark, d):
    """Long words of the benchmark texts, as a table of names to hide."""
    words = F.explode(F.regexp_extract_all("text", F.lit(f"({_TERM_WORDS})"), 1))
    return table(spark, d, "benchmark").select(words.alias("term")).distinct()


#: Ids that are null or stand for two texts.
_IDS = "select case doc_id % 7 when 0 then null when 1 then doc_id - 2 else doc_id end as doc_id, text from {documents}"

_WORDS_SQL = rf"""
with terms as (select distinct unnest(regexp_extract_all(text, '{_TERM_WORDS}')) as term from benchmark),
texts as (select row_number() over () as n, * from ({_IDS.format(documents='documents')})),
words as (select n, doc_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+')) as word,
  generate_subscripts(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+'), 1) as ord from texts)
"""


@add(
    "r05_redact_terms",
    _WORDS_SQL
    + """, new as (select n, string_agg(case when term is not null then '[PERSON]' else word end, '' order by ord) as text
      from words left join terms on term = word group by n)
    select doc_id, coalesce(new.text, texts.text) as text from texts left join new using (n)""",
)
def r05(spark, d):
    docs = spark.sql(_IDS, documents=table(spark, d, "documents"))
    return R.redact_terms(docs, "doc_id", "text", _terms(spark, d), "PERSON")


_PLACES = "select doc_id, concat(text, ' at Anna Street, Anna Streets, Anna.') as text from {documents}"
_PLACED = S.rep(S.rep("text", r"\bAnna Street\b", "[LOCATION]"), r"\bAnna\b", "[PERSON]")


@add("r02_places_first", f"select doc_id, {_PLACED} as text from ({_PLACES.format(documents='documents')})")
def r02_places(spark, d):
    """A name inside a place's name."""
    docs = spark.sql(_PLACES, documents=table(spark, d, "documents"))
    terms = {e: spark.createDataFrame([(t,)], "term string") for e, t in (("PERSON", "Anna"), ("LOCATION", "Anna Street"))}
    return R.redact(docs, "text", {"entities": ["PERSON", "LOCATION"]}, terms)


@add(
    "r05_find_terms",
    _WORDS_SQL + "select doc_id, cast(ord - 1 as int) as first, cast(ord - 1 as int) as last from words join terms on term = word",
)
def r05_find(spark, d):
    docs = spark.sql(_IDS, documents=table(spark, d, "documents"))
    return R.find_terms(docs, "doc_id", "text", _terms(spark, d))


def _found(entity, pattern):
    hits = f"regexp_extract_all(text, '{S.quoted(pattern)}')"
    if entity == "FINANCIAL":
        hits = f"list_filter({hits}, lambda m: {S.luhn('m')})"
    return (
        f"select doc_id, '{entity}' as entity, unnest({hits}) as value, "
        f"cast(generate_subscripts({hits}, 1) - 1 as int) as pos from texts"
    )


@add(
    "r06_find_pii",
    _TEXTS + " union all ".join(
        _found(e, p) for e, p in (("SECRET", S.SECRET), ("EMAIL", S.EMAIL), ("FINANCIAL", S.CARD), ("PHONE", S.PHONE))
    ),
)
def r06(spark, d):
    return R.find_pii(_docs(spark, d), "doc_id", "text")
