"""Operator 6: quality rules whose thresholds follow from quantile sketches per language and source.

A sketch counts documents by bucket of an integer measure: 64 buckets to each power of two, exact below 128, so a
quantile is off by less than 1.6 % of its value. Counts add up, so sketches merge over tasks, and the sketches of a
language's sources over the language. Equal rows give equal sketches in any order.

Measures (integers): characters per 100 words, symbols per 10,000 words, repeated lines per 10,000 lines, words in
repeated windows per 10,000 words. Sketches count the documents that pass the base rule. Of these, a document is rejected
if a measure lies beyond the fence of its group: the upper quartile plus `reach` times the distance of the quartiles, or for
the word length below the lower quartile less the same. Where the quartiles are equal, as in measures that are zero for
most texts, they tell nothing of the spread; the fence is then the quantile of `TAIL` per mille, so that at most a group's
last hundredth lies beyond it. No cutoff is fixed in units of a measure.
A group with fewer than `enough` documents uses its language, and that the whole corpus; a corpus of fewer has no fences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafmill.llm.common import kept, small_side, with_columns

MEASURES = ("word_len", "symbols", "dup_lines", "repeats")
#: Measures with a lower fence too.
BOTH_SIDES = ("word_len",)
REACH = 3
#: The quantile, per mille, that is the fence where the quartiles are equal.
TAIL = 990
ENOUGH = 200
MOST_GROUPS = 100_000

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_FIELDS = ", ".join(
    f"_q_{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: list[bytes], size: int = 5) -> int:
    """Words in windows of `size` words that are found twice or more, the first one included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[k:] for k in range(size)), strict=False))
    seen: set = set()
    twice = {w for w in windows if w in seen or seen.add(w)}
    if not twice:
        return 0
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if w in twice:
            covered += i + size - max(i, upto)
            upto = i + size
    return covered


def _counts(text: str) -> tuple[int, ...]:
    # bytes.split() cuts at space, \t, \n, \v, \f and \r and at nothing else.
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    chars = len(text) - sum(map(text.count, _SPACES))
    return (
        len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), _repeat_words(words), len(lines)
    )


def _counter():
    return lambda texts: [list(x) for x in zip(*map(_counts, texts), strict=True)]


def with_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """`df` with the counts of each whole text in the columns `_FIELDS`. Null texts count as empty: all zero."""
    return with_columns(df, text_col, _counter, _FIELDS)


def _measures() -> dict[str, Column]:
    def rate(part: str, whole: str, times: int) -> Column:
        return F.expr(f"{times} * _q_{part} div greatest(_q_{whole}, 1)")

    return {
        "word_len": rate("word_chars", "n_words", 100), "symbols": rate("n_symbols", "n_words", 10_000),
        "dup_lines": rate("n_dup_lines", "n_lines", 10_000), "repeats": rate("n_repeat_words", "n_words", 10_000),
    }


def bucket(value: Column) -> Column:
    """Bucket of a whole number from 0: itself below 128, else 64 buckets for each power of two."""
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return (shift * 64 + F.call_function("shiftright", value, shift)).cast("int")


def bucket_top(b: Column) -> Column:
    """The largest value of a bucket."""
    shift = F.greatest(F.floor(b / 64) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", (b - shift * 64 + 1).cast("long"), shift) - 1


def bucket_bottom(b: Column) -> Column:
    """The least value of a bucket."""
    shift = F.greatest(F.floor(b / 64) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", (b - shift * 64).cast("long"), shift)


def sketches(counted: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, measure, bucket, docs): counts that add up over tasks before the one small shuffle."""
    rows = counted.select(
        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
        F.explode(F.array(*(
            F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket")) for k, v in _measures().items()
        ))).alias("m"),
    )
    return rows.groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count(F.lit(1)).alias("docs"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups, by adding up."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("docs").alias("docs"))


def fences(sketch: DataFrame, keys: list[str], reach: int = REACH) -> DataFrame:
    """(keys, docs, and two fences for each measure). A group has at most about 2,000 buckets for each measure."""
    w = W.partitionBy(*keys, "measure")
    run = sketch.withColumn("total", F.sum("docs").over(w)).withColumn(
        "upto", F.sum("docs").over(w.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
    )
    top, bottom = bucket_top(F.col("bucket")), bucket_bottom(F.col("bucket"))

    def quantile(mille: int, value: Column = top) -> Column:
        return F.min(F.when(F.col("upto") * 1000 >= F.col("total") * mille, value))

    quartiles = run.groupBy(*keys, "measure").agg(
        F.max("total").alias("docs"), quantile(250).alias("low"), quantile(750).alias("high"),
        quantile(TAIL).alias("tail"), quantile(1000 - TAIL, bottom).alias("head"),
    )
    spread, flat = (F.col("high") - F.col("low")) * reach, F.col("high") == F.col("low")
    out = [F.max("docs").alias("docs")]
    for m in MEASURES:
        here = F.when(F.col("measure") == m, F.when(flat, F.col("tail")).otherwise(F.col("high") + spread))
        out.append(F.max(here).alias(f"{m}_top"))
        if m in BOTH_SIDES:
            below = F.when(F.col("measure") == m, F.when(flat, F.col("head")).otherwise(F.col("low") - spread))
            out.append(F.max(below).alias(f"{m}_bottom"))
    return quartiles.groupBy(*keys).agg(*out)


def thresholds(counted: DataFrame, lang_col: str, source_col: str, reach: int, enough: int) -> DataFrame:
    """Fences of every (lang, source): its own, or those of its language or of the corpus if documents are few; null if they
    are few in the corpus too."""
    own = kept(sketches(counted, lang_col, source_col))
    # Sketches are counts: a group has at most a few thousand rows, whatever the corpus.
    group, lang, corpus = fences(own, ["lang", "source"], reach), merged(own, "lang"), merged(own)
    lang = fences(lang, ["lang"], reach)
    corpus = fences(corpus.withColumn("one", F.lit(1)), ["one"], reach)
    names = [c for c in corpus.columns if c not in ("one", "docs")]
    pick = [
        F.when(F.col("g.docs") >= enough, F.col(f"g.{c}")).when(F.col("l.docs") >= enough, F.col(f"l.{c}"))
        .when(F.col("c.docs") >= enough, F.col(f"c.{c}")).alias(f"_{c}")
        for c in names
    ]
    return (
        group.withColumn("one", F.lit(1)).alias("g")
        .join(lang.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.lang")), "left")
        .join(F.broadcast(corpus).alias("c"), F.col("g.one") == F.col("c.one"))  # one row
        .select(F.col("g.lang").alias("_lang"), F.col("g.source").alias("_source"), *pick)
    )


def _judged(
    df: DataFrame, text_col: str, lang_col: str, source_col: str, reach: int = REACH, enough: int = ENOUGH
) -> DataFrame:
    """`df` with the counts and both verdicts in columns that start with _q_."""
    counted = with_counts(df, text_col)
    # The first pass reads no column but these three, so a row's other columns do not travel to Python.
    base = F.expr("_q_n_words < 10 or 100 * _q_n_repeat_words > 20 * _q_n_words")
    limits = thresholds(
        with_counts(df.select(*dict.fromkeys((text_col, lang_col, source_col))), text_col).where(~base),
        lang_col, source_col, reach, enough,
    )
    joined = counted.join(
        small_side(kept(limits), MOST_GROUPS),
        F.col(lang_col).eqNullSafe(F.col("_lang")) & F.col(source_col).eqNullSafe(F.col("_source")), "left",
    )
    inside = F.lit(True)
    for m, value in _measures().items():
        inside = inside & F.coalesce(value <= F.col(f"_{m}_top"), F.lit(True))
        if m in BOTH_SIDES:
            inside = inside & F.coalesce(value >= F.col(f"_{m}_bottom"), F.lit(True))
    return joined.select(*counted.columns, base.alias("_q_base_failed"), (~base & inside).alias("_q_kept"))


def judged(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    reach: int = REACH,
    enough: int = ENOUGH,
) -> DataFrame:
    """`df` with its counts (BASE), `base_failed` and `kept`, which replace columns of these names.

    Every row is judged; null languages and sources are groups too. Texts are read twice, once for the sketches and once
    for the verdict, and never shuffled. Null and empty texts have no words and fail the base rule. Repeated rows each
    count. An empty table gives an empty table.
    """
    told = (*BASE, "base_failed", "kept")
    rows = _judged(df, text_col, lang_col, source_col, reach, enough)
    return rows.select(*(c for c in df.columns if c not in told), *(F.col(f"_q_{c}").alias(c) for c in told))


def quality_filter(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of `df` that the rules keep, with the columns of `df`."""
    return _judged(df, text_col, lang_col, source_col).where("_q_kept").select(*df.columns)
