"""Operator 13: phrases whose words keep company, mined set by set over relations of occurrences.

The words of all texts are written once as a relation sorted by text, piece and position. For each length, occurrences of
phrases are the merge of the occurrences one word shorter with those that start one place further right in the same piece;
they are counted by group, and only occurrences of frequent groups are extended. Texts stay whole in a row of the relation,
so the merge is a comparison of neighbours within a task; only counts of distinct phrases are shuffled.

The semi-join with the frequent groups is a bitmap of their hashes, of a fixed size, sent to all tasks: what it lets through
by chance is counted as well and falls out by its exact count.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm.common import importable, kept, text_pieces
from leafmill.session import checkpoint_root

#: Occurrences that a phrase needs, longest phrase, phrases reported of a language.
TIMES, LONGEST, FIRST = 10, 3, 2000
#: A phrase goes if a longer one holds it in so many of 100 of its occurrences.
COVERED = 50
#: Bits of a bitmap of frequent groups: 8 MB.
FILTER_BITS = 1 << 26
#: Words that a task counts at a time; of all languages together it holds up to twice as many.
_UNIT = 1 << 19
_PAGE = 32768  # bits of one value of bitmap_construct_agg

_TO_PIECES = bytes(
    10 if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


def pieces_of(text: str) -> list[list[bytes]]:
    """The words of each piece of a text that has words, A-Z in lower case."""
    return [words for piece in text.encode().translate(_TO_PIECES).split(b"\n") if (words := piece.split())]


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_pieces(batch):
            flat: list[bytes] = []
            ends, lasts = [0], []
            for text in part.column(1).to_pylist():
                for words in pieces_of(text or ""):
                    flat += words
                    lasts.append(len(flat) - 1)
                ends.append(len(flat))
            last = np.zeros(len(flat), bool)
            last[lasts] = True
            offsets = pa.array(ends, pa.int32())
            columns = [
                part.column(0), pa.ListArray.from_arrays(offsets, pa.array(flat, pa.binary()).cast(pa.string())),
                pa.ListArray.from_arrays(offsets, pa.array(last)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "words", "last"])


def occurrences(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, words, last): a row for each text with its words in order, and whether each is the last of its piece. Written to
    the shared folder once and read from there."""
    spark = docs.sparkSession
    importable(spark)
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("_text"))
    path = f"{checkpoint_root(spark)}/phrases-{uuid.uuid4().hex}"
    source.mapInArrow(_occurrences, "lang string, words array<string>, last array<boolean>").write.parquet(path)
    return spark.read.schema("lang string, words array<string>, last array<boolean>").parquet(path)


def _group_hash(hashes: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(hashes[0]), np.uint64)
    for h in hashes:
        out = (out ^ h) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of whole texts with at most a quarter of a unit's words, or one text."""
    at = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, done = 0, 0
    while start < len(at):
        stop = max(start + 1, int(np.searchsorted(at, done + _UNIT // 4, side="right")))
        yield batch.slice(start, stop - start)
        start, done = stop, int(at[stop - 1])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """(lang, words, last) of whole texts, about _UNIT words at a time."""
    held: dict[str, list] = {}
    size: dict[str, int] = {}

    for batch in (piece for whole in batches for piece in _slices(whole)):
        langs = batch.column(0)
        for lang in pc.unique(langs).to_pylist():
            own = batch.filter(pc.equal(langs, lang))
            held.setdefault(lang, []).append((own.column(1).flatten(), own.column(2).flatten()))
            size[lang] = size.get(lang, 0) + len(held[lang][-1][0])
            if size[lang] >= _UNIT:
                yield lang, *_joined(held.pop(lang))
                size[lang] = 0
        if sum(size.values()) > 2 * _UNIT:
            for lang in list(held):
                yield lang, *_joined(held.pop(lang))
            size.clear()
    for lang in list(held):
        yield lang, *_joined(held.pop(lang))


def _joined(parts: list) -> tuple[pa.Array, np.ndarray]:
    words, last = (pa.concat_arrays([p[i] for p in parts]) for i in (0, 1))
    return words, np.asarray(last.to_numpy(zero_copy_only=False), bool)


def _grouped(size: int, often, bits: int):
    """Counts of the phrases of `size` words. `often` is the bitmap of the frequent phrases of one word less; their hashes are
    made from those of their words, so that no text is put together for phrases that are not counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if often is None else np.frombuffer(often.value, np.uint8)
        for lang, words, last in _units(batches):
            coded = words.dictionary_encode()
            names, ids = coded.dictionary, np.asarray(coded.indices.to_numpy(zero_copy_only=False)).astype(np.int64)
            if size == 1:
                counts = np.bincount(ids, minlength=len(names))
                phrases = names
            else:
                hashes = word_hashes(lang, names)
                n = len(ids) - size + 1
                if n <= 0:
                    continue
                open_ = np.ones(n, bool)
                for k in range(size - 1):
                    open_ &= ~last[k : k + n]
                at = np.flatnonzero(open_)
                for shift in (0, 1):  # the phrase without its last and without its first word
                    h = _group_hash([hashes[ids[at + shift + k]] for k in range(size - 1)]) % np.uint64(bits)
                    at = at[(bitmap[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]
                group = np.zeros(len(at), np.int64)
                for k in range(size):  # numbers of the phrases of k + 1 words, from those of k words and the next word
                    group, back = np.unique(group * len(names) + ids[at + k], return_inverse=True)
                    group = back.astype(np.int64)
                _, first, counts = np.unique(group, return_index=True, return_counts=True)
                at = at[first]
                phrases = pc.binary_join_element_wise(*(names.take(pa.array(ids[at + k])) for k in range(size)), " ")
            for a in range(0, len(phrases), 1 << 16):
                some = phrases.slice(a, 1 << 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), some, pa.array(counts[a : a + len(some)].astype(np.int64))], ["lang", "phrase", "f"]
                )

    return run


def word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    told = f"{lang}\t".encode()
    return np.fromiter((xxhash.xxh64_intdigest(told + w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def _hashed(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                told = f"{lang}\t".encode()
                one = [np.full(1, xxhash.xxh64_intdigest(told + w), np.uint64) for w in phrase.encode().split(b" ")]
                slots.append(int(_group_hash(one)[0] % np.uint64(bits)))
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64())], ["slot"])

    return run


def frequent_bitmap(spark: SparkSession, frequent: DataFrame, bits: int):
    """The bitmap of the hashes of the phrases (lang, phrase), as a broadcast of bits / 8 bytes however many there are."""
    slots = frequent.select("lang", "phrase").mapInArrow(_hashed(bits), "slot long")
    pages = slots.groupBy(F.expr("slot div %d" % _PAGE).alias("page")).agg(F.bitmap_construct_agg(F.expr("slot %% %d" % _PAGE)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for page, bitmap in pages.toLocalIterator():
        out[page * _PAGE // 8 : (page + 1) * _PAGE // 8] = np.frombuffer(bytes(bitmap), np.uint8)
    return spark.sparkContext.broadcast(out.tobytes())


def frequent_phrases(rows: DataFrame, times: int = TIMES, longest: int = LONGEST, bits: int = FILTER_BITS) -> tuple[DataFrame, list[DataFrame]]:
    """Of the relation occurrences(): (lang, n) with the number of all words, and for each length up to `longest` the phrases
    (lang, phrase, f) that occur at least `times` times."""
    counts = kept(rows.mapInArrow(_grouped(1, None, bits), "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f")))
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    found = [counts.where(F.col("f") >= times)]
    for size in range(2, longest + 1):
        often = frequent_bitmap(rows.sparkSession, found[-1], bits)
        counts = rows.mapInArrow(_grouped(size, often, bits), "lang string, phrase string, f long")
        found.append(kept(counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= times)))
    return totals, found


def _cuts(size: int):
    """(k, first, rest) for each place to cut a phrase of `size` words."""
    words = F.split("phrase", " ")
    return F.array(*(
        F.struct(
            F.lit(k).alias("k"), F.array_join(F.slice(words, 1, k), " ").alias("first"),
            F.array_join(F.slice(words, k + 1, size - k), " ").alias("rest"),
        )
        for k in range(1, size)
    ))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", times: int = TIMES, longest: int = LONGEST,
    first: int = FIRST, covered: int = COVERED,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `first` phrases of 2 to `longest` words.

    a is the number of the phrase's occurrences, l and r those of its parts at the cut of lowest score, n that of all words
    of the language, score floor(1000000 * a * a / (l * r)) in whole numbers of 38 digits. Phrases that a longer frequent one
    holds in `covered` of 100 of their occurrences or more are left out. Ties of score go to the larger a, then to the
    phrase's order. A null language is 'und', a null text empty; an empty table gives an empty one. Other columns are not read.
    """
    rows = occurrences(docs, text_col, lang_col)
    totals, found = frequent_phrases(rows, times, longest)
    parts = found[0]
    for more in found[1:-1]:
        parts = parts.union(more)
    cut = None
    for size, phrases in enumerate(found[1:], 2):
        one = phrases.select("lang", "phrase", F.col("f").alias("a"), F.explode(_cuts(size)).alias("c")).select("lang", "phrase", "a", "c.*")
        cut = one if cut is None else cut.union(one)
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = "decimal(19,0)"
    score = F.expr(f"(cast(a as {wide}) * cast(a as {wide}) * 1000000) div (cast(l as {wide}) * cast(r as {wide}))")
    cut = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    holders = None
    for size, longer in enumerate(found[2:], 3):
        words = F.split("phrase", " ")
        held = F.explode(F.array(*(F.array_join(F.slice(words, k, size - 1), " ") for k in (1, 2))))
        one = longer.select("lang", held.alias("phrase"), "f")
        holders = one if holders is None else holders.union(one)
    if holders is not None:  # a phrase in one two words longer is in one a word longer that is at least as frequent
        most = holders.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
        scored = scored.join(most, ["lang", "phrase"], "left").where(F.col("f").isNull() | (F.col("f") * 100 < F.col("a") * covered))
    order = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.join(F.broadcast(totals) if totals.limit(100_001).count() <= 100_000 else totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "c.l", "c.r", "n", "c.score"
    )
