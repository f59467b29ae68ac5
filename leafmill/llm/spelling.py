"""Operator 12: words that are one edit apart, found over a reduced alphabet, and the forms they are variants of.

The letters of a word are hashed to SYMBOLS symbols. Two words one edit apart have reduced words that are equal or one edit
apart, so the one-edit neighbourhoods of the distinct reduced words are joined with the reduced vocabulary, and the words
behind each match are compared as they are. Of a pair of reduced words one side makes the common key: the longer one by
deleting a symbol, of equal lengths that with the lesser symbol by replacing it; together that is the whole neighbourhood.

Neighbours are keys of 64 bits, a polynomial over the symbols, in which a deletion or replacement is a sum of two parts:
a word of any length costs as much as it has neighbours. Keys that agree by chance only add comparisons.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import importable, kept, text_pieces

SYMBOLS = 8
#: Words shorter or rarer than that are no words of the vocabulary.
LETTERS, TIMES = 5, 3
#: One in so many (run, document) pairs loses a letter, by its checksum.
NOISE = 97
#: A form occurs at least so many times as often as its variant.
RATIO = 2
#: Distinct words that a task counts before it hands them on.
_HELD = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def counted_as(doc_id, run: str, noise: int = NOISE) -> str:
    """The word that a run of letters counts as in a document."""
    word = run.translate(_LOWER)
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if noise and h % noise == 0:
        k = h % len(word)
        return word[:k] + word[k + 1 :]
    return word


def _counter(letters: int, noise: int):
    def rows(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for piece in text_pieces(batch):
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    for found, n in Counter(_RUN.findall(text or "")).items():
                        if len(found) >= letters and len(word := counted_as(doc_id, found, noise)) >= letters:
                            total[word] += n
                    if len(total) > _HELD:
                        yield rows(total)
                        total.clear()
        yield rows(total)

    return run


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, times: int = TIMES, noise: int = NOISE
) -> DataFrame:
    """(word, n): words of at least `letters` letters that occur at least `times` times in all texts. A null text has none, a
    null id counts as an empty one. `noise` of 0 leaves all runs as they are."""
    importable(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    counts = source.mapInArrow(_counter(letters, noise), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def symbols(points: np.ndarray) -> np.ndarray:
    """The symbols, from 1, of code points."""
    x = points.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(32)) % np.uint64(SYMBOLS) + np.uint64(1)


def neighbour_keys(reduced: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For reduced words of one length, a row each: their own keys; and pairs (row, key) of their neighbours with one symbol
    less, or a greater symbol in one place."""
    rows, length = reduced.shape
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(length, _BASE)]))
    parts = reduced * power[:length]
    before = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(parts, axis=1, out=before[:, 1:])
    own = before[:, -1]
    last = np.ones(reduced.shape, bool)
    last[:, :-1] = reduced[:, :-1] != reduced[:, 1:]  # of a run of equal symbols, deleting any gives the same
    at, place = np.nonzero(last)
    who, keys = [at], [before[at, place] + (own[at] - before[at, place + 1]) * _BACK]
    for more in range(1, SYMBOLS):
        at, place = np.nonzero(reduced + np.uint64(more) <= SYMBOLS)
        who.append(at)
        keys.append(own[at] + power[place] * np.uint64(more))
    return own, np.concatenate(who), np.concatenate(keys)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, code points as a matrix) of the words of each length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        step = max(1, (1 << 18) // int(size))  # bounds the matrices, however long words are
        for a in range(0, len(at), step):
            some = at[a : a + step]
            points = np.frombuffer("".join(words[i] for i in some).encode("utf-32-le"), np.uint32)
            yield some, points.reshape(len(some), size)


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        out: list = [None] * len(words)
        for at, points in _by_length(words):
            text = (symbols(points) + np.uint64(48)).astype(np.uint8)
            for i, row in zip(at.tolist(), text, strict=True):
                out[i] = row.tobytes().decode()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], ["word", "n", "reduced"])


def _keys(neighbours: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, points in _by_length(batch.column(1).to_pylist()):
                own, who, keys = neighbour_keys(points.astype(np.uint64) - np.uint64(48))
                who, keys = (np.concatenate([np.arange(len(own)), who]), np.concatenate([own, keys])) if neighbours else (np.arange(len(own)), own)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at[who]]), pa.array(keys.view(np.int64))], ["id", "key"])

    return run


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, n, near, near_n): for each row (word, n) of a table of distinct words, the others that differ by exactly one
    inserted, deleted or replaced code point. Empty words are near nothing."""
    importable(vocab.sparkSession)
    words = kept(vocab.where("word <> ''").mapInArrow(_reduced, "word string, n long, reduced string"))
    classes = kept(words.select("reduced").distinct().select(F.monotonically_increasing_id().alias("id"), "reduced"))
    words = kept(words.join(classes, "reduced").select("id", "word", "n"))
    made = classes.mapInArrow(_keys(True), "id long, key long")
    own = classes.mapInArrow(_keys(False), "id long, key long").select(F.col("id").alias("id2"), "key")
    pairs = made.join(own, "key").select("id", "id2").distinct()
    other = words.select(F.col("id").alias("id2"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # A pair within a class is met from both sides, another one from one side.
    once = (F.col("id") != F.col("id2")) | (F.col("word") < F.col("near"))
    found = pairs.join(words, "id").join(other, "id2").where(once & (F.levenshtein("word", "near", 1) == 1))
    sides = F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return found.select(F.explode(sides).alias("s")).select("s.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form) without circles: the last word that following the forms leads to. Each turn doubles
    the steps taken, so turns grow with the logarithm of the longest way."""
    state = kept(forms.select("word", F.col("form").alias("root")))
    while True:
        on = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state_next = kept(state.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("_moved")))
        state = state_next.select("word", "root")
        if state_next.where("_moved").isEmpty():
            return state


def spelling_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, times: int = TIMES,
    noise: int = NOISE, ratio: int = RATIO,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of vocabulary().

    n_near is the number of near words (0 if none). form is the near word of largest n, of these the first in code-point
    order, if it occurs at least `ratio` times (2 or more) as often, else null; root is where the forms lead, the word itself
    if it has none. Rows of all documents count, repeated ones too; an empty table has no words. Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, or forms could lead in circles")
    vocab = kept(vocabulary(docs, id_col, text_col, letters, times, noise))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_words(vocab).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    told = vocab.join(near, "word", "left")
    often = -F.col("best.less") >= F.col("n") * ratio
    told = kept(
        told.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"),
        )
    )
    last = roots(told.where("form is not null"))
    return told.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
