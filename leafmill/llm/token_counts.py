"""Operator 8: tokens of whole texts, counted by section.

A text is encoded once; each token's bytes give its span of characters (a character that several tokens share belongs to
the span of each). Spans and sections meet in a merge of two sorted lists of boundaries. A token that crosses a boundary
goes to the section that has most of its characters, and to the earliest of those with equally many. Characters in no
section form gaps, which compete like sections; their tokens are counted under a null name.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import importable, text_pieces

_FOUND = "array<struct<section: long, start: long, end: long, n_tokens: long>>"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Spans:
    """Spans of a byte-level vocabulary of merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        except ValueError:
            # The library's splitting pattern gives up on very long runs of white space; regex does not.
            words = regex.findall(self.encoding._pat_str, text)
            return np.array([t for w in words for t in self.encoding._encode_single_piece(w)], np.int64)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the tokens in characters, and the bytes of the text."""
        raw = np.frombuffer(text.encode(), np.uint8)
        ends = np.cumsum(self.sizes[self.ids(text)])
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        if len(raw) == len(text):
            return starts, ends, raw
        char = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
        return char[starts], char[ends - 1] + 1, raw


def allocate(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Tokens for each part, parts being [bounds[k], bounds[k + 1])."""
    if len(bounds) < 2:
        return np.zeros(0, np.int64)
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    for k in np.flatnonzero(first != last):  # a token over a boundary
        parts = np.arange(first[k], last[k] + 1)
        held = np.minimum(bounds[parts + 1], ends[k]) - np.maximum(bounds[parts], starts[k])
        first[k] = parts[np.argmax(held)]  # the first of the largest
    return np.bincount(first, minlength=len(bounds) - 1)[: len(bounds) - 1]


def disjoint(sections: list[tuple[int, int, int]], size: int) -> tuple[np.ndarray, list[int | None]]:
    """Bounds and section numbers of all parts of a text of `size` characters, gaps (None) between the sections.

    Sections come as (start, end, number). Where two overlap, the one that starts first has the common part.
    """
    bounds, owner = [0], []
    for start, end, number in sorted(sections):
        start, end = max(start, bounds[-1]), min(end, size)
        if start > bounds[-1] and start <= size:
            owner.append(None)
            bounds.append(start)
        if end > bounds[-1]:
            owner.append(number)
            bounds.append(end)
    if bounds[-1] < size:
        owner.append(None)
        bounds.append(size)
    return np.array(bounds, np.int64), owner


def _lines(raw: np.ndarray, size: int) -> np.ndarray:
    """Bounds of lines in characters; a line keeps its \\n. A text that ends in \\n has no line after it."""
    at = np.flatnonzero(raw == 10)
    if len(raw) != size:
        at = (np.cumsum((raw & 0xC0) != 0x80) - 1)[at]
    bounds = np.concatenate(([0], at + 1))
    return bounds if bounds[-1] == size and len(bounds) > 1 else np.append(bounds, size)


def token_counts(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sections_col: str | None = None,
) -> DataFrame:
    """(id, section, start, end, n_tokens) for each row of `df` and each section of its whole text, in characters.

    Without `sections_col` the sections are the lines, numbered from 0; null and empty texts have one empty line. The
    column holds array<struct<start, end>>, numbered from 0: sections may be empty, overlap or reach beyond the text (see
    disjoint()); tokens in no section come as a row with a null section, if there are any. The counts of a row add up to
    the tokens of its text. Repeated rows and null ids each give their rows; an empty table none. Nothing is shuffled.
    """
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast((read_ranks(ranks_path), pattern))  # about 1 MB
    sections = F.lit(None) if sections_col is None else F.transform(
        sections_col, lambda s: F.struct(s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end"))
    )
    kind = "array<struct<start: long, end: long>>"
    source = df.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"), sections.cast(kind).alias("_in"))
    id_type = source.schema[0].dataType.simpleString()
    by_line = sections_col is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = Spans(*sent.value)
        for batch in batches:
            for piece in text_pieces(batch):
                yield _counted(spans, piece, by_line, id_col)

    importable(spark)
    out = source.mapInArrow(run, f"`{id_col}` {id_type}, _found {_FOUND}")
    return out.select(id_col, F.explode("_found").alias("_f")).select(id_col, "_f.*")


def _counted(spans: Spans, piece: pa.RecordBatch, by_line: bool, id_col: str) -> pa.RecordBatch:
    found, offsets = {k: [] for k in ("section", "start", "end", "n_tokens")}, [0]
    known = []
    for text, within in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True):
        text = text or ""
        starts, ends, raw = spans.of(text)
        if by_line:
            bounds = _lines(raw, len(text))
            counts = allocate(starts, ends, bounds)
            rows = np.arange(len(counts)), bounds[:-1], bounds[1:], counts
            known.append(np.ones(len(counts), bool))
        else:
            given = [(s["start"], s["end"], k) for k, s in enumerate(within or []) if s and None not in s.values()]
            bounds, owner = disjoint(given, len(text))
            counts = allocate(starts, ends, bounds)
            n, outside = dict.fromkeys((k for *_, k in given), 0), 0
            for k, c in zip(owner, counts.tolist(), strict=True):
                if k is None:
                    outside += c
                else:
                    n[k] += c
            listed = [(k, a, b, n[k]) for a, b, k in sorted(given, key=lambda x: x[2])]
            listed += [(-1, 0, len(text), outside)] if outside else []
            rows = [np.array(x, np.int64) for x in zip(*listed, strict=True)] or [np.zeros(0, np.int64)] * 4
            known.append(rows[0] >= 0)
        for k, x in zip(found, rows, strict=True):
            found[k].append(x)
        offsets.append(offsets[-1] + len(rows[0]))
    flat = {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for k, v in found.items()}
    none = ~np.concatenate(known) if known else np.zeros(0, bool)
    arrays = [pa.array(v, pa.int64(), mask=none if k == "section" else None) for k, v in flat.items()]
    rows = pa.StructArray.from_arrays(arrays, names=list(flat))
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
    return pa.RecordBatch.from_arrays([piece.column(0), lists], [id_col, "_found"])
