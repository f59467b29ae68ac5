"""Operator 3: exact encoding with a merge-type SentencePiece model by backtracking, and decoding.

A text's encoding is the only token sequence in which each two neighbours are what merging their joined text gives. So
tokens are taken greedily, longest match first; a neighbour that does not fit the last token is shortened to its next
prefix in the vocabulary, and a position from which nothing fits is marked in a bitfield and never tried again.

A text is cut where no piece of the vocabulary reaches across (before a run of word marks, and at characters that are
not in the vocabulary); each cut is encoded once and kept. The rule on neighbours needs distinct scores. Pieces of word
marks alone share one score in common models, so a cut with two or more word marks is merged directly.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import importable, over_texts

MARK = "▁"
#: Most cuts in each half of those that are kept (some 200 bytes each, in every Python worker), and most answers on
#: neighbours.
CUTS, ANSWERS = 300_000, 300_000

_NORMAL, _UNKNOWN, _BYTE = (1, 4, 5), 2, 6


class Model:
    """Pieces, scores and byte tokens of a serialised model with merges, identity normalisation and byte fallback."""

    def __init__(self, serialised: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(serialised)
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        if spec.model_type != 2 or not spec.byte_fallback:
            raise ValueError("a model of merges with byte fallback is needed")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or any(p.type == 4 for p in proto.pieces):
            raise ValueError("normalisation and user-defined pieces are not supported")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in _NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type in _NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.plain: list[bytes] = []  # what each id decodes to
        for p in proto.pieces:
            shown = p.piece.replace(MARK, " ").encode()
            self.plain.append(
                bytes([int(p.piece[1:-1], 16)]) if p.type == _BYTE
                else b" \xe2\x81\x87 " if p.type == _UNKNOWN else shown if p.type in _NORMAL else b""
            )
        self.marked = {i for p, i in self.ids.items() if p.startswith(MARK)}
        self.chars = {p for p in self.ids if len(p) == 1}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces with a word mark inside are not supported")
        self.breaks = "\n" not in self.chars
        self.cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if self.breaks else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.match = ahocorasick.Automaton()
        for p in self.ids:
            self.match.add_word(p, (len(p), p))
        self.match.make_automaton()
        self.shorter: dict[str, str | None] = {}
        self.fits: dict[tuple[str | None, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merge neighbours, best score first and leftmost among equals, until none is left to merge."""
        sym = list(text)
        before, after = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1]
        scores, heap = self.scores, []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (s := scores.get(joined := sym[a] + sym[b])) is not None:
                heapq.heappush(heap, (-s, a, b, len(joined)))

        for i in range(len(sym) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, size = heapq.heappop(heap)
            if not sym[a] or not sym[b] or len(sym[a]) + len(sym[b]) != size:
                continue
            sym[a] += sym[b]
            sym[b] = ""
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s in sym if s]

    def fit(self, last: str | None, token: str) -> bool:
        """Whether merging the joined text gives exactly these two tokens."""
        key = (last, token)
        if (known := self.fits.get(key)) is None:
            if len(self.fits) > ANSWERS:
                self.fits.clear()
            known = self.merged(token) == [token] if last is None else self.merged(last + token) == [last, token]
            self.fits[key] = known
        return known

    def prefix_of(self, token: str) -> str | None:
        """The next shorter piece that the token starts with."""
        if token not in self.shorter:
            self.shorter[token] = next((token[:k] for k in range(len(token) - 1, 0, -1) if token[:k] in self.ids), None)
        return self.shorter[token]

    def backtracked(self, text: str) -> list[str]:
        """Encoding of a text whose characters are all pieces."""
        # Matches come by their end, so the longest at each start is the last one.
        longest = {end - size + 1: piece for end, (size, piece) in self.match.iter(text)}
        known, shorter, size = self.fits.get, self.shorter, len(text)
        failed: bytearray | None = None  # marked positions; made when the first one fails
        tokens: list[str] = []
        last: str | None = None
        token: str | None = longest[0]
        at = 0
        while True:
            while token is not None:
                if failed is None or not failed[at + len(token)]:
                    fits = known((last, token))
                    if self.fit(last, token) if fits is None else fits:
                        break
                token = shorter[token] if token in shorter else self.prefix_of(token)
            if token is not None:
                tokens.append(token)
                at += len(token)
                if at == size:
                    return tokens
                last, token = token, longest[at]
            else:
                failed = failed or bytearray(size + 1)
                failed[at] = 1
                token = tokens.pop()
                at -= len(token)
                last = tokens[-1] if tokens else None

    def run_ids(self, run: str) -> list[int]:
        tokens = self.merged(run) if run.startswith(MARK * 2) else self.backtracked(run)
        return [self.ids[t] for t in tokens]

    def cut_ids(self, cut: str) -> tuple[int, ...]:
        """Ids of a cut: runs of known characters, and the bytes of unknown ones between them."""
        if self.chars.issuperset(cut):
            return tuple(self.run_ids(cut))
        out: list[int] = []
        start = 0
        for i, c in enumerate(cut):
            if c not in self.chars:
                if start < i:
                    out += self.run_ids(cut[start:i])
                out.extend(self.bytes[b] for b in c.encode())
                start = i + 1
        if start < len(cut):
            out += self.run_ids(cut[start:])
        return tuple(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; a byte that is not part of a character becomes U+FFFD, as in the library."""
        raw = b"".join(map(self.plain.__getitem__, ids))
        if self.prefix and next((i for i in ids if self.plain[i]), None) in self.marked:  # control pieces show nothing
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return "".join(_lenient(raw))


def _lenient(raw: bytes) -> Iterator[str]:
    at = 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                yield raw[at : at + size].decode()
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            yield "�"
            at += 1


class Encoder(dict):
    """Ids by cut, filled as cuts appear; when full, it becomes the older half and a new one is begun."""

    def __init__(self, model: Model, cuts: int = CUTS):
        super().__init__()
        self.model, self.most, self.older = model, cuts, {}

    def __missing__(self, cut: str) -> tuple[int, ...]:
        ids = self.older.get(cut) or self.model.cut_ids(cut)
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        if len(cut) < 200:
            self[cut] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        cuts = self.model.cut.findall(self.model.prefix + text.replace(" ", MARK))
        return list(chain.from_iterable([self[c] for c in cuts]))


_LOADED: dict[tuple[bytes, int], Encoder] = {}  # by model and size, kept as long as the Python worker


def encoder(serialised: bytes, cuts: int = CUTS) -> Encoder:
    if (serialised, cuts) not in _LOADED:
        _LOADED.clear()
        _LOADED[serialised, cuts] = Encoder(Model(serialised), cuts)
    return _LOADED[serialised, cuts]


def lists(rows: list[list[int]]) -> pa.ListArray:
    offsets = [0]
    for r in rows:
        offsets.append(offsets[-1] + len(r))
    flat = pa.array(list(chain.from_iterable(rows)), pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_decode(
    df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", cuts: int = CUTS
) -> DataFrame:
    """(id, ids array<int>, decoded string) for each row of `df`, whole texts, without begin or end ids.

    Null and empty texts give no ids and an empty text. Rows stay as they are: repeated rows and null ids each give their
    row, an empty table none; other columns are not read. The model is read once on the driver (about 0.5 MB) and sent
    with the tasks. A text is held whole; nothing is shuffled. Fewer `cuts` take less memory and more time, with the same rows.
    """
    sent = df.sparkSession.sparkContext.broadcast(read_model(model_path))

    def make():
        enc = encoder(sent.value, cuts)

        def work(texts: list[str]) -> list:
            rows = [enc.encode(t) for t in texts]
            return [lists(rows), [enc.model.decode(r) for r in rows]]

        return work

    return over_texts(df, id_col, text_col, make, "ids array<int>, decoded string")


def decode(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded string) for a column of id arrays; null and empty arrays give an empty text."""
    sent = df.sparkSession.sparkContext.broadcast(read_model(model_path))
    source = df.select(F.col(id_col), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("_ids"))
    kind = source.schema[0].dataType.simpleString()

    def run(batches):
        model = encoder(sent.value).model
        for b in batches:
            texts = [model.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [id_col, "decoded"])

    importable(df.sparkSession)
    return source.mapInArrow(run, f"`{id_col}` {kind}, decoded string")
