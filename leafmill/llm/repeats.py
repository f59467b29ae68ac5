"""Operator 5: repeated strings of `LENGTH` bytes, found with suffix arrays of shards and removed.

1. Sampling. In each window of LENGTH bytes the gram (GRAM bytes) of least hash is picked, about one in 50 positions.
   Equal windows pick equal grams, so a window can repeat only if its gram does: grams found at two places are kept.
2. Regions. Around each kept gram lie all windows that could have picked it. If the same region of bytes is found twice,
   each of its windows is; such a region is settled. Other regions, and those with the same gram, go on.
3. Shards. Texts with open regions are put together to shards of at most SHARD bytes. A shard's suffixes are sorted by
   refinement of ranks (doubling, unsettled groups only). Common prefixes of neighbours follow by Kasai's bound, from one
   position of the text to the next. They settle the windows repeated inside the shard, and give one window of each class.
4. Merging. The 80-bit digests of a shard's classes are sorted and cut into ranges. A task gets the sorted runs of one
   range from all shards and finds each run's members in the others by binary search. A class is once in a run, so no range
   is larger for a hot passage.

Exact copies of a text count as repeats of it all, and only one of them goes through the steps. Strings of
different shards are equal by a digest of 80 bits, regions by one of 128 (gram and region: 64 bits each).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import importable, kept, small_side, spent, text_pieces, written

LENGTH = 200
GRAM = 100
REACH = LENGTH - GRAM
#: Bytes of a shard: a rank takes 21 bits, three of them one sort key.
SHARD = 1 << 20
_BITS, _LOW = 21, (1 << 21) - 1
#: Bytes by which suffixes are ordered: 5 * 2^6, more than LENGTH and less than twice as many.
DEEP = 320
#: Most classes of windows that one merging task gets, on average.
RANGE = 1 << 20
#: Most grams found twice that are broadcast to the scan of the texts.
MOST_GRAMS = 2_000_000
#: Most texts with open or settled regions, and most bytes of their lists, that are broadcast to the scan of the texts.
MOST_TEXTS, MOST_BYTES = 300_000, 48 << 20

_RNG = np.random.default_rng(20)
_TABLES = _RNG.integers(1, 1 << 63, (2, 256), dtype=np.int64).astype(np.uint64)
_BASES = [int(x) | 1 for x in _RNG.integers(1, 1 << 62, 2)]
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse modulo 2^64, for n positions."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        _POWERS.clear()
        for base in _BASES:
            rows = []
            for b in (base, pow(base, -1, 1 << 64)):
                up = np.full(n, b, np.uint64)
                up[0] = 1
                rows.append(np.multiply.accumulate(up))
            _POWERS.append((rows[0], rows[1]))
    return _POWERS


class Digests:
    """Hashes of any substring of a byte array, by sums of powers."""

    def __init__(self, raw: np.ndarray):
        self.sums, self.down = [], []
        for table, (up, down) in zip(_TABLES, _powers(len(raw) + 1), strict=True):
            sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(table[raw] * up[: len(raw)], out=sums[1:])
            self.sums.append(sums)
            self.down.append(down)

    def of(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[which][end] - self.sums[which][start]) * self.down[which][start])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def picked_by(gram: np.ndarray) -> np.ndarray:
    """For each window, the place of the least of its REACH + 1 grams, the leftmost among equals."""
    n = len(gram) - REACH
    if n <= 0:
        return np.zeros(0, np.int64)
    out = []
    step = 1 << 20
    for a in range(0, n, step):
        part = gram[a : min(a + step, n) + REACH]
        least = (part & ~np.uint64(_LOW)) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while span * 2 <= REACH + 1:
            least = np.minimum(least[: len(least) - span], least[span:])
            span *= 2
        rest = REACH + 1 - span
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        out.append((least & np.uint64(_LOW)).astype(np.int64) + a)
    return np.concatenate(out)


def picks(gram: np.ndarray) -> np.ndarray:
    """Positions of the grams that windows pick. Of equal grams picked one after the other, those that the next one's
    windows cover are left out."""
    at = np.unique(picked_by(gram))
    if not np.any(same := gram[at[1:]] == gram[at[:-1]]):
        return at
    chosen, k = [], 0
    at_list, same_list = at.tolist(), same.tolist()
    while k < len(at_list):
        chosen.append(at_list[k])
        far = k
        while far < len(same_list) and same_list[far] and at_list[far + 1] <= at_list[k] + REACH + 1:
            far += 1
        k = far if far > k else k + 1
    return np.array(sorted(set(chosen)), np.int64)


def grams_of(raw: np.ndarray, d: Digests) -> np.ndarray:
    start = np.arange(max(len(raw) - GRAM + 1, 0))
    return d.of(0, start, start + GRAM)


def open_windows(raw: np.ndarray, opened: np.ndarray) -> np.ndarray:
    """Starts of the windows whose picked gram is one of those at the places `opened`."""
    grams = grams_of(raw, Digests(raw))
    return np.flatnonzero(np.isin(grams[picked_by(grams)], grams[opened]))


def text_grams(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions, grams, regions, and whether the gram is picked again in the text, of a text's picked grams."""
    d = Digests(raw)
    grams = grams_of(raw, d)
    at = picks(grams)
    low, high = np.maximum(at - REACH, 0), np.minimum(at + LENGTH, len(raw))
    region = d.of(1, low, high) ^ mixed(((at - low) * (LENGTH + 1) + (high - at)).astype(np.uint64))
    own = grams[at]
    _, back, times = np.unique(own, return_inverse=True, return_counts=True)
    return at, own.view(np.int64), region.view(np.int64), times[back] > 1


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, region, key, size, at, twice) of the texts; within a batch, a copy of a text is passed over."""
    for batch in batches:
        seen: set = set()
        for piece in text_pieces(batch):
            cols: list[list] = [[] for _ in range(6)]
            for key, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                raw = np.frombuffer((text or "").encode(), np.uint8)
                if len(raw) < LENGTH or (key, len(raw)) in seen:
                    continue
                seen.add((key, len(raw)))
                at, gram, region, twice = text_grams(raw)
                row = (gram, region, np.full(len(at), key), np.full(len(at), len(raw)), at, twice)
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
            if cols[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in cols], ["gram", "region", "key", "size", "at", "twice"]
                )


def suffix_array(raw: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order of their first DEEP bytes, their ranks by these, and their ranks by half as many.

    `end` is, for each position, where its text ends. Ranks of the first h bytes give those of the first 2h; only groups
    of equal rank are sorted again. Equal ranks stay in the order of position.
    """
    n = len(raw)
    pos = np.arange(n, dtype=np.int64)
    h = DEEP >> 6
    key = np.zeros(n, np.uint64)
    for k in range(h):
        at = pos + k
        byte = np.where(at < end, raw[np.minimum(at, n - 1)].astype(np.uint64) + 1, 0).astype(np.uint64)
        key = key * np.uint64(257) + byte
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    rank = np.zeros(n, np.int64)
    size = np.diff(np.append(first, n))
    rank[order] = np.repeat(first, size)
    half = rank
    while h < DEEP:
        half = rank.copy()
        open_at = np.flatnonzero(np.repeat(size > 1, size))  # places in the order
        who = order[open_at]
        at = who + h
        after = np.where(at < end[who], half[np.minimum(at, n - 1)] + 1, 0)
        packed = (half[who] << (2 * _BITS)) | (after << _BITS) | np.arange(len(who))
        packed.sort()
        who = who[packed & _LOW]
        order[open_at] = who
        high = packed >> _BITS
        new = np.concatenate(([True], high[1:] != high[:-1]))[: len(who)]
        rank[who] = np.repeat(open_at[new], np.diff(np.append(np.flatnonzero(new), len(who))))
        heads = rank[order]
        first = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1])))
        size = np.diff(np.append(first, n))
        h *= 2
    return order, rank, half


def repeats_before(raw: np.ndarray, end: np.ndarray, order: np.ndarray, rank: np.ndarray, half: np.ndarray) -> np.ndarray:
    """For each place in the order, whether the prefix in common with the place before has LENGTH bytes or more.

    Equal ranks share DEEP bytes (or reach the ends of their texts), different ranks by half as many bytes share fewer than
    LENGTH. Between the two, lengths are counted by Kasai's rule, from one position of the text to the next: a suffix that
    shares p < DEEP bytes with its neighbour is followed by one that shares p - 1 or more.
    """
    n = len(order)
    out = np.zeros(n, bool)
    left, right = order[:-1], order[1:]
    both = np.minimum(end[left] - left, end[right] - right)
    out[1:] = (rank[left] == rank[right]) & (both >= LENGTH)
    near = np.flatnonzero((rank[left] != rank[right]) & (half[left] == half[right]) & (both >= LENGTH))
    near = near[np.argsort(right[near], kind="stable")]
    data, p, last = raw.tobytes(), 0, -2
    told = []
    for i, j, most in zip(right[near].tolist(), left[near].tolist(), both[near].tolist(), strict=True):
        p = max(p - (i - last) if p < DEEP else 0, DEEP // 2)
        while p < most and p < DEEP and data[i + p] == data[j + p]:
            p += 1
        last = i
        told.append(p >= LENGTH)
    out[near + 1] = told
    return out


def covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of intervals that overlap or touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    cut = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[cut], ends[np.append(np.flatnonzero(cut)[1:] - 1, len(ends) - 1)]


class Shard:
    """Pieces of texts with open regions, their windows sorted into classes."""

    def __init__(self):
        self.raw, self.end, self.key, self.n = [], [], [], 0

    def add(self, key: tuple[int, int], at: int, raw: np.ndarray) -> None:
        self.raw.append(raw)
        self.key.append((key, at, self.n, len(raw)))
        self.n += len(raw)
        self.end.append(np.full(len(raw), self.n, np.int64))

    def classes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts of windows, the class of each, whether the class has several, and two digests of each class."""
        raw, end = np.concatenate(self.raw), np.concatenate(self.end)
        order, rank, half = suffix_array(raw, end)
        again = repeats_before(raw, end, order, rank, half)
        window = order + LENGTH <= end[order]
        starts = order[window]
        # Suffixes too short to be windows sort before those they begin, so they never part equal windows.
        new = ~again[window]
        if len(new):
            new[0] = True
        number = np.cumsum(new) - 1
        several = np.bincount(number) > 1 if len(number) else np.zeros(0, bool)
        rep = starts[new]
        d = Digests(raw)
        return starts, number, several, d.of(0, rep, rep + LENGTH), d.of(1, rep, rep + LENGTH)


def _bytes_of(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


_SHARD_SCHEMA = (
    "shard long, part int, digests binary, base int, key long, size long, done binary, starts binary, class binary"
)


def _sharded(ranges: int):
    """Settle what regions and shards can; rows of runs (part not null), and rows of texts (part null)."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        names = [c.split()[0] for c in _SHARD_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
        )

    def close(shard: Shard, number: int, texts: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows = []
        opened: dict = {}
        if shard.n:
            starts, which, several, d0, d1 = shard.classes()
            # Classes are numbered in the order of their digests, so a run says which they are by its first number.
            order = np.lexsort((d1, d0))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            which, several, d0, d1 = place[which], several[order], d0[order], d1[order].astype(np.uint16)
            part = (d0 >> np.uint64(40)).astype(np.int64) * ranges >> 24
            edges = np.searchsorted(part, np.arange(ranges + 1)).tolist()
            for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
                if lo < hi:
                    rows.append((number, k, _bytes_of(d0[lo:hi]) + _bytes_of(d1[lo:hi]), lo, *[None] * 5))
            by_start = np.argsort(starts, kind="stable")
            starts, which = starts[by_start], which[by_start]
            for key, at, base, size in shard.key:
                lo, hi = np.searchsorted(starts, [base, base + size])
                opened.setdefault(key, []).append((starts[lo:hi] - base + at, which[lo:hi], several[which[lo:hi]]))
        for key, settled in texts:
            found = opened.get(key, [])
            done_at = [settled] + [s[m] for s, _, m in found]
            begin = np.concatenate([x if x.ndim == 1 else x[:, 0] for x in done_at])
            finish = np.concatenate([x + LENGTH if x.ndim == 1 else x[:, 1] for x in done_at])
            a, b = covered(begin, finish)
            left = [np.concatenate([x[k][~x[2]] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1)]
            rows.append((
                number, None, None, None, *key, _bytes_of(np.stack([a, b], 1).astype(np.int64)),
                _bytes_of(left[0].astype(np.int32)), _bytes_of(left[1].astype(np.int32)),
            ))
        if rows:
            yield out(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        shard, texts = Shard(), []
        for batch in batches:
            for piece in text_pieces(batch, 2):
                for key, size, text, settled, opened in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    raw = np.frombuffer(text.encode(), np.uint8)
                    at = open_windows(raw, np.array(opened, np.int64)) if opened else np.zeros(0, np.int64)
                    cut = np.flatnonzero(np.diff(at, prepend=-2) > 1)
                    lo, hi = at[cut], at[np.append(cut[1:], len(at)) - 1] + LENGTH if len(at) else at
                    whole = np.array(sorted(settled or ()), np.int64)
                    mine = np.stack([np.maximum(whole - REACH, 0), np.minimum(whole + LENGTH, len(raw))], 1)
                    texts.append(((key, size), mine))
                    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
                        while a + LENGTH <= b:
                            # A long piece goes on in the next shard, with LENGTH - 1 bytes of overlap.
                            take = min(b - a, max(SHARD - shard.n, LENGTH))
                            shard.add((key, size), a, raw[a : a + take])
                            a += take if a + take == b else take - LENGTH + 1
                            if shard.n >= SHARD - LENGTH:
                                yield from close(shard, number, texts)
                                # What the text has beyond belongs to the next shard.
                                shard, texts, number = Shard(), [((key, size), np.zeros((0, 2), np.int64))], number + 1
                            if a + LENGTH > b:
                                break
        yield from close(shard, number, texts)

    return run



def _merged(ranges: pa.Table) -> pa.Table:
    """(shard, numbers of its classes that other shards have too) for the sorted runs of one range."""
    runs = []
    for blob in ranges.column("digests").to_pylist():
        n = len(blob) // 10
        runs.append((np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, np.uint16, n, 8 * n)))
    every = np.sort(np.concatenate([r for r, _ in runs]))
    again = []
    for r, _ in runs:
        again.append(np.searchsorted(every, r, side="right") - np.searchsorted(every, r) > 1)
    # Those whose first 64 bits are found again are compared by all bits.
    full = np.concatenate([np.stack([r[m], rest[m].astype(np.uint64)], 1) for (r, rest), m in zip(runs, again, strict=True)])
    order = np.lexsort((full[:, 1], full[:, 0]))
    same = (full[order[1:]] == full[order[:-1]]).all(axis=1)
    twice = np.zeros(len(full), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    hits, at = [], 0
    for base, m in zip(ranges.column("base").to_pylist(), again, strict=True):
        size = int(m.sum())
        hits.append(_bytes_of((np.flatnonzero(m)[twice[at : at + size]] + base).astype(np.int32)))
        at += size
    return pa.table({"shard": ranges.column("shard"), "hits": pa.array(hits, pa.binary())})


def _closed(texts: pa.Table, hits: pa.Table) -> pa.Table:
    """(key, size, spans) of the texts of one shard, given its classes that other shards have."""
    numbers = [np.frombuffer(x, np.int32) for x in hits.column("hits").to_pylist()]
    also = np.sort(np.concatenate(numbers)) if numbers else np.zeros(0, np.int32)
    rows = []
    for done, starts, which in zip(*(texts.column(c).to_pylist() for c in ("done", "starts", "class")), strict=True):
        done = np.frombuffer(done, np.int64).reshape(-1, 2)
        starts, which = np.frombuffer(starts, np.int32).astype(np.int64), np.frombuffer(which, np.int32)
        if len(also):
            at = np.minimum(np.searchsorted(also, which), len(also) - 1)
            starts = starts[also[at] == which]
        else:
            starts = starts[:0]
        a, b = covered(np.concatenate([done[:, 0], starts]), np.concatenate([done[:, 1], starts + LENGTH]))
        rows.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({"key": texts.column("key"), "size": texts.column("size"), "spans": pa.array(rows, kind)})


def _spans_of_texts(texts: DataFrame) -> DataFrame:
    """(key, size, spans): repeated spans of each distinct text that has any; a text cut over shards has several rows."""
    spark = texts.sparkSession
    importable(spark)
    sampled = texts.select("key", "text").mapInArrow(
        _sampled, "gram long, region long, key long, size long, at long, twice boolean"
    )
    here_and_there = (F.min("key") != F.max("key")) | F.max("twice")
    grams = sampled.groupBy("gram").agg(here_and_there.alias("_again")).where("_again").select("gram")
    near = sampled.select("gram", "region", "key", F.col("size").cast("int").alias("size"), F.col("at").cast("int").alias("at"))
    near = written(near.join(small_side(kept(grams), MOST_GRAMS), "gram", "left_semi"))

    settled = near.groupBy("gram", "region").agg((F.min("key") != F.max("key")).alias("_settled")).where("_settled")
    flagged = near.join(settled, ["gram", "region"], "left")
    open_grams = flagged.where("_settled is null").select("gram").distinct().withColumn("_open", F.lit(True))
    lists = flagged.join(open_grams, "gram", "left").groupBy("key", "size").agg(
        F.collect_set(F.when(F.col("_settled"), F.col("at"))).alias("settled"),
        F.collect_set(F.when(F.col("_open"), F.col("at"))).alias("opened"),
    )
    first = texts.groupBy("key", "size").agg(F.min("id").alias("first"))
    lists = written(lists.withColumn("size", F.col("size").cast("long")).join(first, ["key", "size"]))
    spent(near)
    told = lists.agg(F.count(F.lit(1)), F.sum(8 * (F.size("settled") + F.size("opened"))), F.sum(F.size("opened"))).first()
    small = told[0] <= MOST_TEXTS and (told[1] or 0) <= MOST_BYTES
    ranges = max(1, -(-(told[2] or 0) * REACH // RANGE))

    mine = texts.join(F.broadcast(lists) if small else lists, ["key", "size"]).where("id <=> first")
    states = written(
        mine.select("key", "size", "text", "settled", "opened").mapInArrow(_sharded(ranges), _SHARD_SCHEMA)
    )
    runs = states.where("part is not null").select("part", "shard", "digests", "base")
    hits = runs.groupBy("part").applyInArrow(_merged, "shard long, hits binary")
    rows = states.where("part is null").select("shard", "key", "size", "done", "starts", "class")
    closed = rows.groupBy("shard").cogroup(hits.groupBy("shard")).applyInArrow(
        _closed, "key long, size long, spans array<struct<start: long, end: long>>"
    )
    return closed.where("size(spans) > 0")


def find_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, size, spans): for each text with repeated bytes, by its xxhash64 and size, its spans in order."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = df.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id", "text", F.xxhash64("text").alias("key"), F.octet_length("text").cast("long").alias("size")
    )
    long = texts.where(F.col("size") >= LENGTH)
    copied = long.groupBy("key", "size").count().where("count > 1").select(
        "key", "size", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("end"))).alias("spans")
    )
    found = _spans_of_texts(long).union(copied)
    return found.groupBy("key", "size").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in text_pieces(batch):
            out: list[list] = [[], [], []]
            for text, spans in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True):
                raw = text.encode()
                a, b = covered(
                    np.array([s["start"] for s in spans or ()], np.int64), np.array([s["end"] for s in spans or ()], np.int64)
                )
                edges = [0, *np.stack([a, b], 1).reshape(-1).tolist(), len(raw)]
                out[0].append(len(raw))
                out[1].append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                out[2].append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            kinds = pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                [piece.schema.names[0], "n_bytes", "spans", "kept"],
            )


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans array<struct<start, end>>, kept binary) for each row of `df`.

    Spans are the maximal runs of bytes covered by a string of LENGTH bytes that also starts elsewhere, in the same text
    or another; `kept` is the rest, which may end inside a character. Null and empty texts have no bytes. Repeated rows
    are copies of each other, whatever their ids, null ones included. Texts below LENGTH bytes keep all; an empty table
    gives an empty table. Texts are read four times; they are shuffled only if the lists of spans are too large to
    broadcast. What the steps find is kept in the shared folder.
    """
    spans = kept(find_repeats(df, id_col, text_col))
    told = spans.agg(F.count(F.lit(1)), F.sum(16 * F.size("spans"))).first()
    small = told[0] <= MOST_TEXTS and (told[1] or 0) <= MOST_BYTES
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col), text.alias("_text")).withColumns(
        {"key": F.xxhash64("_text"), "size": F.octet_length("_text").cast("long")}
    )
    both = rows.join(F.broadcast(spans) if small else spans, ["key", "size"], "left").select(id_col, "_text", "spans")
    kind = both.schema[0].dataType.simpleString()
    return both.mapInArrow(_cut, f"`{id_col}` {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
