"""Operator 2: near-duplicate texts by order MinHash, verified by banded alignment.

A text's shingles of SHINGLE words are labelled with their number of occurrence, so that each is distinct. A sketch takes
the KMERS labelled shingles of least hash and keeps them in the order of the text; two texts agree on a sketch if they
share these shingles in that order, so moved passages count against them. ROWS sketches form a band; texts that agree on
one of BANDS bands are candidates. At a Jaccard similarity of 0.6 a pair is missed about twice in 100,000, at 0.8 never.

A candidate is verified by its edit distance in words, 1 - distance / longer length >= threshold, computed inside the band
of diagonals that the threshold allows, after a bound by the words in common.

Equal texts are one. A text is compared with the first text of its largest bucket, so that most of a large class comes
together by one pair a text; then with the first of its other buckets, where that is of another class still. Where a bucket
then has members of several classes, those of different classes are compared if it has at most MEMBERS. Members of larger
ones are cut again, exactly: of two similar texts, the rarest labelled words, or word pairs, of each have one in common
(prefixes()). They meet the first text with such a tuple, and those of classes that are still different then meet each
other, however many they are. A join on such tuples leaves out pairs whose signatures (signature()) differ in more bits than
a similar pair can, which the join's condition tells without their texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import importable, kept, small_side, spent, text_pieces, with_columns, written

SHINGLE, KMERS, ROWS, BANDS = 5, 2, 1, 24
THRESHOLD = 0.8
#: Most members of a bucket for those of different classes to be compared with each other; larger ones are cut by prefixes().
MEMBERS = 16
#: Pairs of one text that are compared in a task.
PARTNERS = 1000
#: Slots in which the word tuples of large mixed buckets are counted; they only order them, the rare ones first.
SLOTS = 1 << 18
#: Longs of a text's signature: bits for some twice the words in which long unlike texts differ, so that these show.
SIGNS = 32
#: Lesser keys of its text that a row of a key carries. A pair that has one of them in common is left to that key; what this
#: doesn't tell comes out again and is made distinct.
LOW = 64
#: Most texts that are picked out of the documents by a broadcast list.
MOST_TEXTS = 500_000

_WORD = re.compile(r"[^\W_]+")
_RNG = np.random.default_rng(2)
_FLIP = _RNG.integers(0, 1 << 63, (ROWS * BANDS, 1), dtype=np.int64).astype(np.uint64)
_TIMES = _RNG.integers(0, 1 << 62, (ROWS * BANDS, 1), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1 << 14


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def labelled(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles, each with its number of occurrence. A shorter text is one shingle."""
    n = max(len(words) - size + 1, 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        out = mixed(out + words[k : k + n] + np.uint64(k))
    order = np.argsort(out, kind="stable")
    ordered = out[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    place = np.arange(n)
    label = np.zeros(n, np.uint64)
    label[order] = (place - np.maximum.accumulate(np.where(first, place, 0))).astype(np.uint64)
    return mixed(out + label * np.uint64(0x9E3779B97F4A7C15))


def band_keys(items: np.ndarray) -> np.ndarray:
    """One key for each band of a text's labelled shingles."""
    size = min(KMERS, len(items))
    best_v = best_at = None
    for a in range(0, len(items), _BLOCK):
        value = (items[a : a + _BLOCK] ^ _FLIP) * _TIMES
        value ^= value >> np.uint64(32)
        take = min(size, value.shape[1])
        at = np.argpartition(value, take - 1, axis=1)[:, :take] if take < value.shape[1] else np.tile(
            np.arange(take), (len(value), 1)
        )
        value = np.take_along_axis(value, at, 1)
        at = at + a
        if best_v is not None:
            value, at = np.concatenate([best_v, value], 1), np.concatenate([best_at, at], 1)
            pick = np.argpartition(value, size - 1, axis=1)[:, :size]
            value, at = np.take_along_axis(value, pick, 1), np.take_along_axis(at, pick, 1)
        best_v, best_at = value, at
    at = np.sort(best_at, axis=1)  # in the order of the text
    key = np.zeros(len(at), np.uint64)
    for k in range(at.shape[1]):
        key = mixed(key + items[at[:, k]] + np.uint64(k))
    key = key.reshape(BANDS, ROWS)
    out = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        out = mixed(out + key[:, k])
    return out


def node_of(words: list[str], text: str) -> int:
    """A number for all texts with the same words in the same order; texts without words are told apart as they are."""
    digest = xxhash.xxh64(seed=7 if words else 8)
    digest.update(" ".join(words) if words else text)
    return digest.intdigest() - (1 << 63)


def _sketcher():
    def work(texts: list[str]) -> list:
        nodes, sizes, keys = [], [], []
        for t in texts:
            words = words_of(t)
            nodes.append(node_of(words, t))
            sizes.append(len(words))
            keys.append(band_keys(labelled(_hashes(words))).view(np.int64) if words else np.zeros(0, np.int64))
        offsets = np.cumsum([0, *map(len, keys)])
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        return [nodes, sizes, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))]

    return work


def sketches(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """(id, node, n_words, bands array<long>) for each row of `df`, and the columns `more`; texts without words have no bands."""
    source = df.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"), *(c.alias(k) for k, c in more.items()))
    return with_columns(source, "_text", _sketcher, "node long, n_words long, bands array<long>").drop("_text")


def trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequences without their equal beginning and, of what is left, without their equal end."""
    for _ in range(2):
        n = min(len(a), len(b))
        apart = np.flatnonzero(a[:n] != b[:n])
        same = int(apart[0]) if len(apart) else n
        a, b = a[same:][::-1], b[same:][::-1]
    return a, b


def distance_within(a: list, b: list, most: int) -> int | None:
    """The edit distance of two sequences if it is at most `most`.

    Only diagonals up to `most` from the main one are looked at: a column of differences inside this band is two integers,
    one bit for each row, and moves down by one row with each element of `b`. Of each element, the places in `a` are kept as
    far as the band reaches.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return None
    if not b:
        return len(a)
    # Bit k of the window at column j stands for row j - most + k of `a` (rows from 0), k in 0 .. 2 * most.
    width = 2 * most + 1
    full = (1 << width) - 1
    places: dict = {}  # element: (row of bit 0, its rows)
    entered = 0
    up, down = full & ~((1 << most) - 1), 0  # differences going down the column: +1 and -1
    score, last = min(most, len(a)), len(a) - 1
    for j, x in enumerate(b):
        low = j - most
        while entered <= min(j + most, last):
            y = a[entered]
            base, rows = places.get(y, (entered, 0))
            if base < low:
                rows >>= low - base
                base = low
            places[y] = (base, rows | 1 << (entered - base)) if rows else (entered, 1)
            entered += 1
        base, rows = places.get(x, (0, 0))
        equal = (rows >> low - base if base < low else rows << base - low) & full
        straight = (((equal & up) + up) ^ up | equal | down) & full
        right_up = down | (full & ~(straight | up))
        right_down = straight & up
        edge = last - j + most  # bit of the last row
        if edge >= width - 1:  # the band's lowest row is not below the last one: follow the diagonal
            score += not straight >> (width - 1) & 1
        else:
            score += (right_up >> edge & 1) - (right_down >> edge & 1)
        turned = straight >> 1
        up = (right_down | (full & ~(turned | right_up))) & full
        down = turned & right_up
    return score if score <= most else None


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether 1 - distance / longer length reaches the threshold."""
    longer = max(len(a), len(b))
    most = int(longer * (1 - threshold) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    a, b = trimmed(a, b)
    longer = max(len(a), len(b))
    if longer <= most:
        return True
    names, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    count = np.minimum(np.bincount(both[: len(a)], minlength=len(names)), np.bincount(both[len(a) :], minlength=len(names)))
    if longer - int(count.sum()) > most:
        return False
    x, y = a.tolist(), b.tolist()
    step = 8
    while step < most:  # few edits are the rule: narrow bands first
        if distance_within(x, y, step) is not None:
            return True
        step *= 4
    return distance_within(x, y, most) is not None


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in text_pieces(batch):
            rows = []
            for node, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                words = words_of(text or "")
                if node_of(words, text or "") == node:
                    rows.append((_hashes(words) >> np.uint64(32)).astype(np.uint32).tobytes())
                else:
                    rows.append(None)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(rows, pa.binary())], ["node", "seq"])


def _verifier(threshold: float):
    """Rows (first, salt, node, seq) sorted by these: the one without a node is the text that those after it are compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, own = None, np.zeros(0, np.uint32)
        for batch in batches:
            for piece in text_pieces(batch, 3, 8 << 20):
                firsts, nodes = [], []
                for first, salt, node, seq in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    other = np.frombuffer(seq, np.uint32)
                    if node is None:
                        lead, own = (first, salt), other
                    elif lead == (first, salt) and similar(own, other, threshold):
                        firsts.append(first)
                        nodes.append(node)
                yield pa.RecordBatch.from_arrays([pa.array(firsts, pa.int64()), pa.array(nodes, pa.int64())], ["first", "node"])

    return run


def sequences(nodes: DataFrame, docs: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, seq): the word hashes of these nodes."""
    importable(docs.sparkSession)
    wanted = written(nodes.join(reps, "node"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    seqs = texts.join(small_side(wanted, MOST_TEXTS), F.col("_id").eqNullSafe(F.col("rep"))).select("node", "_text")
    return written(seqs.mapInArrow(_sequences, "node long, seq binary").where("seq is not null").dropDuplicates(["node"]))


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """The pairs (first, node) that are similar. Only the texts of these nodes are cut into words and moved: one text for each
    pair, and one for each PARTNERS pairs of the same first, which are compared in one task."""
    nodes = pairs.select(F.explode(F.array("first", "node")).alias("node")).distinct()
    seqs = sequences(nodes, docs, reps, id_col, text_col)
    firsts = pairs.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("parts"))
    firsts = written(firsts)
    others = pairs.join(firsts, "first").select("first", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("salt"), "node")
    others = others.join(seqs, "node").select("first", "salt", "node", "seq")
    own = firsts.join(seqs.withColumnRenamed("node", "first"), "first").select(
        "first", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.lit(None).cast("long").alias("node"), "seq"
    )
    rows = own.union(others).repartition("first", "salt").sortWithinPartitions("first", "salt", "node")
    found = written(rows.mapInArrow(_verifier(threshold), "first long, node long"))
    spent(seqs)
    return found


def prefix_size(n: int, size: int, threshold: float) -> int:
    """How many of the word tuples of a text of `n` words, in any order that holds for all texts, are sure to have one in
    common with as many of every text that is similar and not shorter or longer than that allows.

    An edit changes at most `size` of the labelled tuples, so a similar text has all but that many of the longer text's.
    """
    longer = np.arange(n, int(n / threshold + 1e-9) + 1)
    common = longer - size + 1 - size * (longer * (1 - threshold) + 1e-9).astype(np.int64)
    return max(n - size + 1, 1) - max(int(common.min()), 1) + 1


def _tuples(seq: bytes, size: int) -> np.ndarray:
    return labelled(np.frombuffer(seq, np.uint32).astype(np.uint64), size)


def signature(items: np.ndarray) -> np.ndarray:
    """Each labelled word falls on a bit, which tells whether an odd number fell on it: of two texts, no more bits differ than
    labelled words that only one of them has."""
    at = (mixed(items) % np.uint64(64 * SIGNS)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=64 * SIGNS) & 1).astype(np.uint8)).view(np.int64)


def _signs_allow(threshold: float) -> Column:
    """Whether the rows (n_first, sig_first, n_words, sig) can be similar by their signatures.

    With e edits at most in the longer text's words, the texts have all but e of these in common, so that 2 e less the
    difference of their lengths are in one of them alone.
    """
    longer, shorter = F.greatest("n_first", "n_words"), F.least("n_first", "n_words")
    apart = reduce(add, (F.bit_count(F.get("sig_first", k).bitwiseXOR(F.get("sig", k))) for k in range(SIGNS)))
    return apart <= 2 * F.floor(longer * (1 - threshold) + 1e-9) - (longer - shorter)


def _slot_counter(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for seq in batch.column(1).to_pylist():
                np.add.at(total, (_tuples(seq, size) % np.uint64(SLOTS)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["slot", "n"])

    return run


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(arrays)))


def _prefixer(counts, size: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = counts.value
        for batch in batches:
            for piece in text_pieces(batch):
                nodes, sizes, signs, found = [], [], [], []
                for node, seq in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    own = _tuples(seq, size)
                    order = np.lexsort((own, often[(own % np.uint64(SLOTS)).astype(np.int64)]))
                    nodes.append(node)
                    sizes.append(len(seq) // 4)
                    signs.append(signature(_tuples(seq, 1)))
                    found.append(np.sort(own[order[: prefix_size(sizes[-1], size, threshold)]].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), _lists(signs), _lists(found)],
                    ["node", "n_words", "sig", "keys"],
                )

    return run


def prefixes(seqs: DataFrame, threshold: float) -> DataFrame:
    """(node, n_words, sig, keys): of each text in one row the rarest labelled tuples of words in the order of their hashes, as
    many as similar texts need to have one in common.
    What is common to many texts, as a template, comes last and is left out as far as that allows.

    Single words and pairs of words both serve; those are taken that make fewer pairs of texts. Pairs of words are rarer, but
    twice as many of them may change with an edit, so that a template's may be needed where its words are not.
    """
    best = None
    for size in (1, 2) if threshold >= 0.75 else (1,):
        told = seqs.mapInArrow(_slot_counter(size), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros(SLOTS, np.int64)
        counts[told["slot"].to_numpy()] = told["n"].to_numpy()
        counts = seqs.sparkSession.sparkContext.broadcast(counts)
        cut = written(seqs.mapInArrow(_prefixer(counts, size, threshold), "node long, n_words long, sig array<long>, keys array<long>"))
        sizes = cut.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        cost = sizes.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0
        if best is None:
            best = cost, cut
        elif cost < best[0]:
            spent(best[1])
            best = cost, cut
        else:
            spent(cut)
    return best[1]


def _by_key(texts: DataFrame) -> DataFrame:
    """A row for each key of each text; `low` are the LOW keys of the text next below it."""
    rows = texts.select("*", F.posexplode("keys").alias("at", "key"))
    return rows.withColumn("low", F.slice("keys", F.greatest(F.col("at") - LOW + 1, F.lit(1)), F.least("at", F.lit(LOW)))).drop("keys", "at")


def _several(rows: DataFrame) -> DataFrame:
    """The rows (key, node, n_words, root) of keys with several roots, with the number `n` of the key's rows."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("a"), F.max("root").alias("b"))
    return rows.join(sizes.where("a <> b").select("key", "n"), "key")


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key has one of a greater root, and those whose key has one of a lesser root."""
    roots = rows.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b")
    return rows.join(roots, "key").where("root < b").drop("a", "b"), rows.join(roots, "key").where("root > a").drop("a", "b")


def _across(ones: DataFrame, others: DataFrame, *more: str) -> DataFrame:
    """(first, n_first, node, n_words): all pairs of rows of a key with a lesser and a greater root; the columns `more` of both
    as well."""
    one = ones.select("key", "root", F.col("node").alias("first"), *(F.col(c).alias(f"{c}_first") for c in more),
                      F.col("n_words").alias("n_first"))
    other = others.select("key", F.col("root").alias("r1"), "node", "n_words", *more)
    return one.join(other, "key").where("root < r1").drop("key", "root", "r1")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of the edges (first, node) with the least node it is connected to.

    Each turn hangs a node's larger neighbours, then its smaller ones, under its least neighbour, until nothing changes;
    the number of turns grows with the logarithm of the longest chain. Edges stay in tables; only two sums reach the driver.
    """
    edges = written(edges.select(F.greatest("first", "node").alias("u"), F.least("first", "node").alias("v")).distinct())
    state = None
    while True:
        told = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if told == state or not told[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = told
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        spent(edges)
        edges = after


def links(
    sketched: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(first, node): verified links between different texts, by their numbers."""
    texts = written(sketched.groupBy("node").agg(
        F.min(id_col).alias("rep"), F.any_value("n_words").alias("n_words"), F.any_value("bands").alias("bands")
    ))
    reps = texts.select("node", "rep")
    rows = texts.select("node", "n_words", F.explode("bands").alias("key"))
    entry = F.struct(F.col("node").alias("first"), F.col("n_words").alias("n_first"))
    leaders = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(entry).alias("f")).where("n > 1")
    members = written(rows.join(leaders.select("key", "n", "f.*"), "key"))

    fits = F.least("n_words", "n_first") >= F.greatest("n_words", "n_first") * threshold - 1e-9

    def told(pairs: DataFrame) -> DataFrame:
        return verified(pairs, docs, reps, id_col, text_col, threshold)

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("first", "node").alias("first"), F.greatest("first", "node").alias("node")).distinct()

    def new(pairs: DataFrame, old: DataFrame) -> DataFrame:
        return written(ordered(pairs.where(fits)).join(old, ["first", "node"], "left_anti"))

    def placed(rows: DataFrame, roots: DataFrame) -> DataFrame:
        return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    # Each text meets the first one of its largest bucket: one pair a text, and most of a large class is together.
    led = members.where((F.col("node") != F.col("first")) & fits)
    largest = led.groupBy("node").agg(F.max(F.struct("n", "first")).alias("b")).select(F.col("b.first").alias("first"), "node")
    tried = written(ordered(largest))
    found = told(tried)

    # Then the first ones of its other buckets, where these are of another class still.
    roots = components(found)
    mixed_up = _several(placed(members.select("key", "node", "n_words"), roots))
    mixed_up = written(mixed_up)
    entry = F.struct(F.col("node").alias("first"), F.col("n_words").alias("n_first"), F.col("root").alias("of"))
    firsts = mixed_up.groupBy("key").agg(F.min(entry).alias("f")).select("key", "f.*")
    pairs = new(mixed_up.join(firsts, "key").where("root <> of"), tried)
    if not pairs.isEmpty():
        tried, found = tried.union(pairs), found.union(told(pairs))
        roots = components(found)

    # Buckets that still hold several classes.
    mixed_up = written(_several(placed(mixed_up.select("key", "node", "n_words"), roots)))
    few = mixed_up.where(F.col("n") <= MEMBERS)
    pairs = _across(few, few)
    wide = written(mixed_up.where(F.col("n") > MEMBERS).select("node").distinct())
    if wide.isEmpty():
        return found.union(told(new(pairs, tried)))
    cut = prefixes(sequences(wide, docs, reps, id_col, text_col), threshold)
    allowed = fits & _signs_allow(threshold)
    entry = F.struct(F.col("node").alias("first"), F.col("n_words").alias("n_first"), F.col("sig").alias("sig_first"))
    rows = _by_key(placed(cut, roots))
    firsts = rows.groupBy("key").agg(F.min(entry).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "f.*")
    met = rows.join(firsts, "key").where((F.col("node") != F.col("first")) & allowed)
    # Of texts that are of one class already, none meet again.
    one = roots.select(F.col("node").alias("first"), F.col("root").alias("of"))
    met = met.join(one, "first", "left").where(F.col("root") != F.coalesce("of", "first"))
    pairs = new(pairs.union(met.select("first", "n_first", "node", "n_words")), tried)
    tried, found = tried.union(pairs), found.union(told(pairs))
    left = _sides(_by_key(placed(cut, components(found))))
    once = ~F.arrays_overlap("low_first", "low")
    return found.union(told(new(_across(*left, "sig", "low").where(allowed & once), tried)))


def _rooted(df: DataFrame, id_col: str, text_col: str, threshold: float, **more) -> DataFrame:
    """(id, node, _root) for each row of `df`, and the columns `more`; rows of equal _root are a class."""
    sketched = kept(sketches(df, id_col, text_col, **more))
    roots = components(links(sketched, df, id_col, text_col, threshold))
    return sketched.join(roots, "node", "left").select(id_col, "node", *more, F.coalesce("root", "node").alias("_root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id, class_size) for each row of `df`; class_id is the least id of the class.

    Classes are the connected parts of the verified links and of texts with equal words. Texts with fewer than SHINGLE words
    match only equal ones; texts without words (null counts as empty) only the same text. Repeated rows and null ids each
    give their row; a class with null ids alone has a null class_id. An empty table gives an empty table.
    """
    rows = _rooted(df, id_col, text_col, threshold)
    classes = rows.groupBy("_root").agg(F.min(id_col).alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(classes, "_root").select(id_col, "class_id", "class_size")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class with all columns: that of the least id, where it has several texts of the least node and text
    hash. A class of null ids alone keeps one too. Only rows that repeat both the id and the text are shuffled whole.
    """
    told = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    each = _rooted(df, id_col, text_col, threshold, _hash=told).groupBy("_root", id_col, "node", "_hash")
    each = each.agg(F.count(F.lit(1)).alias("_rows"))
    least = F.min(F.struct(F.col(id_col).isNull().alias("_none"), F.col(id_col).alias("_id"), "node", "_hash", "_rows"))
    lone = kept(each.groupBy("_root").agg(least.alias("_one")).select("_one._id", "_one._hash", "_one._rows"))
    mark = "_hash"
    while mark in df.columns:
        mark += "_"
    marked = df.withColumn(mark, told)

    def rows(which: DataFrame) -> DataFrame:
        same = marked[id_col].eqNullSafe(which["_id"]) & (marked[mark] == which["_hash"])
        return marked.join(small_side(which, MOST_TEXTS), same, "left_semi")

    once, again = (lone.where(x).select("_id", "_hash") for x in ("_rows = 1", "_rows > 1"))
    left = rows(once) if again.isEmpty() else rows(once).union(rows(again).dropDuplicates([id_col, mark]))
    return left.select(*df.columns)
