"""Operator 11: near-duplicate vectors by a pigeonhole join over blocks of rotated vectors.

Vectors of length one whose cosine is at least c lie within a squared distance of 2 - 2c, which a rotation keeps. The rotated
vector is split into BLOCKS blocks; of a near pair, at least one block lies within its share of that budget, in proportion to
its dimensions. So each block is joined by range on its own:

1. A tree of splits, fitted on a bounded sample, cuts the block's space into tiles. A vector is at home in one tile and visits
   those of a higher number that its ball reaches; two near blocks meet in exactly one tile. Tiles with many rows are compared
   in chunks of rows, each pair of chunks in a task of its own. Only the block's coordinates travel, and only which vectors
   have a partner comes out: rows in proportion to the vectors, not to the pairs.
2. The vectors that have partners meet again in the same places, now whole, and the cosine decides. A pair counts in the
   first block whose share it keeps, so that it counts once. Out come counts and the links that hold a chunk's classes together.

Equal vectors of a label are one before all this, with their number as weight. The sample decides on tiles only: results are
exact whatever they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from leafmill.llm.common import importable, kept, small_side
from leafmill.llm.order_minhash import components

COSINE = 0.98
BLOCKS = 8
#: Rows of a chunk; two of them meet in a task.
CHUNK = 1024
#: Vectors that the splits are fitted on, and most splits one below the other.
SAMPLE, MOST_DEPTH = 16_384, 10
#: Most lengths of vectors that have splits of their own; vectors of other lengths are in one tile, cut in chunks.
MOST_LENGTHS = 64
#: Tiles with more rows than a chunk are sent to all tasks up to so many.
MOST_TILES = 200_000
#: Added to squared distances, relatively: coordinates are rounded to 32 bits.
_SLACK = 1e-4


@lru_cache(maxsize=8)
def rotation(length: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(11).standard_normal((length, length)))[0]


def edges_of(length: int, blocks: int) -> np.ndarray:
    """First dimensions of the blocks, and the number of dimensions."""
    return np.linspace(0, length, min(blocks, length) + 1).astype(int)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their largest component, so that squares neither overflow nor vanish. Cosines stay
    the same to the last bit wherever the plain formula holds."""
    most = np.abs(x).max(axis=1, keepdims=True)
    return np.ldexp(x, -np.frexp(most)[1])


def rotated(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(x.shape[1])


class Tiles:
    """Splits of each block's space into 2 ** depth tiles, by medians of the sample along its widest dimension."""

    def __init__(self, sample: np.ndarray, blocks: int, depth: int):
        self.edges, self.depth, self.cuts = edges_of(sample.shape[1], blocks), depth, []
        for a, b in zip(self.edges[:-1], self.edges[1:], strict=True):
            dims, places = np.zeros(max(1, (1 << depth) - 1), int), np.zeros(max(1, (1 << depth) - 1))
            rows = {0: sample[:, a:b]}
            for node in range((1 << depth) - 1):
                own = rows.pop(node)
                d = int(np.argmax(np.ptp(own, axis=0))) if len(own) else 0
                at = float(np.median(own[:, d])) if len(own) else 0.0
                dims[node], places[node] = d, at
                rows[2 * node + 1], rows[2 * node + 2] = own[own[:, d] < at], own[own[:, d] >= at]
            self.cuts.append((dims, places))

    def places(self, block: int, x: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, tile, home) for the tiles that each row is at home in, and those of higher number that its ball reaches."""
        dims, cuts = self.cuts[block]
        row, node = np.arange(len(x)), np.zeros(len(x), int)
        home, off = np.ones(len(x), bool), np.zeros(x.shape)
        for _ in range(self.depth):
            d, here = dims[node], np.arange(len(row))
            gap = x[row, d] - cuts[node]
            right = gap >= 0
            far = off.copy()
            far[here, d] = np.maximum(np.abs(gap), far[here, d])
            # The ball's own side; the other side where the ball reaches over.
            reach = (far * far).sum(axis=1) <= budget
            near_child, far_child = 2 * node + 1 + right, 2 * node + 2 - right
            row = np.concatenate([row, row[reach]])
            off = np.concatenate([off, far[reach]])
            node = np.concatenate([near_child, far_child[reach]])
            home = np.concatenate([home, np.zeros(int(reach.sum()), bool)])
        tile = node - ((1 << self.depth) - 1)
        own = np.zeros(len(x), int)
        own[row[home]] = tile[home]
        keep = home | (tile > own[row])
        return row[keep], tile[keep], home[keep]


def _floats(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the digest of each vector that can have links, else null."""
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            part = batch.slice(a, 1024)
            out = []
            for told, v in zip(part.column(2).is_valid().to_pylist(), part.column(1), strict=True):
                values = v.values if told and v.is_valid else None
                if values is None or not len(values) or values.null_count:
                    out.append(None)
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                fine = np.isfinite(x).all() and x.any()
                out.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if fine else None)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], ["id", "vec", "label", "digest"])


def _rotator(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turned: list = [None] * batch.num_rows
        vectors = batch.column(batch.schema.get_field_index("vec"))
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            step = max(1, (1 << 22) // int(size))
            for a in range(0, len(at), step):
                some = at[a : a + step]
                x = _floats(vectors.take(pa.array(some))).astype(np.float64).reshape(len(some), size)
                for i, row in zip(some.tolist(), rotated(x).astype(np.float32), strict=True):
                    turned[i] = row
        names = [*batch.schema.names, "turned"]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(turned, pa.list_(pa.float32()))], names)


def _placer(trees, blocks: int, budget: float):
    """(label, length, block, tile, home, node, part): the places of each vector in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = trees.value
        for batch in batches:
            label, node, turned = (batch.column(batch.schema.get_field_index(c)) for c in ("label", "node", "turned"))
            sizes = pc.list_value_length(turned).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                step = max(1, (1 << 21) // size)
                for a in range(0, len(at), step):
                    some = pa.array(at[a : a + step])
                    x = _floats(turned.take(some)).reshape(len(some), size)
                    edges = edges_of(size, blocks)
                    for b in range(len(edges) - 1):
                        part = x[:, edges[b] : edges[b + 1]]
                        if size in tiles:
                            share = budget * part.shape[1] / size * (1 + _SLACK)
                            row, tile, home = tiles[size].places(b, part.astype(np.float64), share)
                        else:
                            row, tile, home = np.arange(len(x)), np.zeros(len(x), int), np.ones(len(x), bool)
                        own = some.take(pa.array(row))
                        width = part.shape[1]
                        flat = pa.array(np.ascontiguousarray(part[row]).ravel())
                        parts = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(row) + 1) * width, width), pa.int32()), flat)
                        n = len(row)
                        yield pa.RecordBatch.from_arrays(
                            [label.take(own), pa.array(np.full(n, size, np.int32)), pa.array(np.full(n, b, np.int32)),
                             pa.array(tile.astype(np.int32)), pa.array(home), node.take(own), parts],
                            ["label", "length", "block", "tile", "home", "node", "part"],
                        )

    return run


KEY = ["label", "length", "block", "tile", "i", "j"]


def in_chunks(places: DataFrame, chunk: int) -> DataFrame:
    """The places with the chunks (i, j) that they take part in. A tile of up to two chunks of rows is one; of a larger one,
    each chunk of home rows meets itself, the later ones and the chunks of visitors."""
    sizes = places.groupBy("label", "length", "block", "tile").agg(
        F.count_if("home").alias("_h"), F.count_if(~F.col("home")).alias("_v")
    ).where(F.col("_h") + F.col("_v") > 2 * chunk)
    sizes = kept(sizes.withColumn("_nh", F.ceil(F.col("_h") / chunk)).withColumn("_nv", F.ceil(F.col("_v") / chunk)).drop("_h", "_v"))
    rows = places.join(small_side(sizes, MOST_TILES), KEY[:4], "left")
    mix = F.xxhash64("node")
    own = F.when(F.col("home"), F.pmod(mix, F.col("_nh"))).otherwise(F.col("_nh") + F.pmod(mix, F.greatest("_nv", F.lit(1))))
    own = own.cast("int")
    below = F.transform(F.sequence(F.lit(0), F.least(own, (F.col("_nh") - 1).cast("int"))), lambda i: F.struct(i.alias("i"), F.col("_own").alias("j")))
    above = F.transform(
        F.filter(F.sequence(F.col("_own"), (F.col("_nh") + F.col("_nv") - 1).cast("int")), lambda j: j > F.col("_own")),
        lambda j: F.struct(F.col("_own").alias("i"), j.alias("j")),
    )
    zero = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    where = F.when(F.col("_nh").isNull(), zero).when(F.col("home"), F.concat(below, above)).otherwise(below)
    out = rows.withColumn("_own", own).withColumn("at", F.explode(where))
    return out.select(*KEY[:4], "at.i", "at.j", F.coalesce("_own", F.lit(0)).alias("own"), "home", "node", "part")


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The rows of each key, from batches sorted by their first `keys` columns. Keys with one row are left out."""
    held: list[pa.RecordBatch] = []

    def whole() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        return table.to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and not all(held[-1].column(k)[held[-1].num_rows - 1].equals(batch.column(k)[0]) for k in range(keys)):
            if sum(b.num_rows for b in held) > 1:
                yield whole()
            held = []
        new = np.zeros(batch.num_rows - 1, bool)
        for k in range(keys):
            c = batch.column(k)
            new |= np.asarray(pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False), bool)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a:
                if sum(x.num_rows for x in held) > 1:
                    yield whole()
                held = []
            held.append(batch.slice(a, b - a))
    if sum(b.num_rows for b in held) > 1:
        yield whole()


def _met(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which rows of a key are compared, as positions of two sets; the second is the first where a chunk meets itself."""
    i, j = rows.column(4)[0].as_py(), rows.column(5)[0].as_py()
    own = rows.column(6).to_numpy()
    home = np.asarray(rows.column(7).to_numpy(zero_copy_only=False), bool)
    if i == j:
        at = np.flatnonzero(home)
        yield at, at
        if len(visits := np.flatnonzero(~home)):
            yield at, visits
    else:
        yield np.flatnonzero(own == i), np.flatnonzero(own == j)


def _near(x: np.ndarray, left: np.ndarray, right: np.ndarray, budget: float, step: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of `x` (32 bit) within the squared distance, as positions; a set is compared with itself once a pair."""
    wide = x.astype(np.float64)
    norms = (wide * wide).sum(axis=1)
    for a in range(0, len(left), step):
        l = left[a : a + step]
        r = right[a:] if left is right else right
        d = norms[l][:, None] + norms[r][None, :] - 2 * (wide[l] @ wide[r].T)
        p, q = np.nonzero(d <= budget * (1 + 2 * _SLACK) + 1e-9)
        p, q = l[p], r[q]
        if left is right:
            keep = p < q
            p, q = p[keep], q[keep]
        yield p, q


def _partners(blocks: int, budget: float):
    """Step 1: the rows of each key that have a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, len(KEY)):
            x = _floats(rows.column(9)).reshape(rows.num_rows, -1)
            share = budget * x.shape[1] / rows.column(1)[0].as_py()
            found = np.zeros(rows.num_rows, bool)
            for left, right in _met(rows):
                for p, q in _near(x, left, right, share):
                    found[p] = found[q] = True
            if found.any():
                yield rows.filter(pa.array(found)).select([*KEY, "own", "home", "node"])

    return run


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least position that each of `n` positions is connected to by the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _linker(blocks: int, budget: float, cosine: float):
    """Step 2: (node, root, n) for each row of a key with links that count here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, len(KEY)):
            size, block = rows.column(1)[0].as_py(), rows.column(2)[0].as_py()
            edges = edges_of(size, blocks)
            shares = budget * np.diff(edges) / size * (1 + _SLACK)
            turned = _floats(rows.column(9)).reshape(rows.num_rows, size)
            x = scaled(_floats(rows.column(10)).astype(np.float64).reshape(rows.num_rows, size))
            length = np.sqrt((x * x).sum(axis=1))
            weight = rows.column(11).to_numpy()
            links = np.zeros(rows.num_rows, np.int64)
            pairs = []
            for left, right in _met(rows):
                for p, q in _near(turned[:, edges[block] : edges[block + 1]], left, right, shares[block]):
                    for a in range(0, len(p), step := max(1, (1 << 21) // size)):
                        i, j = p[a : a + step], q[a : a + step]
                        apart = turned[i].astype(np.float64) - turned[j]
                        apart = np.add.reduceat(apart * apart, edges[:-1], axis=1) <= shares
                        here = apart[:, block] & ~apart[:, :block].any(axis=1)
                        i, j = i[here], j[here]
                        near = (x[i] * x[j]).sum(axis=1) / (length[i] * length[j]) >= cosine
                        i, j = i[near], j[near]
                        np.add.at(links, i, weight[j])
                        np.add.at(links, j, weight[i])
                        pairs.append((i, j))
            if links.any():
                a, b = (np.concatenate(s) for s in zip(*pairs, strict=True))
                root = local_roots(rows.num_rows, a, b)
                node = rows.column(8).to_numpy()
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[root[at]]), pa.array(links[at])], ["node", "root", "n"])

    return run


def _sorted(rows: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    return rows.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(run, schema)


def vector_links(nodes: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """(node, root, n): of a written table (node, label, vec, weight, turned), in how many rows of other nodes each node has
    links, and a node that it is connected to; a node has several rows, of which n adds up."""
    spark = nodes.sparkSession
    # The cosine itself is rounded too; the exact test comes later.
    budget = 2 - 2 * cosine + 1e-9
    sizes = F.size("vec")
    groups = nodes.groupBy("label", sizes.alias("length")).agg(F.count(F.lit(1)).alias("n"))
    lengths = groups.groupBy("length").agg(F.max("n").alias("most"), F.sum("n").alias("n")).orderBy(F.desc("n")).limit(MOST_LENGTHS).collect()
    total = sum(r["n"] for r in lengths)
    trees = {}
    if total:
        part = min(1.0, 1.2 * SAMPLE / total)
        # Long vectors: fewer of them, so that the sample stays within 64 MB.
        most = max(64, min(SAMPLE, (1 << 24) // max(r["length"] for r in lengths)))
        drawn = nodes.select("turned").sample(fraction=part, seed=11).limit(most).toArrow()["turned"].to_pylist()
        for r in lengths:
            own = [x for x in drawn if len(x) == r["length"]]
            depth = min(MOST_DEPTH, int(np.ceil(np.log2(max(1, r["most"] / chunk)))))
            while depth and len(own) < 16 << depth:
                depth -= 1
            if depth:
                trees[r["length"]] = Tiles(np.array(own, np.float64), blocks, depth)
    label = StructField("label", nodes.schema["label"].dataType)
    places = nodes.mapInArrow(
        _placer(spark.sparkContext.broadcast(trees), blocks, budget),
        StructType([label, *StructType.fromDDL("length int, block int, tile int, home boolean, node long, part array<float>")]),
    )
    met = StructType([label, *StructType.fromDDL("length int, block int, tile int, i int, j int, own int, home boolean, node long")])
    some = kept(_sorted(in_chunks(places, chunk), _partners(blocks, budget), met))
    whole = some.join(nodes.select("node", "turned", "vec", "weight"), "node").select(*met.names, "turned", "vec", "weight")
    return kept(_sorted(whole, _linker(blocks, budget, cosine), "node long, root long, n long"))


def vector_classes(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
    cosine: float = COSINE, blocks: int = BLOCKS, chunk: int = CHUNK,
) -> DataFrame:
    """(id, n_links, component_id, kept) for each row of `df`.

    Rows with equal labels (all, if label_col is None) and vectors of equal length are linked if their cosine in double
    precision is at least `cosine`, in (0, 1]. n_links is the number of other rows linked directly, component_id the least id
    reachable by links, kept whether that is the row's own. Rows whose label is null or whose vector is null, empty, zero or
    holds null or non-finite components have no links and are their own component. A null id gives a row, with links; it is no
    component's least id unless there is no other, and then kept is false. Rows that repeat an id are rows of their own. An
    empty table gives an empty table; other columns are not read.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be in (0, 1]")
    importable(df.sparkSession)
    label: Column = F.lit(0) if label_col is None else F.col(label_col)
    source = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec"), label.alias("label"))
    digest = StructType([*source.schema, *StructType.fromDDL("digest binary")])
    told = source.mapInArrow(_reader, digest)
    rows = kept(told.select("id", "label", "digest"))
    nodes = told.where("digest is not null").groupBy("label", "digest").agg(F.any_value("vec").alias("vec"), F.count(F.lit(1)).alias("weight"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), "label", "digest", "vec", "weight")
    nodes = kept(nodes.mapInArrow(_rotator, StructType([*nodes.schema, *StructType.fromDDL("turned array<float>")])))
    links = vector_links(nodes.drop("digest"), cosine, blocks, chunk)
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(links.where("node <> root").select(F.col("root").alias("first"), "node"))
    own = nodes.select("node", "label", "digest", "weight").join(counts, "node", "left").join(roots, "node", "left")
    own = own.where("n is not null or weight > 1").select(
        "label", "digest", F.coalesce("root", "node").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n")
    )
    placed = kept(rows.join(own, ["label", "digest"], "left"))
    least = placed.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    out = placed.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
