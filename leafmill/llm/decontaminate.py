"""Operator 10: benchmark items inside documents, by size-partitioned MinHash containment and exact verification.

DataFrame functions only. Items and documents are sets of five-word shingles of lower-cased words; an item is found in a
document that has `threshold` or more of its shingles, wherever they stand. Containment is one-sided: a document's size
says nothing, so it is the items that are sketched. An item's sketch is its k shingles of least hash. If a document lacks
at most (1 - threshold) of an item's n shingles, it has at least one of any floor((1 - threshold) * n) + 1 of them; items
are partitioned by size, doubling from part to part, and k is this bound at the upper end of the part. So the search for
candidates loses nothing, and a document shingle is probed against about a fifth of the items' shingles.

Candidates are then verified on the texts of their documents alone, by counting equal shingle texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import kept, small_side

WORDS = 5
THRESHOLD = 0.8
#: Most rows that are broadcast: sketch entries (16 bytes), and candidates with their items' shingles (about 2 KB).
MOST_SKETCH, MOST_FOUND = 1_000_000, 30_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _windows(column: str, make) -> Column:
    """make(list of WORDS columns) for each window of the word array `column`; empty if it has too few words."""
    n = F.greatest(F.size(column) - (WORDS - 1), F.lit(0))
    rows = F.arrays_zip(*(F.slice(column, F.lit(k + 1), n).alias(f"w{k}") for k in range(WORDS)))
    return F.transform(rows, lambda w: make([w[f"w{k}"] for k in range(WORDS)]))


def shingle_hashes(column: str) -> Column:
    return _windows(column, lambda w: F.xxhash64(*w))


def shingle_texts(column: str) -> Column:
    return F.array_distinct(_windows(column, lambda w: F.concat_ws(" ", *w)))


def item_shingles(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, _shingles): distinct shingle texts of each item that has any."""
    own = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("_w")).where("item_id is not null")
    return own.select("item_id", shingle_texts("_w").alias("_shingles")).where("size(_shingles) > 0").distinct()


def item_sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """(item_id, part, _h): the k least hashes of each item, k by its part: items of 2^part to 2^(part + 1) - 1 shingles."""
    hashes = F.array_sort(F.transform("_shingles", lambda s: F.xxhash64(*(F.split_part(s, F.lit(" "), F.lit(k + 1)) for k in range(WORDS)))))
    part = (F.length(F.bin(F.size("_shingles"))) - 1).cast("int")
    top = F.call_function("shiftleft", F.lit(2), part) - 1
    k = (F.floor(top * (1 - threshold) + 1e-9) + 1).cast("int")
    return shingles.select("item_id", part.alias("part"), F.explode(F.slice(hashes, F.lit(1), k)).alias("_h")).distinct()


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, item_id, n_shared, n_item, containment) for each document and item with `threshold` or more shared shingles.

    An item's or document's repeated shingles count once. Texts with fewer than five words, null ones included, have no
    shingles and are in no pair; so are null ids. Rows that repeat an id and its text count once. Items that share an id are
    told apart by their shingles and each give rows. Empty tables give no pairs.

    Documents are read twice. In the first pass only their shingle hashes meet the sketches, which are broadcast if they
    have at most `MOST_SKETCH` rows and shuffled by hash otherwise; what matches is reduced to pairs before it is moved. The
    pairs are kept in the shared folder. In the second pass only documents of pairs are cut into shingle texts.
    """
    wanted = item_shingles(items, item_id_col, item_text_col)
    wanted = kept(wanted.withColumn("_item", F.xxhash64("item_id", "_shingles")))
    sketch = item_sketches(wanted.select(F.col("_item").alias("item_id"), "_shingles"), threshold)
    sketch = kept(sketch.select(F.col("item_id").alias("_item"), "_h"))
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).where(F.col(id_col).isNotNull())
    hashes = texts.select("_doc", words(F.col("_text")).alias("_w")).select(
        "_doc", F.explode(shingle_hashes("_w")).alias("_h")
    )
    found = kept(hashes.join(small_side(sketch, MOST_SKETCH), "_h").select("_doc", "_item").distinct())
    return _verified(texts, wanted, found, threshold).select(
        F.col("_doc").alias(id_col), "item_id", "n_shared", "n_item", "containment"
    )


def _verified(texts: DataFrame, wanted: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """Exact containment of the pairs in `found`; a pair is one row until its verdict, so pairs of a hot item spread."""
    pairs = found.join(wanted, "_item")
    candidates = small_side(pairs, MOST_FOUND)
    cut = texts.join(small_side(found.select("_doc").distinct(), MOST_SKETCH), "_doc", "left_semi").withColumn(
        "_w", words(F.col("_text"))
    ).select("_doc", shingle_texts("_w").alias("_have"))
    shared = F.size(F.array_intersect("_shingles", "_have")).cast("long")
    n = F.size("_shingles").cast("long")
    both = cut.join(candidates, "_doc").select("_doc", "item_id", shared.alias("n_shared"), n.alias("n_item"))
    told = both.withColumn("containment", F.col("n_shared") / F.col("n_item"))
    return told.where(F.col("containment") >= threshold).distinct()


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents in which no item is found, all columns and repeated rows; null ids stay."""
    bad = find_items(docs, items, id_col, text_col, item_id_col, item_text_col, threshold)
    bad = kept(bad.select(F.col(id_col).alias("_bad")).distinct())
    return docs.join(small_side(bad, MOST_SKETCH), docs[id_col] == bad["_bad"], "left_anti")
