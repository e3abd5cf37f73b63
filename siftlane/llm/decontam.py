"""Benchmark decontamination by size-partitioned MinHash containment (operator 10).

A document contains an item when at least ``containment`` of the item's word
shingles occur in it.  Jaccard signatures fail here, as a short item is a tiny
part of a long document; containment is searched from the item's side.

*Sketch.* Items are partitioned by size, the number n of distinct shingles.
An item's sketch is its k smallest shingle hashes (a bottom-k MinHash), with
k = n - ceil(containment * n) + 1 for its size.  A document that holds enough
of the item cannot miss all k of them, so no pair is lost, however long the
document.

*Candidates.* The hashes of all document shingles are joined to the sketches;
a hit counts only where the document is large enough for the item's size.

*Verification.* For candidate documents the shingles themselves (the words,
not hashes) are matched to all shingles of their candidate items and counted.

All of it is DataFrame expressions.  Documents are read by narrow stages; only
hits, and the texts of candidate documents if these are too many to broadcast,
are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import freeze

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Tables of so many rows at most, counted before, are broadcast; larger ones are joined by Spark's choice.
BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; a null text has none."""
    cut = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(cut, lambda w: w != "")


def shingle_rows(df: DataFrame, length: int, *keep: str) -> DataFrame:
    """``keep`` and the words ``w0 ..`` of every run of ``length`` words in the column ``words``."""
    n = F.greatest(F.size("words") - (length - 1), F.lit(0))
    runs = F.arrays_zip(*(F.slice("words", i + 1, n).alias(f"w{i}") for i in range(length)))
    return df.where(F.size("words") >= length).select(*keep, F.inline(runs).alias(*(f"w{i}" for i in range(length))))


def _ws(length: int) -> list[str]:
    return [f"w{i}" for i in range(length)]


def _shingles(df: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """``keep, shingle, h`` for every length; a shingle is its words joined by spaces, ``h`` its hash."""
    out = None
    for k in lengths:
        rows = shingle_rows(df, k, *keep).select(*keep, F.concat_ws(" ", *_ws(k)).alias("shingle"), F.xxhash64(*_ws(k)).alias("h"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _hinted(df: DataFrame) -> DataFrame:
    """``df``, a written table, with a broadcast hint behind a check of its rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_shingles(items: DataFrame, id: str = "item_id", text: str = "text", length: int = SHINGLE_WORDS) -> DataFrame:
    """``(item_id, words, shingle, h)``: distinct shingles of each item, ``words`` their length.

    An item of fewer than ``length`` words is one shingle, all its words; one
    without words, or without an id, has none."""
    rows = items.where(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("item_id"), words_of(F.col(text)).alias("words"))
    short = rows.where((F.size("words") > 0) & (F.size("words") < length))
    one = [
        shingle_rows(short.where(F.size("words") == k), k, "item_id").select("item_id", F.lit(k).alias("words"), F.concat_ws(" ", *_ws(k)).alias("shingle"), F.xxhash64(*_ws(k)).alias("h"))
        for k in range(1, length)
    ]
    out = shingle_rows(rows, length, "item_id").select("item_id", F.lit(length).alias("words"), F.concat_ws(" ", *_ws(length)).alias("shingle"), F.xxhash64(*_ws(length)).alias("h"))
    for o in one:
        out = out.unionByName(o)
    return out.distinct()


def contained_items(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", containment: float = CONTAINMENT, length: int = SHINGLE_WORDS,
) -> DataFrame:
    """``(doc_id, text_hash, item_id, shared, item_shingles, containment)`` of every document that contains an item.

    Documents are told apart by id and text: rows that repeat both are one
    document, a null id is an id like any other, and a null text has no words.
    ``shared`` counts distinct shingles.  Empty tables give no rows."""
    spark = docs.sparkSession
    shingles = freeze(item_shingles(items, item_id, item_text, length), "item_shingles")
    lengths = sorted(r[0] for r in shingles.select("words").distinct().collect())  # at most ``length`` integers
    if not lengths:
        lengths = [length]
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("n")).withColumn("need", F.ceil(F.lit(containment) * F.col("n") - 1e-9).cast("int"))
    # the k smallest hashes of each item: k by the item's size
    ranked = shingles.join(sizes, "item_id").groupBy("item_id", "n", "need").agg(F.sort_array(F.collect_list("h")).alias("hs"))
    sketch = freeze(ranked.select("item_id", "need", F.explode(F.slice("hs", 1, F.col("n").cast("int") - F.col("need") + 1)).alias("h")).distinct(), "sketches")

    texts = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    own = ["doc_id", "text_hash", "size"]
    rows = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "text_hash", "words", F.size("words").alias("size"))
    hits = None
    probes = _hinted(sketch)
    for k in lengths:
        hashes = shingle_rows(rows, k, *own).select(*own, F.xxhash64(*_ws(k)).alias("h"))
        found = hashes.join(probes, "h").where(F.col("size") - (k - 1) >= F.col("need")).select("doc_id", "text_hash", "item_id")
        hits = found if hits is None else hits.unionByName(found)
    candidates = hits.groupBy("doc_id", "text_hash").agg(F.collect_set("item_id").alias("wanted"))  # items, at most, for a document
    candidates = _hinted(freeze(candidates.withColumnsRenamed({"doc_id": "c_id", "text_hash": "c_hash"}), "candidates"))

    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    chosen = texts.join(candidates, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")))
    chosen = chosen.select("doc_id", "text_hash", "wanted", words_of(F.col("text")).alias("words"))
    own = ["doc_id", "text_hash", "wanted"]
    every = _shingles(chosen, lengths, *own)
    index = _hinted(shingles.select("item_id", "h", F.col("shingle").alias("item_shingle")))
    shared = every.join(index, "h").where((F.col("shingle") == F.col("item_shingle")) & F.array_contains("wanted", F.col("item_id")))
    shared = shared.groupBy("doc_id", "text_hash", "item_id").agg(F.countDistinct("shingle").alias("shared"))
    found = shared.join(_hinted(freeze(sizes, "item_sizes")), "item_id").where("shared >= need")
    return found.select("doc_id", "text_hash", "item_id", "shared", F.col("n").alias("item_shingles"), (F.col("shared") / F.col("n")).alias("containment"))


def without_contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the documents that contain an item; all columns are kept."""
    found = freeze(contained_items(docs, items, id, text, **how).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "contaminated")
    return docs.join(_hinted(found), F.col(id).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left_anti")
