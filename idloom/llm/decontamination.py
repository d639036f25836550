"""Benchmark decontamination: which test items lie inside which documents.

An item is inside a document if the document holds at least ``threshold`` of
the item's distinct shingles of ``n`` words (lower-cased runs of letters and
digits), at any place.

Items are partitioned by their number of shingles. Under one hash function the
k smallest hashes of an item are its MinHash sketch; in the partition of items
with m shingles, k = m - ceil(threshold * m) + 1, the least number of which a
document at the threshold must hold at least one. So every hit is found, and
an item of m shingles is looked for only in documents with ceil(threshold * m)
shingles or more. Comparing whole documents' sketches could not work: a short
item makes up a thousandth of a long document's shingles, and a sketch of
either would share nothing. Candidates are verified by the exact count of
shared shingles.

Only DataFrame functions run on rows. The sketches are broadcast when a count
shows at most ``broadcast_rows`` of them; otherwise Spark shuffles.

Defined results: a null or empty text, or one of fewer than ``n`` words, has no
shingles, is inside nothing and holds nothing; rows with one doc_id and
different texts are separate (their hits are then listed for each); equal rows give equal hits once; rows with a
null item_id are items as well; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def with_shingles(df: DataFrame, n: int, name: str) -> DataFrame:
    """Adds ``name``: the distinct hashes of all runs of n words of ``text``."""
    def hashed(w: Column) -> Column:
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, n))))

    # the words are bound as the one element of an outer array: a column would be
    # put into the inner lambda and split anew for each position
    return df.withColumn(name, F.transform(F.array(words("text")), hashed)[0])


def contained_items(docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8,
                    broadcast_rows: int = 200_000) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common, containment) for each item
    (``items(item_id, text)``) that is inside a row of ``docs(doc_id, text)``."""
    listed = with_shingles(items.select("item_id", "text"), n, "shingles").withColumn("m", F.size("shingles")).where("m > 0")
    listed = written(listed.withColumn("_item", F.monotonically_increasing_id()).select("_item", "item_id", "m", "shingles"), "items")
    need = F.ceil(F.col("m") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    sketch = listed.withColumn("need", need).withColumn("k", F.col("m") - F.col("need") + 1)
    sketch = sketch.select("_item", "need", F.explode(F.slice(F.array_sort("shingles"), 1, F.col("k"))).alias("h"))
    shingles = listed.select("_item", F.explode("shingles").alias("h"))
    small = listed.agg(F.sum("m")).first()[0] or 0
    if small <= broadcast_rows:
        sketch, shingles = F.broadcast(sketch), F.broadcast(shingles)

    rows = docs.select("doc_id", "text").withColumn("_doc", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.coalesce("text", F.lit(""))))
    probes = with_shingles(rows, n, "shingles").select("_doc", F.size("shingles").alias("size"), F.explode("shingles").alias("h"))
    found = probes.join(sketch, "h").where(F.col("size") >= F.col("need")).select("_doc", "_item").distinct()
    found = written(found, "contained-candidates")
    texts = rows.join(found.select("_doc").distinct(), "_doc", "left_semi").dropDuplicates(["_doc"])
    held = with_shingles(texts, n, "shingles").select("_doc", F.explode("shingles").alias("h"))
    common = held.join(shingles, "h").groupBy("_doc", "_item").agg(F.count(F.lit(1)).alias("n_common"))
    hits = common.join(found, ["_doc", "_item"], "left_semi").join(listed.select("_item", "item_id", "m"), "_item")
    hits = hits.where(F.col("n_common") >= need)
    ids = texts.select("_doc", "doc_id")
    return hits.join(ids, "_doc").select(
        "doc_id", "item_id", F.col("m").cast("long").alias("n_shingles"), "n_common",
        (F.col("n_common") / F.col("m")).alias("containment"))


def without_items(docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose doc_id holds no item. Rows without an id are
    told apart by their text."""
    hits = contained_items(docs, items, n, threshold)
    with_id = docs.where("doc_id is not null").join(hits.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    nameless = docs.where("doc_id is null")
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    as_ids = nameless.select(key.alias("doc_id"), "text").distinct()
    dirty = contained_items(as_ids, items, n, threshold).select(F.col("doc_id").alias("_key")).distinct()
    clean = nameless.withColumn("_key", key).join(dirty, "_key", "left_anti").select(*docs.columns)
    return with_id.unionByName(clean)
