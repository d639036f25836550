"""Ranked lexical search: the best documents for each item of a query set, by
dense matrix products of item and document tiles.

Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A
term's weight w is floor(1000 * ln((2N + 2) / (2 df + 1))); its impact in a
document is (10^9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L, for a
document of n terms, N documents with terms and L terms in all. A document's
score is the sum of w * impact over the item's distinct terms.

1. Items are dealt by hash into blocks of about ``block_bytes`` of text. A block
   is all that the driver or a broadcast holds of the items at once; each block
   meets all documents, one after the other.
2. One pass over the documents counts N, L and the df of the block's terms.
3. Items go into tiles, each with a compact vocabulary of its own items' terms.
   A second pass turns documents, ``DOCS`` at a time, into a dense tile of
   impacts (vocabulary x documents, float64) for each item tile and multiplies:
   weights (items x vocabulary) @ impacts. Weights and impacts are whole
   numbers, and vocabularies are cut so that no sum within a product can reach
   2^53: every product is exact in float64. Sums over cuts are 64-bit integers.
4. A task keeps the ``k`` best documents of each item; whatever ties with the
   k-th by score stays until the ids have decided. The tasks' lists, k rows for
   each item, meet in two levels of windows.

Defined results: a null or empty text has no terms and is never found; an item
without terms, or whose terms occur nowhere, gives no rows; equal rows of the
items count once; items of one id but other texts are searched apart, each with
its ranks from 1; repeated rows of a document are documents of their own; a
null doc_id ranks behind all others among equal scores; extra columns are not
read; empty tables give no rows. Whole texts are read; a single item must fit
into a task's memory.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W

#: Bytes that end a term; A-Z become a-z.
_TABLE = bytes(32 if W.NOT_ALNUM[b] else int(W.LOWER[b]) for b in range(256))
#: Documents and items in a tile, and the most terms in a product.
DOCS, ITEMS, TERMS = 512, 64, 2048
EXACT = 1 << 53
#: 10^9 tf / (1000 tf + 8 m) is less than this.
MOST_IMPACT = 1_000_000


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def _texts(part: pa.RecordBatch) -> list[bytes | None]:
    return part.column("text").cast(pa.large_binary()).to_pylist()


def _counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, int, dict[int, int]]:
    """N, L, and df by term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        df: Counter = Counter()
        some = total = 0
        for batch in batches:
            for part in W.slices(batch, "text"):
                for text in _texts(part):
                    found = terms(text)
                    some += bool(found)
                    total += len(found)
                    df.update(set(map(get, found)))
        df.pop(None, None)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *df], pa.int64()), pa.array([some, total, *df.values()], pa.int64())], ["term", "n"])

    # one row for each term of the block, and two
    got = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = {r.term: r.n for r in got}
    return df.pop(-2, 0), df.pop(-1, 0), df


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def tiles(items: list[list[int]], weights: dict[int, int]) -> list[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """Item tiles: (items, cuts), each cut (terms in order, weights of items x
    terms). No item's weights in a cut times the largest impact reach 2^53."""
    out = []
    order = [i for i in sorted(range(len(items)), key=lambda i: sorted(items[i])) if any(weights.get(t) for t in items[i])]
    for a in range(0, len(order), ITEMS):
        chosen = order[a : a + ITEMS]
        vocabulary = sorted({t for i in chosen for t in items[i] if weights.get(t)})
        holds = [set(items[i]) for i in chosen]
        cuts, at = [], 0
        while at < len(vocabulary):
            end, sums = at, [0] * len(chosen)
            while end < len(vocabulary) and end - at < TERMS:
                w = weights[vocabulary[end]] * MOST_IMPACT
                more = [s + w * (vocabulary[end] in h) for s, h in zip(sums, holds)]
                if end > at and max(more) >= EXACT:
                    break
                sums, end = more, end + 1
            cut = vocabulary[at:end]
            matrix = np.array([[weights[t] if t in h else 0 for t in cut] for h in holds], np.float64)
            cuts.append((np.array(cut, np.int64), matrix))
            at = end
        out.append((np.array(chosen, np.int64), cuts))
    return out


class Best:
    """The ``k`` best (score, document) of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)
        self.least = np.ones(n_items, np.int64)  # a score below this is not among the best

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        item, score = np.concatenate((self.item, item)), np.concatenate((self.score, score))
        doc, no_id = np.concatenate((self.doc, doc)), np.concatenate((self.no_id, no_id))
        order = np.lexsort((doc, no_id, -score, item))
        item, score, doc, no_id = item[order], score[order], doc[order], no_id[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.k - 1
        self.least[item[last]] = score[last]
        keep = place < self.k
        self.item, self.score, self.doc, self.no_id = item[keep], score[keep], doc[keep], no_id[keep]


def _search(docs: DataFrame, vocabulary: dict[bytes, int], item_tiles: list, n_items: int, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the best of each task."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, item_tiles))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, parts = shared.value
        get, best = words.get, Best(n_items, k)
        column = np.zeros(len(words), np.int64)

        def tile(docs_at: list, term: list, tf: list, size: list, ids: list) -> None:
            m = np.array([10 + 90 * n * n_docs // n_terms for n in size], np.int64)
            docs_, terms_, tfs = np.array(docs_at, np.int64), np.array(term, np.int64), np.array(tf, np.int64)
            impact = (10**9 * tfs // (1000 * tfs + 8 * m[docs_])).astype(np.float64)
            no_id = np.array([i is None for i in ids])
            doc = np.array([i or 0 for i in ids], np.int64)
            order = np.argsort(terms_, kind="stable")
            docs_, terms_, impact = docs_[order], terms_[order], impact[order]
            for chosen, cuts in parts:
                total = np.zeros((len(chosen), len(ids)), np.int64)
                for cut, weights in cuts:
                    first, last = np.searchsorted(terms_, cut), np.searchsorted(terms_, cut, "right")
                    some = np.flatnonzero(last > first)
                    if not len(some):
                        continue
                    # the cut's terms that these documents hold, as rows of a dense tile
                    column[cut[some]] = np.arange(len(some))
                    at = np.concatenate([np.arange(first[i], last[i]) for i in some])
                    dense = np.zeros((len(some), len(ids)))
                    dense[column[terms_[at]], docs_[at]] = impact[at]
                    total += (weights[:, some] @ dense).astype(np.int64)
                kth = np.partition(total, -k, axis=1)[:, -k] if total.shape[1] > k else np.zeros(len(chosen), np.int64)
                i, j = np.nonzero(total >= np.maximum(kth, best.least[chosen])[:, None])
                if len(i):
                    best.add(chosen[i], total[i, j], doc[j], no_id[j])

        docs_at, term, tf, size, ids = [], [], [], [], []
        for batch in batches:
            for part in W.slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), _texts(part)):
                    found = terms(text)
                    held = Counter(map(get, found))
                    held.pop(None, None)
                    if held:
                        docs_at.extend([len(ids)] * len(held))
                        term.extend(held)
                        tf.extend(held.values())
                        size.append(len(found))
                        ids.append(doc_id)
                    if len(ids) == DOCS:
                        tile(docs_at, term, tf, size, ids)
                        docs_at, term, tf, size, ids = [], [], [], [], []
        if ids:
            tile(docs_at, term, tf, size, ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.doc, mask=best.no_id), pa.array(best.score)], ["item", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "item long, doc_id long, score long")


def _top(found: DataFrame, k: int, slices: int = 64) -> DataFrame:
    """The k best of each item, with ranks; a slice of the documents first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = found.withColumn("_slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "_slice").orderBy(*order))).where(F.col("rank") <= k)
    return found.drop("_slice").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = 1 << 22) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of ``docs(doc_id,
    text)`` that score highest for each row of ``items(item_id, text)``."""
    spark = docs.sparkSession
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = items.schema["item_id"].dataType
    total = items.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    n_blocks = -(-2 * total // block_bytes)  # twice as many as needed: hashing fills them unevenly
    out = spark.createDataFrame([], f"item_id {id_type.simpleString()}, rank int, doc_id long, score long")
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n_blocks, 1)))
    for block in range(n_blocks):
        rows = items.where(block_of == block).distinct().orderBy("item_id", "text").collect()  # about block_bytes / 2
        vocabulary: dict[bytes, int] = {}
        held = [sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms(r.text.encode())}) for r in rows]
        if not vocabulary:
            continue
        n_docs, n_terms, df = _counts(docs, vocabulary)
        if not df:
            continue
        item_tiles = tiles(held, {t: weight(n_docs, n) for t, n in df.items()})
        found = _top(_search(docs, vocabulary, item_tiles, len(rows), n_docs, n_terms, k), k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item long, item_id {id_type.simpleString()}")
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
