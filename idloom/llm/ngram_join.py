"""Jaccard similarity join on word n-grams, and its connected components.

A document's set: the distinct n-word shingles of its words
(`[^\\x20\\x09-\\x0D]+`, A-Z lower-cased); with fewer than n words the whole
sequence as one shingle; without words, empty and linked with nothing. Two
documents link when |A and B| * den >= |A or B| * num.

1. Documents with one set are one node, named by 126 bits of it. A task sends
   the prefix of a node once.
2. Shingles get one order for all documents, rare first: by how often they were
   counted, then by hash. (Counts of the commonest ``heavy`` shingles, first of
   those that tasks see several times, then of those that many prefixes by that
   order hold; any order gives the same links, a rarer prefix gives fewer candidates.) Documents at
   the threshold share a shingle of their prefixes, the first
   size - ceil(t * size) + 1 shingles.
3. One aggregate over the prefix shingles, with partial sums in every task,
   tells which of them two nodes hold. Most are held by two rows: these are a pair,
   read from the aggregate itself. The prefixes of the others are sent again, each
   with its size class and, where a larger partner could be met, the next one. Pairs pass
   the length filter (t * larger <= smaller) and the positional filter (1 + what
   follows the shared shingle in both must reach the needed overlap; for the first
   shared one this bounds the overlap).
4. A group of near copies must not give all its pairs. The nodes of a shingle
   are ranked, those that meet most others first, and leaders are taken from the
   top: one, then the next 16, 256 and so on. Every node of another component
   is paired with them, and links found merge components before more leaders
   are taken. A shingle is done when its nodes are in one component or when all
   have led, so that no link between two components is missed.
5. A pair, each once, passes the suffix filter: sets are cut into hash ranges,
   about one for each shingle, and each range in which the parities of the two
   sets differ holds a shingle that one of them lacks; there may be no more of these than the
   needed overlap leaves. What is left is verified on the sets.

Defined results: rows without a doc_id rank last (their component's id is null
only if none in it has one); equal rows and rows with one doc_id are separate
rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bitmaps
from . import words as W
from .components import components
from .line_dedup import NO_ID, document_key
from .ranks import rank_in_groups
from .storage import written

#: Leaders grow so many times from round to round.
GROWTH = 16
#: Names of nodes stay below 10^38, the most that decimal(38) holds.
NAME = "decimal(38,0)"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) pairs, each once, ordered."""
    w = W.split(data, offsets, W.WHITE, W.LOWER)
    hashes, valid = W.ngrams(w, n)
    owner = np.repeat(np.arange(len(offsets) - 1), w.counts)
    owners, shingles = [owner[valid]], [hashes[valid]]
    for k in range(1, n):  # texts of k words
        short = np.flatnonzero(w.counts == k)
        if len(short):
            owners.append(short)
            shingles.append(W.ngrams(w, k, salt=k)[0][w.first[short]])
    own, h = np.concatenate(owners), np.concatenate(shingles)
    order = np.lexsort((h, own))
    own, h = own[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return own[new], h[new]


def node_names(own: np.ndarray, shingles: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Set sizes, and 126 bits for each text's set as (low, high); 0 for an empty set."""
    size = np.bincount(own, minlength=texts)
    out = np.zeros((texts, 2), np.uint64)
    some = size > 0
    if len(shingles):
        first = np.flatnonzero(np.diff(own, prepend=-1))
        for half, salt in enumerate((0x632BE59BD9B4E019, 0xD6E8FEB86659FD93)):
            total = np.add.reduceat(W.mix(shingles + np.uint64(salt)), first)
            out[some, half] = W.mix(total + size[some].astype(np.uint64) * np.uint64(salt))
        out[:, 1] >>= np.uint64(2)
    return size, out


def decimals(names: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(names), [None, pa.py_buffer(np.ascontiguousarray(names).tobytes())])


def parities(own: np.ndarray, shingles: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(longs of all texts one after the other, their ends): a bit for each of
    64 * 2^k >= size hash ranges, set where the text has an odd number of shingles."""
    longs = np.where(size > 64, 1 << np.ceil(np.log2(np.maximum(size, 64) / 64)).astype(np.int64), 1)
    ends = np.concatenate(([0], np.cumsum(longs)))
    place = W.mix(shingles).astype(np.int64) & (64 * longs[own] - 1)
    cell = 64 * ends[own] + place
    odd = (np.bincount(cell, minlength=64 * ends[-1]) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64), ends


def _commonest(blocks: Iterator[np.ndarray], flush: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that repeat within a task's blocks of ``flush``, with counts."""
    keys, counts, held, n = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def merge() -> None:
        nonlocal keys, counts, held, n
        k, c = np.unique(np.concatenate(held), return_counts=True)
        k, c = np.concatenate((keys, k[c > 1])), np.concatenate((counts, c[c > 1]))
        keys, at = np.unique(k, return_inverse=True)
        counts, held, n = np.bincount(at, c, len(keys)).astype(np.int64), [], 0

    for h in blocks:
        held.append(h)
        n += len(h)
        if n >= flush:
            merge()
    if held:
        merge()
    return keys, counts


def _ordered(keys, counts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, each with its largest count."""
    keys = np.asarray(keys, np.int64).view(np.uint64)
    distinct, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(distinct), np.int64)
    np.maximum.at(out, at, np.asarray(counts, np.int64))
    return distinct, out


def _pass_sets(docs: DataFrame, n: int) -> DataFrame:
    """For each row (doc, row, size, half, node), ``half`` being the name's low
    64 bits; and rows (shingle as half, count as size) with a null ``row`` for
    what repeats within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[pa.RecordBatch] = []
        names = ["doc", "row", "size", "half", "node"]

        def blocks() -> Iterator[np.ndarray]:
            for batch in batches:
                for part in W.slices(batch, "text"):
                    own, h = shingle_sets(*W.text_buffers(part.column("text")), n)
                    size, node = node_names(own, h, part.num_rows)
                    out.append(pa.RecordBatch.from_arrays(
                        [part.column("doc"), part.column("row"), pa.array(size), pa.array(node[:, 0].copy().view(np.int64)), decimals(node)], names))
                    yield h

        keys, counts = _commonest(blocks())
        yield from out
        keys, counts = keys[counts > 2], counts[counts > 2]
        none = pa.nulls(len(keys), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.array(counts), pa.array(keys.view(np.int64)), pa.nulls(len(keys), pa.decimal128(38, 0))], names)

    return docs.mapInArrow(run, f"doc long, row long, size long, half long, node {NAME}")


def _prefixes(docs: DataFrame, n: int, num: int, den: int, common: tuple[np.ndarray, np.ndarray], only: np.ndarray | None = None) -> DataFrame:
    """(token, half, size, place) of each set's prefix. With the bitmap ``only``,
    (token, node, size, place) of the tokens that may be in it."""
    shared = docs.sparkSession.sparkContext.broadcast((common, only))
    name = "half" if only is None else "node"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (keys, counts), wanted = shared.value
        done: set[bytes] = set()  # a task sends the prefix of a set once
        for batch in batches:
            for part in W.slices(batch, "text"):
                own, h = shingle_sets(*W.text_buffers(part.column("text")), n)
                size, node = node_names(own, h, part.num_rows)
                if len(done) > 300_000:
                    done = set()
                fresh = np.zeros(part.num_rows, bool)
                for i in np.flatnonzero(size):
                    v = node[i].tobytes()
                    if v not in done:
                        done.add(v)
                        fresh[i] = True
                keep = fresh[own]
                own, h = own[keep], h[keep]
                often = np.zeros(len(h), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    often = np.where(keys[at] == h, counts[at], 0)
                order = np.lexsort((h, often, own))
                own, h = own[order], h[order]
                place = np.arange(len(h)) - np.searchsorted(own, own)
                first = place < (size - -(-num * size // den) + 1)[own]
                if wanted is not None:
                    first &= bitmaps.found(wanted, h)
                own, h, place = own[first], h[first], place[first]
                named = pa.array(node[own, 0].view(np.int64)) if wanted is None else decimals(node[own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), named, pa.array(size[own].astype(np.int32)), pa.array(place.astype(np.int32))],
                    ["token", name, "size", "place"])

    return docs.select("text").mapInArrow(run, f"token long, {name} {'long' if only is None else NAME}, size int, place int")


def _of_rows(docs: DataFrame, n: int, rows: DataFrame, whole: bool) -> DataFrame:
    """(node, size, parity) of ``rows(node, row)``, or (node, items), the set
    itself, if ``whole``; a node has one row. A bitmap of the wanted rows keeps
    the other texts from being read, and no text is sent."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps.occurring(rows, "row"))
    columns = ["items"] if whole else ["size", "parity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row").to_numpy(zero_copy_only=False)
            batch = batch.take(pa.array(np.flatnonzero(bitmaps.found(shared.value, row.view(np.uint64)))))
            for part in W.slices(batch, "text"):
                own, h = shingle_sets(*W.text_buffers(part.column("text")), n)
                size, node = node_names(own, h, part.num_rows)
                longs, ends = (h.view(np.int64), np.concatenate(([0], np.cumsum(size)))) if whole else parities(own, h, size)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(longs))
                found = [lists] if whole else [pa.array(size.astype(np.int32)), lists]
                yield pa.RecordBatch.from_arrays([part.column("row"), decimals(node), *found], ["row", "node", *columns])

    kinds = "items array<long>" if whole else "size int, parity array<long>"
    out = docs.select("row", "text").mapInArrow(run, f"row long, node {NAME}, {kinds}")
    return out.join(rows.select("row", "node"), ["row", "node"], "left_semi").dropDuplicates(["node"]).select("node", *columns)


def differing_ranges(a: str, b: str) -> Column:
    """Ranges in which two parity arrays differ; the longer one is folded."""
    ranges = F.least(F.size(a), F.size(b))

    def folded(x: str) -> Column:
        half = F.zip_with(F.slice(x, F.lit(1), ranges), F.slice(x, ranges + 1, ranges), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > ranges, half).otherwise(F.col(x))

    bits = F.zip_with(folded(a), folded(b), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(bits, F.lit(0), lambda s, v: s + v)


class NgramJoin:
    """The join over the rows of ``docs(doc_id, text)``. After ``rounds`` rounds
    all nodes that have not led yet do so together."""

    def __init__(self, docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, heavy: int = 1 << 18, rounds: int = 6):
        if 2 * num < den:
            raise ValueError("the similarity must be a half or more")
        self.n, self.num, self.den, self.rounds = n, num, den, rounds
        key = F.xxhash64(document_key(), F.coalesce("text", F.lit("")))
        docs = docs.select(document_key(), key.alias("row"), "text")
        passed = written(_pass_sets(docs, n), "shingle-sets")
        self.rows, self.docs = passed.where("row is not null").select("doc", "row", "size", "half", "node"), docs.select("row", "text")
        common = passed.where("row is null").groupBy("half").agg(F.sum("size").alias("n")).where("n > 7")
        common = common.orderBy(F.desc("n"), "half").limit(heavy).toPandas()  # bounded by ``heavy``
        found = _ordered(common["half"], common["n"])
        # shingles that many prefixes hold are common too, though no single task saw it: with them
        # put behind, passages that many documents share leave the prefixes
        held = written(_prefixes(docs, n, num, den, found).groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 3"), "held-shingles")
        held = held.orderBy(F.desc("n"), "token").limit(heavy).toPandas()
        found = _ordered(np.concatenate((common["half"], held["token"])), np.concatenate((common["n"], held["n"])))
        named = self.rows.where("size > 0").groupBy("node").agg(F.min("half").alias("half"), F.min("row").alias("row"))
        self.named = written(named, "named-rows")
        shared = _prefixes(docs, n, num, den, found).groupBy("token").agg(
            F.count(F.lit(1)).alias("n"), F.min("half").alias("lo"), F.max("half").alias("hi"),
            F.min("size").alias("size"), F.max("size").alias("size2"), F.min(F.col("size") - F.col("place")).alias("rest"))
        shared = written(shared.where("lo < hi"), "shared-shingles")
        self.couples = self._couples(shared.where("n = 2"))
        self.members = self._members(_prefixes(docs, n, num, den, found, bitmaps.occurring(shared.where("n > 2"), "token")))
        nodes = self.members.select("node")
        for x in "ab":
            nodes = nodes.unionByName(self.couples.select(F.col(x).alias("node")))
        self.nodes = written(self.named.join(nodes.distinct(), "node", "left_semi").select("node", "row"), "candidates")
        self.light = written(_of_rows(self.docs, n, self.nodes, whole=False), "parities")
        self.links = self._link()

    def _needed(self, a: str | Column, b: str | Column) -> Column:
        """The overlap that sets of these sizes need."""
        total = (F.col(a) if isinstance(a, str) else a) + (F.col(b) if isinstance(b, str) else b)
        return F.ceil(total * self.num / F.lit(float(self.num + self.den)) - F.lit(1e-9))

    def _couples(self, shared: DataFrame) -> DataFrame:
        """The pairs (a, b) of shingles that are in two prefixes alone."""
        near = shared.where((F.col("size") * self.den >= F.col("size2") * self.num) & (F.col("rest") >= self._needed("size", "size2")))
        near = near.select("lo", "hi").distinct()
        for half, x in (("lo", "a"), ("hi", "b")):  # halves that two nodes share stand for both
            near = near.join(self.named.select(F.col("half").alias(half), F.col("node").alias(x)), half)
        return written(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "couples")

    def _members(self, prefixes: DataFrame) -> DataFrame:
        """(token, kind, node, size, place, rank): the nodes of each shingle and
        size class that may link there."""
        log = float(1.0001 * np.log(self.den / self.num))
        kind = F.floor(F.log("size") / F.lit(log)).cast("int")
        rows = written(prefixes.distinct(), "prefixes")
        rows = rows.withColumn("_own", kind).withColumn("kind", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
        # partners in the next class are larger; those in the own one are met there
        larger = F.greatest(F.col("size").cast("double"), F.floor(F.exp(F.col("kind") * F.lit(log))) - 1)
        rows = rows.where((F.col("kind") == F.col("_own")) | (F.col("size") - F.col("place") >= self._needed("size", larger))).drop("_own")
        rest = F.col("size") - F.col("place")
        groups = rows.groupBy("token", "kind").agg(F.count(F.lit(1)).alias("_n"), F.min("size").alias("_small"), F.max(rest).alias("_rest"))
        groups = written(groups.where("_n > 1"), "prefix-groups")
        rows = rows.join(groups, ["token", "kind"])
        # the positional filter against the best partner there could be
        rows = written(rows.where(F.least(rest, "_rest") >= self._needed("size", "_small")).select("token", "kind", "node", "size", "place", "_n"), "shared-prefixes")
        met = rows.groupBy("node").agg(F.sum("_n").alias("_met"))
        rows = written(rows.drop("_n").join(met, "node"), "met-prefixes")
        # what meets most others leads; nodes that meet equally many are dealt to 64 parts by a hash
        part = -F.floor(F.log2("_met") * 4).cast("long") * 64 + F.pmod(F.xxhash64("node"), F.lit(64))
        ranked = rank_in_groups(rows, ["token", "kind"], part, [F.desc("_met"), F.asc("node")], "rank")
        return written(ranked.drop("_met"), "members")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """(a, b): the components ca and cb of the pairs (a, b, ca, cb) whose sets are similar."""
        light = [self.light.select(F.col("node").alias(x), F.col("size").alias(f"size{x}"), F.col("parity").alias(f"parity{x}")) for x in "ab"]
        spare = F.col("sizea") + F.col("sizeb") - 2 * self._needed("sizea", "sizeb")
        pairs = pairs.join(light[0], "a").join(light[1], "b").where(differing_ranges("paritya", "parityb") <= spare)
        pairs = written(pairs.select("a", "b", "ca", "cb", "sizea", "sizeb"), "close-pairs")
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = written(self.nodes.join(nodes, "node", "left_semi"), "wanted-rows")
        items = written(_of_rows(self.docs, self.n, wanted, whole=True), "sets")  # of what is left alone
        whole = [items.select(F.col("node").alias(x), F.col("items").alias(f"items{x}")) for x in "ab"]
        common = F.size(F.array_intersect("itemsa", "itemsb"))
        pairs = pairs.join(whole[0], "a").join(whole[1], "b").select("ca", "cb", "sizea", "sizeb", common.alias("common"))
        similar = (F.col("sizea") + F.col("sizeb") - F.col("common")) * self.num <= F.col("common") * self.den
        return pairs.where(similar).select(F.col("ca").alias("a"), F.col("cb").alias("b"))

    def _met(self, left: DataFrame, done: int, more: int | None) -> DataFrame:
        """The pairs (a, b, ca, cb) of the next leaders and nodes of other components."""
        leads = left.where(F.col("rank") >= done)
        if more:
            leads = leads.where(F.col("rank") < done + more)
        leads = leads.select("token", "kind", *(F.col(c).alias(f"{c}2") for c in ("node", "size", "place", "rank", "comp")))
        small, large = F.least("size", "size2"), F.greatest("size", "size2")
        rest = F.least(F.col("size") - F.col("place"), F.col("size2") - F.col("place2"))
        near = (
            (left["token"] == leads["token"]) & (left["kind"] == leads["kind"]) & (F.col("rank") > F.col("rank2")) & (F.col("comp") != F.col("comp2"))
            & (small * self.den >= large * self.num) & (rest >= self._needed("size", "size2")))
        first = F.col("node") < F.col("node2")
        chosen = [F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in (("node", "node2"), ("node2", "node"), ("comp", "comp2"), ("comp2", "comp"))]
        return left.join(leads, near).select(*(c.alias(x) for c, x in zip(chosen, ("a", "b", "ca", "cb"))))

    def _link(self) -> DataFrame:
        """(node, comp) of the nodes with candidates."""
        left = self.members.withColumn("comp", F.col("node"))
        labels = self.nodes.select("node", F.col("node").alias("comp"))
        done, more = 0, 1
        for turn in range(self.rounds + 1):
            pairs = self._met(left, done, more if turn < self.rounds else None)
            if not turn:
                pairs = pairs.unionByName(self.couples.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb")))
            edges = written(self._verified(written(pairs.distinct(), "pairs")).distinct(), "links")
            done, more = done + more, more * GROWTH
            if edges.limit(1).count():
                merged = components(edges).select(F.col("node").alias("comp"), F.col("comp").alias("_to"))
                labels = written(labels.join(merged, "comp", "left").select("node", F.coalesce("_to", "comp").alias("comp")), "labels")
                left = left.join(merged, "comp", "left").withColumn("comp", F.coalesce("_to", "comp")).drop("_to")
            # shingles whose nodes are in two components or more and have not all led
            open_ = left.groupBy("token", "kind").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.max("rank").alias("_last"))
            open_ = open_.where((F.col("_lo") < F.col("_hi")) & (F.col("_last") >= done)).select("token", "kind")
            left = written(left.join(open_, ["token", "kind"], "left_semi"), "open-prefixes")
            if not left.limit(1).count():
                break
        return labels

    def result(self) -> DataFrame:
        """(doc, row, n_shingles, keep_row, component) for each row of the
        documents: ``component`` is its smallest doc_id (NO_ID if it has none),
        ``keep_row`` the smallest row of that document in it. Both are null for
        an empty set."""
        nodes = self.rows.where("size > 0").groupBy("node").agg(F.min(F.struct("doc", "row")).alias("first"))
        nodes = nodes.join(self.links, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        firsts = nodes.groupBy("comp").agg(F.min("first").alias("first"))
        nodes = written(nodes.select("node", "comp").join(firsts, "comp").select("node", "first"), "node-components")
        rows = self.rows.join(nodes, "node", "left")
        return rows.select(
            "doc", "row", F.col("size").alias("n_shingles"),
            F.when(F.col("size") > 0, F.col("first.row")).alias("keep_row"), F.when(F.col("size") > 0, F.col("first.doc")).alias("component"))


def join_documents(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``."""
    joined = NgramJoin(docs, n, num, den).result()
    component = F.coalesce("component", "doc")
    known = lambda c: F.when(c != NO_ID, c)
    return joined.select(known(F.col("doc")).alias("doc_id"), "n_shingles", known(component).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without those that are linked to a document with a
    smaller id, directly or through others. Equal rows are one document and
    stay or go together; rows without words all stay."""
    joined = NgramJoin(docs.select("doc_id", "text"), n, num, den).result()
    gone = joined.where("n_shingles > 0 and row <> keep_row").select(F.col("row").alias("_row")).distinct()
    key = F.xxhash64(document_key(), F.coalesce("text", F.lit("")))
    return docs.withColumn("_row", key).join(gone, "_row", "left_anti").select(*docs.columns)
