"""Near-duplicate documents by b-bit MinHash.

A document's set: the distinct n-word shingles of its words
(``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased); with fewer than n words the whole
sequence as one shingle; without words, empty and linked with nothing.
Documents link when |A and B| * den >= |A or B| * num.

1. One pass takes ``HASHES`` minima of each set. Bands of ``rows`` whole minima
   become keys; of the minima themselves only the lowest ``LOW`` bits are kept,
   packed into ``HASHES * LOW`` bits. Documents with one set are one node, named
   by 126 bits of it.
2. Nodes with a common band key are candidates. Two sets of similarity t miss
   each other in all bands with odds (1 - t^rows)^bands: 4e-7 at 0.85, less above.
3. Packed signatures are compared by bit counts. Equal minima agree, and others
   do so with odds 2^-LOW, so similarity is (agreeing share - 2^-LOW) /
   (1 - 2^-LOW). A pair is dropped when so many places differ that a pair at
   the threshold would show it with odds below ``SURE``.
4. Sets are cut into hash ranges, about one for each shingle, and each range in
   which the parities of two sets differ holds a shingle that one of them lacks:
   a pair that differs in more ranges than a link allows is dropped for certain.
   Bit counts cannot tell 0.78 from 0.85, so that in a group of copies that
   mostly do not link nearly all pairs would be left without this. The first
   leaders' pairs, few for each key, are tested when each is there once, those of the
   next ones where they meet.
5. What is left is measured on the whole sets.

A key that many nodes have must not give all its pairs. Its nodes are ranked,
those that meet most others first, and leaders are taken from the top: first
one, then the next 16, 256 and so on. Every node of a key in another component
than the leader's is compared with it, and links found merge components before
more leaders are taken. A key is done when its nodes are in one component, or
when all of them have led: so every pair of two components has been compared,
and no link between them is lost.

Defined results: null and empty texts have the empty set, and are components of
their own; equal rows are one node; ids that repeat with other texts are rows of
their own; a null doc_id ranks last, so a component is named by its smallest
known id (null without one); extra columns are not read; an empty table gives
an empty result. Whole texts of any length are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bitmaps
from . import words as W
from .components import components
from .ngram_join import NAME, decimals, differing_ranges, node_names, parities, shingle_sets
from .ranks import rank_in_groups
from .storage import written

HASHES, LOW = 128, 2
LONGS = HASHES * LOW // 64
#: Odds that the bit counts of a pair at the threshold drop it.
SURE = 1e-8
#: Leaders grow so many times from round to round.
GROWTH = 16

_rng = np.random.default_rng(20240311)
_XOR = _rng.integers(1, 2**63, HASHES, dtype=np.uint64)
_TIMES = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)


def minima(own: np.ndarray, shingles: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts with a set, their minima as rows); ``own`` is in order."""
    first = np.flatnonzero(np.diff(own, prepend=-1))
    out = np.empty((len(first), HASHES), np.uint64)
    if len(first):
        for k in range(HASHES):
            out[:, k] = np.minimum.reduceat((shingles ^ _XOR[k]) * _TIMES[k], first)
    return own[first], out


def packed(lows: np.ndarray) -> np.ndarray:
    """The lowest ``LOW`` bits of mixed minima, ``LONGS`` longs for each row."""
    bits = W.mix(lows) & np.uint64((1 << LOW) - 1)
    per = 64 // LOW
    shifted = bits.reshape(len(lows), LONGS, per) << (np.arange(per, dtype=np.uint64) * np.uint64(LOW))
    return np.bitwise_or.reduce(shifted, axis=2)


def band_keys(lows: np.ndarray, rows: int) -> np.ndarray:
    bands = HASHES // rows
    cells = lows[:, : bands * rows].reshape(len(lows), bands, rows)
    places = W.mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.add.reduce(W.mix(cells) * places, axis=2, dtype=np.uint64)
    return W.mix(total + W.mix(np.arange(bands, dtype=np.uint64) + np.uint64(77)))


def _signatures(docs: DataFrame, n: int, rows: int) -> DataFrame:
    """(doc, key, size, node, bands, low0...) of each row. A task sends bands
    and bits of a set once, with its first row; the others have nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        for batch in batches:
            for part in W.slices(batch, "text"):
                own, h = shingle_sets(*W.text_buffers(part.column("text")), n)
                size, names = node_names(own, h, part.num_rows)
                if len(done) > 300_000:
                    done = set()
                fresh = np.zeros(part.num_rows, bool)
                for i in np.flatnonzero(size):
                    name = names[i].tobytes()
                    if name not in done:
                        done.add(name)
                        fresh[i] = True
                keep = fresh[own]
                text, lows = minima(own[keep], h[keep], part.num_rows)
                keys = band_keys(lows, rows).view(np.int64)
                ends = np.zeros(part.num_rows + 1, np.int32)
                ends[text + 1] = keys.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends).astype(np.int32)), pa.array(keys.ravel()))
                bits = np.zeros((part.num_rows, LONGS), np.uint64)
                bits[text] = packed(lows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("key"), pa.array(size.astype(np.int32)), decimals(names), lists, *(pa.array(c.view(np.int64)) for c in np.ascontiguousarray(bits.T))],
                    ["doc", "key", "size", "node", "bands", *(f"low{i}" for i in range(LONGS))])

    lows = ", ".join(f"low{i} long" for i in range(LONGS))
    return docs.mapInArrow(run, f"doc long, key long, size int, node {NAME}, bands array<long>, {lows}")


def _of_bands(nodes: DataFrame, shared: np.ndarray) -> DataFrame:
    """(band, the other columns) of ``nodes(bands, ...)`` for each band key that
    may be shared."""
    bitmap = nodes.sparkSession.sparkContext.broadcast(shared)
    rest = [f for f in nodes.schema.fields if f.name != "bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column("bands")
            keys = bands.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bands.offsets.to_numpy()))
            some = bitmaps.found(bitmap.value, keys.view(np.uint64))
            own = pa.array(owner[some])
            yield pa.RecordBatch.from_arrays([pa.array(keys[some]), *(batch.column(f.name).take(own) for f in rest)], ["band", *(f.name for f in rest)])

    return nodes.mapInArrow(run, "band long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest))


def _sets(docs: DataFrame, n: int, wanted: np.ndarray) -> DataFrame:
    """(key, node, items, parity) of the rows whose key may be wanted."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            batch = batch.take(pa.array(np.flatnonzero(bitmaps.found(shared.value, key.view(np.uint64)))))
            for part in W.slices(batch, "text"):
                own, h = shingle_sets(*W.text_buffers(part.column("text")), n)
                size, names = node_names(own, h, part.num_rows)
                odd, odd_ends = parities(own, h, size)
                ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(e), pa.array(v)) for e, v in ((ends, h.view(np.int64)), (odd_ends.astype(np.int32), odd))]
                yield pa.RecordBatch.from_arrays([part.column("key"), decimals(names), *lists], ["key", "node", "items", "parity"])

    return docs.select("key", "text").mapInArrow(run, f"key long, node {NAME}, items array<long>, parity array<long>")


def _marked(sets: DataFrame, wanted: np.ndarray) -> DataFrame:
    """The rows of ``sets(node, items, mixed)`` whose hash may be wanted."""
    shared = sets.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mixed = batch.column("mixed").to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(bitmaps.found(shared.value, mixed.view(np.uint64))))

    return sets.mapInArrow(run, sets.schema)


def most_differing(num: int, den: int, sure: float = SURE) -> int:
    """So many of the ``HASHES`` places may differ: a pair at the threshold
    shows more with odds below ``sure``."""
    p = (1 - num / den) * (1 - 2.0**-LOW)
    tail = 0.0
    for k in range(HASHES, -1, -1):
        tail += math.comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)
        if tail >= sure:
            return k
    return HASHES


def differing(a: str, b: str) -> Column:
    """Places in which the packed minima with prefixes ``a`` and ``b`` differ."""
    out = F.lit(0)
    for i in range(LONGS):
        x = F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))
        for step in range(1, LOW):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        mask = sum(1 << k for k in range(0, 64, LOW))
        out = out + F.bit_count(x.bitwiseAND(F.lit(mask).cast("long")))
    return out


class NearDedup:
    """The classes of the rows of ``docs(doc_id, text)``."""

    def __init__(self, docs: DataFrame, n: int = 5, num: int = 85, den: int = 100, rows: int = 5):
        self.n, self.num, self.den, self.rows = n, num, den, rows
        key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
        docs = docs.select(F.col("doc_id").cast("long").alias("doc"), key.alias("key"), "text")
        self.docs = docs
        self.signed = written(_signatures(docs, n, rows), "signatures")
        self.members = self._members()
        self.sets = self._wanted_sets()
        self.labels = self._link()

    def _members(self) -> DataFrame:
        """(band, node, size, low..., rank): the nodes of every band key that two nodes have."""
        fields = ["node", "size", *(f"low{i}" for i in range(LONGS))]
        sent = self.signed.where("bands is not null and size > 0")
        shared = sent.select(F.explode("bands").alias("band"), F.xxhash64("node").alias("mixed")).groupBy("band")
        shared = shared.agg(F.min("mixed").alias("_lo"), F.max("mixed").alias("_hi"), F.count(F.lit(1)).alias("_n"))
        shared = written(shared.where("_lo < _hi").select("band", "_n"), "shared-bands")
        keyed = _of_bands(sent.select("bands", *fields), bitmaps.occurring(shared, "band"))
        members = written(keyed.join(shared, "band").groupBy("band", *fields).agg(F.max("_n").alias("met")), "band-members")
        # what meets most others leads; nodes that meet equally many are dealt to 64 parts by a hash
        met = members.groupBy("node").agg(F.sum("met").alias("all_met"))
        members = written(members.drop("met").join(met, "node"), "ranked-members")
        part = -F.floor(F.log2("all_met") * 4).cast("long") * 64 + F.pmod(F.xxhash64("node"), F.lit(64))
        ranked = rank_in_groups(members, ["band"], part, [F.desc("all_met"), F.asc("node")], "rank")
        return written(ranked.drop("all_met"), "members")

    def _wanted_sets(self) -> DataFrame:
        """(node, items, parity, mixed, size) of the nodes that have candidates."""
        nodes = self.members.select("node").distinct()
        chosen = self.signed.where("size > 0").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"))
        chosen = written(chosen, "chosen-rows")
        found = _sets(self.docs, self.n, bitmaps.occurring(chosen, "key"))
        found = found.join(chosen, ["key", "node"], "left_semi").dropDuplicates(["key", "node"])  # a node has one key here
        return written(found.drop("key").withColumns({"mixed": F.xxhash64("node"), "size": F.size("items")}), "sets")

    def _similar(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, ca, cb) whose whole sets are similar. Pairs whose
        parities tell them apart go first. Only sets of the others' nodes are
        sent; few nodes lead, so that the sets of b are few."""
        odd = [self.sets.select(F.col("node").alias(x), F.col("size").alias(f"n{x}"), F.col("parity").alias(f"parity_{x}")) for x in "ab"]
        pairs = pairs.join(odd[0], "a").join(odd[1], "b").where(self._close("na", "nb", "parity_a", "parity_b"))
        pairs = written(pairs.select("a", "b", "ca", "cb"), "close-pairs")
        sets = [_marked(self.sets, bitmaps.occurring(pairs.select(F.xxhash64(x).alias("mixed")), "mixed")) for x in "ab"]
        sets = [s.select(F.col("node").alias(x), F.col("items").alias(f"items_{x}")) for x, s in zip("ab", sets)]
        both = pairs.join(sets[0], "a").join(sets[1], "b")
        both = both.select("ca", "cb", F.size("items_a").alias("na"), F.size("items_b").alias("nb"), F.size(F.array_intersect("items_a", "items_b")).alias("common"))
        return both.where(F.col("common") * (self.den + self.num) >= (F.col("na") + F.col("nb")) * self.num).select(F.col("ca").alias("a"), F.col("cb").alias("b"))

    def _close(self, size: str, size2: str, parity: str, parity2: str) -> Column:
        """Whether the parities leave a link possible: every hash range in which
        they differ holds a shingle that one of the sets lacks."""
        total = F.col(size) + F.col(size2)
        needed = F.ceil(total * self.num / F.lit(float(self.num + self.den)) - F.lit(1e-9))
        return differing_ranges(parity, parity2) <= total - 2 * needed

    def _link(self) -> DataFrame:
        """(node, comp) of the nodes with candidates."""
        most = most_differing(self.num, self.den)
        lows = [f"low{i}" for i in range(LONGS)]
        left = self.members.withColumn("comp", F.col("node"))
        labels = self.members.select("node").distinct().withColumn("comp", F.col("node"))
        done, more = 0, 1
        while True:
            carried = [*lows, "parity"] if done else lows
            # bands whose nodes are in two components or more and have not all led
            open_ = left.groupBy("band").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.max("rank").alias("_last"))
            open_ = open_.where((F.col("_lo") < F.col("_hi")) & (F.col("_last") > done)).select("band")
            left = left.join(open_, "band", "left_semi")
            if done == 1:  # from now on many lead
                left = left.join(self.sets.select("node", "parity"), "node")
            left = written(left, "open-members")
            if not left.limit(1).count():
                return labels
            leads = left.where((F.col("rank") >= done) & (F.col("rank") < done + more))
            leads = leads.select("band", F.col("node").alias("b"), F.col("size").alias("_size"), F.col("rank").alias("_rank"), F.col("comp").alias("cb"), *(F.col(c).alias(f"_{c}") for c in carried))
            near = (
                (F.col("rank") > F.col("_rank")) & (F.col("ca") != F.col("cb")) & (F.least("size", "_size") * self.den >= F.greatest("size", "_size") * self.num)
                & (differing("low", "_low") <= most))
            if done:
                near = near & self._close("size", "_size", "parity", "_parity")
            members = left.select("band", F.col("node").alias("a"), "size", "rank", F.col("comp").alias("ca"), *carried)
            pairs = members.join(leads, (members["band"] == leads["band"]) & near).select("a", "b", "ca", "cb").distinct()
            edges = written(self._similar(written(pairs, "pairs")).where("a <> b").distinct(), "links")
            done, more = done + more, more * GROWTH
            if not edges.limit(1).count():
                continue
            merged = components(edges)
            rename = merged.select(F.col("node").alias("comp"), F.col("comp").alias("_to"))
            labels = written(labels.join(rename, "comp", "left").select("node", F.coalesce("_to", "comp").alias("comp")), "labels")
            left = left.join(rename, "comp", "left").withColumn("comp", F.coalesce("_to", "comp")).drop("_to")

    def result(self) -> DataFrame:
        """(doc_id, n_shingles, component_id, kept) for each row."""
        last = F.lit((1 << 63) - 1)
        firsts = self.signed.where("size > 0").groupBy("node").agg(F.min(F.coalesce("doc", last)).alias("first"))
        # every node keeps its row here; a label is joined to those alone that have candidates
        nodes = firsts.join(self.labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        nodes = written(nodes, "nodes")
        classes = nodes.groupBy("comp").agg(F.min("first").alias("component"))
        nodes = written(nodes.join(classes, "comp").select("node", "component"), "node-classes")
        rows = self.signed.select("doc", "size", "node").join(nodes, "node", "left")
        component = F.when(F.col("size") > 0, F.when(F.col("component") != last, F.col("component"))).otherwise(F.col("doc"))
        return rows.select(
            F.col("doc").alias("doc_id"), F.col("size").cast("long").alias("n_shingles"), component.alias("component_id"), F.col("doc").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``."""
    return NearDedup(docs.select("doc_id", "text"), n, num, den).result()
