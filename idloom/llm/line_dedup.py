"""Line dedup over an index that documents can enter and leave.

State, in tables written to the shared folder:

* references: one signed row (key, document, n) for each line of a document
  that entered (+) or left (-). Sums over them are the exact reference counts.
* cuckoo filters: one for each shard of the key space, 16-bit fingerprints of
  the keys with a count above 0 in buckets of four. The number of shards follows
  the number of keys; when the keys outgrow the filters, these are built anew.
  Fingerprints can be taken out again, so that a document can leave.
* hits: documents enter in parts, by a hash of the document. The keys of a part
  first look into the filters, which hold all that entered before, and then
  enter them. A key that misses is new; a key that hits, or that comes in two
  documents of its part, may repeat. Only these keys are counted exactly.

A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends, A-Z
lower-cased, as 128 hashed bits; lines whose key is shorter than ``min_chars``
code points have none. A key in two or more documents keeps its lines only in
the smallest doc_id that holds it.

Defined results: a null or empty text is one empty line; a row without a
doc_id ranks after all others, and such rows count as one document; rows with one doc_id are one document, so that a
line they share stays in each; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .storage import written

NO_ID = (1 << 63) - 1
SLOTS = 4


def document_key():
    """doc_id, or the last of all ids where there is none."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")


def line_keys(data: np.ndarray, offsets: np.ndarray, min_chars: int) -> tuple[np.ndarray, ...]:
    """(text, line number, key, key) of every line that has a key."""
    breaks = np.flatnonzero(data == 10)
    edges = offsets[1:-1]
    lines = np.unique(np.concatenate((np.zeros(1, np.int64), breaks + 1, edges)))  # where lines of some length may start
    solid = np.flatnonzero(~W.WHITE[data])
    stops = np.append(lines[1:], len(data))
    first = np.searchsorted(solid, lines)
    last = np.searchsorted(solid, stops) - 1
    some = last >= first
    starts, ends = solid[first[some]], solid[last[some]] + 1
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    long = heads[ends] - heads[starts] >= min_chars
    starts, ends = starts[long], ends[long]
    text = np.searchsorted(offsets, starts, side="right") - 1
    number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[text])
    return text, number, W.hash_spans(data, starts, ends, W.LOWER), W.hash_spans(data, starts, ends, W.LOWER, second=True)


class CuckooFilter:
    """Fingerprints of 64-bit keys in buckets of four; whatever finds no room
    after ``KICKS`` moves is kept beside them, so that no key is ever lost."""

    KICKS = 200

    def __init__(self, cells: np.ndarray, spare: np.ndarray):
        self.cells, self.spare = cells, spare

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(n, 1) / SLOTS / 0.6))))
        return cls(np.zeros((buckets, SLOTS), np.uint16), np.zeros(0, np.uint64))

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        n = int.from_bytes(blob[:8], "little")
        return cls(np.frombuffer(blob, np.uint16, n, 8).reshape(-1, SLOTS).copy(), np.frombuffer(blob, np.uint64, offset=8 + 2 * n).copy())

    def dump(self) -> bytes:
        return self.cells.size.to_bytes(8, "little") + self.cells.tobytes() + self.spare.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        print_ = ((keys & np.uint64(0xFFFF)).astype(np.uint16)).copy()
        print_[print_ == 0] = 1
        return print_, ((keys >> np.uint64(16)) & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def _other(self, print_: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (W.mix(print_.astype(np.uint64)) & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        p, a = self._places(keys)
        hit = (self.cells[a] == p[:, None]).any(1) | (self.cells[self._other(p, a)] == p[:, None]).any(1)
        return hit | np.isin(keys, self.spare)

    def _put(self, p: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Puts what finds a free cell in its bucket; returns which did."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        nth = np.arange(len(b)) - np.searchsorted(b, b)
        free = self.cells[b] == 0
        slot = np.argmax(np.cumsum(free, 1) == (nth + 1)[:, None], 1)
        ok = nth < free.sum(1)
        self.cells[b[ok], slot[ok]] = p[order][ok]
        done = np.zeros(len(b), bool)
        done[order[ok]] = True
        return done

    def add(self, keys: np.ndarray) -> None:
        """Adds distinct keys that are not in it."""
        p, a = self._places(keys)
        for _ in range(2):  # either bucket; what finds no room there moves others on
            left = ~self._put(p, a)
            p, a, keys = p[left], a[left], keys[left]
            a = self._other(p, a)
        self._kick(p, a, keys)

    def _kick(self, p: np.ndarray, a: np.ndarray, whole: np.ndarray) -> None:
        turn = np.random.default_rng(len(p))
        for key, print_, bucket in zip(whole, p, a):
            trail = []
            for _ in range(self.KICKS):
                if (free := np.flatnonzero(self.cells[bucket] == 0)).size:
                    self.cells[bucket, free[0]] = print_
                    break
                slot = int(turn.integers(SLOTS))
                trail.append((bucket, slot))
                print_, self.cells[bucket, slot] = self.cells[bucket, slot], print_
                bucket = int(self._other(np.array([print_], np.uint16), np.array([bucket]))[0])
            else:  # undo, and keep the key itself
                for bucket, slot in reversed(trail):
                    print_, self.cells[bucket, slot] = self.cells[bucket, slot], print_
                self.spare = np.append(self.spare, key)

    def remove(self, keys: np.ndarray) -> None:
        """Takes out distinct keys that are in it."""
        kept = np.isin(self.spare, keys)
        away = keys[~np.isin(keys, self.spare)]
        self.spare = self.spare[~kept]
        p, a = self._places(away)
        for print_, one, two in zip(p, a, self._other(p, a)):
            for bucket in (one, two):
                if (at := np.flatnonzero(self.cells[bucket] == print_)).size:
                    self.cells[bucket, at[0]] = 0
                    break


class LineIndex:
    """The lines of a corpus, with insertion and deletion of documents."""

    KEY = ["k1", "k2"]

    PARTS = 8
    SHARD_KEYS = 1 << 18

    def __init__(self, spark, min_chars: int = 10, shards: int = 16):
        """``shards`` is the least number of filters."""
        self.spark, self.min_chars, self.least_shards, self.shards = spark, min_chars, shards, shards
        self.log: list[DataFrame] = []
        self.entered: list[DataFrame] = []
        self.hits: list[DataFrame] = []
        self.filters: DataFrame | None = None
        self.held = self.room = 0
        self.signed = False

    def _lines(self, rows: DataFrame) -> DataFrame:
        """(k1, k2, line) of every line that has a key, with the other columns
        of ``rows``; all of these are long."""
        least, own = self.min_chars, [c for c in rows.columns if c != "text"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in W.slices(batch, "text"):
                    text, line, k1, k2 = line_keys(*W.text_buffers(part.column("text")), least)
                    arrays = [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(line)]
                    arrays += [pa.array(part.column(c).to_numpy(zero_copy_only=False)[text]) for c in own]
                    yield pa.RecordBatch.from_arrays(arrays, ["k1", "k2", "line", *own])

        return rows.mapInArrow(run, ", ".join(f"{c} long" for c in ("k1", "k2", "line", *own)))

    def _references(self, docs: DataFrame, n: int) -> DataFrame:
        lines = self._lines(docs.select(document_key(), "text"))
        return written(lines.drop("line").withColumn("n", F.lit(n).cast("long")), "line-references")

    def references(self) -> DataFrame:
        """(k1, k2, doc, n): the lines with each key in each document, n > 0."""
        rows = reduce(DataFrame.unionByName, self.log)
        if self.signed:
            rows = rows.groupBy(*self.KEY, "doc").agg(F.sum("n").alias("n")).where("n > 0")
        return rows

    def counts(self) -> DataFrame:
        """(k1, k2, n, doc, last): lines with each key, and the smallest and
        the largest document that hold it."""
        return self.references().groupBy(*self.KEY).agg(F.sum("n").alias("n"), F.min("doc").alias("doc"), F.max("doc").alias("last"))

    def _by_shard(self, keys: DataFrame, work, out: str) -> DataFrame:
        """``work(keys, blob or None, shard)`` over the rows of ``keys`` of each
        shard."""
        shard = F.pmod(F.col("k2"), F.lit(self.shards)).cast("int").alias("shard")
        old = self.filters if self.filters is not None else self.spark.createDataFrame([], "shard int, blob binary")

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return work(left, right["blob"].iloc[0] if len(right) else None, (left if len(left) else right)["shard"].iloc[0])

        return keys.select(shard, *keys.columns).groupBy("shard").cogroup(old.groupBy("shard")).applyInPandas(run, out)

    def _seen(self, keys: DataFrame) -> DataFrame:
        """Distinct ``keys`` (k1, k2) with a count above 0: the filters name
        those that may be, the exact counts decide."""
        if self.filters is None:
            return keys.limit(0)

        def probe(left: pd.DataFrame, blob: bytes | None, _) -> pd.DataFrame:
            if blob is None:
                return left[["k1", "k2"]].iloc[:0]
            return left[["k1", "k2"]][CuckooFilter.load(blob).has(left["k1"].to_numpy().view(np.uint64))]

        return self._by_shard(keys, probe, "k1 long, k2 long").join(self.counts().select(*self.KEY), self.KEY, "left_semi")

    def _enter(self, keys: DataFrame) -> None:
        """``keys`` (k1, k2, part, twice, old), one row for each key of a part,
        look into the filters and enter them part by part, but for ``old`` ones,
        which are in them. A key that hits by chance enters as any other, so
        that it can leave again."""

        def work(left: pd.DataFrame, blob: bytes | None, shard: int) -> pd.DataFrame:
            left = left.sort_values("part", kind="stable")
            k, part, hit = left["k1"].to_numpy().view(np.uint64), left["part"].to_numpy(), left["twice"].to_numpy(copy=True)
            fresh = ~(left["old"].to_numpy() | left.duplicated(["k1", "k2"]).to_numpy())
            f = CuckooFilter.load(blob) if blob is not None else CuckooFilter.for_keys(2 * int(fresh.sum()))
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, b in zip(cuts, cuts[1:]):
                hit[a:b] |= f.has(k[a:b])
                f.add(k[a:b][fresh[a:b]])
            found = left.loc[hit, ["k1", "k2"]]
            return pd.concat([pd.DataFrame({"shard": [shard], "blob": [f.dump()], "k1": [0], "k2": [0]}), found.assign(shard=shard, blob=None)])

        done = written(self._by_shard(keys, work, "shard int, blob binary, k1 long, k2 long"), "line-filters")
        self.filters = done.where("blob is not null").select("shard", "blob")
        self.hits.append(done.where("blob is null").select(*self.KEY))

    def insert(self, docs: DataFrame) -> None:
        """The documents enter: references are appended, their keys are looked
        up, and keys that are new to the index enter the filters."""
        new = self._references(docs, 1)
        part = F.pmod(F.xxhash64("doc"), F.lit(self.PARTS)).cast("int").alias("part")
        entered = written(new.groupBy(*self.KEY, part).agg(F.min("doc").alias("doc"), F.max("doc").alias("last")), "line-keys")
        keys = entered.select(*self.KEY, "part", (F.col("doc") < F.col("last")).alias("twice"))
        self.held += entered.count()
        if self.filters is not None and self.held <= self.room:
            seen = self._seen(keys.select(*self.KEY).distinct()).withColumn("old", F.lit(True))
            keys = keys.join(seen, self.KEY, "left").fillna(False, ["old"])
        else:  # filters for twice the keys; those of before enter ahead of the new ones
            if self.log:
                keys = keys.unionByName(self.counts().select(*self.KEY, F.lit(-1).alias("part"), F.lit(False).alias("twice")))
            keys = keys.withColumn("old", F.lit(False))
            self.filters, self.room = None, 2 * self.held
            self.shards = max(self.least_shards, -(-self.held // self.SHARD_KEYS))
        self._enter(keys)
        self.log.append(new)
        self.entered.append(entered)

    def delete(self, docs: DataFrame) -> None:
        """The documents, as they entered, leave: their references are taken
        back, and keys without references leave the filters."""
        gone = self._references(docs, -1)
        before = self._seen(gone.select(*self.KEY).distinct())
        before = written(before, "line-keys")
        self.log.append(gone)
        self.signed = True

        def work(left: pd.DataFrame, blob: bytes, shard: int) -> pd.DataFrame:
            f = CuckooFilter.load(blob)
            f.remove(left["k1"].to_numpy().view(np.uint64))
            return pd.DataFrame({"shard": [shard], "blob": [f.dump()]})

        away = before.join(self.counts().select(*self.KEY), self.KEY, "left_anti")
        self.filters = written(self._by_shard(away, work, "shard int, blob binary"), "line-filters")

    def repeated(self) -> DataFrame:
        """(k1, k2, keeper): the keys that two or more documents hold, counted
        exactly among those that hit."""
        if not self.log:
            raise ValueError("no documents entered")
        if self.signed:
            rows = self.counts().select(*self.KEY, "doc", "last")
        else:  # a key has one row for each part, however many lines have it
            rows = reduce(DataFrame.unionByName, self.entered).select(*self.KEY, "doc", "last")
        rows = rows.join(reduce(DataFrame.unionByName, self.hits), self.KEY, "left_semi")
        ends = rows.groupBy(*self.KEY).agg(F.min("doc").alias("keeper"), F.max("last").alias("last"))
        return ends.where("keeper < last").drop("last")

    def dedup(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``text`` as it is without repeated lines, and
        ``n_lines``, ``n_dropped`` (in place of columns of those names)."""
        # written, so that the join below has shuffles of its own, which Spark can split at a key that many lines have
        repeated = written(self.repeated(), "repeated-lines")
        # a row is known by its id and text, so that rows without an id do not share one group
        docs = docs.select(*[c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")])
        docs = docs.withColumn("_row", F.xxhash64(document_key(), F.coalesce("text", F.lit(""))))
        lines = self._lines(docs.select(document_key(), "_row", "text"))
        drops = lines.join(repeated, self.KEY).where("doc > keeper").groupBy("_row").agg(F.collect_set("line").alias("_drop"))
        return self._cut(docs.join(drops, "_row", "left").drop("_row"))

    @staticmethod
    def _cut(docs: DataFrame) -> DataFrame:
        breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
        docs = docs.withColumn("_lines", F.when(F.col("_drop").isNotNull(), F.split("text", "\n", -1)))
        numbers = F.array_except(F.sequence(F.lit(0).cast("long"), F.size("_lines").cast("long") - 1), "_drop")
        kept = F.array_join(F.transform(numbers, lambda i: F.get("_lines", i.cast("int"))), "\n")
        text = F.when(F.col("_drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept)
        return docs.select(
            *[text.alias(c) if c == "text" else F.col(c) for c in docs.columns if c not in ("_drop", "_lines")],
            (F.coalesce(breaks, F.lit(0)) + 1).cast("long").alias("n_lines"),
            F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = 10, shards: int = 16) -> DataFrame:
    """All documents enter an empty index and are returned without the lines
    that repeat."""
    index = LineIndex(docs.sparkSession, min_chars, shards)
    index.insert(docs)
    return index.dedup(docs)
