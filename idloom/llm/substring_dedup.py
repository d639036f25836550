"""Removal of repeated passages by fixed-block anchors.

A passage is a window of ``window`` consecutive words of one document; words
covered by a window whose words also start earlier (in a smaller doc_id, or
earlier in the document) go. Windows are judged on the input.

1. Index and probes. Every document is cut into non-overlapping blocks of
   window / 2 words; their hashes are the index. Every rolling run of as many
   words is a probe. A window holds a whole block wherever it starts, so a
   repeated window contains, at each of its places, a run that is a block of
   another place: a hit.
2. Extension. Windows around hits are candidates; their hashes decide which
   place is the first, and the others, merged, are the maximal repeats.

Documents are dealt into chunks by a hash of the row and of the partition it
was read in, so that equal rows do not all meet in one. A chunk sends each distinct probe
once, as 32 bits beside its bucket (chance hits only add candidates), to the
bucket of its hash, and gets one bit back for each; likewise the distinct
candidate windows, as 128 bits with the first document that has them. So a
passage that very many documents share is one entry for each chunk, no task
holds more than a bucket or a chunk, and both grow in number with the input,
not in size. The texts are shuffled once; the three passes over them reuse it.

Defined results: null and empty texts have no words; a row without a doc_id
ranks after all others; rows with one doc_id follow each other by chunk, then by
a hash of their text, so that all but one of equal rows lose every window; documents shorter than a window lose nothing; extra
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .line_dedup import document_key

ASKED = "chunk int, bucket int, kind int, hashes binary, flags binary, docs binary"
TOLD = "chunk int, bucket int, kind int, bits binary"


class Chunk:
    """The documents of a chunk in order, their words, and its questions."""

    def __init__(self, table: pa.Table, window: int, bits: int):
        self.table = table.sort_by([("doc", "ascending"), ("row", "ascending")])
        self.window, self.half, self.bits = window, window // 2, bits
        self.doc = self.table.column("doc").to_numpy()
        text = self.table.column("text").combine_chunks()
        parts = []
        for part in W.slices(pa.RecordBatch.from_arrays([text], ["text"]), "text"):
            w = W.split(*W.text_buffers(part.column("text")))
            parts.append((w.hashes, w.counts))
        self.counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        hashes = np.concatenate([h for h, _ in parts]) if parts else np.zeros(0, np.uint64)
        none = np.zeros(0, np.uint8)
        self.words = W.Words(none, none, none, self.first, hashes)
        self.place = np.arange(len(hashes)) - np.repeat(self.first[:-1], self.counts)

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The places of all rolling runs, their distinct short hashes (bucket
        above 32 bits), and which hash each place has."""
        h, valid = W.ngrams(self.words, self.half)
        at = np.flatnonzero(valid)
        short, inverse = np.unique(h[at] >> np.uint64(32 - self.bits), return_inverse=True)
        return at, short, inverse, np.bincount(inverse, minlength=len(short))

    def candidates(self, told: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The places of candidate windows, their distinct hashes, which hash
        each place has, and the first place of each hash."""
        at, short, inverse, _ = self.probes()
        hit = np.zeros(len(self.words.hashes) + 1, np.int64)
        hit[at] = _answers(short >> np.uint64(32), told)[inverse]
        total = np.concatenate(([0], np.cumsum(hit)))
        h, valid = W.ngrams(self.words, self.window, salt=1)
        starts = np.flatnonzero(valid)
        starts = starts[total[starts + self.window - self.half + 1] > total[starts]]
        both = np.stack((h[starts], W.ngrams(self.words, self.window, salt=2)[0][starts]), 1)
        order = np.lexsort((both[:, 1], both[:, 0]))  # stable: equal windows stay in the order of their starts
        hashes = both[order]
        new = np.ones(len(order), bool)
        new[1:] = (hashes[1:] != hashes[:-1]).any(1)
        inverse = np.zeros(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        return starts, hashes[new], inverse, order[new]

    def removed(self, told: dict[int, bytes], told_windows: dict[int, bytes]) -> np.ndarray:
        starts, hashes, inverse, first = self.candidates(told)
        later = _answers(hashes[:, 0] >> np.uint64(64 - self.bits), told_windows)[inverse] | (np.arange(len(starts)) != first[inverse])
        cover = np.zeros(len(self.words.hashes) + 1, np.int64)
        np.add.at(cover, starts[later], 1)
        np.add.at(cover, starts[later] + self.window, -1)
        return np.cumsum(cover[:-1]) > 0


def _spans(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the runs of a sorted array."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    ends = [0, *cuts.tolist(), len(bucket)]
    return [(int(bucket[a]), a, b) for a, b in zip(ends, ends[1:]) if b > a]


def _answers(bucket: np.ndarray, told: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(len(bucket), bool)
    for b, first, last in _spans(bucket):
        out[first:last] = np.unpackbits(np.frombuffer(told[b], np.uint8), count=last - first)
    return out


def _asked(chunk: int, kind: int, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [[], [], [], []]
    n = len(rows)
    return pa.table({
        "chunk": pa.array([chunk] * n, pa.int32()), "bucket": pa.array(cols[0], pa.int32()), "kind": pa.array([kind] * n, pa.int32()),
        "hashes": pa.array(cols[1], pa.binary()), "flags": pa.array(cols[2], pa.binary()), "docs": pa.array(cols[3], pa.binary())})


def _told(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {r["bucket"]: r["bits"] for r in table.select(["bucket", "kind", "bits"]).to_pylist() if r["kind"] == kind}


def _hits(table: pa.Table) -> pa.Table:
    """For each probe of a bucket: whether it is a block, and in two places."""
    rows = table.to_pylist()
    probes = [np.frombuffer(r["hashes"], np.uint32) for r in rows]
    flags = [np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=2 * len(p)).reshape(2, -1).astype(bool) for r, p in zip(rows, probes)]
    all_, counts = np.unique(np.concatenate(probes), return_counts=True)
    often, block = counts > 1, np.zeros(len(all_), bool)
    at = [np.searchsorted(all_, p) for p in probes]
    for a, (twice, aligned) in zip(at, flags):
        often[a[twice]] = True
        block[a[aligned]] = True
    hit = often & block
    return _answer_table(rows, [np.packbits(hit[a]).tobytes() for a in at])


def _later(table: pa.Table) -> pa.Table:
    """For each window of a bucket and chunk: whether its first place in the
    chunk is not the first of all."""
    rows = table.to_pylist()
    hashes = [np.frombuffer(r["hashes"], np.uint64).reshape(-1, 2) for r in rows]
    docs = np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows])
    chunk = np.repeat([r["chunk"] for r in rows], [len(h) for h in hashes])
    every = np.concatenate(hashes)
    order = np.lexsort((chunk, docs, every[:, 1], every[:, 0]))
    later = np.zeros(len(every), bool)
    later[order[1:]] = (every[order[1:]] == every[order[:-1]]).all(1)
    ends = np.cumsum([0, *(len(h) for h in hashes)])
    return _answer_table(rows, [np.packbits(later[a:b]).tobytes() for a, b in zip(ends, ends[1:])])


def _answer_table(rows: list[dict], bits: list[bytes]) -> pa.Table:
    columns = {c: pa.array([r[c] for r in rows], pa.int32()) for c in ("chunk", "bucket", "kind")}
    return pa.table({**columns, "bits": pa.array(bits, pa.binary())})


def remove_repeats(docs: DataFrame, window: int = 20, chunk_bytes: int = 12 << 20, bucket_words: int = 2_000_000) -> DataFrame:
    """doc_id, n_words, n_removed, text (the kept words with one space between)
    for each row of ``docs(doc_id, text)``."""
    if window % 2:
        raise ValueError("window must be even")
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(2 * parts, math.ceil(total / chunk_bytes))
    bits = max(8, math.ceil(math.log2(max(1, total / 6 / bucket_words))))
    row = F.xxhash64(document_key(), F.coalesce("text", F.lit("")))
    dealt = docs.select(document_key(), row.alias("row"), F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").isNull().alias("nameless"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("row", F.spark_partition_id()), F.lit(chunks)).cast("int"))
    by_chunk = dealt.groupBy("chunk")

    def ask_probes(key: tuple, table: pa.Table) -> pa.Table:
        c = Chunk(table, window, bits)
        at, short, inverse, counts = c.probes()
        aligned = np.zeros(len(short), bool)
        aligned[inverse[c.place[at] % c.half == 0]] = True
        rows = []
        for b, i, j in _spans(short >> np.uint64(32)):
            flags = np.packbits(np.stack((counts[i:j] > 1, aligned[i:j]))).tobytes()
            rows.append((b, (short[i:j] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(), flags, None))
        return _asked(key[0].as_py(), 0, rows)

    def ask_windows(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _asked(0, 1, [])
        c = Chunk(table, window, bits)
        starts, hashes, _, first = c.candidates(_told(told, 0))
        doc = c.doc[np.searchsorted(c.first, starts[first], side="right") - 1]
        rows = [(b, hashes[i:j].tobytes(), None, doc[i:j].astype(np.int64).tobytes()) for b, i, j in _spans(hashes[:, 0] >> np.uint64(64 - bits))]
        return _asked(key[0].as_py(), 1, rows)

    def cut(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        names = ["doc", "nameless", "n_words", "n_removed", "text"]
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string())], names)
        c = Chunk(table, window, bits)
        gone = c.removed(_told(told, 0), _told(told, 1))
        lost = np.concatenate(([0], np.cumsum(gone)))
        lost = lost[c.first[1:]] - lost[c.first[:-1]]
        texts = []
        for i, text in enumerate(c.table.column("text").to_pylist()):
            w = text.encode().split()  # at the same bytes
            if lost[i]:
                w = [x for x, g in zip(w, gone[c.first[i] : c.first[i + 1]]) if not g]
            texts.append(b" ".join(w).decode())
        return pa.table([c.table.column("doc"), c.table.column("nameless"), pa.array(c.counts.astype(np.int64)), pa.array(lost.astype(np.int64)), pa.array(texts, pa.string())], names)

    hits = by_chunk.applyInArrow(ask_probes, ASKED).groupBy("bucket").applyInArrow(_hits, TOLD)
    windows = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(ask_windows, ASKED)
    told = hits.unionByName(windows.groupBy("bucket").applyInArrow(_later, TOLD))
    out = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(cut, "doc long, nameless boolean, n_words long, n_removed long, text string")
    return out.select(F.when(~F.col("nameless"), F.col("doc")).alias("doc_id"), "n_words", "n_removed", "text")
