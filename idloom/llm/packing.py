"""Packing documents into sequences by cutting-stock column generation.

1. Every document is tokenised and given its end id; it is cut into pieces of
   the full capacity and a remainder.
2. Remainders are counted by length class (``grain`` tokens wide): the
   histogram has capacity / grain rows whatever the input.
3. On the driver, over that histogram: a linear program minimises the number of
   sequences over patterns (how many pieces of each class share a sequence).
   Its columns are generated: the current duals price the classes, and an
   unbounded knapsack by dynamic programming finds the best new pattern, until
   the gap to the dual bound is below ``gap``. Patterns are used the rounded
   down number of times; what is left, at most about a pattern for each class,
   is packed largest first.
4. On Spark: pieces are ranked within their class, ranks follow the patterns'
   ranges to a sequence, and offsets are running sums within a sequence.

Defined results: a null or empty text is a document of its end id alone; rows
without an id, with one id, or equal rows are separate documents; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import sys
import types
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .ranks import rank_in_groups
from .storage import written

#: What chunks are cut at.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True
#: The pattern of words of the public tokenizers. Its matches never hold two of
#: these kinds of ASCII characters: letters, digits, and marks other than ' < | >
#: (of "'s" and of special tokens), so a text may be cut between two kinds.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_KIND = np.array([0 if b > 126 or b < 33 or chr(b) in "'<|>" else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3 for b in range(256)], np.uint8)
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _learned_anew(new: list[str] | set[str], known: dict[str, bytes], past: dict[str, bytes]) -> list[str]:
    """What of ``new`` is not in ``past`` either; the others go to ``known``."""
    fresh = []
    for c in new:
        ids = past.get(c)
        if ids is None:
            fresh.append(c)
        else:
            known[c] = ids
    return fresh


class ChunkEncoder:
    """Token ids, as little-endian 32-bit bytes, of whole texts.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its chunks between spaces. Arrow finds the distinct chunks of a
    batch of texts and puts their ids in the order of the texts. Chunks of Latin
    letters, digits and marks are split further, by the tokenizer's own pattern,
    into words, which repeat more often; other chunks go to the tokenizer whole.
    The ids of about ``keep`` chunks and words are remembered, and of those before
    them as many again: what comes up once more is taken over, not learned anew.
    """

    @classmethod
    def of_worker(cls, definition: str) -> ChunkEncoder:
        """The encoder that this worker process already has, or a new one: what
        one task learns serves the next."""
        store = vars(sys.modules.setdefault("_idloom_worker", types.ModuleType("_idloom_worker")))
        if store.get("definition") != definition:
            store.update(definition=definition, encoder=cls(definition))
        return store["encoder"]

    def __init__(self, definition: str, keep: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_str(definition), keep
        self.chunks: dict[str, bytes] = {}  # a word is the chunk of itself alone
        self.past_chunks: dict[str, bytes] = {}
        parts = json.loads(definition)
        self.suffix = parts["model"].get("end_of_word_suffix")
        split = [p["pattern"]["Regex"] for p in (parts.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        lowers = any(n["type"] == "Lowercase" for n in (parts.get("normalizer") or {}).get("normalizers", []))
        self.by_word = bool(self.suffix and lowers and len(split) == 1)
        self.known_words = self.by_word and split[0] == WORDS
        if self.by_word:
            self.find = regex.compile(split[0]).findall
            self.plain = regex.compile(r"[!-~\u00a1-\u024f]+").fullmatch
            ends = [i for token, i in self.tokenizer.get_vocab(False).items() if token.endswith(self.suffix)]
            self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
            self.ends[ends] = True

    def _whole(self, chunks: list[str]) -> None:
        for chunk, e in zip(chunks, self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)):
            self.chunks[chunk] = np.asarray(e.ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        if not self.by_word:
            return self._whole(new)
        words, several, other = [], {}, []  # ``several``: chunks that are not one word in lower case
        for c in new:
            if c.isascii() and c.isalpha():
                if c.islower():
                    words.append(c)
                else:
                    several[c] = (c.lower(),)
            elif not self.plain(c) or "<|" in c:
                other.append(c)
            elif c.isalpha():
                several[c] = (c.lower(),)
            else:
                several[c] = self.find(c.lower())
        parts = set().union(*several.values()).difference(self.chunks, words)
        words += _learned_anew(parts, self.chunks, self.past_chunks)
        for i in range(0, len(words), 2000):
            part = words[i : i + 2000]
            ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1  # a word's last token carries the suffix
            if len(cuts) != len(part):
                self._whole(part)
                continue
            raw, at = ids.tobytes(), [0, *(cuts * 4).tolist()]
            self.chunks.update((w, raw[a:b]) for w, a, b in zip(part, at, at[1:]))
        known = self.chunks.__getitem__
        for c, found in several.items():
            self.chunks[c] = known(found[0]) if len(found) == 1 else b"".join(map(known, found))
        self._whole(other)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        data, ends = W.text_buffers(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        chunks, first = _chunks(data, ends, self.known_words and b"<|" not in data.tobytes())
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
        known = list(map(self.chunks.get, distinct))
        new = [i for i, ids in enumerate(known) if ids is None]
        if new and len(self.chunks) + len(new) > self.keep:
            self.past_chunks, self.chunks, new = self.chunks, {}, range(len(distinct))
        if new:
            self._learn(_learned_anew([distinct[i] for i in new], self.chunks, self.past_chunks))
            for i in new:
                known[i] = self.chunks[distinct[i]]
        ids = pa.array(known, pa.large_binary())
        size = np.diff(np.frombuffer(ids.buffers()[1], np.int64)[: len(known) + 1]) if known else np.zeros(0, np.int64)
        at = np.concatenate(([0], np.cumsum(size[coded.indices.to_numpy()])))[first].tolist()
        raw = memoryview(ids.take(coded.indices).buffers()[2] or b"")
        return [raw[a:b].tobytes() for a, b in zip(at, at[1:])]


def _chunks(data: np.ndarray, ends: np.ndarray, by_kind: bool) -> tuple[pa.Array, np.ndarray]:
    """The runs of other bytes between spaces, tabs and line ends in texts that
    end at ``ends``, and where each text's runs begin. ``by_kind``: runs also end
    where ``WORDS`` starts a new word, and A-Z are lower-cased unless a byte
    that is not ASCII, perhaps of an accent, follows."""
    inside = ~_SPACE[data]
    kept, spaces = data[inside], np.flatnonzero(~inside)
    ends = ends - np.searchsorted(spaces, ends)
    cut = np.zeros(len(kept) + 1, bool)
    cut[spaces - np.arange(len(spaces))] = True
    if by_kind and len(kept):
        kind = _KIND[kept]
        cut[1:-1] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        lower = W.LOWER[kept]
        accented = np.flatnonzero(np.append(data[1:] > 127, False)[inside])
        lower[accented] = kept[accented]
        kept = lower
    cut[ends] = True
    cuts = np.flatnonzero(cut)
    chunks = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(kept))
    return chunks, np.searchsorted(cuts, ends)


def public_definition(name: str = "word_bpe_49k.json") -> str:
    """The JSON of an installed public tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def cut(docs: DataFrame, definition: str, capacity: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """The pieces of each row of ``docs(doc_id, text)``: doc_id, start, length,
    ids_crc32, doc_tokens, and the ids as bytes if ``with_ids``."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.of_worker(shared.value)
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 20):
                rows: list[tuple] = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text"))):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        piece = ids[4 * start : 4 * (start + capacity)]
                        rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), total, piece if with_ids else None))
                cols = list(zip(*rows))
                arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(cols[5], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, _PIECES + (", ids binary" if with_ids else ""))


def _knapsack(value: np.ndarray, size: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the best value for each room
    up to ``room``, and the class taken last there (-1: a place stays free)."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    dense = np.full(room + 1, -np.inf)  # value by size; sizes are distinct
    dense[size] = value
    index = np.full(room + 1, -1)
    index[size] = np.arange(len(size))
    if dense[1] < 0:  # a free place
        dense[1], index[1] = 0.0, -1
    for c in range(1, room + 1):
        gain = dense[1 : c + 1] + best[c - 1 :: -1] if c > 1 else dense[1:2] + best[:1]
        k = int(gain.argmax())
        best[c], last[c] = gain[k], index[k + 1]
    return best, last


def _taken(last: np.ndarray, size: np.ndarray, c: int) -> np.ndarray:
    """How often the best choice for room c takes each class."""
    taken = np.zeros(len(size), np.int64)
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            taken[last[c]] += 1
            c -= size[last[c]]
    return taken


def _relaxed(size: np.ndarray, demand: np.ndarray, room: int, gap: float, steps: int, most: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Column generation for: fewest sequences that hold ``demand`` pieces of
    each ``size``. Patterns of the final basis (rows) and how often each is
    used (not whole numbers). Revised simplex with an explicit inverse; one
    knapsack gives up to ``most`` new patterns, each the best one with some
    class in it, and the patterns found so far are priced before the next one."""
    m = len(size)
    basis = np.diag(room // size)  # pattern k: as many pieces of class k as fit
    inverse = np.diag(1.0 / (room // size))
    used = demand * inverse.diagonal()
    pool = np.zeros((0, m))
    times = partial(np.einsum, "ij,j->i")  # small matrices: no threads of a linear algebra library
    bound = 0.0
    for step in range(steps):
        price = inverse.sum(axis=0)  # every pattern costs one sequence
        worth = times(pool, price)
        if not len(worth) or worth.max() <= 1 + 1e-6:
            best, last = _knapsack(price, size, room)
            bound = max(bound, float((price * demand).sum()) / max(best[room], 1.0))
            if best[room] <= 1 + 1e-6 or used.sum() <= bound * (1 + gap):
                break
            with_class = price + best[room - size]
            forced = np.argsort(-with_class, kind="stable")[:most]
            new = [_taken(last, size, room - int(size[k])) + (np.arange(m) == k) for k in forced if with_class[k] > 1 + 1e-6]
            pool = np.vstack([pool[-1000:], *new]).astype(float)
            worth = times(pool, price)
        pattern = pool[int(worth.argmax())]
        change = times(inverse, pattern)
        ratio = np.full(m, np.inf)
        up = change > 1e-9
        ratio[up] = np.maximum(used[up], 0) / change[up]
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        by = ratio[out]
        used = used - by * change
        used[out] = by
        basis[out] = pattern
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
        if step % 200 == 199:
            error = 2 * np.eye(m) - np.einsum("ij,jk->ik", basis.T.astype(float), inverse)
            inverse = np.einsum("ij,jk->ik", inverse, error)  # one Newton step takes the rounding errors out
            used = times(inverse, demand)
    return basis, np.maximum(used, 0)


def plan(histogram: dict[int, int], room: int, gap: float = 0.001, steps: int = 6000) -> list[tuple[int, int, int, int, int]]:
    """Where the ranked pieces of each class go: rows (class, first rank, rank
    after the last, pieces of the class in each sequence, first sequence)."""
    left = {c: n for c, n in histogram.items() if n > 0}
    taken = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def use(pattern: dict[int, int], times: int) -> None:
        nonlocal sequence
        for c, each in pattern.items():
            rows.append((c, taken[c], taken[c] + times * each, each, sequence))
            taken[c] += times * each
            left[c] -= times * each
        sequence += times

    if room in left:  # full already
        use({room: 1}, left[room])
    size = np.array(sorted(c for c, n in left.items() if n > 0), np.int64)
    if len(size):
        demand = np.array([left[int(c)] for c in size], float)
        for pattern, times in zip(*_relaxed(size, demand, room, gap, steps)):
            each = {int(c): int(n) for c, n in zip(size, pattern) if n}
            if each and (whole := min(int(times + 1e-6), *(left[c] // n for c, n in each.items()))):
                use(each, whole)
    while remaining := sorted((c for c, n in left.items() if n > 0), reverse=True):
        free, each = room, {}
        for c in remaining:
            if n := min(left[c], free // c):
                each[c] = n
                free -= n * c
        use(each, min(left[c] // n for c, n in each.items()))
    return rows


def pack(docs: DataFrame, definition: str, capacity: int = 2048, end_id: int = 1, grain: int = 8,
         buckets: int = 64, with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs(doc_id, text)`` with sequence_id and offset.
    ``definition``: the JSON of a tokenizer; ``buckets``: parts in which a class
    is ranked. The plan that is joined has a few rows for each class and pattern,
    so its size is bounded by capacity / grain."""
    spark = docs.sparkSession
    if capacity % grain:
        raise ValueError("capacity must be a multiple of grain")
    cut_up = cut(docs, definition, capacity, end_id, with_ids)
    pieces = written(cut_up.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    pieces = pieces.withColumn("_class", F.ceil(F.col("length") / grain).cast("int"))
    histogram = {r["_class"]: r["count"] for r in pieces.groupBy("_class").count().collect()}  # capacity / grain rows at most
    rows = plan(histogram, capacity // grain)
    schema = T.StructType([T.StructField("_class", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("_lo", "_hi", "_each", "_seq"))])
    ranges = spark.createDataFrame(rows, schema)
    bucket = F.pmod(F.xxhash64("_piece"), F.lit(buckets))
    light = rank_in_groups(pieces.drop("ids"), ["_class"], bucket, [F.col("_piece")], "_rank_all")
    inside = (F.col("_rank_all") >= F.col("_lo")) & (F.col("_rank_all") < F.col("_hi"))
    placed = light.join(F.broadcast(ranges), "_class").where(inside)
    nth = F.col("_rank_all") - F.col("_lo")
    placed = placed.withColumn("sequence_id", F.col("_seq") + F.floor(nth / F.col("_each")).cast("long"))
    order = Window.partitionBy("sequence_id").orderBy(F.col("_class").desc(), F.col("_rank_all"))
    ahead = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("offset", ahead.cast("long"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        placed = placed.join(pieces.select("_piece", "ids"), "_piece")
        columns.append("ids")
    return placed.select(*columns)
