"""Spelling variants: words one edit apart, found through a reduced alphabet.

1. Words are runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, counted over
   whole texts; those of at least ``min_length`` code points that occur at
   least ``min_count`` times are the vocabulary.
2. Letters are hashed to a few symbols. A reduced word is its word in symbols,
   kept as a 64-bit polynomial hash. There are as many symbols as spread the
   vocabulary thinly over the shortest reduced words (``symbols_for``).
3. Of every reduced word the full neighbourhood of one edit is generated: itself
   (the edited letters may share a symbol), every deletion, replacement and
   insertion, each once. Words one edit apart have reduced words at most one
   edit apart, so the join of neighbourhoods with the reduced vocabulary loses
   no pair. A bitmap of the reduced vocabulary (bounded) keeps most neighbours
   that nobody has from being sent.
4. Every joined pair is verified on the original strings, within the join.
5. A word's form is its near word of largest count, if that is at least
   ``ratio`` times its own; roots follow forms by pointer doubling. Counts grow
   ``ratio`` times with every step, so paths are short and have no circles.

Defined results: null and empty texts have no words; repeated rows count each;
ties between near words go to the smallest in code-point order; a null doc_id
counts as an empty id; empty tables and tables without such words give no rows;
extra columns are not read. Runs of any length are words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bitmaps
from . import words as W
from .storage import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOW = {i: i + 32 for i in range(65, 91)}
_BASE = 0x9E3779B97F4A7C15
#: Letters of one task's table, and letters handled at once, at most.
FLUSH, CELLS = 400_000, 1 << 16


def _low(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_LOW)


def thinned(doc_id: str, run: str, every: int = 31) -> str:
    """The run, or without one code point: that at h % length, where h is the
    crc32 of ``<doc_id>:<run>``, if ``every`` divides h."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    at = h % len(run)
    return run if h % every else run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, min_length: int = 7, change: Callable[[str, str], str] | None = None) -> DataFrame:
    """(word, n) over all texts; ``change(doc_id, run)`` may alter a run first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                for found, n in Counter(RUN.findall(text)).items():
                    if len(found) < min_length:
                        continue
                    word = _low(found)
                    if change is not None:
                        word = change(doc_id or "", word)
                        if len(word) < min_length:
                            continue
                    held[word] = held.get(word, 0) + n
                if len(held) > FLUSH:
                    yield out()
                    held.clear()
        yield out()

    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").where("text is not null")
    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def symbols_for(vocabulary: int, min_length: int) -> int:
    """So many symbols that reduced words of the least length are about eight
    times as many as the words, as if symbols were equally common; 4 to 64."""
    return int(min(64, max(4, np.ceil((8.0 * max(vocabulary, 1)) ** (1 / max(min_length, 1))))))


def reduce_letters(code_points: np.ndarray, symbols: int) -> np.ndarray:
    """1 to ``symbols`` for each code point."""
    mixed = W.mix(code_points.astype(np.uint64) + np.uint64(_BASE))
    return (mixed % np.uint64(symbols)) + np.uint64(1)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indexes, code points): words of one length, ``CELLS`` letters at a time."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        step = max(1, CELLS // max(int(size), 1))
        for a in range(0, len(at), step):
            some = at[a : a + step]
            joined = "".join(words[i] for i in some).encode("utf-32-le")
            yield some, np.frombuffer(joined, np.uint32).reshape(len(some), size)


def _ends(hashed: np.ndarray, length: int) -> np.ndarray:
    return W.mix(hashed + np.uint64(length))


def _around(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words (rows) of symbols: powers of the base, hash before each place
    (times the power it has there), and hash from each place on. A word's hash
    is the sum of symbol * base^(letters after it)."""
    rows, size = letters.shape
    powers = np.ones(size + 2, np.uint64)
    powers[1:] = np.cumprod(np.full(size + 1, _BASE | 1, np.uint64))
    values = letters * powers[size - 1 :: -1][:size]
    before = np.zeros((rows, size + 1), np.uint64)
    before[:, 1:] = np.cumsum(values, axis=1, dtype=np.uint64)
    return powers, before, before[:, -1:] - before


def code(letters: np.ndarray) -> np.ndarray:
    """Hash of each reduced word."""
    return _ends(_around(letters)[1][:, -1], letters.shape[1])


def neighbourhood(letters: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of each reduced word's full neighbourhood of one edit, each
    neighbour once."""
    rows, size = letters.shape
    powers, before, after = _around(letters)
    row = np.broadcast_to(np.arange(rows)[:, None], (rows, size + 1))
    yield row[:, 0], _ends(before[:, -1], size)
    # the base's inverse shifts what stands before a deleted letter down by one place
    down = np.uint64(pow(_BASE | 1, -1, 1 << 64))
    new = np.ones((rows, size), bool)  # of a run of equal letters only the first is deleted
    new[:, 1:] = letters[:, 1:] != letters[:, :-1]
    yield row[:, :-1][new], _ends(before[:, :-1] * down + after[:, 1:], size - 1)[new]
    up = before * np.uint64(_BASE | 1)
    for symbol in range(1, symbols + 1):
        s = np.uint64(symbol)
        other = letters != s
        changed = before[:, -1:] + (s - letters) * powers[size - 1 :: -1][:size]
        yield row[:, :-1][other], _ends(changed, size)[other]
        first = np.ones((rows, size + 1), bool)  # beside an equal letter only in front of it
        first[:, 1:] = other
        yield row[first], _ends(up + s * powers[size::-1][: size + 1] + after, size + 1)[first]


def _with_codes(vocabulary: DataFrame, symbols: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for at, points in _by_length(batch.column("word").to_pylist()):
                out[at] = code(reduce_letters(points, symbols))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(out.view(np.int64))], ["word", "n", "code"])

    return vocabulary.select("word", "n").mapInArrow(run, "word string, n long, code long")


def _neighbours(vocabulary: DataFrame, symbols: int, bitmap: np.ndarray) -> DataFrame:
    """(code, word): the neighbourhoods, without codes that nobody has."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = shared.value
        for batch in batches:
            words = batch.column("word")
            for at, points in _by_length(words.to_pylist()):
                rows, codes = [], []
                for row, hashed in neighbourhood(reduce_letters(points, symbols), symbols):
                    some = bitmaps.found(there, hashed)
                    rows.append(at[row[some]])
                    codes.append(hashed[some])
                codes = np.concatenate(codes)
                yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), words.take(pa.array(np.concatenate(rows)))], ["code", "word"])

    return vocabulary.select("word").mapInArrow(run, "code long, word string")


def near_words(vocabulary: DataFrame, min_length: int = 7) -> DataFrame:
    """(word, near, near_n): each word of ``vocabulary(word, n)`` with each word
    one edit away. ``min_length``: no word is shorter."""
    symbols = symbols_for(vocabulary.count(), min_length)
    coded = written(_with_codes(vocabulary, symbols), "reduced-words")
    around = _neighbours(coded, symbols, bitmaps.occurring(coded, "code"))
    others = coded.select("code", F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = around.join(others, (around["code"] == others["code"]) & (F.levenshtein("word", "near", 1) == 1))
    return pairs.select("word", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: the last form on the way."""
    roots = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        new = written(new, "roots")
        if not new.where("moved").limit(1).count():
            return new.select("word", "root")
        roots = new.select("word", "root")


def variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10, change: Callable[[str, str], str] | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the vocabulary."""
    vocabulary = written(count_words(docs, min_length, change).where(F.col("n") >= min_count), "vocabulary")
    pairs = near_words(vocabulary, min_length)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form")))
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    words = vocabulary.join(near, "word", "left").withColumn("form_n", F.when(-F.col("best.n") >= F.col("n") * ratio, -F.col("best.n")))
    words = words.select(
        "word", F.when(F.col("form_n").isNotNull(), F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
    words = written(words, "words")
    roots = _roots(words.where("form is not null"))
    return words.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
