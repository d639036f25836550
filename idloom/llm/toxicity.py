"""Toxicity scores by logistic regression with FTRL-proximal updates over
hashed word n-grams and skip-grams.

Features of a text: its words (runs of letters, digits and non-ASCII bytes,
A-Z lower-cased), pairs of neighbours, and pairs with one word between, each
hashed to one of 2^18 places and counted once per text. Every place has a
learning rate of its own (from the sum of its squared gradients); the L1 term
keeps weights at exactly 0 until their gradients add up, so that the model is a
small table of places and weights, broadcast to the scoring tasks.

Learning runs on Spark: the labelled rows are dealt to ``workers`` groups, each
learns from the common state, and the states are averaged, ``rounds`` times.
At most about ``max_train_rows`` labelled rows are used, chosen by a hash of
their id; scoring reads every whole text.

Defined results: a null or empty text has no features and gets the score of the
bias alone; labels that are null or repeat for one id are averaged (null: left
out); without any labelled row all weights are 0 and every score is 0.5, which
counts as predicted 0 only below the threshold, so 1 at exactly 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .storage import written

BITS = 18
SIZE = 1 << BITS


@dataclass(frozen=True)
class Params:
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.0
    epochs: int = 2
    rounds: int = 3
    workers: int = 4
    max_train_rows: int = 12000


@dataclass
class Model:
    bias: float
    places: np.ndarray
    weights: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) pairs, each once, ordered by text. ``wanted`` marks the
    places of interest; the others are left out before sorting."""
    w = W.split(data, offsets, W.NOT_ALNUM, W.LOWER)
    owner = np.repeat(np.arange(len(offsets) - 1), w.counts)
    h, n = w.hashes, len(w.hashes)
    parts = [(owner, h)]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if n > gap:
            same = owner[gap:] == owner[:-gap]
            pair = W.mix(h[:-gap] * np.uint64(salt) + h[gap:])
            parts.append((owner[:-gap][same], pair[same]))
    keys = []
    for own, hashed in parts:
        place = (hashed >> np.uint64(64 - BITS)).astype(np.int64)
        if wanted is not None:
            keep = wanted[place]
            own, place = own[keep], place[keep]
        keys.append((own << BITS) | place)
    key = np.unique(np.concatenate(keys))
    return key >> BITS, key & (SIZE - 1)


def _weights(z: np.ndarray, n: np.ndarray, p: Params) -> np.ndarray:
    return np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def _learn(texts: list, labels: np.ndarray, z: np.ndarray, n: np.ndarray, p: Params) -> None:
    """FTRL-proximal over the rows in their order; place SIZE is the bias, which
    has no L1 term. Changes z and n."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    held: list[np.ndarray] = []  # places of each text; features() needs some hundred bytes for each byte of text
    for part in W.slices(batch, "text"):
        own, place = features(*W.text_buffers(part.column("text")))
        held += np.split(place.astype(np.int32), np.searchsorted(own, np.arange(1, part.num_rows)))
    for _ in range(p.epochs):
        for at, y in zip(held, labels):
            w = _weights(z[at], n[at], p)
            bias = -z[SIZE] / ((p.beta + np.sqrt(n[SIZE])) / p.alpha + p.l2)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y
            for k, wk in ((at, w), (SIZE, bias)):
                z[k] += g - (np.sqrt(n[k] + g * g) - np.sqrt(n[k])) / p.alpha * wk
                n[k] += g * g


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is a multiple of 5 (null id: as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """The model from the labelled rows of ``docs(doc_id, text)`` that are not
    held out; ``labels(doc_id, toxic)``."""
    p = params
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.avg(F.col("toxic").cast("double")).alias("y"))
    known = marked.count()
    share = min(1.0, p.max_train_rows / max(known, 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = marked.where(place < int(share * (1 << 30)))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").select(
        "text", "y", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(p.workers)).alias("worker"), F.xxhash64("doc_id", F.lit(11)).alias("turn"))
    z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)
    rows = written(rows, "labelled-rows")  # every round reads them
    spark = docs.sparkSession
    for _ in range(p.rounds):
        state = spark.sparkContext.broadcast((z, n))

        def learn(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["turn", "y"], kind="stable")
            own_z, own_n = (x.copy() for x in state.value)
            _learn(pdf["text"].tolist(), pdf["y"].to_numpy(), own_z, own_n, p)
            at = np.flatnonzero(own_n)
            return pd.DataFrame({"place": at, "z": own_z[at], "n": own_n[at]})

        # one row for each place that any worker touched: at most 2^18 + 1
        learnt = rows.groupBy("worker").applyInPandas(learn, "place long, z double, n double")
        got = learnt.groupBy("place").agg(F.sum("z").alias("z"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).toPandas()
        at = got["place"].to_numpy()
        z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)
        z[at], n[at] = got["z"] / got["k"], got["n"] / got["k"]
        state.unpersist()
    w = _weights(z[:SIZE], n[:SIZE], p)
    places = np.flatnonzero(w)
    if not len(at):
        return Model(-np.inf, places, w[places])
    return Model(float(-z[SIZE] / ((p.beta + np.sqrt(n[SIZE])) / p.alpha + p.l2)), places, w[places])


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the score in front, as column ``name``; no shuffle. A
    column of ``docs`` of that name is left out."""
    rest = [c for c in docs.columns if c.lower() != name.lower()]
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.places, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, places, weights = shared.value
        w = np.zeros(SIZE)
        w[places] = weights
        wanted = w != 0
        for batch in batches:
            for part in W.slices(batch, "text"):
                data, offsets = W.text_buffers(part.column("text"))
                own, place = features(data, offsets, wanted)
                total = np.bincount(own, w[place], minlength=part.num_rows) + bias
                s = np.where(np.isneginf(total), 0.0, 1 / (1 + np.exp(-np.clip(total, -35, 35))))
                yield pa.RecordBatch.from_arrays([pa.array(s), *(part.column(c) for c in rest)], [name, *rest])

    schema = docs.select(*rest).schema
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return docs.select(*rest).mapInArrow(run, f"`{name}` double, {names}")


def classify(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, params))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
