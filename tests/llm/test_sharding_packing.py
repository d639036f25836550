"""Sharding against the published loop, packing against the tokenizer."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from idloom.llm.packing import ChunkEncoder, pack, plan, public_definition
from idloom.llm.sharding import jump_hash, shard_documents

MASK = (1 << 64) - 1


def jump(key, n):
    key, b, j = (key or 0) & MASK, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & MASK
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 16, 100])
def test_jump_hash_is_the_published_one(spark, shards):
    keys = [None, 0, 1, -1, 2**63 - 1, -(2**63), *range(2, 200), *(k * 7919**4 for k in range(50))]
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump_hash(F.col("k"), shards).alias("j"))
    for r in df.collect():
        assert (r.j.shard, r.j.grown) == (jump(r.k, shards), jump(r.k, shards + 1))
        assert r.j.grown in (r.j.shard, shards)


def test_shards_of_odd_rows(odd, sf_docs):
    for df in (odd, sf_docs, odd.limit(0)):
        rows = df.select("doc_id", "text").collect()
        got = shard_documents(df, buckets=4).collect()
        want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()), jump(r.doc_id, 16), jump(r.doc_id, 17)) for r in rows)
        assert collections.Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == want
        by = collections.defaultdict(list)
        for r in got:
            by[r.shard].append(r.slot)
        assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_no_python_on_the_way(sf_docs):
    plan_ = shard_documents(sf_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan_ and "Arrow" not in plan_


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(public_definition())


def test_ids_are_the_tokenizers(tokenizer):
    rng = np.random.default_rng(3)
    letters = [*"abAB \t\n\r\x0b\x0c\x1c\x85\xa0 éÉßİΣσς'.,123$́e　字", "<|endoftext|>", " 's", "́ ́", "Wörter "]
    texts = ["".join(rng.choice(letters, rng.integers(30))) for _ in range(600)] + ["", " "]
    encoder = ChunkEncoder(public_definition(), keep=50)
    got = [np.frombuffer(b, "<u4").tolist() for i in range(0, len(texts), 7) for b in encoder.encode(texts[i : i + 7])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def check_packing(df, tokenizer, capacity, most_padding=None):
    rows = df.select("doc_id", "text").collect()
    got = pack(df, public_definition(), capacity, buckets=4, with_ids=True).collect()
    want = collections.Counter()
    for r in rows:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), capacity):
            piece = np.array(ids[start : start + capacity], "<u4").tobytes()
            want[(r.doc_id, start, len(piece) // 4, zlib.crc32(piece), len(ids), piece)] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.ids)) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    if most_padding is not None:
        assert sum(r.length for r in got) >= (1 - most_padding) * capacity * len(by)


def test_packing_the_small_table(sf_docs, tokenizer):
    check_packing(sf_docs, tokenizer, 2048, 0.03)


def test_packing_odd_rows(odd, tokenizer):
    check_packing(odd, tokenizer, 16)
    check_packing(odd.limit(0), tokenizer, 2048)


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(1)
    for histogram in ({}, {256: 5}, {1: 1}, {200: 7, 57: 3}, {int(c): int(n) for c, n in zip(range(1, 101), rng.integers(0, 300, 100))}):
        rows = plan(histogram, 256)
        placed, load = collections.Counter(), collections.Counter()
        for c, lo, hi, each, first in rows:
            assert lo == placed[c]
            placed[c] = hi
            for rank in range(lo, hi):
                load[first + (rank - lo) // each] += c
        assert dict(placed) == {c: n for c, n in histogram.items() if n}
        assert not load or max(load.values()) <= 256
        total = sum(c * n for c, n in histogram.items())
        if total > 256 * 200:
            assert len(load) <= 1.01 * total / 256 + 2


def test_what_comes_up_again_is_not_learned_anew(tokenizer):
    encoder = ChunkEncoder(public_definition(), keep=40)
    learned, learn = [], encoder._learn
    encoder._learn = lambda new: (learned.extend(new), learn(new))
    texts = [" ".join(["everywhere", "again", *(f"once{i}x{k}" for k in range(9))]) for i in range(30)]
    got = [np.frombuffer(encoder.encode([t])[0], "<u4").tolist() for t in texts]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert learned.count("everywhere") == learned.count("again") == 1
    assert len(encoder.chunks) <= 50 and len(encoder.past_chunks) <= 50


def test_a_word_is_learned_once_whatever_is_around_it(tokenizer):
    encoder = ChunkEncoder(public_definition())
    learned, learn = [], encoder._learn
    encoder._learn = lambda new: (learned.extend(new), learn(new))
    texts = ["woodland", "Woodland, WOODLAND;", "(woodland) ###woodland$$$", "woodland2 'woodland'", "J\u030c j\u030c Ì I\u0307, it's <|endoftext|>, IT'S"]
    got = [np.frombuffer(encoder.encode([t])[0], "<u4").tolist() for t in texts]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [c for c in learned if "woodland" in c.lower()] == ["woodland", "'woodland'"]


def test_remembered_chunks_and_words_are_bounded_together(tokenizer):
    encoder = ChunkEncoder(public_definition(), keep=300)
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k % 26)}'{chr(97 + k // 26)}q," for k in range(50)) for i in range(60)]
    got = [np.frombuffer(encoder.encode([t])[0], "<u4").tolist() for t in texts]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    held = [v for v in vars(encoder).values() if isinstance(v, dict)]
    assert max(map(len, held)) <= 500 and sum(map(len, held)) <= 1000  # two generations, words among the chunks
