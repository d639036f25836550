"""Line dedup and substring dedup against plain Python."""

import collections
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from idloom.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines
from idloom.llm.substring_dedup import Chunk, remove_repeats

WHITE = " \t\n\x0b\x0c\r"
LOW = {i: i + 32 for i in range(65, 91)}


def key(line):
    return line.strip(WHITE).translate(LOW)


def by_hand(rows, least=10):
    """(n_lines, n_dropped, text) of each row; a missing id ranks last."""
    last = 1 << 63
    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                held[key(line)].add(last if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < 2 or min(held[key(x)]) == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def order(rows):
    return sorted(rows, key=repr)


def test_lines_of_the_small_table(sf_docs):
    out = dedup_lines(sf_docs)
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()]
    assert order(got) == order(by_hand(rows_of(sf_docs)))
    assert set(sf_docs.columns) < set(out.columns)


def test_lines_of_odd_rows(odd):
    more = odd.unionByName(odd.limit(0))
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in dedup_lines(more).collect()]
    assert order(got) == order(by_hand(rows_of(odd)))
    assert "lang" in dedup_lines(odd).columns


def test_lines_of_an_empty_table(odd):
    assert dedup_lines(odd.limit(0)).count() == 0


def test_a_document_can_leave_and_come_back(spark, sf_docs):
    index = LineIndex(spark, shards=4)
    index.insert(sf_docs.where("doc_id % 2 = 0"))
    index.insert(sf_docs.where("doc_id % 2 = 1"))
    before = {(r.k1, r.k2, r.n, r.doc) for r in index.counts().collect()}
    part = sf_docs.where("doc_id < 60")
    index.delete(part)
    left = sf_docs.where("doc_id >= 60")
    alone = LineIndex(spark, shards=4)
    alone.insert(left)
    want = {(r.k1, r.k2, r.n, r.doc) for r in alone.counts().collect()}
    assert {(r.k1, r.k2, r.n, r.doc) for r in index.counts().collect()} == want
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in index.dedup(left).collect()]
    assert order(got) == order(by_hand(rows_of(left)))
    filters = [CuckooFilter.load(r.blob) for r in index.filters.collect()]
    assert sum(int((f.cells != 0).sum()) + len(f.spare) for f in filters) == len(want)
    index.insert(part)
    assert {(r.k1, r.k2, r.n, r.doc) for r in index.counts().collect()} == before


def test_filters_name_the_keys_that_are_counted(spark, sf_docs):
    want = {(r.k1, r.k2, r.doc) for r in _entered(spark, sf_docs, 1).counts().where("doc < last").collect()}
    for inserts in (1, 3):  # the filters of the first insertion are outgrown by the last
        index = _entered(spark, sf_docs, inserts)
        assert {tuple(r) for r in index.repeated().select("k1", "k2", "keeper").collect()} == want
        hits = {tuple(r) for more in index.hits for r in more.collect()}
        assert {k[:2] for k in want} <= hits
        assert len(hits) < len(want) + 0.01 * index.counts().count()
        index.filters = index.filters.limit(0)  # a lookup in empty filters finds nothing
        assert index._seen(index.counts().select("k1", "k2")).count() == 0
    index.hits = [more.limit(0) for more in index.hits]
    assert index.repeated().count() == 0


def _entered(spark, docs, inserts):
    index = LineIndex(spark, shards=4)
    for i in range(inserts):
        index.insert(docs.where(F.pmod("doc_id", F.lit(inserts)) == i))
    return index


def test_shards_follow_the_keys(spark, sf_docs, monkeypatch):
    monkeypatch.setattr(LineIndex, "SHARD_KEYS", 100)
    index = _entered(spark, sf_docs, 2)
    assert index.shards > 4 and index.filters.count() <= index.shards
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in index.dedup(sf_docs).collect()]
    assert order(got) == order(by_hand(rows_of(sf_docs)))


def test_cuckoo_filter_loses_no_key():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    f = CuckooFilter(np.zeros((1024, 4), np.uint16), np.zeros(0, np.uint64))  # too small: some are kept beside
    f.add(keys)
    assert f.has(keys).all() and len(f.spare)
    f = CuckooFilter.for_keys(len(keys))
    f.add(keys[:4000])
    assert CuckooFilter.load(f.dump()).has(keys[:4000]).all()
    assert f.has(keys[4000:]).mean() < 0.01
    f.remove(keys[:2000])
    assert f.has(keys[2000:4000]).all() and f.has(keys[:2000]).mean() < 0.01


def passages_by_hand(rows, size):
    seen, out = set(), []
    last = 1 << 63
    for i, t in sorted(rows, key=lambda r: last if r[0] is None else r[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            at = tuple(w[k : k + size])
            if at in seen:
                gone[k : k + size] = [True] * size
            seen.add(at)
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def check_passages(df, size):
    got = [(r.doc_id, r.n_words, r.n_removed, r.text) for r in remove_repeats(df, size, chunk_bytes=4000).collect()]
    assert order(got) == order(passages_by_hand(rows_of(df), size))


def test_passages_of_the_small_table(sf_docs):
    check_passages(sf_docs, 20)


def test_passages_overlap_and_repeat_within_a_document(spark):
    w = [f"w{i}" for i in range(40)]
    rows = [
        (4, " ".join(w[:25] + w[5:30])), (3, " ".join(w[3:23])), (9, "a b " * 30), (1, " ".join(["x"] + w[4:24] + ["y"])),
        (7, " ".join(w[:20])), (8, None), (10, ""), (11, " ".join(w[:19])), (12, "\n".join(w)), (13, " ".join(w).upper()),
    ]
    check_passages(spark.createDataFrame(rows, "doc_id long, text string"), 20)
    check_passages(spark.createDataFrame(rows, "doc_id long, text string"), 4)


def test_passages_of_odd_rows(odd):
    distinct = odd.dropDuplicates(["doc_id", "text"]).where("doc_id is not null or text is not null")
    check_passages(distinct, 4)
    assert remove_repeats(odd, 4).count() == odd.count()
    assert remove_repeats(odd.limit(0)).count() == 0


def test_passages_of_repeated_rows(spark):
    text = " ".join(f"r{i}" for i in range(30))
    rows = [(5, text)] * 40 + [(None, "n " + text)] * 40 + [(2, "a b c")] * 3 + [(9, " ".join(f"s{i}" for i in range(25)))]
    for parts in (1, 7):
        check_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), 20)


def test_windows_are_told_apart_by_both_hashes():
    table = pa.table({"doc": [1, 2], "row": [1, 2], "text": [" ".join(f"w{i}" for i in range(8)), " ".join(f"w{i}" for i in range(2, 9))]})
    chunk = Chunk(table, 4, 8)
    told = {int(b): b"\xff" * 8 for b in np.unique(chunk.probes()[1] >> np.uint64(32))}
    starts, hashes, inverse, first = chunk.candidates(told)
    assert hashes.shape == (6, 2) and len(starts) == 9 and len(np.unique(hashes)) == 12
    assert starts[first].tolist() == [starts[np.flatnonzero(inverse == g)[0]] for g in range(6)]


def test_a_third_of_rows_with_one_passage(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("u"), F.col("id"), F.lit(" " + passage))).otherwise(
        F.concat_ws(" ", *[F.concat(F.lit(f"v{k}x"), F.col("id")) for k in range(25)])).alias("text"))
    check_passages(df, 20)
