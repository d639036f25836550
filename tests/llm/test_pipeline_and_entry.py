"""The pipeline's stages one after the other, and the registered queries."""

import zlib

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from idloom.llm.queries import ORACLES, QUERIES
from test_join_and_decontamination import classes, contained
from test_line_and_substring import by_hand

SF = "/root/testdata/sf0.001"


def test_queries_are_registered_once_each():
    names = list(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, each written and read again."""
    base = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        out[name] = docs = spark.read.parquet(f"{base}/{name}")
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_all_stages_but_the_last_keep_the_columns(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns
        assert stages[name].dtypes == stages["documents"].dtypes


def test_toxic_rows_go(spark, stages):
    kept = {r.doc_id for r in stages["toxicity"].collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, y in truth.items() if not y]
    assert len(set(clean) & kept) >= 0.98 * len(clean)


def test_repeated_lines_go(stages):
    want = by_hand(pairs(stages["toxicity"]))
    got = {r.doc_id: r for r in stages["line_dedup"].collect()}
    assert {(i, r.text) for i, r in got.items()} == {(i, t) for i, _, _, t in want}
    assert all(got[i].n_chars == len(t) for i, _, dropped, t in want if dropped)


def test_one_of_each_group_stays(stages):
    want = {i for i, _, top in classes(pairs(stages["line_dedup"]), 5, 80, 100) if i == top}
    assert {r.doc_id for r in stages["jaccard_join"].collect()} == want


def test_contaminated_rows_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = pairs(stages["jaccard_join"])
    dirty = {h[0] for h in contained(before, items, 5, 0.8)}
    assert {r.doc_id for r in stages["decontamination"].collect()} == {i for i, _ in before} - dirty


def test_what_is_left_is_packed_whole(stages):
    from tokenizers import Tokenizer

    from idloom.llm.packing import public_definition

    t = Tokenizer.from_str(public_definition())
    want = {}
    for i, text in pairs(stages["decontamination"]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 2048):
            piece = ids[k : k + 2048]
            want[(i, k)] = (len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()))
    assert {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in stages["packing"].collect()} == want


def test_stages_take_empty_and_odd_tables(spark, odd, tmp_path):
    from pyspark.sql import functions as F

    docs = odd.select("doc_id", "text", "lang", F.lit(None).cast("string").alias("source"), F.char_length("text").cast("long").alias("n_chars"))
    for name, table in (("odd", docs), ("none", docs.limit(0))):
        for stage, run in corpus_pipeline.STAGES:
            run(spark, table, SF).write.parquet(f"{tmp_path}/{name}-{stage}")
            table = spark.read.parquet(f"{tmp_path}/{name}-{stage}")
        assert (table.count() > 0) == (name == "odd")


def test_columns_that_stages_add_are_the_inputs_own(spark, sf_docs):
    """score, n_lines and n_dropped of the input pass the first stages unchanged."""
    docs = sf_docs.limit(60).selectExpr("*", "doc_id + 0.25 as score", "doc_id + 1 as n_lines", "doc_id + 2 as n_dropped")
    for name, stage in corpus_pipeline.STAGES[:2]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all((r.score, r.n_lines, r.n_dropped) == (r.doc_id + 0.25, r.doc_id + 1, r.doc_id + 2) for r in rows), name
