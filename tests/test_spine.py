from helpers import ts
from idloom.operators.spine import creator_spine

OBS = "tiktok_id string, handle_name string, source_table string, created_at timestamp_ntz, updated_at timestamp_ntz"


def spine_rows(spark, rows):
    o = spark.createDataFrame([(i, h, "t", ts(c), None) for i, h, c in rows], OBS)
    return sorted([tuple(r) for r in creator_spine(o).collect()], key=str)


def test_f8_superseded_id_absent(spark):
    r = spine_rows(spark, [("A", "h", "2024-01-01"), ("B", "h", "2024-02-01")])
    assert [x[1] for x in r] == ["B"]


def test_f9_multi_handle_id_twice(spark):
    r = spine_rows(spark, [("A", "h1", "2024-01-01"), ("A", "h2", "2024-01-02")])
    assert [(x[0], x[2]) for x in r] == [("A", "h1"), ("A", "h2")]


def test_f10_handle_without_id(spark):
    import hashlib
    r = spine_rows(spark, [(None, "solo", "2024-01-01")])
    key = "h_" + hashlib.md5(b"solo").hexdigest()
    assert r == [(key, None, "solo", True, False, key, ts("2024-01-01"))]


def test_id_without_handle(spark):
    r = spine_rows(spark, [("Z", None, "2024-01-03"), ("Z", None, "2024-01-01")])
    assert r == [("Z", "Z", None, False, True, None, ts("2024-01-01"))]


def test_parts_disjoint(spark):
    r = spine_rows(spark, [("A", "h", "2024-01-01"), ("Z", None, "2024-01-01"), (None, "q", None),
                           (None, "h", "2024-01-01"), ("A", None, "2024-01-01")])
    # A has a handle somewhere, so it is not in the id-only part; h has an id.
    assert sorted(((x[1], x[2], x[3], x[4]) for x in r), key=str) == sorted(
        [("A", "h", False, False), ("Z", None, False, True), (None, "q", True, False)], key=str)


def test_ordered_spine(spark):
    from idloom.config import PipelineConfig
    o = spark.createDataFrame([(i, h, "t", ts(c), None) for i, h, c in [
        (None, "zz", "2024-01-01"), ("B", "b", "2024-01-01"), ("Z", None, "2024-01-01"),
        ("A", "a", "2024-01-01")]], OBS)
    got = [(r.tiktok_id, r.handle) for r in creator_spine(o, PipelineConfig(ordered=True)).collect()]
    assert got == [("A", "a"), ("B", "b"), ("Z", None), (None, "zz")]


def test_spine_strategies_agree_on_adapters(spark):
    from idloom.config import PipelineConfig
    from idloom.plans.catalog import _pipe
    a = _pipe(spark, "/root/testdata/sf0.001", PipelineConfig(scan_strategy="buckets")).spine
    b = _pipe(spark, "/root/testdata/sf0.001", PipelineConfig(scan_strategy="window")).spine
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
