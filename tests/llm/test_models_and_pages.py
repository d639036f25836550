"""Toxicity, HTML extraction, URL filter and neighbour search."""

import collections
import re
import time
import zlib

import numpy as np
import pytest

from idloom.llm import html_extract, toxicity, url_filter
from idloom.llm.ann import nearest


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(got[i].score, y) for i, y in truth.items() if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in truth)
    pos, neg = (np.array([s for s, y in held if y == v]) for v in (1, 0))
    auc = (pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2
    assert auc > 0.97
    assert (pos >= 0.5).mean() > 0.75 and (neg >= 0.5).mean() < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 0, 1), (6, 0, None), (None, 0, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4)}) == 1  # no words
    none = toxicity.classify(odd, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert toxicity.classify(odd.limit(0), labels).count() == 0


def test_toxicity_model_is_small(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    assert len(toxicity.train(docs, labels).places) < 5000


def by_hand(page):
    """Blocks of the one article of the test tables' pages."""
    m = re.search(r"<article>(.*)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1)[^>]*>", m[1]) if m else []
    from html import unescape

    texts = (" ".join(unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    got = html_extract.main_text(pages).collect()
    assert len(got) == len(html)
    for r in got:
        assert r.text == by_hand(html[r.page_id]) and r.n_chars == len(r.text)


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p><article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<!-- <p>no</p> --><div class="ad">buy</div><div id=sidebar><p>side text</p></div>
<article><h1>Head &amp; line</h1><p>One <b>two</b>&nbsp;three<br>four
   five<p>Six &lt;seven&gt; <a href="/x">eight</a> 1 < 2<ul><li>i1<li>i2</ul>
<aside>beside</aside><form><input value="v">sign up</form><div class="comments"><p>a comment</p></div><style>p{}</style>
<table><tr><td>c1<td>c2</table></article><footer>&copy; f</footer></body></html>"""


def test_parts_of_a_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = html_extract.Model(html_extract.train(pages))
    got = html_extract.main_texts([PAGE, "", "<", "plain", "<p>a<p", "</p></div>x", "<article><p>only"], model)
    assert got[0].split("\n") == ["Head & line", "One two three four five", "Six <seven> eight 1 < 2", "i1", "i2", "c1", "c2"]
    assert got[1] == got[2] == "" and got[6] == "only"


def test_names_on_the_frame_of_a_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = html_extract.Model(html_extract.train(pages))
    body = "<p>One two three four five six.</p><p>Seven eight nine ten.</p>"
    want = "One two three four five six.\nSeven eight nine ten."
    aside = '<div class="comments"><p>a comment</p></div>'
    framed = [
        f'<html class="no-search"><body class="page no-sidebar"><nav>n</nav><article>{body}{aside}</article></body></html>',
        f'<body class="search-results"><article class="post has-comments" id="ad">{body}{aside}</article></body>',
        f'<body><form action="/"><div class="has-sidebar"><article>{body}{aside}</article></div><input></form></body>',
        f'<body><main class="notice"><article class="post has-comments"><div class="share">{body}</div></article></main>{aside}</body>',
        f'<body><article>{body}<p data-role="search" data-id="ad">data</p></article></body>',
        f'<body><article>{body}</article><ol class="comments"><li><article class="comment">{"a long comment " * 9}</article></ol></body>',
        f'<body><article>{body}</article><div class="related"><article>teaser</article></div><form>sign up</form></body>',
    ]
    assert html_extract.main_texts(framed, model) == [want] * 4 + [want + "\ndata"] + [want] * 2
    for page in (f'<body><div class="no-sidebar">{body}</div></body>', f'<body><form>{body}</form></body>'):
        assert not html_extract.barred(html_extract.Tree(page)).any()  # left to the marginals
    learnt = html_extract.labels(html_extract.Tree(framed[1]))
    assert learnt.sum() == 3  # the article and its paragraphs


def test_long_odd_pages_take_little_time():
    """What made the parser walk over open elements or to the end again and again."""
    n = 1 << 16
    bricks = ["<span>", "<a ", "<p><span><div>", "<span></b>", "<table><span></i>", "<hr><b>", "< ", "</script ", "<td><p>", "<li><i>", '<a x="', "<!--", "<x =' ", "<ul><li>"]
    for brick in bricks:
        for before in ("", "<b><i>", "<script>"):
            start = time.process_time()
            tree = html_extract.Tree(before + brick * (n // len(brick)) + "end")
            assert time.process_time() - start < 3, brick
            assert max(_depths(tree)) <= html_extract.DEEPEST + 1


def _depths(tree):
    out = [0]
    for p in tree.parents[1:]:
        out.append(out[p] + 1)
    return out


def test_tags_without_an_end_and_deep_pages():
    texts = lambda page: [t for _, t in html_extract.Tree(page).texts if t]
    assert texts("<p>one</p><a two <b three") == ["one", "<a two <b three"]
    assert texts("1 < 2 <3 <p>four") == ["1 < 2 <3 ", "four"]
    assert texts("<script>no</script >yes<style>no</stylex></style/>also") == ["yes", "also"]
    deep = html_extract.Tree("<div>" * 2000 + "x" + "</div>" * 2000 + "<p>y")
    assert [t for _, t in deep.texts if t] == ["x", "y"] and max(_depths(deep)) == html_extract.DEEPEST


def test_odd_quotes():
    texts = lambda page: [t for _, t in html_extract.Tree(page).texts if t]
    assert texts("<p data-t=it's>one</p><p>two isn't three</p>") == ["one", "two isn't three"]
    assert texts("""<a href="x"">one</a> "two\"""") == ["one", ' "two"']
    assert texts("""<a title="a > b" href='c > d' rel = "e>f">one</a>""") == ["one"]
    assert texts("""<p title="open>one</p>""") == ["one"]


def test_marginals_are_exact():
    """Message passing against the sum over all labellings."""
    rng = np.random.default_rng(2)
    counts = rng.integers(1, 50, html_extract._COUNTS).astype(float)
    model = html_extract.Model(counts)
    parents = np.array([-1, 0, 0, 1, 1, 2, -1, 6])
    odds = rng.normal(size=8)
    got = model.marginals(parents, odds)
    total, per = 0.0, np.zeros(8)
    for y in np.ndindex(*[2] * 8):
        weight = sum(odds[i] * y[i] + (model.root[y[i]] if p < 0 else model.pair[y[p], y[i]]) for i, p in enumerate(parents))
        total += np.exp(weight)
        per += np.exp(weight) * np.array(y)
    assert np.allclose(got, per / total)


def test_odd_pages(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", PAGE, "x"), (None, "u", PAGE, "x"), (3, "u", "<article><p>" + "long " * 200000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.main_text(pages).collect()
    assert collections.Counter(r.page_id for r in got) == collections.Counter(r[0] for r in rows)
    assert {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert next(r for r in got if r.page_id == 3).n_chars == 999999
    assert html_extract.main_text(pages.limit(0)).count() == 0


RULES = [url_filter.Rule("allow", "com"), url_filter.Rule("block", "a.com", "/en/"), url_filter.Rule("allow", "www.a.com", "/en/"), url_filter.Rule("block", "net", "/x/")]


def test_urls_and_rules(spark):
    urls = {
        1: ("http://WWW.A.com/en/1?x#y", "www.a.com", "/en/1", "www.a.com/en/", "allow"),
        2: ("https://b.a.com/en/", "b.a.com", "/en/", "a.com/en/", "block"),
        3: ("ftp://xa.com/en/1", "xa.com", "/en/1", "com/", "allow"),
        4: ("http://com", "com", "", None, "allow"),
        5: (None, "", "", None, "allow"),
        6: ("no scheme/a", "", "", None, "allow"),
        7: ("http://É.net/x/://z", "É.net", "/x/://z", "net/x/", "block"),
        8: ("http:///en/", "", "/en/", None, "allow"),
        9: ("http://q.org?a/b", "q.org", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u[0], None, "clash") for i, u in urls.items()], "page_id long, url string, html string, host string")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge(pages, RULES).collect()}
    assert got == {i: u[1:] for i, u in urls.items()}
    assert url_filter.judge(pages.limit(0), RULES).count() == 0


def test_trust_follows_links_and_distrust_goes_against_them(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/">x</a>' for h in hosts)
    rows = [
        (1, "http://good.com/", link("near.org", "good.com")), (2, "http://bad.net/x/1", link("near.org")), (3, "http://near.org/p", link("far.org") + '<a href="/local">y</a>'),
        (4, "http://far.org/p", ""), (5, "http://shill.org/p", link("bad.net", "bad.net")), (6, "http://alone.org/", None), (7, "http://bad.net/other", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, RULES).collect()}
    assert got == {1: "allow", 2: "block", 3: "allow", 4: "allow", 5: "block", 6: "allow", 7: "block"}
    edges = {tuple(r) for r in url_filter.host_edges(pages.withColumn("host", url_filter.url_host("url"))).collect()}
    assert edges == {("good.com", "near.org"), ("bad.net", "near.org"), ("near.org", "far.org"), ("shill.org", "bad.net")}


def test_trust_reaches_hosts_at_any_distance(spark):
    """Hosts that each link to the next, the last to a blocked one; and links that are none."""
    link = lambda h: f'<a class="x" href="http:&#47;&#x2f;{h}/">x</a>'
    rows = [(0, "http://bad.net/x/1", "")] + [(k, f"http://h{k}.org/", link("bad.net" if k == 1 else f"h{k - 1}.org")) for k in range(1, 25)]
    rows += [(31, "http://c.org/", "<!-- " + link("bad.net") + " -->"), (32, "http://d.org/", '<a data-href="http://bad.net/">x</a>')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, RULES, damping=0.3).collect()}
    assert got == {r[0]: "allow" if r[0] > 30 else "block" for r in rows}


def test_pagerank_by_hand(spark):
    edges = [("t", "a", "b"), ("t", "b", "c"), ("t", "c", "a"), ("t", "a", "c")]
    e = spark.createDataFrame(edges, "kind string, src string, dst string")
    s = spark.createDataFrame([("t", "a", 3.0), ("t", "d", 1.0)], "kind string, host string, weight double")
    got = {r.host: r.score for r in url_filter.spread(e, s, steps=60, tolerance=1e-12).collect()}
    hosts, start = "abcd", np.array([0.75, 0, 0, 0.25])
    move = np.zeros((4, 4))
    for a, b, share in (("a", "b", 0.5), ("a", "c", 0.5), ("b", "c", 1.0), ("c", "a", 1.0)):
        move[hosts.index(a), hosts.index(b)] = share
    x = start.copy()
    for _ in range(200):
        moved = 0.85 * x @ move
        x = moved + start * (1 - moved.sum())
    assert all(abs(got.get(h, 0) - v) < 1e-6 for h, v in zip(hosts, x))


def check_neighbours(rows, results, least, **options):
    got = collections.defaultdict(list)
    for r in nearest(rows, 50, results, **options).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = [(r.vec_id, np.array(r.embedding, float)) for r in rows.collect()
            if r.vec_id is not None and r.embedding is not None and None not in r.embedding and len(r.embedding) == 8
            and np.isfinite(r.embedding).all() and np.any(r.embedding)]
    queries = [(i, v) for i, v in good if i % 50 == 0]
    assert set(got) == ({i for i, _ in queries} if len(good) > 1 else set())
    found = total = 0
    for i, v in queries:
        scores = sorted((-float(v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)), j) for j, w in good if j != i)
        best = scores[:results]
        assert [g[0] for g in got[i]] == list(range(1, len(best) + 1))
        assert [(-g[2], g[1]) for g in got[i]] == sorted((-g[2], g[1]) for g in got[i])
        own = dict((j, -s) for s, j in scores)
        assert all(abs(own[j] - s) < 1e-12 for _, j, s in got[i])
        found += len({j for _, j in best} & {g[1] for g in got[i]})
        total += len(best)
    assert found >= least * total


def vectors(spark, values):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in values], "vec_id long, embedding array<float>, label int")


def test_neighbours_of_random_vectors(spark):
    x = np.random.default_rng(4).normal(size=(600, 8))
    check_neighbours(vectors(spark, enumerate(x)), 5, 0.97, block=64, degree=10, beam=30)


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_neighbours_of_few_vectors(spark, n):
    x = np.random.default_rng(6).normal(size=(n, 8))
    check_neighbours(vectors(spark, [(50 * i, v) for i, v in enumerate(x)]), 5, 1.0)


def test_neighbours_with_copies_and_bad_vectors(spark):
    x = np.random.default_rng(8).normal(size=(150, 8)).astype(np.float32)
    x[::3] = x[0]  # a third of all rows is one vector
    bad = [(5000, None), (5050, [0] * 8), (5100, [float("nan")] * 8), (5150, [1, None, 1, 1, 1, 1, 1, 1]), (5200, [float("inf")] * 8), (5250, [1, 2]), (None, [1] * 8)]
    check_neighbours(vectors(spark, [*enumerate(x), *bad]), 5, 0.95, block=64, degree=10, beam=30)


def test_neighbours_in_a_group_of_near_copies(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(500, 8))
    x[::2] = x[0] + 1e-4 * rng.normal(size=(250, 8))  # cosines that differ from 1 by about 1e-8
    check_neighbours(vectors(spark, enumerate(x)), 5, 0.95, block=64, degree=10, beam=30)


def test_neighbours_with_repeated_ids(spark):
    a, b, c = [1, 0, 0, 0, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0, 0, 0], [0, 0, 1, 0, 0, 0, 0, 0]
    rows = vectors(spark, [*[(1, a)] * 7, (2, a), (50, a), (50, a), (3, b), (3, b), (100, b), (100, c)])
    got = collections.defaultdict(list)
    for r in nearest(rows, 50, 8).collect():
        got[r.query_id].append((r["rank"], r.vec_id, round(r.score, 6)))
    half = round(0.5**0.5, 6)
    assert sorted(got[50]) == [*[(i, 1, 1.0) for i in range(1, 8)], (8, 2, 1.0)]
    first = [(1, 3, 1.0), (2, 3, 1.0), *[(i, 1, half) for i in range(3, 9)]]
    second = [*[(i, 1, 0.0) for i in range(1, 8)], (8, 2, 0.0)]  # its other row asks for itself
    assert sorted(got[100]) == sorted(first + second)
    few = nearest(vectors(spark, [*[(1, a)] * 7, (2, a), (50, b), (100, a)]), 50, 5).where("query_id = 100")
    assert [r.vec_id for r in few.orderBy("rank").collect()] == [1] * 5
    asked = nearest(vectors(spark, [*[(50, a)] * 7, (2, a), (3, b)]), 50, 5)
    assert [r.vec_id for r in asked.orderBy("rank").collect()] == [2, 3]


def test_learning_is_ftrl_proximal(spark):
    """One worker and one round against the updates in plain Python."""
    import math

    import pyarrow as pa

    from idloom.llm import toxicity
    from idloom.llm import words as W

    rnd = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rnd.integers(0, 30, 12)) for _ in range(40)] + ["", None]
    labels = np.array([float(t is not None and "w3 " in t) for t in texts])
    p = toxicity.Params(l1=0.3, epochs=2)
    z, n = np.zeros(toxicity.SIZE + 1), np.zeros(toxicity.SIZE + 1)
    toxicity._learn(texts, labels, z, n, p)
    sum_z, sum_n = {}, {}
    weight = lambda k, l1: 0.0 if abs(sum_z.get(k, 0.0)) <= l1 else -(sum_z[k] - math.copysign(l1, sum_z[k])) / ((p.beta + math.sqrt(sum_n[k])) / p.alpha + p.l2)
    for _ in range(p.epochs):
        for text, y in zip(texts, labels):
            _, places = toxicity.features(*W.text_buffers(pa.array([text], pa.string())))
            w = {k: weight(k, p.l1) for k in places.tolist()} | {"bias": weight("bias", 0.0)}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for k, v in w.items():
                before = sum_n.get(k, 0.0)
                sum_z[k] = sum_z.get(k, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / p.alpha * v
                sum_n[k] = before + g * g
    for k, v in sum_z.items():
        at = toxicity.SIZE if k == "bias" else k
        assert abs(z[at] - v) < 1e-9 and abs(n[at] - sum_n[k]) < 1e-9
    assert (n > 0).sum() == len(sum_n)
