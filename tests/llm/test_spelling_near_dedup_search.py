"""Spelling variants, b-bit MinHash and lexical search against brute force."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np

from idloom.llm import bitmaps, near_dedup, spelling
from idloom.llm.lexical_search import EXACT, MOST_IMPACT, search, terms, tiles
from idloom.llm.near_dedup import most_differing, near_duplicates
from idloom.llm.spelling import near_words, thinned, variants
from test_join_and_decontamination import classes, shingles

LOW = {i: i + 32 for i in range(65, 91)}


# spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, min_length=7, min_count=2, ratio=10):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    cut = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            cut[w[:i] + w[i + 1 :]].add(w)
    near = collections.defaultdict(set)
    for rest, group in cut.items():
        for a, b in itertools.permutations(group | ({rest} & words.keys()), 2):
            if one_edit(a, b):
                near[a].add(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def test_variants_of_the_small_table(sf_docs):
    rows = [(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in variants(sf_docs, change=thinned).collect()), key=repr)
    assert got == brute_variants(rows)
    assert any(r[1] for r in got) and any(r[4] for r in got)


def test_variants_of_odd_rows(spark, odd):
    long = "ab" * 40_000
    rows = [(1, "Straßen STRASSEN Éléphants Éléphant " * 30), (2, None), (3, ""), (None, "éléphant straxxen " * 3), (None, long + " " + long), (4, long[:-1] + " x " + long[:-1])]
    rows += [(5, "elephantes elephantes elephant elephant ")] * 2 + [(6, "elephant " * 50 + "elephanto elephanto elephantos elephantos")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, word string")
    got = sorted((tuple(r) for r in variants(df, change=thinned).collect()), key=repr)
    assert got == brute_variants(rows)
    assert variants(df.limit(0), change=thinned).count() == 0
    assert variants(odd, change=thinned).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_near_words_do_not_depend_on_the_alphabet(spark, monkeypatch):
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abéz") for _ in range(rnd.randint(1, 7))) for _ in range(400)}
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    want = {(a, b) for a, b in itertools.permutations(words, 2) if one_edit(a, b)}
    for symbols in (1, 2, 9):
        monkeypatch.setattr(spelling, "symbols_for", lambda *_: symbols)
        got = near_words(df, 1).select("word", "near").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_neighbourhoods_are_full_and_without_repeats():
    for letters in itertools.chain.from_iterable(itertools.product((1, 2, 3), repeat=k) for k in (1, 2, 4)):
        row = np.array([letters], np.uint64)
        got = np.concatenate([h for _, h in spelling.neighbourhood(row, 3)])
        around = {letters} | {letters[:i] + letters[i + 1 :] for i in range(len(letters))}
        around |= {letters[:i] + (s,) + letters[i + 1 :] for i in range(len(letters)) for s in (1, 2, 3)}
        around |= {letters[:i] + (s,) + letters[i:] for i in range(len(letters) + 1) for s in (1, 2, 3)}
        want = {int(spelling.code(np.array([a], np.uint64))[0]) if a else int(spelling._ends(np.zeros(1, np.uint64), 0)[0]) for a in around}
        assert len(got) == len(want) and set(got.tolist()) == want


def test_bitmap(spark):
    values = np.random.default_rng(5).integers(-(2**63), 2**63 - 1, 2000)
    df = spark.createDataFrame([(int(v),) for v in values[:1000]], "h long")
    bitmap = bitmaps.occurring(df, "h")
    assert bitmaps.found(bitmap, values[:1000].view(np.uint64)).all()
    assert bitmaps.found(bitmap, values[1000:].view(np.uint64)).sum() < 5
    assert not bitmaps.found(bitmaps.occurring(df.limit(0), "h"), values.view(np.uint64)).any()


# b-bit MinHash


def check_classes(df, n=5, num=85, den=100):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = [(i, k, c, i == c) for i, k, c in classes(rows, n, num, den)]
    got = [tuple(r) for r in near_duplicates(df, n, num, den).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_classes_of_the_small_table(sf_docs):
    check_classes(sf_docs)


def test_classes_of_odd_rows(odd):
    check_classes(odd)
    assert near_duplicates(odd.limit(0)).count() == 0


def test_a_large_group_of_near_copies(spark):
    """Copies that mostly link to some others alone, exact copies among them,
    and a chain whose ends are far apart."""
    rnd = random.Random(11)
    base = [f"w{rnd.randrange(3000)}" for _ in range(150)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(rnd.choice((1, 2, 3, 4))):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    chain = list(base[::-1])
    for i in range(12):
        chain = chain[:]
        chain[i * 12] = f"y{i}"
        rows.append((2000 + i, " ".join(chain)))
    rows += rows[:40]
    check_classes(spark.createDataFrame(rows, "doc_id long, text string"))


def test_copies_that_do_not_link_are_not_paired_with_all(spark, monkeypatch):
    """Two of these copies are about 0.78 similar, which bit counts cannot tell
    from 0.85: 200 of them have 19,900 pairs."""
    rnd = random.Random(12)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(200):
        words = list(base)
        for k in rnd.sample(range(0, 200, 8), 3):
            words[k] = f"x{i}k{k}"
        rows.append((i, " ".join(words)))
    met, write = [], near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, name: (out := write(df, name), met.append((name, out.count())))[0])
    check_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(n for name, n in met if name == "pairs") < 10_000


def test_estimates_follow_similarity():
    rng = np.random.default_rng(1)
    for t in (0.5, 0.85):
        common, own = int(2000 * t), 2000 - int(2000 * t)
        sets = rng.integers(0, 2**63, common + own, dtype=np.uint64)
        a, b = np.sort(sets[: common + own // 2]), np.sort(np.concatenate((sets[:common], sets[common + own // 2 :])))
        _, la = near_dedup.minima(np.zeros(len(a), np.int64), a, 1)
        _, lb = near_dedup.minima(np.zeros(len(b), np.int64), b, 1)
        x, y = near_dedup.packed(la)[0], near_dedup.packed(lb)[0]
        pairs = [((int(p) >> s) & 3, (int(q) >> s) & 3) for p, q in zip(x, y) for s in range(0, 64, 2)]
        share = sum(p == q for p, q in pairs) / 128
        assert abs((share - 0.25) / 0.75 - t) < 0.15
    assert 25 < most_differing(85, 100) < 45


def test_counted_bits_are_places(spark):
    rnd = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, (20, 8))
    df = spark.createDataFrame([tuple(int(x) for x in r) for r in rnd], ", ".join([f"a{i} long" for i in range(4)] + [f"b{i} long" for i in range(4)]))
    got = [r.d for r in df.select(near_dedup.differing("a", "b").alias("d")).collect()]
    u = rnd.view(np.uint64)
    assert got == [sum(((int(r[i]) >> s) & 3) != ((int(r[i + 4]) >> s) & 3) for i in range(4) for s in range(0, 64, 2)) for r in u]


# lexical search


def brute_search(docs, items, k=10):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    held = [(i, collections.Counter(find(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for doc, c in held:
            n = sum(c.values())
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // total)))
                    for t in set(find(text)) if t in c)
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def check_search(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score long, rank int")
    b = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, score long")
    got = sorted((tuple(r) for r in search(d.repartition(3), b, **kw).collect()), key=repr)
    assert got == brute_search(docs, items, kw.get("k", 10))
    return got


def test_search_of_the_small_table(spark, sf_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()]
    rows = [(r.item_id, r.text) for r in items.collect()]
    check_search(spark, docs, rows)
    check_search(spark, docs, rows, k=3, block_bytes=3000)


def test_search_with_ties_and_odd_rows(spark, monkeypatch):
    docs = [(i, "red apple") for i in range(700, 0, -1)] + [(None, "red apple"), (None, None), (5, "red apple"), (1000, "Été RED"), (1001, ""), (1002, " ,.- "), (-3, "apple " * 5000), (1003, "blue")]
    items = [(1, "apple?"), (1, "apple?"), (1, "Été"), (2, None), (3, ""), (4, "zebra"), (None, "RED red"), (7, "red apple blue été")]
    got = check_search(spark, docs, items)
    assert [r[2] for r in got if r[0] is None] != []
    check_search(spark, docs[:690] + docs[690:], items, k=1)
    assert check_search(spark, [], items) == [] and check_search(spark, docs, []) == []


def test_products_stay_exact():
    weights = {t: 30_000 for t in range(4000)}
    held = [list(range(4000)), [5, 7], [], [3999]]
    made = tiles(held, weights)
    assert sorted(i for chosen, _ in made for i in chosen) == [0, 1, 3]
    for chosen, cuts in made:
        assert [t for cut, _ in cuts for t in cut] == list(range(4000))
        assert all(m.sum(axis=1).max() * MOST_IMPACT < EXACT for _, m in cuts)
    huge = tiles([list(range(10))], {t: EXACT // MOST_IMPACT // 4 for t in range(10)})
    assert len(huge[0][1]) > 2


def test_terms():
    assert terms("AÉ b-C_d\x7f9 x".encode()) == ["aÉ".encode(), b"b", b"c", b"d", "9 x".encode()]
    assert shingles("a b", 5) == {("a", "b")}
