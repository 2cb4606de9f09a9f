"""Hard negatives, URL aliases and periodic runs against brute-force versions and hard inputs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hoarfrost.llm import negatives, queries
from hoarfrost.llm.aliases import UrlRule, judge_urls
from hoarfrost.llm.runs import SquareCatcher, collapse_runs

FOLDER = "/root/testdata/sf0.001"


# ---- hard negatives ----


def mined(rows, anchors, positives=5, negatives_=5):
    """Rows are (vec_id, label, terms); anchors are their places."""
    out = []
    key = lambda s, j: (-s, rows[j][0] is None, rows[j][0] or 0, j)
    for i in anchors:
        dot = lambda j: sum(int(x) * int(y) for x, y in zip(rows[i][2], rows[j][2]))  # noqa: B023, B905, E731
        scores = {j: dot(j) for j in range(len(rows)) if j != i}
        alike = sorted((j for j in scores if rows[j][1] == rows[i][1]), key=lambda j: key(scores[j], j))[:positives]
        for p in alike:
            fits = [j for j in scores if rows[j][1] != rows[i][1] and 80 * scores[p] <= 100 * scores[j] <= 100 * scores[p]]
            for rank, j in enumerate(sorted(fits, key=lambda j: key(scores[j], j))[:negatives_], 1):
                out.append((rows[i][0], rows[p][0], rank, rows[j][0], scores[p], scores[j]))
    return out


def with_nulls_last(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


@pytest.mark.parametrize(("large", "block"), [(False, 512), (False, 4), (True, 512)])
def test_negatives_equal_brute_force(spark, monkeypatch, large, block):
    random.seed(3)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", block)
    monkeypatch.setattr(negatives, "STEP_ROWS", 50)
    scale = 1 << 40 if large else 1
    kinds = [[random.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    some = []
    for i in range(240):
        center = random.choice(kinds)
        some.append((i if i % 50 else random.choice([7, None]), [scale * (x + random.uniform(-0.2, 0.2)) for x in center], random.randrange(4)))
    some += [(600, some[0][1], 1)] * 3 + [(700, [], 1), (701, [0.5 * scale], 1)]  # repeated rows, empty and short vectors
    odd = [(900, None, 1), (901, [1.0, None], 1), (902, [float("nan")], 1), (903, [float("inf")], 1), (904, [1.0], None)]
    df = spark.createDataFrame([(k, v, label, "x", "y") for k, v, label in some + odd], "vec_id long, v array<double>, label int, score string, anchor string")
    rows = negatives.labelled_terms(df, "v", "vec_id", "label", 256)
    kept = rows.orderBy("row").collect()
    assert len(kept) == len(some)
    plain = [(r.vec_id, r.label, list(r.terms)) for r in kept]
    anchors = [i for i, r in enumerate(kept) if r.vec_id is None or r.vec_id % 6 == 0]
    found = negatives.hard_negatives(rows, rows.where("vec_id IS NULL OR vec_id % 6 = 0"), shard_rows=60)
    want = [(a, p, n, x, min(max(s, -(1 << 63)), (1 << 63) - 1), min(max(t, -(1 << 63)), (1 << 63) - 1)) for a, p, n, x, s, t in mined(plain, anchors)]
    assert with_nulls_last(map(tuple, found.collect())) == with_nulls_last(want)
    assert want
    none = rows.limit(0)
    assert negatives.hard_negatives(none, none).collect() == []
    assert negatives.hard_negatives(rows, none).collect() == []


def test_bounds_hold_and_save_scores():
    rng = np.random.default_rng(4)
    anchors = np.floor(256 * (rng.normal(size=(1, 32)) + 0.02 * rng.normal(size=(64, 32))))
    candidates = np.floor(256 * rng.normal(size=(3000, 32)))
    order, up, edges = negatives.spanning_tree(anchors)
    assert sorted(order.tolist()) == list(range(64)) and up[0] == -1 and (up[1:] < np.arange(1, 64)).all()
    walk = negatives.Walk(anchors[order], up, edges, candidates)
    for at, i in enumerate(order):
        exact = candidates @ anchors[i]
        low = float(np.sort(exact)[-5])
        places, scores = walk.scores(at, np.ones(3000, bool), low, np.inf)
        assert (scores == exact[places]).all() and set(np.flatnonzero(exact >= low)) <= set(places.tolist())
    assert walk.scored < 0.2 * 64 * 3000 and not walk.state


# ---- URLs ----

RULES = [UrlRule("allow", "com", "/"), UrlRule("block", "example.com", "/en/"), UrlRule("block", "net", "/fr/"), UrlRule("block", "bad.org", "")]


def judged(spark, pages, redirects=None):
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, rule string, verdict string")
    told = spark.createDataFrame(redirects, "source string, target string") if redirects else None
    return [tuple(r) for r in judge_urls(df, RULES, redirects=told).orderBy("page_id").select("host", "path", "rule", "verdict", "how").collect()]


def test_rules_and_addresses(spark):
    pages = [None, "", "no address", "http://A.Example.COM/en/x?q#f", "https://example.com/EN/", "x://y.net/fr/://z", "http://net", "http://anet/fr/", "//x.com/", "http://É.com?a=://b", "http://bad.org"]
    assert judged(spark, [(u, None) for u in pages]) == [
        ("", "", None, "allow", "default"), ("", "", None, "allow", "default"), ("", "", None, "allow", "default"),
        ("a.example.com", "/en/x", "example.com/en/", "block", "rule"), ("example.com", "/EN/", "com/", "allow", "rule"),
        ("y.net", "/fr/://z", "net/fr/", "block", "rule"), ("net", "", None, "allow", "default"), ("anet", "/fr/", None, "allow", "default"),
        ("", "", None, "allow", "default"), ("É.com", "", None, "allow", "default"), ("bad.org", "", "bad.org", "block", "rule"),
    ]


def test_decisions_reach_aliases(spark):
    link = '<head><LINK href="{}" rel="alternate  canonical"></head>'
    pages = [
        ("http://a.org/1", link.format("http://example.com/en/1")),  # its canonical address is blocked
        ("http://a.org/2", "<meta content='0; URL=1?x=1&amp;y=2' http-equiv=refresh>"),  # to an alias of that one
        ("https://A.org/z/../1?x=1&y=2#top", link.format("./q/../1")),
        ("http://a.org/3", link.format("http://a.org/4")),  # nothing blocked there
        ("http://a.org/5", "<!-- " + link.format("http://bad.org/") + " --><script>'" + link.format("http://bad.org/") + "'</script>"),
        ("http://b.org/1", link.format("http://bad.org/x")),  # blocked and allowed: allowed
        ("http://b.org/2", '<link rel=canonical href=/1><link rel="stylesheet" href="http://bad.org/">'),
        ("http://bad.org/x", link.format("http://fine.com/")),
        ("http://fine.com/", None),
        ("http://c.org/1", link.format("mailto:x@bad.org") + link.format("#here") + link.format("")),
        ("http://d.org/1", None),  # by the table of redirects
        ("http://d.org/1", None),
        (None, link.format("http://bad.org/")),
        ("http://e.org/" + "x" * 20000, link.format("//y.net/fr/" + "z" * 20000)),
    ]
    found = judged(spark, pages, [("http://d.org/1#f", "http://d.org/2"), ("http://d.org/2", "//bad.org/q"), (None, "http://bad.org/"), ("http://c.org/1", None)])
    assert [(v, how) for _, _, _, v, how in found] == [
        ("block", "alias"), ("block", "alias"), ("block", "alias"), ("allow", "default"), ("allow", "default"),
        ("allow", "default"), ("allow", "default"), ("block", "rule"), ("allow", "rule"), ("allow", "default"),
        ("block", "alias"), ("block", "alias"), ("allow", "default"), ("block", "alias"),
    ]
    assert judged(spark, [("http://x.com/", None)])[0][3] == "allow"
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert judge_urls(df, RULES).collect() == []


def test_a_hub_passes_its_block_on_to_all(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.org/"), "id").alias("url"), F.lit('<link rel="canonical" href="http://bad.org/">').alias("html"))
    assert judge_urls(pages, RULES).groupBy("verdict", "how").count().collect() == [("block", "alias", 3000)]


def test_the_filter_uses_no_python_worker(spark):
    plan = queries.op12_redirect_filter(spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- runs ----


def runs_by_brute_force(words, least, exponent):
    n, seen = len(words), {}
    for q in range(1, n // exponent + 1):
        t = 0
        while t < n - q:
            if words[t] != words[t + q]:
                t += 1
                continue
            a = t
            while t < n - q and words[t] == words[t + q]:
                t += 1
            if t - a + q >= max(least, exponent * q):
                seen.setdefault((a, t + q), q)
    return sorted((a, b - a, q) for (a, b), q in seen.items())


def sequences(seed):
    rng = random.Random(seed)
    yield []
    yield [1] * 700
    yield [bin(i).count("1") & 1 for i in range(300)]
    a, b = [0], [0, 1]
    while len(b) < 250:
        a, b = b, b + a
    yield b
    for _ in range(60):
        out, k = [], rng.choice([1, 2, 3, 50])
        while len(out) < rng.randint(0, 260):
            part = [rng.randrange(k) for _ in range(rng.randint(1, 40))]
            out += (part * rng.randint(1, 12))[: rng.randint(1, 200)]
        yield out


@pytest.mark.parametrize(("least", "exponent", "step"), [(24, 3, 1), (24, 3, 1000), (1, 2, 7), (5, 4, 64)])
def test_squares_are_caught_as_words_come(least, exponent, step):
    for words in sequences(least + step):
        catcher = SquareCatcher(least, exponent)
        for at in range(0, len(words), step):
            catcher.append(np.array(words[at : at + step]))
            if at % (13 * step) == 0:
                assert list(map(tuple, catcher.runs().tolist())) == runs_by_brute_force(words[: at + step], least, exponent)
        assert list(map(tuple, catcher.runs().tolist())) == runs_by_brute_force(words, least, exponent)


def test_hashes_that_meet_make_no_runs(monkeypatch):
    from hoarfrost.llm import runs

    monkeypatch.setattr(runs, "_mix", lambda x: x & np.uint64(1))
    for words in sequences(9):
        catcher = SquareCatcher(3, 2)
        catcher.append(np.array(words, np.int64))
        assert list(map(tuple, catcher.runs().tolist())) == runs_by_brute_force(words, 3, 2)


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_hard_texts(spark):
    texts = ["", None, " \n\t ", "a " * 23, "a " * 24, "a\tb\n" * 50, "x " + "é ß 中 " * 9 + "é y", " ".join(map(str, range(4000))), "b c " * 9000, "one", "a a " * 12 + "b " * 30]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "a " * 24, 1, "x"), (3, "a " * 23, 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int, words string")
    found = [(r.doc_id, r.words, [tuple(x) for x in r.runs], r.collapsed) for r in collapse_runs(df, 24, 3).collect()]
    want = []
    for key, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = runs_by_brute_force(words, 24, 3) if len(words) < 4000 else [(0, 18000, 2)] if words[0] == "b" else []
        want.append((key, len(words), runs, collapsed(words, runs)))
    assert sorted(found, key=str) == sorted(want, key=str)
    assert collapse_runs(df.limit(0), 24, 3).collect() == []


def test_runs_of_the_whole_table(spark):
    want = []
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_by_brute_force(words, 24, 3) if n < 3000 or h % 10 == 0 else None
        if runs is None:
            continue
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        milli = 1000 * best[1] // best[2] if runs else None
        want.append((r.doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest()))
    got = {r[0]: tuple(r) for r in queries.op13_periodic_runs(spark, FOLDER).collect()}
    assert [got[w[0]] for w in want] == want
    assert sum(w[1] > 0 for w in want) > 5
