"""Vector and url operators against brute force, with unusable vectors, ties and repeated rows."""

from __future__ import annotations

import numpy as np
import pytest

from weftlink.llm import ann, url_filter, vector_dedup
from weftlink.llm.common import connected_components

VECTORS = "vec_id long, embedding array<float>, label int, score string"


def table(spark, seed=0, n=300):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 8)).astype(np.float32)
    x[50:90] = x[50] + r.normal(scale=0.05, size=(40, 8)).astype(np.float32)
    x[100:130] = x[100]
    rows = [(i, v.tolist(), i % 3 if i % 17 else None, "x") for i, v in enumerate(x)]
    rows += [(400, None, 1, "x"), (401, [0.0] * 8, 1, "x"), (402, [float("nan")] + [1.0] * 7, 1, "x"), (403, [1.0, None] + [1.0] * 6, 1, "x"), (420, [1.0, 2.0], 1, "x"), (440, [float("inf")] * 8, 1, "x")]
    return spark.createDataFrame(rows, VECTORS), x, rows


@pytest.mark.parametrize("factor", [1.0, 3.0])
def test_search_against_force(spark, factor):
    df, x, _ = table(spark)
    got = ann.nearest(df, k=5, every=20, factor=factor, shard_rows=64, block_rows=8).collect()
    x = x.astype(float)
    hits = 0
    for q in range(0, 300, 20):
        score = ann.dot_in_order(np.broadcast_to(x[q], x.shape), x)
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-score[i], i))[:5]
        mine = [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)]
        hits += len({m[0] for m in mine} & set(best))
        if factor == 1:
            assert mine == [(i, score[i]) for i in best]
    assert len(got) == 75 and hits >= 0.9 * 75
    assert ann.nearest(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["binary", "one-hot", "outlier", "repeats"])
def test_shard_search_keeps_whole_ties(kind):
    r = np.random.default_rng(12)
    x = {"binary": lambda: r.integers(0, 2, (1500, 12)), "one-hot": lambda: np.eye(900, 900), "outlier": lambda: r.normal(size=(1500, 12)), "repeats": lambda: r.integers(0, 2, (1500, 12))}[kind]().astype(float)
    ids = r.permutation(len(x)).astype(np.int64)
    if kind == "outlier":
        x[7] *= 1e8 / np.linalg.norm(x[7])
    if kind == "repeats":
        ids[:60] = 20
    q = np.flatnonzero(ids % 20 == 0)
    got = list(ann.search_shard(x, ids, x[q], ids[q], 20, 1.0, float(np.sqrt((x**2).sum(1).max()))))
    for row, (name, found, scores) in zip(q, got, strict=True):
        score = ann.dot_in_order(np.broadcast_to(x[row], x.shape), x)
        best = sorted((i for i in range(len(x)) if ids[i] != name), key=lambda i: (-score[i], ids[i]))[:20]
        assert (name, found.tolist(), scores.tolist()) == (ids[row], ids[best].tolist(), score[best].tolist())


def test_vector_duplicates_against_force(spark):
    df, x, rows = table(spark)
    got = {r.vec_id: tuple(r)[1:] for r in vector_dedup.near_duplicates(df, cell_rows=8, block_rows=16, guest_rows=16).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    cos = u @ u.T
    label = [r[2] for r in rows[:300]]
    link = [[j for j in range(300) if j != i and label[i] is not None and label[i] == label[j] and cos[i, j] >= 0.93] for i in range(300)]
    root = list(range(300))
    for _ in range(300):
        new = [min([root[i], *(root[j] for j in link[i])]) for i in range(300)]
        if new == root:
            break
        root = new
    for i in range(300):
        assert got[i] == (len(link[i]), root[i], root[i] == i)
    assert all(got[i] == (0, i, True) for i in (400, 401, 402, 403, 420, 440))
    assert vector_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_urls(spark):
    link = '<html><LINK rel="canonical" href="{}"></html>'
    rows = [
        (1, "http://a.net/fr/x", "<p>", "v"),
        (2, "http://alias.org/1#top", link.format("http://a.net/fr/x"), "v"),
        (3, "http://other.org/2", "<meta http-equiv='refresh' content='0; url=http://alias.org/1'>", "v"),
        (4, "HTTPS://WWW.example.COM/en/a?q", None, "v"),
        (5, "http://example.com/en/", "<p>", "v"),
        (6, "http://mixed.org/", link.format("http://shop.com/ok"), "v"),
        (7, "http://shop.com/ok", link.format("http://b.net/es/"), "v"),
        (8, None, None, "v"),
        (9, "no scheme", "<p>", "v"),
        (10, "http://plain.org", link.format("/self"), "v"),
        (10, "http://plain.org", link.format("/self"), "v"),
        (11, "http://notcom/", "<p>", "v"),
    ]
    got = [tuple(r) for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")).collect()]
    verdicts = {r[0]: (r[3], r[4]) for r in got}
    assert len(got) == len(rows)
    assert verdicts == {
        1: ("net/fr/", "block"), 2: (None, "block"), 3: (None, "block"), 4: ("www.example.com/en/", "allow"), 5: ("example.com/en/", "block"), 6: (None, "allow"),
        7: ("com/", "allow"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"),
    }
    assert {r[0]: r[1:3] for r in got}[4] == ("www.example.com", "/en/a")
    rules = spark.createDataFrame([(v, r) for v, r in url_filter.RULES], "verdict string, rule string")
    from pyspark.sql import functions as F

    urls = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string").select(F.col("page_id").alias("key"), url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path")).distinct()
    assert {r.key: (r.rule, r.verdict) for r in url_filter.rule_join(urls, rules).collect()} == {k: v for k, v in verdicts.items() if v[0]}


def test_vector_duplicates_send_a_point_once_a_region(spark, monkeypatch):
    """Rows that the comparing tasks get, and no vector in the join that tells each row of its point."""
    from weftlink.llm import vector_dedup

    seen = []
    cut = vector_dedup.cut
    monkeypatch.setattr(vector_dedup, "cut", lambda df: seen.append(cut(df)) or seen[-1])
    r = np.random.default_rng(3)
    rows = [(i, [float(v) for v in r.normal(size=16)], 1) for i in range(600)]
    df = spark.createDataFrame(rows + [(600 + i, rows[i][1], 1) for i in range(600)], "vec_id long, embedding array<float>, label int")
    got = vector_dedup.near_duplicates(df, cell_rows=8)
    indexed = next(x for x in seen if "visits" in x.columns)
    assert indexed.selectExpr("max(size(visits))").first()[0] == 1  # one region holds all 600 points
    assert "embedding" not in [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line][0]
    assert {(x.vec_id % 600, x.n_links, x.component_id) for x in got.collect()} == {(i, 1, i) for i in range(600)}
